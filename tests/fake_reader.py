"""A reader of reports that are JSON: a list of pages."""

import json


class FakeReader:
    def pages(self, data):
        for p in json.loads(data):
            if p == "broken":
                raise ValueError("the file ends here")
            yield p

    def text(self, page):
        return page["text"]

    def size(self, page):
        return 595.0, 842.0

    def words(self, page):
        out = []
        for i, line in enumerate(page["text"].split("\n")):
            out.append((line, 60.0, 60.0 + 9 * len(line), 80.0 + 15 * i, 90.0 + 15 * i))
        return out

    def tables(self, page):
        if page.get("tables") == "bad":
            raise RuntimeError("no tables here")
        return [(300.0, 600.0, 500.0, 700.0, t) for t in page.get("tables", [])]
