"""Files to documents by a fake reader, what fails on the way, and the command line."""

import json

import pytest

from pagewright import __main__ as cli
from pagewright.session import ensure_checkpoint_dir
from pagewright.sources import files
from tests.fake_reader import FakeReader

PAGES = [
    {"text": "甲电股份"},
    {"text": "第三节 管理层讨论与分析\n本年度公司实现營業收入增长。\nOur principal operations", "tables": [[["项目", "金额"], ["收入", "1"]]]},
    {"text": "装机容量稳步提升。", "tables": "bad"},
    {"text": "第四节 公司治理\n治理情况"},
    {"nothing": 1},
]


def base(tmp_path):
    for company, name, data in (("02_甲电", "甲电_2023年年度报告.pdf", PAGES), ("02_甲电", "甲电_2022年年度报告.pdf", [*PAGES[:2], "broken"]), ("03_乙电", "招股书.pdf", None)):
        folder = tmp_path / company / "年报PDF"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(b"not json" if data is None else json.dumps(data).encode())
    (tmp_path / "09_无").mkdir()
    (tmp_path / "other").mkdir()
    return str(tmp_path)


def test_pages_and_what_fails(spark, tmp_path):
    found = files.report_files(spark, base(tmp_path), content=True)
    pages = files.read_pages(found, FakeReader()).cache()
    bad = {(r.path.rsplit("/", 1)[1], r.page_no, r.stage) for r in files.quarantined(pages).collect()}
    assert bad == {("甲电_2023年年度报告.pdf", 3, "tables"), ("甲电_2023年年度报告.pdf", 5, "text"), ("甲电_2022年年度报告.pdf", 2, "open"), ("招股书.pdf", None, "open")}
    t = files.page_tables(pages, found)
    assert t["page_text"].count() == t["page_geom"].count() == 6 and t["doc_table"].count() == 2
    assert t["word"].where("page_no = 2").select("word_no").distinct().count() == 3


def test_extract_and_audit(spark, tmp_path):
    at = base(tmp_path)
    dry = cli.extract(spark, at, "02_甲电", True, FakeReader())
    assert dry[1] == "02_甲电 2023: 董事长=未找到 | MD&A=p2-4[管理层讨论与分析]"
    lines = cli.extract(spark, at, None, False, FakeReader())
    assert "written: 3" in lines and any(x.startswith("total: 3 reports, 0 chairman's letters, 2 discussions, 3 files") for x in lines)
    text = (tmp_path / "02_甲电" / files.MD_FOLDER / "甲电_2023_董事长致辞与MD&A.md").read_text("utf-8")
    assert "| 项目 | 金额 |" in text and "营业收入" in text and "principal" not in text and "绝不虚构" in text
    kept = cli.extract(spark, at, "02_甲电", False, FakeReader(), keep_script=True, keep_english=True)
    text = (tmp_path / "02_甲电" / files.MD_FOLDER / "甲电_2023_董事长致辞与MD&A.md").read_text("utf-8")
    assert "營業收入" in text and "principal" in text and "written: 2" in kept
    lines, passed = cli.audit_base(spark, at)
    assert lines[0].startswith("02_甲电: 2 files") and "09_无: no document" in lines and not any("other" in x for x in lines)
    assert passed and lines[-1] == "passed"
    (tmp_path / "02_甲电" / files.MD_FOLDER / "甲电_2021_董事长致辞与MD&A.md").write_text("Our principal operations\n", "utf-8")
    lines, passed = cli.audit_base(spark, at)
    assert not passed and lines[0].startswith("02_甲电: 3 files") and lines[-1] == "to be looked at"
    assert not list(tmp_path.rglob("*.part"))


def test_no_library_for_pdf():
    with pytest.raises(RuntimeError):
        cli._reader(None)
    assert isinstance(cli._reader("tests.fake_reader:FakeReader"), FakeReader)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "x"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: type("O", (), {"isEmpty": lambda self: True})()})()})()

        def getConf(self):
            return {}

    session = type("Session", (), {"sparkContext": Context(), "conf": {}})()
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(session)
