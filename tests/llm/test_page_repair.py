"""Running titles, page numbers, broken and misread words on small pages."""

from pagewright.llm import page_repair as P
from pagewright.llm.textform import composed
from pagewright.schema import PAGE_GEOM, WORD, empty


def page(doc, no, head, body, foot, company="01_甲乙电力"):
    """Words of a page: a head, body lines (each a list of words) and a foot."""
    rows, n = [], 0
    for top, line in [(40.0, head), *((100.0 + 15 * i, b) for i, b in enumerate(body)), (800.0, foot)]:
        x = 60.0
        for w in line:
            n += 1
            rows.append((doc, company, no, n, w, x, x + 6.0 * len(w), top, top + 10))
            x += 6.0 * len(w) + 4
    return rows


USUAL = ["generation", "million", "management", "environment", "payment", "commission", "investment", "agreement", "capacity", "revenue", "committee", "reached"]
LINES = ["抽水蓄能稳定", "来水偏枯明显", "污水处理达标", "发电设备利用", "售电均价回落", "用电总量下降", "增值服务收入", "新增装机容量", "持续增长动力", "我们自己承担了水电站的建设，电量增加"]
#: Misread words of one page, and what they were.
MISREAD = {
    "generatiou": "generation", "rnillion": "million", "managernent": "management", "euvironment": "environment", "payrnent": "payment", "commissiou": "commission", "revenne": "revenue",
    "44o": "440", "5o3": "503", "o12": "012", "抽氷蓄能稳定": LINES[0], "来氷偏枯明显": LINES[1], "污氷处理达标": LINES[2], "发屯设备利用": LINES[3], "售屯均价回落": LINES[4], "用屯总量下降": LINES[5],
    "僧值服务收入": LINES[6], "新僧装机容量": LINES[7], "持续僧长动力": LINES[8], "我们自己承担了氷电站的建设，屯量僧加": LINES[9], "revennes": "revenues", "capacitv": "capacity",
}
KNOWN = set(MISREAD) - {"revenne", "revennes", "capacitv"}  # one word teaches no confusion


def make(spark, scale=1.0):
    rows = []
    for d in range(12):
        for p in range(1, 5):
            body = [USUAL, ["of", "the", "revenue", "440", "503", "012", f"1{d:02}", f"2{p}7"], *([t] for t in LINES)]
            if (d, p) == (3, 2):
                body += [[w for w in MISREAD if w.isascii()], *([w] for w in MISREAD if not w.isascii())]
                body += [["of", "the", "revenue", "coal-"], ["fired", "capacity", "of", "the", "com-"], ["mittee", "and", "CO2", "O2"]]
            if d == 5:
                body.append(["the", "coal-fired", "units", "CO2", "O2"])
            rows += page(d, p, ["管理层讨论与分析"] if p == 1 else ["甲乙电力股份有限么司"] if (d, p) == (4, 3) else ["甲乙电力股份有限公司"], body, [str(20 + p)])
    rows += rows[:5] + [(1, "01_甲乙电力", 2, 900, None, 1.0, 2.0, 3.0, 4.0)]
    sizes = [(d, p, 595.0, 842.0) for d in range(12) for p in range(1, 5) if d != 7]
    rows = [(*r[:7], r[7] * scale, r[8] * scale) for r in rows]
    return spark.createDataFrame(rows, WORD), spark.createDataFrame([(*r[:2], r[2], r[3] * scale) for r in sizes], PAGE_GEOM)


def test_kinds(spark):
    words, sizes = make(spark)
    clash = words.selectExpr("*", "1 as kind", "2 as height", "3 as n", "4 as first")
    texts = {(r.doc_id, r.page_no, r.word_no): r.text for r in words.collect()}
    got = {}
    for r in P.noisy_words(clash, sizes).collect():
        got.setdefault(r.kind, []).append((r.doc_id, r.page_no, texts[r.doc_id, r.page_no, r.word_no]))
    assert len(got["furniture"]) == 12 * 4 + 12 * 3  # page numbers, and titles on all but the first pages
    assert (4, 3, "甲乙电力股份有限么司") in got["furniture"]
    assert got["hyphen"] == [(3, 2, "com-")]
    assert {t for *_, t in got["misread"]} == KNOWN


def test_plans_are_small(spark):
    """What a run takes of the driver's memory goes with its shuffles, and most with those that are planned at once."""
    words, sizes = make(spark)
    shuffles = spark.sparkContext._jsc.sc().newShuffleId
    before = shuffles()
    noise = P.noisy_words(words, sizes)
    assert noise._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 10
    assert noise.count() > 0 and shuffles() - before <= 62


def test_confusions_are_learned(spark):
    words, _ = make(spark)
    reading = P.Reading(words)
    assert reading.known.han == set("氷屯僧么") and reading.known.letters == "o" and reading.known.values == ("o", "0")
    assert set(reading.known.words) == {("rn", "m"), ("u", "n"), ("o", "0")}
    assert {r.text: r.repaired for r in reading.repairs.collect()} == {k: v for k, v in MISREAD.items() if k in KNOWN} | {"甲乙电力股份有限么司": "甲乙电力股份有限公司"}
    # In a corpus without misread characters nothing is learned.
    clean = P.Reading(words.where("doc_id not in (3, 4)"))
    assert not clean.known.han and not clean.known.words and not clean.known.letters and clean.repairs.count() == 0


def test_zones_go_with_the_page(spark):
    for scale in (0.4, 2.4):  # pages of 337 and 2,021 points
        words, sizes = make(spark, scale)
        pages = {(r.doc_id, r.page_no) for r in P.furniture_words(words, sizes).where("doc_id <> 7").collect()}
        assert pages == {(d, p) for d in range(12) if d != 7 for p in range(1, 5)}


def test_titles_of_any_length(spark):
    title = "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉戌亥" * 4  # 88 letters
    misread = title[:40] + "口" + title[41:]
    rows = []
    for d in range(3):
        for p in range(1, 7):
            rows += page(d, p, [misread if (d, p) == (1, 4) else title if p > 1 else f"首页{'天地玄'[d]}"], [["正文"]], ["未完"])
    rows += [(9, "02_丙", p, 1, "只此一份报告的长标题" * 6, 60.0, 90.0, 40.0, 50.0) for p in range(1, 4)]
    got = {(r.doc_id, r.page_no) for r in P.furniture_words(spark.createDataFrame(rows, WORD)).where("word_no = 1").collect()}
    assert got == {(d, p) for d in range(3) for p in range(2, 7)} | {(9, 2), (9, 3)}


def test_paragraphs(spark):
    words, sizes = make(spark)
    text = "".join(r.t for r in P.body_paragraphs(words, sizes).where("doc_id = 3").orderBy("para_no").collect())
    assert "the committee and CO2 O2" in text and "503" in text and "股份有限公司" not in text and "我们自己承担了水电站的建设，电量增加" in text and "\x1f" not in text


def test_page_numbers():
    form = P._number_forms("BIOSlo")[0]
    assert all(form.match(composed(s)) for s in ["12", "- 64 -", "116 / 161", "Page 3 of 99", "第99页", "iv", "OO96", "l31", "1B"])
    assert not any(form.match(s) for s in ["12.5%", "营业收入 12", "2023年", "Note 3"]) and not P._number_forms("")[0].match("l31")


def test_empty(spark):
    assert P.noisy_words(empty(spark, WORD), empty(spark, PAGE_GEOM)).count() == 0
