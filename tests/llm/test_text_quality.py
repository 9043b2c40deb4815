"""Statistics by hand, trees on a simple problem, and kinds on held-out and made texts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewright.llm import text_quality as Q
from pagewright.llm.boosting import BoostedTrees, platt


def test_statistics_by_hand():
    n, f = Q.statistics("本年收入增长。\n| 甲 | 1 | 2 |\nAB cd", frozenset({"本年", "年收"}), {})
    s = dict(zip(Q.FEATURES, f, strict=True))
    assert n == 7 + 2 + 2 and s["line_end_share"] == 1 / 3
    assert s["mean_word_len"] == pytest.approx((7 + 4 + 2) / n)  # the same words as are counted
    assert s["common_share"] == pytest.approx(2 / (7 + 2)) and s["symbol_share"] == pytest.approx(4 / 27, abs=0.02)


@pytest.mark.parametrize("t", ["", " ", "\n\n", "字" * 100_000, "\ud83d", "�" * 50])
def test_any_text_has_statistics(t):
    assert all(np.isfinite(Q.statistics(t, frozenset(), {})[1]))


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    t = BoostedTrees().fit(x[:600], y[:600])
    s = t.score(x[600:])
    assert ((s > 0) == y[600:]).mean() > 0.93
    a, _ = platt(s, y[600:])
    assert a > 0


def test_shipped_model_on_the_rest_of_the_holdout(spark):
    """The model as the query makes it, held against the hand-checked records that neither training nor calibration has seen."""
    texts = Q._texts(spark.read.parquet("/root/testdata/sf0.1/section_record.parquet"), "mtext", "doc_id")
    common, script = frozenset(Q.common_words(texts)), Q.simplified_script(spark)
    stats = Q._statistics(texts, common, script).cache()
    rows = Q.training_rows(texts, stats, common, script)
    held = {r["text_id"] for r in Q.holdout()}
    x, y = Q.checked("test")
    assert len(y) == 43 and len(Q.checked("calibrate")[1]) == 43
    # No training row is a record of the holdout, or looks like one: none has its statistics.
    assert stats.where(F.col("text_id").isin(sorted(held))).count() >= 80
    assert not {tuple(round(v, 4) for v in f) for _, f in rows} & {tuple(round(v, 4) for v in r["x"]) for r in Q.holdout()}
    assert 1000 < len(rows) < 5000
    found = Q.train(rows).probabilities(x).argmax(1)
    assert (found == y).mean() > 0.9


def test_common_words_are_few_at_every_size(spark):
    rows = [(i, f"其中甲乙丙丁戊己庚辛壬癸子丑寅卯{chr(0x4E00 + i)}{chr(0x5E00 + i)}。") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(Q.common_words(df, 0.01)) <= 100 and "其中" in Q.common_words(df, 0.01) and set(Q.common_words(df, 0.01)) <= set(Q.common_words(df))


def test_kinds(spark):
    sentence = "董事会围绕降本增效，持续改进绩效考核，供热量达到八十亿元。本年度盘活土地资源取得进展，两地管理费用分别下降。"
    rows = [(i, sentence * 4, "x") for i in range(30)]
    rows += [(100, "\n".join(f"- 项目{i}" for i in range(30)), "x"), (101, "\n".join(f"| 收入 | {i}.20 | {i}.1 |" for i in range(30)), "x")]
    rows += [(102, "\n".join("#§@¤*…■*\\=※□@※…■¤*⏎" for _ in range(20)), "x"), (103, None, "x"), (104, "", "x"), (0, sentence * 4, "x")]
    df = spark.createDataFrame(rows, "doc_id long, mtext string, kind string")  # a clashing extra column
    got = {r.doc_id: r.kind for r in Q.not_prose(df).collect()}
    assert got == {100: "list", 101: "table", 102: "junk"}
    assert Q.quality_kinds(df).count() == 33
    assert Q.not_prose(df.where("false")).count() == 0
