"""Leaked passages against a search for every passage."""

import random

from pagewright.llm import leakage as L

ALPHABET = "鸮飛垭一側的自購二級閥组由棠垅水務代為看護倘若櫪渚實業在内未能借檢修之机交割材料指出不计利息推遲灰渣堆場验收答案须引用信中第段"


def make(seed=1):
    rnd = random.Random(seed)
    text = lambda n: "".join(rnd.choice(ALPHABET) for _ in range(n))
    items = [(i, text(110)) for i in range(20)] + [(50, " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 9))) for _ in range(70)))]
    docs, want = [], set()
    for d in range(120):
        i, t = rnd.choice(items)
        latin, n = i == 50, rnd.choice([30, 45, 59, 60, 75, len(t)])
        n = n if not latin else rnd.choice([100, 205, 212, len(t)])
        at = rnd.randint(0, len(t) - n)
        piece = list(t[at : at + n])
        if rnd.random() < 0.5 and n > 40:
            piece[n // 2] = "X" if latin else "错"  # one misread character
        quoted = "".join(piece)
        if rnd.random() < 0.4:
            quoted = quoted.upper().replace("一", "一，\n").replace("的", "的​ ")
        around = "".join(rnd.choice("天地玄黄宇宙洪荒日月盈昃辰宿列张") for _ in range(40))
        docs.append((d, around + "。" + quoted + "。" + around))
        if n == len(t) or n >= (210 if latin else 60):
            want.add((d, i))
    return docs, items, want


def test_found_are_the_planted(spark):
    docs, items, want = make()
    docs += [(900, None), (901, ""), docs[0]]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int")  # a clashing extra column
    e = spark.createDataFrame([*items, (99, None), (98, ""), items[0]], "item_id long, text string")
    got = L.leaked_items(d, e)
    assert {tuple(r) for r in got.collect()} == want
    assert {tuple(r) for r in L.leaked_items(d, e, block_chars=300).collect()} == want  # in several blocks
    spans = L.leaked_passages(d, e).collect()
    texts, items = dict(docs), dict(items)
    for r in spans:
        a, b = texts[r.doc_id][r.doc_start : r.doc_end], items[r.item_id][r.item_start : r.item_end]
        assert a[0].casefold() == b[0].casefold() and a[-1].casefold() == b[-1].casefold()


def test_script(spark):
    item = "在鸮飛埡一側的自購二級閥組由棠壠水務代為看護，倘若櫪渚實業在六千日內未能借檢修之機交割二期二級閥組；據櫪壠動能披露的附注第四十一條，材料指出"
    from pagewright.llm.textform import simplified_script

    simple = item.translate(simplified_script(spark))
    assert simple != item
    d, e = spark.createDataFrame([(1, simple)], "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [tuple(r) for r in L.leaked_items(d, e).collect()] == [(1, 7)]


def test_empty(spark):
    d, e = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert L.leaked_items(d, e).count() == 0
    assert L.leaked_items(spark.createDataFrame([(1, "字" * 100)], "doc_id long, text string"), e).count() == 0


def test_whole_items_of_any_length(spark):
    """Items of 1 to 30 letters in either script against a search for each, with exact places."""
    rnd = random.Random(3)
    items = [(n, "".join(rnd.choice(ALPHABET) for _ in range(n))) for n in range(1, 31)]
    items += [(100 + n, " ".join("".join(rnd.choice("bcdfghjk") for _ in range(min(4, n - k))) for k in range(0, n, 4))) for n in range(1, 31)]
    items += [(200, "电力现货市场价格"), (201, "机组利用小时数是多少？"), (202, "What is ROE?")]
    docs = []
    for d in range(200):
        pieces = [list(rnd.choice(items)[1]) for _ in range(rnd.randint(0, 3))]
        for p in pieces:
            if rnd.random() < 0.3 and len(p) > 3:
                p.insert(len(p) // 2, rnd.choice(["\n", "，", "​", "——", "é"[1]]))
            elif rnd.random() < 0.2 and len(p) > 3:
                del p[rnd.randrange(len(p))]  # almost the whole item
        docs.append((d, "".join(rnd.choice("天地玄黄 ，é") + "".join(p).upper() + rnd.choice(["。", "é", "宇宙"]) for p in pieces)))
    scanner = L.Scanner([(i, t, not any("㐀" <= c <= "鿿" for c in t)) for i, t in items], {}, 6, 12, 60, 210)
    letters = dict((i, scanner.letters(t)) for i, t in items)
    want = {(d, i) for d, t in docs for i in letters if letters[i] and letters[i] in scanner.letters(t)}
    got = L.leaked_passages(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), min_chars=1000, min_chars_latin=1000
    ).collect()
    texts = dict(docs)
    # From four seeds on the two outer letters may be lost.
    short = {(r.doc_id, r.item_id) for r in got if len(letters[r.item_id]) < 24}
    assert short == {(d, i) for d, i in want if len(letters[i]) < 24} and want <= {(r.doc_id, r.item_id) for r in got}
    for r in got:
        if len(letters[r.item_id]) < 12:
            assert scanner.letters(texts[r.doc_id][r.doc_start : r.doc_end]) == letters[r.item_id] and r.item_start == 0


def test_few_letters_among_many_marks(spark):
    item = "甲" + "·" * 40 + "乙丙丁戊己庚" + "·" * 30 + "辛壬癸" + "·" * 60 + "子丑寅卯辰巳午未申酉戌亥"
    d = spark.createDataFrame([(1, "天乙丙丁戊己庚辛壬癸地"), (2, "天乙丙丁戊己地")], "doc_id long, text string")
    e = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [r.doc_id for r in L.leaked_items(d, e).collect()] == [1]


def test_places_of_joined_characters():
    scanner = L.Scanner([(1, "Café 한 ｶﾞ 电力现货市场", False)], {}, 6, 12, 60, 210)
    text = "「Ｃafé 한 ガ 电力​现货市场」"
    assert [(text[a:b], i, j, w) for _, a, b, i, j, w in scanner.scan(text)] == [(text[1:-1], 0, len("Café 한 ｶﾞ 电力现货市场"), True)]
