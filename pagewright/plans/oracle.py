"""SQL for DuckDB that gives the rows of the engine's queries.

Written from the rules, not from the operators: column cuts try every candidate, garbled lines compare characters, sections are found by
correlated search. Only pattern strings and word lists are shared.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions import patterns as P
from ..functions.script import simplified_script


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _re(s: str, pattern: str) -> str:
    return f"regexp_matches({s}, {_q(pattern)})"


def _strip(s: str) -> str:
    return f"regexp_replace({s}, {_q(f'^[{P.SPACE}]+|[{P.SPACE}]+$')}, '', 'g')"


def _lines(text: str, cols: str, source: str) -> str:
    """A sub-query with ``cols, line_no, s``."""
    return f"""(SELECT {cols}, i AS line_no, {_strip("a[i]")} AS s FROM (
        SELECT {cols}, CASE WHEN a[len(a)] = '' THEN a[1:len(a) - 1] ELSE a END AS a
        FROM (SELECT {cols}, string_split_regex({text}, {_q(P.LINE_BREAK)}) AS a FROM {source} WHERE {text} IS NOT NULL)), unnest(range(1, len(a) + 1)) AS u(i))"""


PAGES = "(SELECT doc_id, page_no, max(text) AS text FROM page_text GROUP BY ALL)"
LINES = _lines("text", "doc_id, page_no", PAGES)
_HAN = f"[{P.HAN}]"


def english(s: str) -> str:
    return f"(NOT {_re(s, _HAN)} AND (len(regexp_extract_all({s}, '[A-Za-z]{{2,}}')) >= 2 OR (length({s}) <= 30 AND {_re(s, '[A-Za-z]{4}')})))"


def audit_english(s: str) -> str:
    runs = f"regexp_extract_all({s}, '[A-Za-z]+')"
    return f"(NOT {_re(s, _HAN)} AND ((len({runs}) >= 2 AND length(array_to_string({runs}, '')) >= 24) OR (length({s}) <= 30 AND {_re(s, '[A-Za-z]{4}')})))"


def rev(s: str) -> str:
    figures = r"\p{Nd}{3}"
    return f"(length({s}) <= 40 AND (contains({s}, '司公限有') OR ({_re(s, '[報报]度?年')} AND {_re(s, figures)})))"


def audit_rev(s: str) -> str:
    year = r"\p{Nd}[報报]年"
    return f"(length({s}) <= 40 AND (contains({s}, '司公限有') OR {_re(s, year)}))"


def tripled(s: str) -> str:
    same = f"substring({s}, i, 1) = substring({s}, i + 1, 1) AND substring({s}, i, 1) = substring({s}, i + 2, 1) AND {_re(f'substring({s}, i, 1)', _HAN)}"
    return f"(length({s}) <= 30 AND len(list_filter(range(1, greatest(length({s}) - 1, 1)), lambda i: {same})) > 0)"


def interleaved(s: str) -> str:
    a, b = f"substring({s}, i, 1)", f"substring({s}, i + 1, 1)"
    change = f"({_re(a, _HAN)} AND {_re(b, '[A-Za-z]')}) OR ({_re(b, _HAN)} AND {_re(a, '[A-Za-z]')})"
    n = f"len(list_filter(range(1, greatest(length({s}), 1)), lambda i: {change}))"
    return f"(length({s}) <= 30 AND NOT {_re(s, chr(92) + 'p{Nd}')} AND {n} >= 3 AND {n} >= 0.35 * length({s}))"


def forms(s: str) -> dict[str, str]:
    return {k: _re(s, v) for k, v in P.FURNITURE.items()} | {"report_year": f"({_re(s, P.REPORT_YEAR)} AND {_re(s, P.YEAR_FIGURES)})"}


def furniture(s: str) -> str:
    return "(" + " OR ".join(forms(s).values()) + ")"


def symbols(s: str) -> str:
    return f"NOT {_re(s, f'[{P.HAN}0-9A-Za-z]')}"


def audit_symbols(s: str) -> str:
    return f"({symbols(s)} AND NOT ({' OR '.join(_re(s, p) for p in P.RULE_LINES)}))"


def level(s: str) -> str:
    return f"CASE WHEN {_re(s, P.HEAD)} AND length({s}) <= 40 AND NOT {_re(s, P.NOT_HEAD_END)} THEN CASE WHEN {_re(s, P.HEAD_TOP)} THEN 1 ELSE 2 END ELSE 0 END"


def short_company(c: str) -> str:
    pattern = rf"^\p{{Nd}}+[{P.SPACE}]*[_\-{P.SPACE}][{P.SPACE}]*"
    return f"coalesce(nullif(regexp_replace({c}, {_q(pattern)}, ''), ''), {c})"


def prefix(s: str, terms: list[str], ordinal: bool = False) -> str:
    return "CASE " + " ".join(f"WHEN starts_with({s}, {_q(t)}) THEN {i if ordinal else _q(t)}" for i, t in enumerate(terms)) + " END"


def _num(h: str) -> str:
    return f"CASE WHEN length({h}) = 1 THEN strpos('{P.NUMERALS}', {h}) END"


def _order(terms: list[str]) -> str:
    return f"least({prefix('bare', terms, True)}, {prefix('s', terms, True)})"


FACTS = f"""facts AS (SELECT *, {_order(P.CHAIR_TERMS)} AS chair, {_order(P.MDA_CANON)} AS canon, {_order(P.MDA_FALLBACK)} AS fallback FROM (
    SELECT *, {_strip(f"regexp_replace(s, {_q(P.SECTION_PREFIX)}, '')")} AS bare, nullif(regexp_extract(s, {_q(P.SECTION_HEAD)}, 1), '') AS head,
        s <> '' AND length(s) <= 30 AND NOT {_re("s", f"[{P.CITING}]")} AS eligible FROM {LINES}))"""
_BY_LENGTH = sorted(P.ALL_TITLES, key=lambda t: (-len(t), t))
TOC = f"""toc AS (SELECT doc_id, page_no, n_numerals, n_listed, n_titles, n_figures,
    n_numerals >= 2 OR n_listed >= 2 OR n_titles >= 4 OR (n_titles >= 3 AND n_figures >= 3) AS is_contents FROM (
    SELECT doc_id, page_no, count(DISTINCT CASE WHEN length(s) <= 30 AND NOT contains(s, '...') THEN head END) AS n_numerals,
        count(DISTINCT CASE WHEN eligible AND head IS NULL AND {_re("coalesce(nullif(s1, ''), nullif(s2, ''), '')", P.PAGE_FIGURE)} THEN {prefix("s", _BY_LENGTH)} END) AS n_listed,
        CAST(count(*) FILTER ({_re("s", P.PAGE_FIGURE)}) AS BIGINT) AS n_figures
    FROM (SELECT *, lead(s, 1) OVER w AS s1, lead(s, 2) OVER w AS s2 FROM facts WINDOW w AS (PARTITION BY doc_id, page_no ORDER BY line_no)) GROUP BY ALL)
    LEFT JOIN (SELECT doc_id, page_no, count(DISTINCT t) AS titles FROM facts, unnest([{", ".join(map(_q, P.ALL_TITLES))}]) AS u(t)
        WHERE s <> '' AND length(s) <= 25 AND contains(s, t) GROUP BY ALL) USING (doc_id, page_no), LATERAL (SELECT coalesce(titles, 0) AS n_titles))"""
HITS = f"""hits AS (SELECT f.doc_id, f.page_no, line_no, chair, canon, fallback, coalesce({_num("head")}, {_num("page_head")}) AS own_num
    FROM facts f JOIN toc USING (doc_id, page_no)
    LEFT JOIN (SELECT doc_id, page_no, arg_min(head, line_no) AS page_head FROM facts WHERE head IS NOT NULL GROUP BY ALL) USING (doc_id, page_no)
    WHERE eligible AND NOT is_contents AND coalesce(chair, canon, fallback) IS NOT NULL)"""


def _first(name: str, kind: str, terms: list[str], where: str, source: str = "hits") -> str:
    named = f"([{', '.join(map(_q, terms))}])[{kind} + 1]"
    return f"""{name} AS (SELECT doc_id, page_no AS page, {named} AS term, own_num AS num FROM {source} WHERE {kind} IS NOT NULL AND {where}
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY page_no, line_no, {kind}) = 1)"""


def _ends(name: str, section: str) -> str:
    major = ", ".join(f"CASE WHEN term <> {_q(t)} AND starts_with(s, {_q(t)}) AND length(s) <= {len(t) + 3} THEN {_q('H:' + t)} END" for t in P.MAJOR_TITLES)
    numbered = f"{_re('s', P.SECTION_HEAD_LINE)} AND {_num('head')} IS DISTINCT FROM num"
    return f"""{name}_tok AS (SELECT DISTINCT doc_id, page_no, page, token FROM (SELECT f.doc_id, page_no, page, unnest(CASE WHEN {numbered}
            THEN ['SEC' || coalesce(CAST({_num("head")} AS VARCHAR), 'None')]
            ELSE [CASE WHEN bare <> '' AND bare <> term THEN 'A:' || ({prefix("bare", P.SECTION_NAMES)}) END, {major}] END) AS token
        FROM facts f JOIN {section} USING (doc_id) WHERE eligible) WHERE token IS NOT NULL),
    {name} AS (SELECT s.doc_id, page, term, num, coalesce((SELECT min(t.page_no) FROM {name}_tok t WHERE t.doc_id = s.doc_id AND t.page_no > s.page
            AND (SELECT count(*) FROM {name}_tok b JOIN toc USING (doc_id, page_no) WHERE b.doc_id = t.doc_id AND b.token = t.token AND b.page_no < s.page AND NOT is_contents) < 2),
            n_pages) AS last FROM {section} s JOIN counts USING (doc_id))"""


RANGES = f"""counts AS (SELECT doc_id, max(page_no) AS n_pages FROM page_text GROUP BY ALL), {FACTS}, {TOC}, {HITS},
    {_first("c0", "chair", P.CHAIR_TERMS, "page_no <= 45")}, {_ends("c1", "c0")},
    after AS (SELECT hits.* FROM hits JOIN c1 USING (doc_id) WHERE page_no > last),
    {_first("a1", "canon", P.MDA_CANON, "true")}, {_first("a2", "fallback", P.MDA_FALLBACK, "true")},
    {_first("b1", "canon", P.MDA_CANON, "true", "after")}, {_first("b2", "fallback", P.MDA_FALLBACK, "true", "after")},
    a AS (SELECT * FROM a1 UNION ALL SELECT * FROM a2 WHERE doc_id NOT IN (SELECT doc_id FROM a1)),
    b AS (SELECT * FROM b1 UNION ALL SELECT * FROM b2 WHERE doc_id NOT IN (SELECT doc_id FROM b1)),
    clash AS (SELECT doc_id FROM a JOIN c1 USING (doc_id) WHERE a.page < c1.last),
    m0 AS (SELECT * FROM a WHERE doc_id NOT IN (SELECT doc_id FROM clash) UNION ALL SELECT * FROM b WHERE doc_id IN (SELECT doc_id FROM clash)), {_ends("m1", "m0")},
    ranges AS (SELECT doc_id, c1.page AS chair_start, c1.last AS chair_end, c1.term AS chair_term, c1.num AS chair_num,
        m1.page AS mda_start, m1.last AS mda_end, m1.term AS mda_term, m1.num AS mda_num FROM counts LEFT JOIN c1 USING (doc_id) LEFT JOIN m1 USING (doc_id))"""

GEOM = "(SELECT doc_id, page_no, max(width) AS width, max(height) AS height FROM page_geom GROUP BY ALL)"
_TABS = f"""tabs AS (SELECT t.*, width, height FROM (SELECT DISTINCT doc_id, page_no, table_no, x0, top, x1, bottom, coalesce(rows, []) AS rows FROM doc_table) t LEFT JOIN {GEOM} USING (doc_id, page_no)),
    sized AS (SELECT *, coalesce(list_max(list_transform(rows, lambda r: coalesce(len(r), 0))), 0) AS n_cols,
        flatten(list_transform(rows, lambda r: coalesce(r, []))) AS cells FROM tabs),
    judged AS (SELECT *, CASE WHEN len(cells) > 0 THEN len(list_filter(cells, lambda c: {_strip("coalesce(c, '')")} = '')) / len(cells) ELSE 0.0 END AS share FROM sized),
    ok AS (SELECT *, NOT coalesce(x0 < -5 OR top < -5 OR x1 > width + 5 OR bottom > height + 5, false) AND len(rows) > 0 AND n_cols >= 2
        AND NOT (n_cols >= 10 AND len(cells) > 0 AND share >= 0.6) AS accepted FROM judged)"""
_JOINED = _strip("array_to_string(r, ' ')")
_CELL = _strip("replace(replace(c, chr(10), ' '), '|', '／')")
_MD = f"""{_TABS}, full_rows AS (SELECT doc_id, page_no, table_no, x0, top, x1, bottom, list_filter(list_filter(
            list_transform(rows, lambda r: list_transform(coalesce(r, []), lambda c: coalesce(c, ''))),
            lambda r: NOT ({_JOINED} <> '' AND {english(_JOINED)})), lambda r: len(list_filter(r, lambda c: {_strip("c")} <> '')) > 0) AS rows FROM ok WHERE accepted),
    wide AS (SELECT *, list_max(list_transform(rows, lambda r: len(r))) AS n FROM full_rows WHERE len(rows) > 0),
    kept AS (SELECT *, list_filter(range(1, n + 1), lambda i: len(list_filter(rows, lambda r: {_strip("coalesce(r[i], '')")} <> '')) > 0) AS cols FROM wide),
    mdl AS (SELECT *, list_transform(rows, lambda r: '| ' || array_to_string(list_transform(list_transform(cols, lambda i: coalesce(r[i], '')), lambda c: {_CELL}), ' | ') || ' |') AS lines,
        '| ' || array_to_string(list_transform(cols, lambda i: '---'), ' | ') || ' |' AS rule FROM kept),
    md AS (SELECT doc_id, page_no, table_no, x0, top, x1, bottom, array_to_string(list_concat(lines[1:1], [rule], lines[2:]), chr(10)) AS md FROM mdl)"""

WORDS = "(SELECT DISTINCT doc_id, page_no, word_no, text, x0, x1, top, bottom FROM word WHERE length(text) > 0 AND x0 IS NOT NULL AND top IS NOT NULL)"
_OUT = f"""outside AS (SELECT * FROM {WORDS} w WHERE NOT EXISTS (SELECT 1 FROM md b WHERE b.doc_id = w.doc_id AND b.page_no = w.page_no
    AND w.x0 >= b.x0 - 2 AND w.x1 <= b.x1 + 2 AND w.top >= b.top - 2 AND w.bottom <= b.bottom + 2))"""


def _cut(words: str) -> str:
    """Every candidate is counted against every word of its page."""
    return f"""cand AS (SELECT doc_id, page_no, width, unnest(range(CAST(floor(width * 0.28) AS BIGINT), CAST(floor(width * 0.72) AS BIGINT) + 1, 2)) AS c FROM {GEOM}),
    counted AS (SELECT doc_id, page_no, width, c, count(*) FILTER (x1 <= c) AS l, count(*) FILTER (x0 >= c) AS r, count(*) FILTER (x0 < c AND c < x1) AS sp
        FROM cand JOIN {words} USING (doc_id, page_no) GROUP BY ALL),
    cuts AS (SELECT doc_id, page_no, CAST(c AS INTEGER) AS cut, CAST(sp AS INTEGER) AS spans FROM (SELECT * FROM counted WHERE l >= 8 AND r >= 8
        QUALIFY row_number() OVER (PARTITION BY doc_id, page_no ORDER BY sp, abs(c - width / 2), c) = 1) WHERE sp <= 2)"""


def _choice(words: str) -> str:
    solid = f"regexp_replace(text, {_q(f'[{P.SPACE}]')}, '', 'g')"

    def share(side: str) -> str:
        return f"coalesce(sum(len(regexp_extract_all(text, {_q(_HAN)}))) FILTER ({side}) / greatest(1, sum(length({solid})) FILTER ({side})), 0.0)"

    return f"""shares AS (SELECT doc_id, page_no, cut, {share("x1 <= cut")} AS ls, {share("x1 > cut AND x0 >= cut")} AS rs FROM cuts JOIN {words} USING (doc_id, page_no) GROUP BY ALL),
    choice AS (SELECT *, CASE WHEN ls >= 0.3 AND rs >= 0.3 THEN 'both' WHEN rs >= ls THEN 'right' ELSE 'left' END AS keep FROM shares)"""


def _vlines(source: str, name: str = "vl") -> str:
    gap = f"{_re('coalesce(lag(text) OVER w, chr(32))', '[0-9A-Za-z]$')} AND {_re('text', '^[0-9A-Za-z]')}"
    return f"""{name} AS (SELECT doc_id, page_no, col_no, k, string_agg(piece, '' ORDER BY x0, word_no) AS t, min(x0) AS x0 FROM (
        SELECT *, CASE WHEN {gap} THEN ' ' ELSE '' END || text AS piece FROM (SELECT *, CAST(round_even(top / 3, 0) AS INTEGER) AS k FROM {source})
        WINDOW w AS (PARTITION BY doc_id, page_no, col_no, k ORDER BY x0, word_no)) GROUP BY ALL)"""


ONE_COLUMN = _vlines(f"(SELECT *, 0 AS col_no FROM {WORDS})")
IN_COLUMNS = f"""{_MD}, {_OUT}, {_cut("outside")}, {_choice("outside")},
    placed AS (SELECT w.*, CASE WHEN cut IS NULL THEN 0 WHEN keep IN ('both', 'left') AND x1 <= cut THEN 0 WHEN keep = 'both' AND x0 >= cut THEN 1 WHEN keep = 'right' AND x0 >= cut THEN 0 END AS col_no
        FROM outside w LEFT JOIN choice USING (doc_id, page_no)), {_vlines("(SELECT * FROM placed WHERE col_no IS NOT NULL)")}"""
_GARBLED = f"({rev('t')} OR {tripled('t')} OR {interleaved('t')})"
BODY = f"""body AS (SELECT * FROM (SELECT doc_id, page_no, col_no, k, {_strip("t")} AS t, x0 FROM vl)
    WHERE t <> '' AND NOT {furniture("t")} AND NOT {_GARBLED} AND NOT ({symbols("t")}) AND NOT {english("t")})"""
_B = "doc_id, page_no, col_no"
MARGIN = f"""margin AS (SELECT {_B}, x AS margin FROM (SELECT {_B}, CAST(round_even(x0, 0) AS INTEGER) AS x, count(*) AS n, min(k) AS k FROM body GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY {_B} ORDER BY n DESC, k) = 1)"""
GAP = f"""gap AS (SELECT {_B}, coalesce(list_sort(s)[len(s) // 2 + 1], 1) AS med FROM (SELECT {_B}, list(g) FILTER (g IS NOT NULL) AS s FROM (
    SELECT {_B}, k - lag(k) OVER (PARTITION BY {_B} ORDER BY k) AS g FROM body) GROUP BY ALL)),
    thr AS (SELECT *, greatest(med + 3.0, med * 1.5, 4.0) AS thr FROM gap)"""
PARAS = f"""{BODY}, {MARGIN}, {GAP},
    lev AS (SELECT *, {level("t")} AS lvl FROM body),
    st AS (SELECT lev.*, CASE WHEN lag(k) OVER w IS NULL OR lvl > 0 OR lag(lvl) OVER w > 0 OR x0 - margin >= 12 OR k - lag(k) OVER w >= thr THEN 1 ELSE 0 END AS f
        FROM lev JOIN margin USING ({_B}) JOIN thr USING ({_B}) WINDOW w AS (PARTITION BY {_B} ORDER BY k)),
    raw AS (SELECT {_B}, para_no, max(lvl) AS lvl, string_agg(t, '' ORDER BY k) AS t FROM (SELECT *, sum(f) OVER (PARTITION BY {_B} ORDER BY k) AS para_no FROM st) GROUP BY ALL),
    fine AS (SELECT *, lvl = 0 AND {_re(_strip("t"), f"^[{P.HAN}A-Za-z]$")} AS one FROM raw WHERE lvl > 0 OR NOT ({english("t")} OR {_GARBLED})),
    runs AS (SELECT *, row_number() OVER (PARTITION BY {_B} ORDER BY para_no) - row_number() OVER (PARTITION BY {_B}, one ORDER BY para_no) AS run FROM fine),
    paras AS (SELECT {_B}, CAST(para_no AS BIGINT) AS para_no, lvl, t FROM (SELECT *, count(*) OVER (PARTITION BY {_B}, one, run) AS n FROM runs) WHERE NOT (one AND n >= 4))"""
SECS = """secs AS (SELECT doc_id, section, r.start AS start, r."end" AS last, r.term AS term FROM (
    SELECT doc_id, section, max(struct_pack(start := r.start, "end" := r."end", term := r.term)) AS r FROM (
        SELECT doc_id, 'chair' AS section, chair AS r FROM section_record UNION ALL SELECT doc_id, 'mda', mda FROM section_record)
    WHERE r.start IS NOT NULL AND r."end" IS NOT NULL GROUP BY ALL))"""
FOUND = """secs AS (SELECT doc_id, 'chair' AS section, chair_start AS start, chair_end AS last, chair_term AS term FROM ranges WHERE chair_start IS NOT NULL
    UNION ALL SELECT doc_id, 'mda', mda_start, mda_end, mda_term FROM ranges WHERE mda_start IS NOT NULL)"""
ITEMS = f"""{IN_COLUMNS}, {PARAS},
    items AS (SELECT i.*, section FROM (SELECT doc_id, page_no, 'p' AS kind, lvl, {_strip("t")} AS t, col_no, para_no AS no FROM paras WHERE {_strip("t")} <> ''
        UNION ALL SELECT doc_id, page_no, 't', 0, md, -1, table_no FROM md) i JOIN secs USING (doc_id) WHERE page_no BETWEEN greatest(1, start) AND last),
    pos AS (SELECT *, row_number() OVER w AS pos, CASE WHEN kind = 'p' AND lvl = 0 AND lag(kind) OVER w = 'p' AND lag(lvl) OVER w = 0
        AND (lag(page_no) OVER w <> page_no OR lag(col_no) OVER w <> col_no) AND NOT {_re("lag(t) OVER w", P.SENTENCE_END)} AND NOT {_re("t", P.HEAD_START)} THEN 0 ELSE 1 END AS f
        FROM items WINDOW w AS (PARTITION BY doc_id, section ORDER BY page_no, CASE WHEN kind = 't' THEN 1 ELSE 0 END, col_no, no)),
    merged AS (SELECT doc_id, section, CAST(seq AS INTEGER) AS seq, arg_min(kind, pos) AS kind, arg_min(lvl, pos) AS lvl, string_agg(t, '' ORDER BY pos) AS t
        FROM (SELECT *, sum(f) OVER (PARTITION BY doc_id, section ORDER BY pos) AS seq FROM pos) GROUP BY doc_id, section, seq)"""
MERGED = f"{SECS}, {ITEMS}"
FILES = "(SELECT DISTINCT company, file_name, mtext AS content FROM section_record WHERE length(mtext) > 0)"
_AUD = f"""al AS (SELECT *, {audit_english("s")} AS en, {audit_rev("s")} AS rv, {tripled("s")} AND NOT starts_with(s, '>') AS dp, {audit_symbols("s")} AS sym
    FROM {_lines("content", "company, file_name", "files")} WHERE s <> '')"""
_NORM = f"regexp_replace(regexp_replace(content, {_q(P.LINE_BREAK)}, chr(10), 'g'), '\\n$', '')"
_CHAIR_PART = "CASE WHEN contains(content, '### 董事长致辞') THEN split_part(substring(content, strpos(content, '### 董事长致辞') + 4), '### 管理层', 1) ELSE '' END"


_SUMS = "n_files n_chars en rv dp sym has_chair has_mda found_chair found_mda".split()
AUDIT = f"""{_AUD}, pf AS (SELECT company, count(*) AS n_files, sum(length({_NORM})) AS n_chars, max(CAST({_re(_NORM, P.CHAIR_MENTION)} AS INTEGER)) AS has_chair,
        max(CAST({_re(_NORM, P.MDA_MENTION)} AS INTEGER)) AS has_mda, max(CAST(NOT contains({_CHAIR_PART}, '{P.NOT_FOUND}') AS INTEGER)) AS found_chair,
        max(CAST(NOT contains(content, '{P.NOT_FOUND}】') AS INTEGER)) AS found_mda FROM files GROUP BY company),
    df AS (SELECT company, count(*) FILTER (en) AS en, count(*) FILTER (rv) AS rv, count(*) FILTER (dp) AS dp, count(*) FILTER (sym) AS sym,
        count(*) FILTER (starts_with(s, '|')) AS n_piped, count(*) AS n_lines FROM al GROUP BY company),
    j AS (SELECT * FROM (SELECT DISTINCT company FROM reports) LEFT JOIN pf USING (company) LEFT JOIN df USING (company)),
    t AS (SELECT company, CASE WHEN grouping(company) = 1 THEN 'total' WHEN max(n_files) IS NULL THEN 'missing' ELSE 'ok' END AS status,
        {", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in [*_SUMS, "n_piped", "n_lines"])} FROM j GROUP BY ROLLUP (company))
    SELECT company, status, {", ".join(_SUMS)}, round(n_piped / greatest(1, n_lines), 6) AS piped, en = 0 AND rv = 0 AND sym = 0 AS passed,
        en = 0 AND rv = 0 AND sym = 0 AND dp = 0 AND found_chair > 0 AND found_mda > 0 AS strict FROM t"""


def oracle_sql() -> dict[str, str]:
    f = sorted(forms("s").items())
    year = "coalesce(TRY_CAST(nullif(regexp_extract(file_name, '([0-9]{4})年', 1), '') AS INTEGER), 0)"
    tag = "CASE WHEN {y} <> 0 THEN CAST({y} AS VARCHAR) ELSE '年份未知' END"

    def label(n: str) -> str:
        return f"CASE WHEN {n}_start IS NULL THEN '未找到' ELSE 'p' || {n}_start || '-' || {n}_end || '[' || {n}_term || ']' END"

    def pages(n: str) -> str:
        return f"'第 ' || {n}.start || '–' || {n}.last || ' 页（命中标题「' || {n}.term || '」）'"

    def part(n: str, md: str, missing: str) -> str:
        return f"CASE WHEN {n}.start IS NULL THEN {_q(missing)} ELSE '> 抽取范围：' || {pages(n)} || chr(10) || chr(10) || coalesce(nullif({md}, ''), '（正文为空）') END"

    short, year_tag = short_company("company"), tag.format(y="year")
    content = f"""array_to_string(['# ' || {short} || ' · ' || {year_tag} || ' 年年度报告 · 董事长致辞与管理层讨论与分析', '',
        '> **来源**：`年报PDF/' || file_name || '`（' || {short} || ' ' || {year_tag} || ' 年年度报告）',
        '> **抽取范围**：董事长致辞 ' || coalesce({pages("c")}, '未找到') || '；管理层讨论与分析 ' || coalesce({pages("m")}, '未找到'), {", ".join(map(_q, P.NOTES))}, '',
        '### 董事长致辞（主席報告 / 致股东）', {part("c", "ctext", P.NOT_FOUND + "：本年度年报未单列董事长致辞 / 主席報告】")}, '',
        '### 管理层讨论与分析', {part("m", "mtext", P.NOT_FOUND + "】")}, ''], chr(10))"""
    block = "CASE WHEN kind = 't' THEN chr(10) || t || chr(10) WHEN lvl = 1 THEN chr(10) || '#### ' || t || chr(10) WHEN lvl = 2 THEN chr(10) || '##### ' || t || chr(10) ELSE t || chr(10) END"
    rendered = f"""rendered AS (SELECT doc_id, section, {_strip('regexp_replace(b, chr(10) || chr(10) || chr(10) || chr(43), chr(10) || chr(10), chr(103))')} AS md
        FROM (SELECT doc_id, section, string_agg({block}, chr(10) ORDER BY seq) AS b FROM merged GROUP BY ALL))"""
    documents = f"""docs AS (SELECT doc_id, company, year, file_name, {short} || '_' || {year_tag} || '_董事长致辞与MD&A.md' AS md_name, {content} AS content
        FROM (SELECT DISTINCT doc_id, company, year, file_name FROM reports) LEFT JOIN (SELECT * FROM secs WHERE section = 'chair') c USING (doc_id)
        LEFT JOIN (SELECT * FROM secs WHERE section = 'mda') m USING (doc_id) LEFT JOIN tx USING (doc_id))"""
    latest = "SELECT * FROM docs QUALIFY row_number() OVER (PARTITION BY company, md_name ORDER BY file_name DESC, doc_id DESC) = 1"
    texts = "tx AS (SELECT doc_id, max(md) FILTER (section = 'chair') AS ctext, max(md) FILTER (section = 'mda') AS mtext FROM rendered GROUP BY doc_id)"
    whole_run = f"{RANGES}, {FOUND}, {ITEMS}, {rendered}, {texts}, {documents}"
    found = {
        "line_english": f"SELECT doc_id, page_no, line_no, {english('s')} AS english, {audit_english('s')} AS audit_english FROM {LINES}",
        "line_furniture": f"SELECT doc_id, page_no, line_no, {', '.join(f'{c} AS {k}' for k, c in f)}, {furniture('s')} AS furniture FROM {LINES}",
        "line_garbled": f"SELECT doc_id, page_no, line_no, {rev('s')} AS rev, {audit_rev('s')} AS audit_rev, {tripled('s')} AS tripled, {interleaved('s')} AS interleaved, {symbols('s')} AS symbols, {audit_symbols('s')} AS audit_symbols FROM {LINES}",
        "line_heading": f"SELECT doc_id, page_no, line_no, {level('s')} AS lvl FROM {LINES}",
        "company_parse": f"SELECT doc_id, path, {year} AS parsed_year, {tag.format(y=year)} AS tag, {short} AS short FROM (SELECT DISTINCT * FROM reports)",
        "toc_pages": f"WITH {FACTS}, {TOC} SELECT * FROM toc",
        "section_hits": f"WITH {FACTS}, {TOC}, {HITS} SELECT * FROM hits",
        "section_ranges": f"WITH {RANGES} SELECT * FROM ranges",
        "range_labels": f"WITH {RANGES} SELECT doc_id, company, year, company || ' ' || year || ': 董事长=' || {label('chair')} || ' | MD&A=' || {label('mda')} AS label FROM (SELECT DISTINCT doc_id, company, year FROM reports) LEFT JOIN ranges USING (doc_id)",
        "audit_lines": f"WITH files AS (SELECT * FROM {FILES}), {_AUD} SELECT company, file_name, line_no, en, rv, dp, sym FROM al",
        "audit_rollup": f"WITH files AS (SELECT * FROM {FILES}), {AUDIT}",
        "table_filter": f"WITH {_TABS} SELECT doc_id, page_no, table_no, CAST(n_cols AS INTEGER) AS n_cols, round(share, 6) AS blank_share, accepted FROM ok",
        "table_md": f"WITH {_MD} SELECT doc_id, page_no, table_no, md FROM md",
        "words_outside": f"WITH {_MD}, {_OUT} SELECT doc_id, page_no, word_no FROM outside",
        "column_cut": f"WITH {_cut(WORDS)} SELECT * FROM cuts",
        "column_choice": f"WITH {_cut(WORDS)}, {_choice(WORDS)} SELECT doc_id, page_no, cut, round(ls, 6) AS left_share, round(rs, 6) AS right_share, keep FROM choice",
        "visual_lines": f"WITH {ONE_COLUMN} SELECT * FROM vl",
        "column_lines": f"WITH {IN_COLUMNS} SELECT * FROM vl",
        "margin_mode": f"WITH {ONE_COLUMN}, {BODY}, {MARGIN} SELECT * FROM margin",
        "gap_median": f"WITH {ONE_COLUMN}, {BODY}, {GAP} SELECT {_B}, CAST(med AS INTEGER) AS med, CAST(thr AS DOUBLE) AS thr FROM thr",
        "paragraph_reflow": f"WITH {ONE_COLUMN}, {PARAS} SELECT * FROM paras",
        "page_merge": f"WITH {MERGED} SELECT * FROM merged",
        "paragraph_lengths": f"WITH {MERGED} SELECT doc_id, section, count(*) AS n_paragraphs, round(avg(length(t)), 6) AS mean_length, count(*) FILTER (length(t) <= 60) AS n_short FROM merged WHERE kind = 'p' AND lvl = 0 GROUP BY ALL",
        "render_sections": f"WITH {MERGED}, {rendered} SELECT * FROM rendered",
        "render_report": f"WITH {SECS}, tx AS (SELECT doc_id, max(ctext) AS ctext, max(mtext) AS mtext FROM section_record GROUP BY doc_id), {documents} {latest}",
        "extract_reports": f"WITH {whole_run} {latest}",
        "extract_audit": f"""WITH {whole_run}, placed_files AS (SELECT company, md_name AS file_name, content, CASE WHEN year = 0 THEN 0 ELSE 1 END AS sub FROM ({latest})),
            files AS (SELECT company, file_name, content FROM placed_files QUALIFY sub = max(sub) OVER (PARTITION BY company)), {AUDIT}""",
        "extract_summary": f"""WITH {SECS}, h AS (SELECT doc_id, max(CAST(section = 'chair' AS INTEGER)) AS c, max(CAST(section = 'mda' AS INTEGER)) AS m FROM secs GROUP BY doc_id),
            e AS (SELECT company, year, count(*) AS n, sum(coalesce(c, 0)) AS c, sum(coalesce(m, 0)) AS m FROM (SELECT DISTINCT doc_id, company, year FROM reports) LEFT JOIN h USING (doc_id) GROUP BY ALL)
            SELECT company, CAST(sum(n) AS BIGINT) AS n_reports, CAST(sum(c) AS BIGINT) AS n_chair, CAST(sum(m) AS BIGINT) AS n_mda, count(*) AS n_files FROM e GROUP BY ROLLUP (company)""",
    }
    session = SparkSession.getActiveSession()
    if session is not None:  # the table of characters comes from the session
        script = simplified_script(session)
        plain = f"translate(content, {_q(''.join(map(chr, script)))}, {_q(''.join(script.values()))})"
        found["extract_simplified"] = f"WITH {whole_run} SELECT doc_id, company, year, file_name, md_name, {plain} AS content FROM ({latest})"
    return found
