"""Fixed values of the report-text rules: word lists, character classes and patterns, as they must be for the right results.

Patterns use only what Java and RE2 have in common, with explicit Unicode classes, so the same rule runs in Spark and in other engines.
"""

from __future__ import annotations

# White space and line boundaries of Unicode text.
SPACE = r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LINE_BREAK = r"\r\n|[\n\r\x{b}\x{c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
HAN = "一-鿿"
NUMERALS = "一二三四五六七八九十"

# Titles of the two sections, in the order of the search.
CHAIR_TERMS = [
    "董事长报告书", "董事长致辞", "董事長致辭", "董事會致辭", "致股东的信", "致股东书", "致股東信", "主席致辭", "主席的話", "主席報告", "董事長報告書", "董事長報告",
    "致股东", "致股東",
]
MDA_TERMS = [
    "管理层讨论与分析", "经营情况讨论与分析", "管理層討論與分析", "管理層討論及分析", "董事會工作報告", "董事會報告", "董事会报告", "董事会工作报告", "業務回顧", "业务回顾",
]
MDA_CANON = ["管理層討論與分析", "管理層討論及分析", "管理层讨论与分析", "经营情况讨论与分析", "董事會工作報告", "董事會報告", "董事会工作報告", "董事会报告"]
MDA_FALLBACK = ["業務回顧", "业务回顾", "業務回顧與分析"]

# Top-level titles that end a section.
MAJOR_TITLES = [
    "管理層討論與分析", "管理層討論及分析", "董事會工作報告", "董事會報告", "企業管治報告", "監事會工作報告", "獨立核數師報告", "綜合財務報表", "財務報表", "主席報告", "董事長報告",
    "環境社會及管治報告", "可持續發展報告", "業務回顧", "业务回顾",
]
SECTION_NAMES = [
    "重要提示", "目录", "释义", "公司简介和主要财务指标", "管理层讨论与分析", "经营情况讨论与分析", "董事会报告", "监事会报告", "公司治理", "环境与社会责任", "重要事项",
    "股份变动及股东情况", "优先股相关情况", "债券相关情况", "财务报告", "董事长致辞", "致股东的信", "致股东书",
]
ALL_TITLES = sorted({*CHAIR_TERMS, *MDA_TERMS, *MAJOR_TITLES, *SECTION_NAMES})
if len(ALL_TITLES) > 63:
    raise ValueError("a page's titles are the bits of one number")

# Lines with these characters cite a section rather than open it.
CITING = "，。、（）()：;；,.參閱詳見請頁见"
SECTION_HEAD = f"^第([{NUMERALS}]+)[节節]"
SECTION_HEAD_LINE = f"^第[{NUMERALS}]+[节節]([{SPACE}]+[一-龥].*)?$"
SECTION_PREFIX = f"^第[{NUMERALS}]+[节節][{SPACE}]*"
PAGE_FIGURE = r"^\p{Nd}{1,4}$"

# The thirteen forms of page furniture, by name.
FURNITURE = {
    "page_of": rf"^[{SPACE}]*\p{{Nd}}{{1,4}}[{SPACE}]*[/／][{SPACE}]*\p{{Nd}}{{1,4}}[{SPACE}]*$",
    "bare_number": rf"^[{SPACE}]*\p{{Nd}}{{1,6}}[{SPACE}]*$",
    "section_title": (
        f"^[{SPACE}]*(?:主席報告|主席报告|董事長致辭|董事长致辞|董事長報告|致股東|致股东|管理層討論與?及?分析|管理层讨论与分析|經營?情況討論與分析|董事會報告|董事会报告|業務回顧|业务回顾)[{SPACE}]*$"
    ),
    "number_company": rf"^[{SPACE}]*\p{{Nd}}{{1,4}}[{SPACE}]*[{HAN}]{{2,}}?(?:股份)?有限公司[{SPACE}]*$",
    "company_number": rf"^[{SPACE}]*[{HAN}]{{2,}}?(?:股份)?有限公司[{SPACE}]*\p{{Nd}}{{1,4}}[{SPACE}]*$",
    "annual_report": "(?i)Annual Report",
    "unit_simplified": "^单位",
    "unit_traditional": "^單位",
    "tick_box": rf"[√□][{SPACE}]*适用",
    "security_code": "证券代码|证券简称|證券代碼|證券簡稱",
    "url": r"http|www\.",
    "continued": "上接第|下转第",
}
# The thirteenth form, a report's name with its year.
REPORT_YEAR = "年度?[報报]"
YEAR_FIGURES = r"\p{Nd}{4}|[〇零一二三四五六七八九]{4}"

# Numbered headings; the first three forms are of the top level.
_TOP_HEAD = f"第[{NUMERALS}]+[节節]|[{NUMERALS}]+、|[（(][{NUMERALS}]+[）)]"
_ANY_HEAD = _TOP_HEAD + "|[0-9]{1,2}[.、]|[（(][0-9]{1,2}[）)]"
HEAD = f"^[{SPACE}]*(?:{_ANY_HEAD})[{SPACE}]*[^{SPACE}]"
HEAD_TOP = f"^[{SPACE}]*(?:{_TOP_HEAD})[{SPACE}]*[^{SPACE}]"
HEAD_START = f"^[{SPACE}]*(?:{_ANY_HEAD})"
NOT_HEAD_END = "[。，,、；;：:]$"
SENTENCE_END = "[。！？；：…”」』）)]$"

# Lines without letters that Markdown needs.
RULE_LINES = [r"^[-*_]{3,}$", rf"^\|[{SPACE}\-:|]+\|$", rf"^\|[{SPACE}\-:|（()）%–—]*\|$"]
CHAIR_MENTION = "董事长致辞|董事長致辭|主席報告|致股东"
MDA_MENTION = "管理层讨论与分析|管理層討論|董事会报告|業務回顧|经营情况讨论"
NOT_FOUND = "【未找到该章节"

# What a document says about itself, in this order.
NOTES = (
    "> **已做可读化重整**：PDF 断行并回整段；章节标题分层（`####` / `#####`）；页码/页眉/勾选框等页家具剔除；表格尽量还原为 Markdown 表格。",
    "> **只保留中文**：港股年报为中英双语，双语双栏按栏位切分后**去除英文栏**；A股本即中文。",
    "> 说明：A股年报通常无独立「董事长致辞」章节（多在「第三节 管理层讨论与分析」）；港股多在「主席報告 / 致股東」中。未找到的章节如实标注，绝不虚构。",
    "> 局限：① 极少数「数据概览 / 图版」页为多表拼版，文字顺序可能错乱；② 含装饰性 logo 水印的页面（如华润电力部分年份），水印字母可能残留少量孤立字母行。遇此请以源 PDF 页码回查。",
)
