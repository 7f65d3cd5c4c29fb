"""Character classes, headings, labels, snippets: Column functions with CJK defaults.

Java's \\s and \\d are ASCII unless (?U) is set; every pattern that relies on them sets it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: CJK with compatibility ideographs, and CJK with the supplementary plane instead.
CJK_COMPAT = "一-鿿㐀-䶿豈-﫿"
CJK_WIDE = "一-鿿㐀-䶿\\x{20000}-\\x{2a6df}"
#: Numerals, section words, heavenly stems, earthly branches.
NUMERALS = "一二三四五六七八九十百千万"
SECTIONS = "章節节篇部"
STEMS = "甲乙丙丁戊己庚辛壬癸"
BRANCHES = "子丑寅卯辰巳午未申酉戌亥"
#: Words that mark purely structural divisions.
STRUCTURAL = ("目次", "綱要", "目錄", "目録", "科分")
#: Simplified and traditional forms that labels may mix, in pairs.
SIMPLIFIED_TRADITIONAL = (
    "脱脫 觉覺 间間 会會 圆圓 识識 众眾 体體 义義 门門 证證 实實 学學 经經 论論 广廣 严嚴 宝寶 禅禪 观觀 净淨 应應 处處 转轉 释釋 "
    "导導 纲綱 约約 说說 总總 系係 构構 专專 题題 达達 传傳 团團 机機 关關 归歸 划劃 节節 类類 历歷 统統 制制 华華 习習 写寫 录錄 "
    "权權 树樹 极極 乐樂 谛諦 摄攝 择擇 据據 断斷 异異 当當 号號 国國 图圖 对對 复復 从從 动動 卫衛 湿濕 煖煖 协協"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` written and evaluated once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def count_class(text: Column, chars: str = CJK_COMPAT) -> Column:
    """How many code points of a character class a text holds; null counts none."""
    return F.coalesce(F.length(F.regexp_replace(text, f"[^{chars}]", "")), F.lit(0))


def is_only(text: Column, chars: str = CJK_WIDE) -> Column:
    """Whether a text is not empty and of one character class."""
    return text.rlike(f"^[{chars}]+$")


def bucket(n: Column, limits: tuple = (5000, 15000, 30000), names: tuple = ("5-8", "8-12", "10-15", "12-18")) -> Column:
    """The name of the first limit that ``n`` does not exceed, else the last name."""
    out = F.lit(names[-1])
    for limit, name in reversed(tuple(zip(limits, names, strict=False))):
        out = F.when(n <= limit, name).otherwise(out)
    return out


def thousands(n: Column) -> Column:
    """``n`` in thousands, rounded down."""
    return F.floor(n / 1000).cast("long")


def space_heading(heading: Column, numerals: str = NUMERALS, sections: str = SECTIONS, stems: str = STEMS) -> Column:
    """An ideographic space behind the ordinal that a heading begins with, by four rules in turn."""
    ahead, gap = "(?=[一-鿿])", "$1　"
    out = F.regexp_replace(heading, f"^(第[{numerals}]+[{sections}]){ahead}", gap)
    out = F.regexp_replace(out, f"^([{stems}][{numerals}]+){ahead}", gap)
    out = F.regexp_replace(out, f"^([{stems}])(?![{numerals}]){ahead}", gap)
    return F.regexp_replace(out, f"^([{numerals}]){ahead}", gap)


def semantic_label(heading: Column, parent: Column) -> Column:
    """部 章 節 小節 小小節 or ? of a spaced heading, by its pattern and its parent's label."""

    def under(pairs: dict, other: str) -> Column:
        out = F.lit(other)
        for above, below in pairs.items():
            out = F.when(parent == above, below).otherwise(out)
        return out

    n, gap = f"[{NUMERALS}]+", "[　、]"
    return (
        F.when(heading.rlike(f"^第{n}章"), "章")
        .when(heading.rlike(f"^第{n}[節节]"), "節")
        .when(heading.rlike("^[０-９]+[　、．]"), "小節")
        .when(heading.rlike(f"^[{STEMS}]{n}"), under({"部": "章", "章": "節", "節": "小節", "小節": "小小節"}, "節"))
        .when(heading.rlike(f"^[{STEMS}]{gap}"), under({"章": "節", "節": "小節", "小節": "小小節"}, "節"))
        .when(heading.rlike(f"^[{BRANCHES}]{gap}"), under({"節": "小節"}, "小小節"))
        .when(heading.rlike(f"^{n}{gap}"), under({"部": "章", "章": "節", "節": "小節"}, "小節"))
        .otherwise(under({"篇": "部", "部": "章", "章": "節", "節": "小節"}, "?"))
    )


def is_structural(heading: Column, words: tuple = STRUCTURAL) -> Column:
    """Whether a heading names a table of contents, an outline or the like."""
    return F.coalesce(heading.rlike("|".join(words)), F.lit(False))


def is_heading_line(line: Column, deepest: int = 3) -> Column:
    """Whether a line is a Markdown heading of at most ``deepest`` marks."""
    return line.rlike(rf"(?U)^#{{1,{deepest}}}(\s|$)")


def simplified(label: Column, pairs: str = SIMPLIFIED_TRADITIONAL) -> Column:
    """Traditional characters replaced by simplified ones, one by one."""
    return F.translate(label, "".join(p[1] for p in pairs.split()), "".join(p[0] for p in pairs.split()))


def standard_term(label: Column) -> Column:
    """``term`` of ``term（gloss）``; other labels as they are."""
    return F.regexp_replace(label, "^([^（]+)（[^）]+）$", "$1")


def normal_label(label: Column) -> Column:
    """standard_term() in simplified characters."""
    return simplified(standard_term(label))


def snippet(text: Column, position: Column, window: int = 40) -> Column:
    """The text around a 0-based position, line feeds as spaces, with ellipses where it is cut."""
    start = F.greatest(position - window, F.lit(0))
    end = F.least(F.length(text), position + window + 2)
    inner = F.translate(F.substring(text, start + 1, end - start), "\n", " ")
    return F.concat(F.when(start > 0, "…").otherwise(""), inner, F.when(end < F.length(text), "…").otherwise(""))


def joined(labels: Column, between: str = "、") -> Column:
    """A list as text."""
    return F.array_join(labels, between)


def link_list(names: Column, targets: Column, between: str = " / ") -> Column:
    """Markdown links of two arrays."""
    return F.array_join(F.zip_with(names, targets, lambda n, t: F.concat(F.lit("["), n, F.lit("]("), t, F.lit(")"))), between)


def yaml_quoted(text: Column) -> Column:
    """A double-quoted YAML scalar."""
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def split_trailing_source(text: Column) -> Column:
    """struct(body, source): a closing ``。（見…）`` cut off the last line that is not blank."""
    pattern = r"(?s)^(.*。)(（見[^）]*）)\s*$"
    hit = text.rlike(pattern)
    return F.struct(
        F.when(hit, F.regexp_extract(text, pattern, 1)).otherwise(text).alias("body"),
        F.when(hit, F.regexp_extract(text, pattern, 2)).alias("source"),
    )


def split_appendix_heading(heading: Column) -> Column:
    """The subtitle of a heading that begins with 附 and a colon, a space or nothing; null for others."""
    return F.when(heading.rlike("^附"), F.regexp_replace(heading, "^附[：:　 ]?", ""))


def truncated(text: Column, most: int) -> Column:
    """The first ``most`` characters of a text."""
    return F.substring(text, 1, most)


def directory_index(name: Column, names: Column) -> Column:
    """The place of a name in a list, from 1; null if it is not there."""
    return F.nullif(F.array_position(names, name), F.lit(0))
