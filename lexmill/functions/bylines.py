"""Bylines: era years to common years, and the parts of a normalised byline."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.numerals import DIGITS, small_numeral
from lexmill.functions.text import let, strip

#: Era names with the year before their first, seasons with their month.
ERAS = {"宣統": 1908, "民國": 1911}
SEASONS = {"春": "03", "夏": "06", "秋": "09", "冬": "12"}
#: What a byline of a mere source begins with; closing verbs, longest first.
SOURCE_ONLY = "見海刊"
VERBS = ("編述", "編", "講", "作", "記", "說")
_MONTH = "^([正一二三四五六七八九]|十[一二]?)月"


def _month_number(name: Column) -> Column:
    months = {"正": 1, **{d: i for i, d in enumerate(DIGITS, 1)}, "十": 10, "十一": 11, "十二": 12}
    out = F.lit(None).cast("int")
    for text, n in months.items():
        out = F.when(name == text, n).otherwise(out)
    return out


def month_season(rest: Column) -> Column:
    """struct(month, rest): a leading month as ``N 月``, a leading season as it is, else ''."""
    t = strip(F.coalesce(rest, F.lit("")))
    n = _month_number(F.regexp_extract(t, _MONTH, 1))
    season = F.substring(t, 1, 1).isin(*SEASONS)
    return F.struct(
        F.when(n.isNotNull(), F.concat(n.cast("string"), F.lit(" 月"))).when(season, F.substring(t, 1, 1)).otherwise("").alias("month"),
        F.when(n.isNotNull(), strip(F.regexp_replace(t, _MONTH, ""))).when(season, strip(F.substring(t, 2, 1 << 30))).otherwise(t).alias("rest"),
    )


def date_suffix(month: Column, rest: Column) -> Column:
    """Month and rest behind a year; a season, of one character, takes no space."""
    gap = F.when((month == "") | (F.length(month) == 1), "").otherwise(" ")
    return F.concat(gap, month, F.when(rest == "", "").otherwise(F.concat(F.lit("，"), rest)))


def normalize_byline(raw: Column, eras: dict = ERAS, bare: int = 1911, source_only: str = SOURCE_ONLY) -> Column:
    """``（year month，rest）`` of a byline with an era year or a bare year of 1 to 99; others in brackets as they are.

    The first rule that holds decides; a year that is no numeral passes on to the next.
    Runs of two or more long dashes at the ends go. A mere source gives ''. Null gives ''.
    """
    def dated(text: Column, prefix: str, base: int, bounded: bool = False) -> Column:
        pattern = f"^{prefix}(.+?)年(.*)"
        year = F.when(text.rlike(pattern), small_numeral(F.regexp_extract(text, pattern, 1)))
        tail = let(month_season(F.regexp_extract(text, pattern, 2)), lambda ms: date_suffix(ms["month"], ms["rest"]))
        said = lambda y: F.concat(F.lit("（"), (y + base).cast("string"), F.lit(" 年"), tail, F.lit("）"))
        return let(year, lambda y: F.when(y.between(1, 99) if bounded else y.isNotNull(), said(y)))

    def normal(text: Column) -> Column:
        rules = [dated(text, era, base) for era, base in eras.items()] + [dated(text, "", bare, bounded=True)]
        wrapped = F.coalesce(*rules, F.concat(F.lit("（"), text, F.lit("）")))
        return F.when(text.startswith(source_only), "").when(text.rlike("^（.+記）$"), text).otherwise(wrapped)

    given = strip(F.coalesce(raw, F.lit("")))
    return F.when(given == "", "").otherwise(let(strip(F.regexp_replace(given, "^——+|——+$", "")), normal))


def byline_fields(byline: Column) -> Column:
    """struct(create_y, create_m, create_d, location, context) of a normalised byline; '' where missing."""
    inner = F.regexp_replace(F.coalesce(byline, F.lit("")), "^[（ ）()]+|[（ ）()]+$", "")
    year = F.regexp_extract(inner, r"(?U)^(\d+)\s*年", 1)
    after_year = strip(F.regexp_replace(inner, r"(?U)^\d+\s*年", ""))
    month = F.regexp_extract(after_year, r"(?U)^(\d{1,2})\s*月", 1)
    after_month = strip(F.regexp_replace(after_year, r"(?U)^\d{1,2}\s*月", ""))
    day = F.when(month != "", F.regexp_extract(after_month, r"(?U)^(\d{1,2})\s*日", 1)).otherwise("")
    first = F.substring(after_year, 1, 1)
    season = F.lit("")
    for name, number in SEASONS.items():
        season = F.when(first == name, number).otherwise(season)
    with_month = strip(F.regexp_replace(after_month, r"(?U)^\d{1,2}\s*日", ""))
    with_season = F.when(season != "", strip(F.substring(after_year, 2, 1 << 30))).otherwise(after_year)
    rest = F.when(year == "", inner).otherwise(F.regexp_replace(F.when(month != "", with_month).otherwise(with_season), r"(?U)^[，,]\s*", ""))
    two = lambda x: F.lpad(x, 2, "0")
    in_place = "^在(.+?)([編講作記述說]+)$"
    location, context = rest, F.lit("")
    for verb in reversed(VERBS):
        ends = rest.endswith(verb)
        location = F.when(ends, strip(F.substring(rest, F.lit(1), F.length(rest) - len(verb)))).otherwise(location)
        context = F.when(ends, verb).otherwise(context)
    at = "^作於(.+)"
    return F.struct(
        year.alias("create_y"),
        F.when(year == "", "").when(month != "", two(month)).otherwise(season).alias("create_m"),
        F.when((year == "") | (day == ""), "").otherwise(two(day)).alias("create_d"),
        F.when(rest.rlike(in_place), strip(F.regexp_extract(rest, in_place, 1))).when(rest.rlike(at), strip(F.regexp_extract(rest, at, 1))).otherwise(location).alias("location"),
        F.when(rest.rlike(in_place), F.regexp_extract(rest, in_place, 2)).when(rest.rlike(at), "作").otherwise(context).alias("context"),
    )


def appendix_place(text: Column) -> Column:
    """``講於X`` as ``在X講``."""
    return F.regexp_replace(text, "講於([^，。,]+)", "在$1講")


def lecture_place(text: Column) -> Column:
    """A place as ``在X``, and ``講於X`` as ``在X講``."""
    t = F.ltrim(text, F.lit("，,。."))
    told = F.concat(F.lit("在"), F.regexp_replace(t, "^講於", ""), F.lit("講"))
    return F.when(t.startswith("講於"), told).when((t == "") | t.startswith("在"), t).otherwise(F.concat(F.lit("在"), t))


def appendix_date(raw: Column) -> Column:
    """``（year month，place）`` of a note that dates an appendix, the place by lecture_place(); without a year as normalize_byline(). Null gives ''."""
    dated = f"(?U)^(.+?年(?:[{DIGITS}十]+月|[{''.join(SEASONS)}])?)\\s*(.*)"

    def told(t: Column) -> Column:
        parts = F.struct(normalize_byline(F.regexp_extract(t, dated, 1)).alias("date"), lecture_place(strip(F.regexp_extract(t, dated, 2))).alias("place"))
        whole = lambda p: F.concat(F.lit("（"), F.btrim(p["date"], F.lit("（）")), F.lit("，"), p["place"], F.lit("）"))
        both = let(parts, lambda p: F.when((p["date"] == "") | (p["place"] == ""), p["date"]).otherwise(whole(p)))
        return F.when(t.rlike(dated), both).otherwise(normalize_byline(t))

    return let(strip(F.coalesce(raw, F.lit(""))), told)


def date_parts(text: Column) -> Column:
    """struct(y, m, d) of YYYY.MM.DD or YYYY-MM-DD; null fields where there is none."""
    pattern = r"(\d{4})[.-](\d{2})[.-](\d{2})"
    part = lambda i: F.nullif(F.regexp_extract(text, pattern, i), F.lit(""))
    return F.struct(part(1).alias("y"), part(2).alias("m"), part(3).alias("d"))


def dotted_date(text: Column) -> Column:
    """A full date with dots for hyphens; other texts as they are."""
    return F.regexp_replace(text, r"^(\d{4})-(\d{2})-(\d{2})$", "$1.$2.$3")
