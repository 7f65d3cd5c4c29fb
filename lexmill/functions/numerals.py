"""Chinese numerals as Column functions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import let, strip

DIGITS = "一二三四五六七八九"
#: Single characters with values of their own.
SINGLE = {"十": 10, "廿": 20, "卅": 30, "卌": 40, "圩": 50, "進": 60, "圆": 70, "枯": 80, "枠": 90, "零": 0, "０": 0}
_FULL, _ASCII = "０１２３４５６７８９", "0123456789"


def direct_values() -> dict[str, int]:
    """Numerals that are looked up whole: single characters and 1 to 99 by the rule of tens and ones."""
    out = {d: i for i, d in enumerate(DIGITS, 1)} | SINGLE
    for n in range(11, 100):
        tens, ones = divmod(n, 10)
        out[("" if tens == 1 else DIGITS[tens - 1]) + "十" + (DIGITS[ones - 1] if ones else "")] = n
    return out


def _map(values: dict[str, int]) -> Column:
    return F.create_map(*map(F.lit, chain.from_iterable(values.items())))


def _ascii(text: Column) -> Column:
    return F.translate(text, _FULL, _ASCII)


def small_numeral(text: Column) -> Column:
    """1 to 99 by adding up at 十; digits as they are; other characters, zero and nothing give null."""
    value = _map({d: i for i, d in enumerate(DIGITS, 1)})
    begin = F.struct(F.lit(0).alias("total"), F.lit(0).alias("last"))
    step = lambda acc, c: F.when(
        c == "十", F.struct((acc["total"] + F.when(acc["last"] == 0, 1).otherwise(acc["last"]) * 10).alias("total"), F.lit(0).alias("last"))
    ).otherwise(F.struct(acc["total"].alias("total"), F.coalesce(F.element_at(value, c), F.lit(0)).alias("last")))

    def parsed(t: Column) -> Column:
        chars = F.filter(F.split(t, ""), lambda c: c != "")
        total = F.nullif(F.aggregate(chars, begin, step, lambda acc: acc["total"] + acc["last"]), F.lit(0))
        return F.when(t.rlike("^[0-9０-９]+$"), _ascii(t).try_cast("int")).when(t.rlike(f"^[{DIGITS}十]+$"), total).cast("int")

    return let(strip(text), parsed)


def wide_numeral(text: Column) -> Column:
    """Numerals looked up whole, digits of both widths, three or more digits by position, else 百 and 十 compounds."""
    table = _map(direct_values())
    head = lambda s, mark: F.substring_index(s, mark, 1)
    tail = lambda s, mark: F.substring(s, F.length(head(s, mark)) + 2, 1 << 30)
    part = lambda s: F.when(s == "", 1).otherwise(F.coalesce(F.element_at(table, s), F.lit(1)))
    ones = lambda s: F.coalesce(F.element_at(table, s), F.lit(0))
    tens = lambda s: F.when(s.contains("十"), part(head(s, "十")) * 10 + ones(tail(s, "十"))).otherwise(ones(s))
    compound = lambda t: F.when(t.contains("百"), part(head(t, "百")) * 100 + let(tail(t, "百"), tens)).otherwise(tens(t))

    def parsed(t: Column) -> Column:
        return (
            F.when(t == "", F.lit(None))
            .when(F.element_at(table, t).isNotNull(), F.element_at(table, t))
            .when(t.rlike("^[+-]?[0-9０-９]+$"), _ascii(t).try_cast("int"))
            .when(t.rlike(f"^[{DIGITS}〇零]{{3,}}$"), F.translate(t, DIGITS + "〇零", "12345678900").try_cast("int"))
            .otherwise(F.nullif(compound(t), F.lit(0)))
            .cast("int")
        )

    return let(strip(text), parsed)
