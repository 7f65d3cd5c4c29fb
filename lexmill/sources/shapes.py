"""Schema on read: JSON lines of several generations as VARIANT, with malformed lines kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The lists of a log line: the dimensions of new rows, and the two names that old rows have for concepts.
LISTS = ("concepts", "domains", "functions", "bearings", "gap_terms", "keywords")


def read_variant_lines(spark: SparkSession, path: str) -> DataFrame:
    """line, v (VARIANT) and malformed of every line that is not blank; malformed lines have a null v and stay."""
    lines = spark.read.text(path).withColumnRenamed("value", "line").filter(F.trim(F.regexp_replace("line", r"[\t\r]", " ")) != "")
    return lines.withColumn("v", F.try_parse_json("line")).withColumn("malformed", F.col("v").isNull())


def shape(v: Column) -> Column:
    """The schema of one value, as text."""
    return F.schema_of_variant(v)


def common_shape(rows: DataFrame) -> str:
    """The schema that holds all values of a table, as text."""
    return rows.agg(F.schema_of_variant_agg("v")).first()[0]


def listed(v: Column, name: str) -> Column:
    """A list of texts in a value: of an array its elements, of a text or number that one, of anything else or nothing null."""
    many = F.try_variant_get(v, f"$.{name}", "array<string>")
    one = F.try_variant_get(v, f"$.{name}", "string")
    return F.coalesce(many, F.when(one.isNotNull() & ~one.startswith("{") & ~one.startswith("["), F.array(one)))


def log_rows(lines: DataFrame) -> DataFrame:
    """article_path and the lists of both generations of a log, of lines that are objects with a path; old ``keywords`` count as gap_terms."""
    v = F.col("v")
    rows = lines.filter("v is not null").select(F.try_variant_get(v, "$.article_path", "string").alias("article_path"), *(listed(v, n).alias(n) for n in LISTS))
    none = F.array().cast("array<string>")
    old = F.when(F.col("gap_terms").isNotNull() | F.col("keywords").isNotNull(), F.concat(F.coalesce("gap_terms", none), F.coalesce("keywords", none)))
    return rows.withColumn("gap_terms", old).drop("keywords").filter("article_path is not null")
