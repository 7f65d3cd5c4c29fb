"""Catalogues, logs, markdown, front matter, database dumps and exports as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_catalogues(spark: SparkSession, path: str, entries: str, pattern: str = "*.json") -> DataFrame:
    """One row per entry of the array ``entries`` of JSON catalogues, with its position and file."""
    docs = spark.read.option("multiLine", True).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).json(path)
    return docs.select(F.input_file_name().alias("file_name"), F.posexplode(entries).alias("entry_index", "entry")).select("file_name", "entry_index", "entry.*")


def catalogue_entries(spark: SparkSession, path: str, mark: str = "_編目錄.json") -> DataFrame:
    """folder and entry (entry_index and its fields) of the catalogues ``NAME`` + ``mark`` in folders that begin with two digits and a line."""
    names = F.split(F.url_decode("file_name"), "/")
    found = read_catalogues(spark, path, "entries", "*" + mark).withColumn("folder", F.element_at(names, -2))
    return found.filter(F.col("folder").rlike(r"^\d{2}_")).drop("file_name")


def read_log(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines; malformed ones are skipped."""
    reader = spark.read.option("mode", "DROPMALFORMED")
    return (reader.schema(schema) if schema else reader).json(path)


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """seq, standard, variants, ... of a JSON document with an array ``terms``."""
    terms = spark.read.option("multiLine", True).json(path).select(F.posexplode("terms").alias("seq", "t"))
    return terms.select("seq", "t.*")


def read_labels(spark: SparkSession, path: str, dimensions: tuple[str, ...] = ("functions", "bearings")) -> DataFrame:
    """dimension and label of JSON documents that list the labels of each dimension; documents without a list have none."""
    schema = ", ".join(f"`{d}` array<string>" for d in dimensions)
    docs = spark.read.schema(schema).option("multiLine", True).json(path)
    named = F.map_from_arrays(F.array(*map(F.lit, dimensions)), F.array(*(F.coalesce(d, F.array().cast("array<string>")) for d in dimensions)))
    return docs.select(F.explode(named).alias("dimension", "labels")).select("dimension", F.explode("labels").alias("label")).distinct()


#: What a publication of a calendar may tell.
CALENDAR = "category: string, aliases: array<string>, ref_count: long, volume_to_year: map<string,int>, confidence: string"


def read_calendar(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(publications, heuristics) of JSON calendars: name and the fields of CALENDAR, lists and maps never null; name and rule."""
    docs = spark.read.schema(f"publications map<string,struct<{CALENDAR}>>, heuristics map<string,string>").option("multiLine", True).json(path)
    rows = docs.select(F.explode("publications").alias("name", "p")).select("name", "p.*")
    filled = rows.withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>"))).withColumn("volume_to_year", F.coalesce("volume_to_year", F.create_map().cast("map<string,int>")))
    return filled.withColumn("ref_count", F.coalesce("ref_count", F.lit(0))), docs.select(F.explode("heuristics").alias("name", "rule"))


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """path and text of Markdown files."""
    return spark.read.option("wholetext", True).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(path).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def front_matter(text: Column) -> Column:
    """Map of ``key: value`` lines between the first two --- lines; of repeated keys the last counts."""
    block = F.regexp_extract(text, r"(?s)\A\s*---[ \t]*\n(.*?)\n---[ \t]*(?:\n|\z)", 1)
    lines = F.filter(F.split(block, "\n"), lambda x: x.contains(":"))
    trim = lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")
    pairs = F.transform(lines, lambda x: F.struct(trim(F.substring_index(x, ":", 1)).alias("k"), trim(F.substring(x, F.length(F.substring_index(x, ":", 1)) + 2, 1 << 30)).alias("v")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def body(text: Column, contents: str = "目錄") -> Column:
    """The text without front matter and without the contents section, which ends at the next heading."""
    out = F.regexp_replace(text, r"(?s)\A\s*---[ \t]*\n.*?\n---[ \t]*(?:\n|\z)", "")
    return F.regexp_replace(out, rf"(?ms)^##[ \t]+{contents}[ \t]*$.*?(?=^##?[ \t]+\S|\z)", "")


def title(text: Column, fallback: Column) -> Column:
    """The first heading of level 1 without a closing [n]; else ``fallback``."""
    found = F.regexp_replace(F.regexp_extract(text, r"(?m)^#[ \t]+(.+?)[ \t]*$", 1), r"\s*\[\d+\]$", "")
    return F.when(found != "", found).otherwise(fallback)


def markdown_tables(docs: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """key, line_no, section, heading, cells of every data row of Markdown tables; section and heading are the last before."""
    lines = docs.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    mark = lambda p: F.when(F.col("line").rlike(p), F.regexp_extract("line", p, 1))
    filled = lines.select(
        key, "line_no", "line", F.last(mark(r"^# (?:\d+、)?(.*)$"), True).over(w).alias("section"), F.last(mark(r"^## (.*)$"), True).over(w).alias("heading")
    )
    rows = filled.filter(F.col("line").rlike(r"^\s*\|") & ~F.col("line").rlike(r"^\s*\|[\s|:-]*$"))
    cells = F.transform(F.split(F.regexp_replace("line", r"^\s*\||\|\s*$", ""), r"\|"), lambda c: F.trim(c))
    nxt = Window.partitionBy(key, "section", "heading").orderBy("line_no")
    return rows.withColumn("__n", F.row_number().over(nxt)).filter("__n > 1").select(key, "line_no", "section", "heading", cells.alias("cells"))


def carried(lines: DataFrame, key: str, order: str, line: str, patterns: dict[str, str]) -> DataFrame:
    """Lines with, for every name, the last match of its pattern up to there: a report read back."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.select("*", *(F.last(F.when(F.col(line).rlike(p), F.regexp_extract(line, p, 1)), True).over(w).alias(n) for n, p in patterns.items()))


def dump_type(declared: str) -> T.DataType:
    """The column type of a declared database type: integers, real numbers, or text."""
    t = declared.lower()
    if "int" in t:
        return T.LongType()
    return T.DoubleType() if any(x in t for x in ("float", "double", "decimal", "real", "numeric")) else T.StringType()


def read_dump(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """Rows of an XML database dump as maps from field to text."""
    rows = spark.read.format("xml").option("rowTag", "row").schema("field array<struct<_VALUE:string,_name:string>>").load(path)
    return rows.select(F.map_from_entries(F.transform("field", lambda f: F.struct(f["_name"].alias("k"), f["_VALUE"].alias("v")))).alias("fields"))


def dump_columns(spark: SparkSession, path: str) -> list[tuple[str, T.DataType, bool]]:
    """(name, type, is key) of the columns that a dump declares."""
    kind = "_name string, field array<struct<_Field:string,_Type:string,_Null:string,_Key:string,_Extra:string>>"
    s = spark.read.format("xml").option("rowTag", "table_structure").schema(kind).load(path).first()
    return [(f["_Field"], dump_type(f["_Type"] or ""), f["_Key"] == "PRI") for f in (s["field"] if s else [])]


def typed_dump(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a dump in declared types; what does not fit its type is null."""
    return read_dump(spark, path).select(*(F.col("fields")[n].try_cast(t).alias(n) for n, t, _ in dump_columns(spark, path)))


def create_statement(table: str, columns: list[tuple[str, T.DataType, bool]]) -> str:
    """CREATE TABLE: a single key column inline, several as a clause."""
    names = {"bigint": "INTEGER", "double": "REAL"}
    keys = [n for n, _, k in columns if k]
    lines = [f'  "{n}" {names.get(t.simpleString(), "TEXT")}' + (" PRIMARY KEY" if keys == [n] else "") for n, t, _ in columns]
    if len(keys) > 1:
        lines.append("  PRIMARY KEY (" + ", ".join(f'"{k}"' for k in keys) + ")")
    return f'CREATE TABLE "{table}" (\n' + ",\n".join(lines) + "\n)"
