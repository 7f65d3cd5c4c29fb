"""Line dedup: lines that several documents hold stay in one document only.

Lines are exploded, normalised and hashed; documents are counted per hash; lines
over the threshold go, and what is left is put together again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import SPACES, ascii_lower, let, stored

#: A key that stands in more than this part of all rows is joined by broadcast; there are fewer than HOT such keys.
HOT = 1000


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.trim(line, F.lit(SPACES)))


def _hashes(key: Column) -> Column:
    """128 bits of a key: two hashes of different seeds."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("line"), key).alias("b"))


def _lines() -> Column:
    return F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)


def _reassembled(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``docs`` with __kept, the lines left, and __gone, the positions of the others (null: none).

    Lines are exploded once with their positions, and their keys travel as 128-bit hashes. A row is
    its doc_id and a hash of its text; its dropped positions meet it in one join, and the
    others are put together again in order, in time linear in its lines.
    """
    tie = F.xxhash64("text")
    key = line_key(F.col("line"))
    held = stored(
        docs.select("doc_id", tie.alias("t"), F.posexplode(_lines()).alias("pos", "line"))
        .select("doc_id", "t", "pos", key.alias("key"))
        .filter(F.length("key") >= min_chars)
        .select("doc_id", "t", "pos", _hashes(F.col("key")).alias("h"))
        .select("doc_id", "t", "pos", "h.a", "h.b")
    )
    counted = held.select("doc_id", "a", "b").distinct().groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("keeper"))
    common = stored(counted.filter(F.col("n") >= min_docs))
    hot = F.col("n") * HOT > held.count()
    met = held.join(F.broadcast(common.filter(hot)), ["a", "b"]).unionByName(held.join(common.filter(~hot), ["a", "b"]))
    gone = (
        met.filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc_id").alias("__id"), F.col("t").alias("__t"))
        .agg(F.collect_set("pos").alias("__gone"))
    )
    joined = docs.join(gone, docs["doc_id"].eqNullSafe(gone["__id"]) & (tie == gone["__t"]), "left").drop("__id", "__t")
    rest = lambda x: F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("__gone"))
    together = let(_lines(), lambda x: F.array_join(F.transform(rest(x), lambda i: F.get(x, i)), "\n"))
    return joined.withColumn("__kept", F.when(F.col("__gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(together))


def line_dedup(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """Drop lines whose key is in at least ``min_docs`` documents, except in the smallest doc_id.

    Returns every column of ``docs`` with ``text`` replaced by the kept lines joined by
    \\n, and n_lines, n_dropped (long) added (columns of these names are replaced).
    Keys under ``min_chars`` code points always stay. Null text is one empty line.
    Rows with equal doc_id are one document and each comes back; null doc_ids are one
    document that sorts last. All lines of the keeping document stay, repeats too.
    An empty table gives an empty table.
    """
    return (
        _reassembled(docs, min_chars, min_docs)
        .withColumn("n_lines", F.size(_lines()).cast("long"))
        .withColumn("n_dropped", F.coalesce(F.size("__gone"), F.lit(0)).cast("long"))
        .withColumn("text", F.col("__kept"))
        .drop("__kept", "__gone")
    )


def without_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the text of line_dedup(), all other columns unchanged; n_chars, if there, is counted anew."""
    found = _reassembled(docs, 10, 2).withColumn("text", F.col("__kept"))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)


def op3(docs: DataFrame) -> DataFrame:
    """The digest of line_dedup(): doc_id, n_lines, n_dropped, kept_sha256."""
    return line_dedup(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


ORACLE = r"""
WITH l AS (
  SELECT r, doc_id, u.line, u.pos,
         translate(trim(u.line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents) d,
       LATERAL (SELECT unnest(d.a) AS line, unnest(range(len(d.a))) AS pos) u),
k AS (
  SELECT key, min(doc_id) AS keeper FROM l WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT l.doc_id, count(*)::BIGINT AS n_lines,
       (count(*) FILTER (WHERE keeper IS NOT NULL AND keeper <> doc_id))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keeper IS NULL OR keeper = doc_id), ''))
         AS kept_sha256
FROM l LEFT JOIN k ON l.key = k.key
GROUP BY r, l.doc_id
"""
