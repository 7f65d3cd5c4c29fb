"""Document fingerprints by winnowing.

Hashes of all k-grams of words roll over the text; of every window of hashes the
smallest is kept, the rightmost of equals, with its position. Any passage of
``k + window - 1`` words that two texts share leaves a fingerprint in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import GAP, cuts, let

#: Words in a gram, grams in a window: shared runs of 12 words are always caught.
K, WINDOW = 5, 8
#: Low bits of what windows compare hold the position, counted down so that of equal hashes the rightmost is least. No string
#: of Spark's has 2**30 words; the 33 bits above order the hashes, of which marks keep all 64.
POSITION_BITS = 30
#: Documents between two cuts of the id range, about, and cuts at most.
RUN, MOST_RUNS = 500, 4096


def marks(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """Winnowed marks of a text, ascending by position: structs of hash (64 bits) and position.

    Words are runs of [^\\x20\\x09-\\x0D]. A text of fewer than ``k`` words is one gram;
    a text without words (null, empty) has no marks.
    """
    last = (1 << POSITION_BITS) - 1
    words = F.filter(F.split(F.coalesce(text, F.lit("")), GAP, -1), lambda x: x != "")
    hashes = F.transform(words, lambda x: F.xxhash64(x))

    def gram(run: Column, at: Column) -> Column:
        top = F.shiftleft(F.shiftrightunsigned(F.xxhash64(run), 1 + POSITION_BITS), POSITION_BITS)
        return top.bitwiseOR(F.lit(last) - at.cast("long"))

    def grams(h: Column) -> Column:
        whole = F.array(gram(h, F.lit(0)))
        rolled = F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: gram(F.slice(h, i + 1, k), i))
        return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).when(F.size(h) <= k, whole).otherwise(rolled)

    def least(g: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(g) - window + 1), lambda i: F.array_min(F.slice(g, i, window)))
        return (
            F.when(F.size(g) == 0, g)
            .when(F.size(g) <= window, F.array(F.array_min(g)))
            .otherwise(F.array_distinct(windows))
        )

    def named(h: Column) -> Column:
        at = F.transform(let(grams(h), least), lambda x: (F.lit(last) - x.bitwiseAND(F.lit(last))).cast("int"))
        return F.transform(at, lambda i: F.struct(F.xxhash64(F.slice(h, i + 1, k)).alias("hash"), i.alias("position")))

    return let(hashes, named)


def mark_hashes(found: Column) -> Column:
    """The distinct hashes of marks."""
    return F.array_distinct(F.transform(found, lambda x: x["hash"]))


def mark_positions(found: Column) -> Column:
    """The word positions of marks."""
    return F.transform(found, lambda x: x["position"])


def digest(found: Column) -> Column:
    """Marks as text: each hash in hex, in order of position."""
    return F.array_join(F.transform(found, lambda x: F.lower(F.hex(x["hash"]))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of hashes; two empty ones are alike, 1."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Every row of ``docs`` with ``marks`` (hash and position) of its whole text; a column of this name is replaced."""
    return docs.withColumn("marks", marks(F.col("text"), k, window))


def _rank(value: Column, at: list, id_type) -> Column:
    """How many of the ascending ``at`` are not above ``value``: first among every 64th, then among 64."""
    if not at:
        return F.lit(0)
    edges = F.array(*[F.lit(x).cast(id_type) for x in at])
    coarse = F.array(*[F.lit(x).cast(id_type) for x in at[::64]])
    block = F.size(F.filter(coarse, lambda x: x <= value))
    return F.when(block == 0, F.lit(0)).otherwise(
        64 * (block - 1) + F.size(F.filter(F.slice(edges, 64 * (block - 1) + 1, 64), lambda x: x <= value))
    )


def with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """doc_id, text, next_text, own, and the window they came from: the next row by ascending doc_id.

    Null ids stand last, equal ids by text; after the last row comes the first. Ids are
    cut into runs at quantiles, and each run's first rows are also dealt to the run before
    (own is false there), so no task orders all rows and each text moves once.
    """
    ids = docs.select("doc_id")
    id_type = docs.schema["doc_id"].dataType
    n, n_ids, first = ids.agg(F.count(F.lit(1)), F.count("doc_id"), F.min("doc_id")).first()
    at = cuts(ids, "doc_id", min(MOST_RUNS, n // RUN + 1))
    null_run, has_nulls = len(at) + 1, n > n_ids
    last_run = null_run if has_nulls else len(at)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "run", F.when(F.col("doc_id").isNull(), null_run).otherwise(_rank(F.col("doc_id"), at, id_type))
    )
    nowhere = F.array().cast("array<struct<to:int,lap:int>>")
    place = lambda to, lap: F.array(F.struct(F.lit(to).cast("int").alias("to"), F.lit(lap).cast("int").alias("lap")))
    # a cut is an id of the table, so the rows at a cut are the first of their run
    at_cut = F.get(F.array(*[F.lit(x).cast(id_type) for x in at]), F.col("run") - 1) == F.col("doc_id") if at else F.lit(False)
    dealt = rows.withColumn(
        "at",
        F.explode(
            F.concat(
                F.array(F.struct(F.col("run").cast("int").alias("to"), F.lit(0).alias("lap"))),
                F.when(at_cut, F.array(F.struct((F.col("run") - 1).cast("int").alias("to"), F.lit(1).alias("lap")))).otherwise(nowhere),
                F.when(F.col("doc_id").eqNullSafe(F.lit(first).cast(id_type)), place(last_run, 2)).otherwise(nowhere),
            )
        ),
    ).select("doc_id", "text", "at.to", "at.lap")
    if has_nulls and n_ids:  # the nulls follow the last run; the least of them is what its last row meets
        least = docs.filter("doc_id is null").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
        dealt = dealt.unionByName(
            least.select(F.lit(None).cast(id_type).alias("doc_id"), "text", F.lit(len(at)).alias("to"), F.lit(1).alias("lap"))
        )
    order = Window.partitionBy("to").orderBy("lap", F.col("doc_id").asc_nulls_last(), "text")
    return dealt.withColumn("own", F.col("lap") == 0).withColumn("next_text", F.lead("text").over(order)), order


def op5(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text: the last floor(n/2) of n code points replaced by the first as many
    (or all) of the next document's text. Null texts are empty; two empty fingerprints
    have likeness 1, an empty and another 0. Of one row alone, the next is itself.
    An empty table gives an empty table.
    """
    paired, order = with_next(docs.select("doc_id", "text"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - half),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half),
    )
    return (
        paired.withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("edited", edited)
        .withColumn("marks", marks(F.col("text")))
        .withColumn("edited_marks", marks(F.col("edited")))
        .withColumn("hashes", mark_hashes(F.col("marks")))
        .withColumn("next_hashes", F.lead("hashes").over(order))
        .filter("own")
        .select(
            "doc_id",
            "n_chars",
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            digest(F.col("marks")).alias("fingerprint"),
            digest(F.col("edited_marks")).alias("edited_fingerprint"),
            likeness(F.col("hashes"), mark_hashes(F.col("edited_marks"))).alias("near_edited"),
            likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
        )
    )
