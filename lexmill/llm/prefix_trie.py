"""A trie of conversations by their turns, built level by level, with what sharing prefixes saves.

Turns are numbered by a prefix scan, so no task holds a conversation. Conversations that are
equal throughout become one with a weight. Then, depth by depth, live conversations are grouped
by (parent node, next turn) and a group takes its least conv_id; a conversation that is
alone in its group leaves, since the rest of it is a chain. Leaves and savings are rolled up
by joins from the deepest level to the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import stored
from lexmill.llm.mixing import n_words
from lexmill.operators.scan import scan

#: Conversations whose first turns are taken over have ids that this divides; the number of taken turns is crc32(id) modulo the other.
STRIDE, HEADS = 20, 4
#: Member ids that are written together.
CHUNK = 4096
_NONE = hashlib.sha256(b"").hexdigest()


def _digest(role: Column, text: Column) -> Column:
    """256 bits that tell turns apart: of the role's length, the role and the text."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), key, words, upto (words up to here) of every turn, ordered by turn (null first), role and text.

    Null role and text are empty; rows without a conv_id belong to no conversation and are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"), _digest(role, text).alias("key"), n_words(text).alias("words")
    )
    return scan(rows, [F.col("turn").asc_nulls_first(), "role", "text"], ["conv_id"], "pos", sums={"upto": "words"}, keep=["conv_id", "key", "words"])


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """turns() with their first ones taken over: stored turns (conv_id, pos, key, words, rest), and conversations (conv_id, len).

    Conversation c gets the first h turns of c - c % STRIDE (all if that has fewer, none if it
    is absent), h = crc32(c in decimal) % HEADS, then its own turns behind its first h. ``rest``
    counts the words from a turn to the end.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    mine = (
        rows.withColumn("h", h).groupBy("conv_id", "h")
        .agg(F.max("pos").alias("own"), F.sum("words").alias("all"), F.sum(F.when(F.col("pos") <= F.col("h"), F.col("words")).otherwise(0)).alias("skipped"))
    )
    mine = stored(mine)
    heads = rows.filter((F.col("pos") < HEADS) & (F.col("conv_id") % STRIDE == 0)).select(F.col("conv_id").alias("base"), "pos", "key", "words", "upto")
    wants = mine.filter("h > 0").select("conv_id", "h", (F.col("conv_id") - F.col("conv_id") % STRIDE).alias("base"))
    # at most HEADS - 1 turns of a base, each wanted by fewer than 2 * STRIDE conversations
    taken = stored(wants.join(heads, "base").filter("pos <= h").select("conv_id", "pos", "key", "words", "upto"))
    had = taken.groupBy("conv_id").agg(F.count(F.lit(1)).alias("k"), F.sum("words").alias("taken_words"))
    whole = mine.join(had, "conv_id", "left").withColumn("k", F.coalesce("k", F.lit(0)).cast("long")).withColumn(
        "total", F.col("all") - F.col("skipped") + F.coalesce("taken_words", F.lit(0))
    )
    whole = stored(whole.select("conv_id", "h", "k", "total", (F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len"), "all"))
    own = rows.withColumn("h", h).filter("pos > h")
    own = own.join(whole.select("conv_id", "k", "all"), "conv_id").select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "key", "words", (F.col("all") - F.col("upto") + F.col("words")).alias("rest"))
    over = taken.join(whole.select("conv_id", "total"), "conv_id").select("conv_id", "pos", "key", "words", (F.col("total") - F.col("upto") + F.col("words")).alias("rest"))
    return stored(own.unionByName(over)), whole.select("conv_id", "len")


def _classes(found: DataFrame, conversations: DataFrame) -> DataFrame:
    """Stored: conv_id (the least), weight, len, ends_sha256 of each group of conversations that are equal throughout.

    Sequences are told apart by 128 bits that add up in any order, so that no task needs a whole one.
    """
    a, b = F.xxhash64("key", "pos"), F.xxhash64("pos", "key", F.lit("turn"))
    of = found.groupBy("conv_id").agg(F.bit_xor(a).alias("a"), F.bit_xor(b).alias("b"))
    named = stored(conversations.join(of, "conv_id", "left").select("conv_id", "len", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b")))
    classes = stored(named.groupBy("len", "a", "b").agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("weight")))
    shared = classes.filter("weight > 1")
    members = named.join(shared.select("len", "a", "b", "rep"), ["len", "a", "b"]).select("rep", "conv_id")
    return stored(
        classes.join(_digests(members), "rep", "left")
        .select(F.col("rep").alias("conv_id"), "weight", "len", F.coalesce("sha", F.sha2(F.col("rep").cast("string").cast("binary"), 256)).alias("ends_sha256"))
    )


def _digests(members: DataFrame) -> DataFrame:
    """rep, sha: the digest of each class's member ids, ascending and joined by commas.

    Ids are sorted and written in chunks by many tasks; only the digest itself, which no
    two tasks can share, passes a class's chunks one after the other.
    """
    placed = scan(members, ["conv_id"], ["rep"], "n")
    chunk = F.floor((F.col("n") - 1) / CHUNK).alias("chunk")
    pieces = placed.groupBy("rep", chunk).agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("piece"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rep, sha = None, None
        for batch in batches:
            out: list[tuple] = []
            for r, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if r != rep:
                    if sha:
                        out.append((rep, sha.hexdigest()))
                    rep, sha = r, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(piece.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())], ["rep", "sha"])
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([rep], pa.int64()), pa.array([sha.hexdigest()])], ["rep", "sha"])

    return pieces.repartition("rep").sortWithinPartitions("rep", "chunk").select("rep", "piece").mapInArrow(run, "rep long, sha string")


def _levels(found: DataFrame, classes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Stored groups of each depth from 1 on, until every conversation is alone or over, and the turns of the classes."""
    reps = classes.select(F.col("conv_id").alias("rep"), "weight", "len")
    # by depth, so that a level reads its own part of the files
    all_turns = found.join(reps, F.col("conv_id") == F.col("rep")).drop("rep")
    all_turns = stored(all_turns.repartitionByRange("pos", "conv_id").sortWithinPartitions("pos", "conv_id"))
    levels: list[DataFrame] = []
    root, live = classes.agg(F.min("conv_id")).first()[0], None
    while True:
        d = len(levels) + 1
        here = all_turns.filter(F.col("pos") == d)
        if live is None:
            here = stored(here.withColumn("node", F.lit(root).cast("long")))
        else:
            here = stored(here.join(live, "conv_id"))
        over = F.when(F.col("len") == d, F.struct("conv_id", "weight"))
        groups = stored(
            here.groupBy("node", "key").agg(
                F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("m"), F.sum("weight").alias("n_convs"), F.max("words").alias("words"),
                F.max("rest").alias("rest"), F.max("len").alias("longest"), F.max(over).alias("over"),
            )
        )
        levels.append(groups)
        shared = groups.filter("m > 1").select("node", "key", F.col("conv_id").alias("to"))
        if shared.isEmpty():
            return levels, all_turns
        live = here.filter(F.col("len") > d).join(shared, ["node", "key"]).select("conv_id", F.col("to").alias("node"))


def prefix_trie(found: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``found`` has turns (conv_id, pos from 1 without gaps, key, words, and rest, the words from a
    turn to the end), ``conversations`` all conv_ids with their len, turnless ones too. A node is a distinct
    sequence of first turns; conv_id is its smallest member, and with depth its name. The
    root has depth 0 and no parent. saved_tokens adds (n_convs - 1) * words of the last turn up over a
    node's subtree. Without conversations there are no nodes.

    It takes one round for each depth at which two different conversations still agree, and
    as many to roll up. A hot first turn is one group that is added up before it is
    shuffled; the join that hands its node to its conversations has one skewed side, which adaptive execution splits.
    """
    classes = _classes(found, conversations)
    levels, all_turns = _levels(found, classes)
    over = F.col("over.conv_id").alias("end"), F.col("over.weight").alias("end_weight")
    zero = F.lit(0).cast("long")
    alone = F.col("m") == 1
    done: list[DataFrame] = []
    below: DataFrame | None = None
    for d in range(len(levels), 0, -1):
        here = levels[d - 1]
        saved_alone = (F.col("n_convs") - 1) * F.col("rest")
        own = (F.col("n_convs") - 1) * F.col("words")
        if below is None:
            here = here.withColumns({"n_children": zero, "leaves": zero, "saved": zero})
        else:
            here = here.join(below.withColumnRenamed("parent", "conv_id"), "conv_id", "left")
        here = stored(here.select(
            "conv_id", F.lit(d).cast("long").alias("depth"), F.col("node").alias("parent_conv_id"), "n_convs",
            F.when(alone, (F.col("longest") > d).cast("long")).otherwise(F.coalesce("n_children", zero)).alias("n_children"),
            F.when(alone, F.lit(1).cast("long")).otherwise(F.coalesce("leaves", F.lit(1).cast("long"))).alias("n_leaves"),
            F.when(alone, saved_alone).otherwise(own + F.coalesce("saved", zero)).alias("saved_tokens"), *over, "m",
        ))
        done.append(here)
        below = here.groupBy(F.col("parent_conv_id").alias("parent")).agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    root = classes.agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max(F.when(F.col("len") == 0, F.struct("conv_id", "weight"))).alias("over")
    ).filter("conv_id is not null")
    root = root.join(F.broadcast(below), F.col("conv_id") == F.col("parent"), "left").select(  # the children of the root have one parent: one row
        "conv_id", zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"), F.coalesce("saved", zero).alias("saved_tokens"), *over,
    )
    nodes = root
    for here in done:
        nodes = nodes.unionByName(here.drop("m"))
    since = None
    for here in done:
        mine = here.filter("m = 1").select("conv_id", F.col("depth").alias("since"))
        since = mine if since is None else since.unionByName(mine)
    chain = all_turns.join(since, "conv_id").filter("pos > since").select(
        "conv_id", F.col("pos").alias("depth"), F.col("conv_id").alias("parent_conv_id"), F.col("weight").alias("n_convs"), (F.col("pos") < F.col("len")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), ((F.col("weight") - 1) * F.col("rest")).alias("saved_tokens"),
        F.when(F.col("pos") == F.col("len"), F.col("conv_id")).alias("end"), F.when(F.col("pos") == F.col("len"), F.col("weight")).alias("end_weight"),
    )
    nodes = nodes.unionByName(chain)
    several = F.coalesce(F.col("end_weight") > 1, F.lit(False))
    named = classes.filter("weight > 1").select(F.col("conv_id").alias("end"), "ends_sha256")
    one = F.when(F.col("end").isNull(), F.lit(_NONE)).otherwise(F.sha2(F.col("end").cast("string").cast("binary"), 256))
    told = nodes.filter(~several).withColumn("ends_sha256", one).unionByName(nodes.filter(several).join(named, "end").select(*nodes.columns, "ends_sha256"))
    return told.drop("end", "end_weight")


def op13(conversations: DataFrame) -> DataFrame:
    """prefix_trie() of the rebuilt() turns() of a table conv_id, turn, role, text.

    Turns are ordered by turn, null first, of equal ones by role and text; repeated rows are
    turns of their own. Null role and text are empty. Rows with a null conv_id are left out. Other
    columns are ignored. An empty table gives no nodes.
    """
    return prefix_trie(*rebuilt(turns(conversations.select("conv_id", "turn", "role", "text"))))


ORACLE = rf"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p,
         coalesce(role, '') AS r, coalesce(text, '') AS x
  FROM conversations WHERE conv_id IS NOT NULL),
k AS (
  SELECT c, xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda z: ascii(z)::UBIGINT), lambda a, z:
           list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda s, o: xor(s >> 1, 3988292384::UBIGINT * (s & 1)), xor(a, z)), 4294967295::UBIGINT),
         4294967295::UBIGINT) % {HEADS} AS h
  FROM (SELECT DISTINCT c FROM t)),
b AS (
  SELECT k.c, 0 AS o, p, r, x FROM k JOIN t ON t.c = k.c - k.c % {STRIDE} AND p <= h
  UNION ALL SELECT k.c, 1, p, r, x FROM k JOIN t ON t.c = k.c AND p > h),
n AS (
  SELECT c, row_number() OVER w AS d, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words,
         string_agg(sha256(length(r) || ':' || r || x), '') OVER w AS path
  FROM b WINDOW w AS (PARTITION BY c ORDER BY o, p)),
m AS (SELECT c, d, words, path FROM n UNION ALL SELECT c, 0, 0, '' FROM k),
l AS (SELECT c, max(d) AS len FROM m GROUP BY c),
v AS (
  SELECT d, path, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = len), '')) AS ends
  FROM m JOIN l USING (c) GROUP BY d, path),
e AS (
  SELECT v.d, v.path, v.conv_id, v.n_convs, v.words, v.ends, p.path AS up, p.d AS up_d FROM v LEFT JOIN m p ON p.c = v.conv_id AND p.d = v.d - 1),
g AS (SELECT up AS path, up_d AS d, count(*) AS n_children FROM e WHERE up IS NOT NULL GROUP BY up, up_d),
s AS (
  SELECT a.d, a.path, sum(CASE WHEN g.path IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved
  FROM v LEFT JOIN g ON g.path = v.path AND g.d = v.d JOIN m a ON a.c = v.conv_id AND a.d <= v.d GROUP BY a.d, a.path)
SELECT e.conv_id, e.d::BIGINT AS depth, q.conv_id AS parent_conv_id, e.n_convs::BIGINT AS n_convs, coalesce(g.n_children, 0)::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, e.ends AS ends_sha256
FROM e LEFT JOIN v q ON q.path = e.up AND q.d = e.up_d LEFT JOIN g ON g.path = e.path AND g.d = e.d JOIN s ON s.path = e.path AND s.d = e.d
"""
