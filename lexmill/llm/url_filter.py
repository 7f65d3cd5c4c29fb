"""URL filter by a path-template tree.

Every host has a tree of path segments, as deep as its labels can still tell branches apart.
Segments that vary (those with digits) become wildcards; branches whose share of bad pages does
not differ significantly from their siblings', or that have few pages or labels, merge into a wildcard.
A template is rejected if its share of bad labelled pages, smoothed towards its host's and the
host's towards all hosts', is high. Given rules by host and path come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import ascii_lower, stored

#: (verdict, host, path): a rule holds for its host and all subdomains and for paths that begin with its path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: A branch stands alone if it has so many pages and labels, and differs from its siblings by so many standard errors.
MIN_PAGES, MIN_LABELLED, ERRORS = 20, 5, 2.0
#: Labels that a smoothing prior counts as, and the purity that rejects.
PRIOR, REJECT = 10.0, 0.5
#: Generalised paths of more than this part of all pages are joined by broadcast; there are fewer than HOT of them.
HOT = 1000
VARIES, ANY, REST, END = "#", "*", "**", ""
#: Segments of a path that the SQL below follows; the tree itself has no such bound.
SQL_DEPTH = 8


def parts(url: Column) -> tuple[Column, Column]:
    """host, A-Z lower-cased, and path of a url; both empty for null and for urls without ://."""
    pattern = r"://([^/?#]*)([^?#]*)"
    take = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return ascii_lower(take(1)), take(2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def _segments(path: Column) -> Column:
    """The segments of a path, those with a digit as VARIES."""
    return F.transform(F.split(F.regexp_replace(path, "^/+", ""), "/+"), lambda x: F.when(x.rlike("[0-9]"), F.lit(VARIES)).otherwise(x))


def _apart() -> Column:
    """Whether a branch differs from its siblings taken together: shares smoothed by half a label each way, so that few labels count for little."""
    n, b = F.col("labelled"), F.col("bad")
    rest, rest_bad = F.col("all_labelled") - n, F.col("all_bad") - b
    share = (F.col("all_bad") + 1) / (F.col("all_labelled") + 2)
    gap = (b + 0.5) / (n + 1) - (rest_bad + 0.5) / (rest + 1)
    return (
        (F.col("pages") >= MIN_PAGES) & (n >= MIN_LABELLED) & (rest > 0)
        & (gap * gap > ERRORS * ERRORS * share * (1 - share) * (1 / (n + 1) + 1 / (rest + 1)))
    )


def templates(counts: DataFrame) -> DataFrame:
    """``counts`` (host, segs, pages, labelled, bad) with ``template``: generalised paths, split level by level from the root.

    Below a node whose labels are too few, or all alike, no branch can stand apart: what follows is
    REST. In other nodes a path's end keeps to itself, a branch that has none beside it keeps its name, and so do
    those that stand apart; the others are ANY. Levels follow each other until nothing is open; each is stored,
    since the next one reads it several times.
    """
    open_, done = counts.withColumn("template", F.col("host")), None
    k = 0
    while True:
        here = open_.withColumn("s", F.coalesce(F.get("segs", F.lit(k)), F.lit(END)))
        node = ["host", "template"]
        branch = here.groupBy(*node, "s").agg(*(F.sum(c).alias(c) for c in ("pages", "labelled", "bad")))
        whole = branch.groupBy(*node).agg(F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad"), F.count(F.when(F.col("s") != END, 1)).alias("beside"))
        mixed = (F.col("all_labelled") >= 2 * MIN_LABELLED) & (F.col("all_bad") > 0) & (F.col("all_bad") < F.col("all_labelled"))
        name = F.when(~mixed, F.lit(REST)).when((F.col("s") == END) | (F.col("beside") == 1) | _apart(), F.col("s")).otherwise(F.lit(ANY))
        told = branch.join(whole, node).select(*node, "s", F.concat_ws("/", "template", name).alias("next"), (mixed & (F.col("s") != END)).alias("goes_on"))
        level = stored(here.join(told, [*node, "s"]).select(*counts.columns, F.col("next").alias("template"), "goes_on"))
        closed = level.filter(~F.col("goes_on")).drop("goes_on")
        done = closed if done is None else done.unionByName(closed)
        open_ = level.filter("goes_on").drop("goes_on")
        k += 1
        if open_.isEmpty():
            return done


def url_filter(pages: DataFrame, bad: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template of every row of ``pages``.

    ``bad`` (page_id, bad 0 or 1) labels some pages; rows with nulls label nothing, of several
    labels of a page the worst counts. Rows with equal or null page_id are judged each. A
    page that no rule fits is blocked if its template's smoothed purity is at least REJECT. Empty
    tables give an empty result.

    Pages are counted by generalised path first, so that trees are built from counts and
    a host with a third of all pages is many partial sums.
    """
    host, path = parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("segs", _segments(F.col("path")))
    labels = bad.filter("page_id is not null and bad is not null").groupBy(F.col("page_id").alias("__id")).agg(F.max("bad").alias("bad"))
    counts = stored(
        split.join(labels, split["page_id"] == labels["__id"], "left")
        .groupBy("host", "segs")
        .agg(F.count(F.lit(1)).alias("pages"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
    )
    named = templates(counts)
    of_host = counts.groupBy("host").agg(F.sum("labelled").alias("host_labelled"), F.sum("bad").alias("host_bad"))
    everything = counts.agg(F.sum("pages").alias("pages"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")).first()
    base = (everything["bad"] or 0) / (everything["labelled"] or 1)
    host_share = (F.col("host_bad") + PRIOR * base) / (F.col("host_labelled") + PRIOR)
    judged = (
        named.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
        .join(of_host, "host")
        .select("host", "template", ((F.col("bad") + PRIOR * host_share) / (F.col("labelled") + PRIOR) >= REJECT).alias("rejected"))
    )
    leaf = stored(named.join(judged, ["host", "template"]).select("host", "segs", "template", "rejected", (F.col("pages") * HOT > (everything["pages"] or 0)).alias("hot")))
    hot, rest = (leaf.filter(c).drop("hot") for c in (F.col("hot"), ~F.col("hot")))
    met = split.join(F.broadcast(hot), ["host", "segs"]).unionByName(split.join(rest, ["host", "segs"]))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return met.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "template",
    )


def op10(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """url_filter() of all pages; a page is bad if the labels of the document of its id say low quality or toxic."""
    low, toxic = F.coalesce(1 - F.col("quality"), F.lit(0)), F.coalesce("toxic", F.lit(0))
    bad = labels.filter("quality is not null or toxic is not null").select(F.col("doc_id").alias("page_id"), F.greatest(low, toxic).cast("long").alias("bad"))
    return url_filter(pages.select("page_id", "url"), bad)


def _oracle() -> str:
    ctes = [
        r"""u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
          coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages)""",
        "a AS (SELECT *, regexp_split_to_array(regexp_replace(path, '^/+', ''), '/+') AS a FROM u)",
        "p AS (SELECT page_id, host, path, "
        + ", ".join(f"CASE WHEN regexp_matches(coalesce(a[{i + 1}], ''), '[0-9]') THEN '{VARIES}' ELSE coalesce(a[{i + 1}], '') END AS s{i}" for i in range(SQL_DEPTH)) + " FROM a)",
        "b AS (SELECT doc_id, max(greatest(coalesce(1 - quality, 0), coalesce(toxic, 0))) AS bad FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id)",
    ]
    names = ", ".join(f"s{i}" for i in range(SQL_DEPTH))
    ctes.append(f"c0 AS (SELECT host, {names}, count(*) AS pages, count(bad) AS labelled, coalesce(sum(bad), 0) AS bad, host AS t, true AS o FROM p LEFT JOIN b ON page_id = doc_id GROUP BY host, {names})")
    share = "((ab + 1) / (an + 2))"
    gap = "((b + 0.5) / (n + 1) - (ab - b + 0.5) / (an - n + 1))"
    for k in range(SQL_DEPTH):
        ctes.append(
            f"""n{k} AS (SELECT host, t, s{k}, sum(pages) AS pages, sum(labelled)::DOUBLE AS n, sum(bad)::DOUBLE AS b, (sum(sum(labelled)) OVER w)::DOUBLE AS an,
              (sum(sum(bad)) OVER w)::DOUBLE AS ab, count(CASE WHEN s{k} <> '' THEN 1 END) OVER w AS beside FROM c{k} WHERE o GROUP BY host, t, s{k} WINDOW w AS (PARTITION BY host, t))"""
        )
        ctes.append(
            f"""k{k} AS (SELECT host, t, s{k}, an >= {2 * MIN_LABELLED} AND ab > 0 AND ab < an AS mixed,
              CASE WHEN NOT (an >= {2 * MIN_LABELLED} AND ab > 0 AND ab < an) THEN '{REST}' WHEN s{k} = '' OR beside = 1 OR (pages >= {MIN_PAGES} AND n >= {MIN_LABELLED} AND an - n > 0
              AND {gap} * {gap} > {ERRORS * ERRORS} * {share} * (1 - {share}) * (1 / (n + 1) + 1 / (an - n + 1))) THEN s{k} ELSE '{ANY}' END AS name FROM n{k})"""
        )
        ctes.append(
            f"""c{k + 1} AS (SELECT host, {names}, pages, labelled, bad, CASE WHEN o THEN t || '/' || name ELSE t END AS t, o AND mixed AND s{k} <> '' AS o FROM (
              SELECT c{k}.*, mixed, name FROM c{k} LEFT JOIN k{k} ON o AND c{k}.host = k{k}.host AND c{k}.t = k{k}.t AND c{k}.s{k} = k{k}.s{k}))"""
        )
    last = f"c{SQL_DEPTH}"
    ctes.append("h AS (SELECT host, sum(labelled) AS hn, sum(bad) AS hb FROM c0 GROUP BY host), g AS (SELECT coalesce(sum(bad)::DOUBLE / nullif(sum(labelled), 0), 0) AS g FROM c0)")
    ctes.append(f"j AS (SELECT host, t, (sum(bad) + {PRIOR} * ((any_value(hb) + {PRIOR} * any_value(g)) / (any_value(hn) + {PRIOR}))) / (sum(labelled) + {PRIOR}) >= {REJECT} AS rejected FROM {last} JOIN h USING (host), g GROUP BY host, t)")
    rule = "CASE " + " ".join(
        f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{q}') THEN '{h + q}'" for _, h, q in sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    ) + " END"
    verdict = "CASE rule " + " ".join(f"WHEN '{h + q}' THEN '{w}'" for w, h, q in RULES) + " ELSE CASE WHEN rejected THEN 'block' ELSE 'allow' END END"
    ctes.append(f"r AS (SELECT p.*, {rule} AS rule, t AS template, rejected FROM p JOIN {last} USING (host, {names}) JOIN j USING (host, t))")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT page_id, host, path, rule, {verdict} AS verdict, template FROM r"


ORACLE = _oracle()
