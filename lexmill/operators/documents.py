"""Trees of nodes: outlines with labels, paragraphs, notes, bylines and whole articles as Markdown."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.bylines import appendix_date, normalize_byline
from lexmill.functions.classify import about_publication, classify_byline
from lexmill.functions.text import CJK_COMPAT, count_class, is_structural, strip


#: What scanned() tells of a node besides the attributes that are asked for.
_SCANNED = (("doc_id", pa.string()), ("node_id", pa.int32()), ("parent_id", pa.int32()), ("ord", pa.int32()), ("tag", pa.string()), ("text", pa.string()), ("path", pa.list_(pa.int32())), ("tags", pa.list_(pa.string())))


def scanned(nodes: DataFrame, kept: list[str], texts: list[str], attrs: tuple[str, ...] = ()) -> DataFrame:
    """Nodes of the ``kept`` tags: doc_id, node_id, parent_id, ord, tag, the given attributes, text, path and tags.

    ``text``: of nodes of the tags ``texts``, all within the node, in order; else null. ``path``, ``tags``: the ids and tags of
    the ancestors and the node. A node's text stands before its children's and its tail behind all below it. Each document's nodes
    pass once, in order; a node's text grows while it is open, so no pairs of nodes are made and nothing is joined.
    """
    wanted, told = frozenset(kept), frozenset(texts)
    schema = pa.schema([*_SCANNED, *((a, pa.string()) for a in attrs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, trail, stack, done = None, [], [], []  # stack: depth, tail, parts of a node whose text is told, what else is told of a kept one

        def close(depth: int) -> None:
            while stack and stack[-1][0] >= depth:
                _, tail, parts, row = stack.pop()
                if row is not None:
                    row[5] = None if parts is None else "".join(parts)
                    done.append(row)
                for _, _, above, _ in stack if tail else ():
                    if above is not None:
                        above.append(tail)

        def made() -> pa.RecordBatch:
            got = list(zip(*done, strict=True)) or [()] * len(schema)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(got, schema, strict=True)], schema=schema)

        for b in batches:
            for d, depth, node, parent, nth, tag, text, tail, *rest in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if d != doc:
                    close(-1)
                    doc, trail = d, []
                close(depth)
                trail = [*trail[:depth], (node, tag)]
                row = None
                if tag in wanted:
                    path, tags = zip(*trail, strict=True)
                    row = [d, node, parent, nth, tag, None, path, tags, *rest]
                stack.append((depth, tail, [] if tag in told else None, row))
                for _, _, parts, _ in stack if text else ():
                    if parts is not None:
                        parts.append(text)
            yield made()
        close(-1)
        yield made()

    ordered = nodes.select("doc_id", "depth", "node_id", "parent_id", "ord", "tag", "text", "tail", *(F.col("attrs")[a].alias(f"__{a}") for a in attrs)).repartition("doc_id").sortWithinPartitions("doc_id", "node_id")
    columns = ["doc_id string, node_id int, parent_id int, ord int, tag string, text string, path array<int>, tags array<string>", *(f"`{a}` string" for a in attrs)]
    return ordered.mapInArrow(run, ", ".join(columns))


def tree_text(nodes: DataFrame, tags: list[str]) -> DataFrame:
    """doc_id, node_id, text: all text within each node of the given tags, in order."""
    return scanned(nodes, tags, tags).select("doc_id", "node_id", "text")


def toc_lines(toc: DataFrame, style: str = "flat") -> DataFrame:
    """doc_id, seq, line of each heading: flat (indented), csv (quotes not escaped), or tree (branches and levels, of an outline())."""
    if style == "csv":
        line = F.format_string('%d,"%s"', "level", "text")
    elif style == "tree":
        line = F.concat(F.col("bars"), F.when(F.col("is_last"), "`-- ").otherwise("|-- "), F.col("text"), F.format_string(" (level %d)", "level"))
    else:
        line = F.concat(F.expr("repeat('  ', greatest(level - 1, 0))"), F.col("text"))
    return toc.select("doc_id", "seq", line.alias("line"))


def nested_toc(toc: DataFrame) -> DataFrame:
    """doc_id, toc of every document: its headings (seq, level, text, parent_seq) as nested JSON, children under their parents."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("seq").to_pylist()
        made = {r["seq"]: {"text": r["text"], "level": r["level"], "children": []} for r in rows}
        roots = []
        for r in rows:
            above = made.get(r["parent_seq"])
            (above["children"] if above else roots).append(made[r["seq"]])
        return pa.table({"doc_id": [rows[0]["doc_id"]], "toc": [json.dumps(roots, ensure_ascii=False)]})

    kind = toc.schema["doc_id"].dataType.simpleString()
    return toc.select("doc_id", "seq", "level", "text", "parent_seq").groupBy("doc_id").applyInArrow(run, f"doc_id {kind}, toc string")


#: Attributes that tell what a note is.
_NOTE_ATTRS = ("place", "type", "rend", "target", "id")


def _is_inline(within: str | None) -> Column:
    """Whether a scanned note is inline and no hidden addition, everywhere or within an element."""
    shown = (F.col("place") == "inline") & ~F.coalesce((F.col("type") == "add") & (F.col("rend") == "hide"), F.lit(False))
    shown = (F.col("tag") == "note") & shown
    return shown & F.array_contains("tags", within) if within else shown


def inline_notes(nodes: DataFrame, within: str | None = "byline") -> DataFrame:
    """doc_id, node_id, text of inline notes that are not hidden additions, everywhere or within an element."""
    return scanned(nodes, ["note"], ["note"], _NOTE_ATTRS).filter(_is_inline(within)).select("doc_id", "node_id", "text")


def _pointed(rows: DataFrame) -> DataFrame:
    """Scanned anchors and notes with ``target``, and of each anchor with an id ``seq`` and ``note``, the text of the first note that points to it."""
    anchor = (F.col("tag") == "anchor") & F.col("id").isNotNull()
    named = F.nullif(F.ltrim(F.coalesce("target", F.lit("")), F.lit("#")), F.lit(""))
    rows = rows.withColumn("anchor", anchor).withColumn("target", F.when(anchor, F.col("id")).when(F.col("tag") == "note", named))
    # both windows hold one document's rows at most: they are dealt out by document once
    upto = Window.partitionBy("doc_id").orderBy("node_id").rowsBetween(Window.unboundedPreceding, 0)
    note = F.min_by("text", F.when(F.col("tag") == "note", F.col("node_id"))).over(Window.partitionBy("doc_id", "target"))
    return rows.repartition("doc_id").withColumn("seq", F.count_if("anchor").over(upto).cast("int")).withColumn("note", F.when(F.col("anchor"), note))


def anchored_notes(nodes: DataFrame) -> DataFrame:
    """doc_id, seq, target, text: notes that anchors point to, in the anchors' order; missing ones have null text."""
    rows = _pointed(scanned(nodes, ["anchor", "note"], ["note"], _NOTE_ATTRS))
    return rows.filter("anchor").select("doc_id", "seq", "target", F.col("note").alias("text"))


def end_matter(nodes: DataFrame, sources: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, type, raw_text, byline_type of bylines, inline notes, paragraphs and back notes on publication; texts once, of the first source."""
    rows = _pointed(scanned(nodes, ["byline", "p", "anchor", "note"], ["byline", "p", "note"], _NOTE_ATTRS))
    rows = rows.withColumn("inline", F.coalesce(_is_inline("byline"), F.lit(False))).filter("tag in ('byline', 'p') or inline or anchor")
    kind = F.when(F.col("tag") == "byline", "byline").when(F.col("tag") == "p", "paragraph").when(F.col("inline"), "inline_note").otherwise("back_note")
    raw = F.regexp_replace(F.when(F.col("anchor"), F.col("note")).otherwise(F.col("text")), r"(?U)\s+", "")
    each = rows.select("doc_id", F.when(F.col("anchor"), 1 << 30).otherwise(F.col("node_id")).alias("node_id"), kind.alias("type"), raw.alias("raw_text")).filter("raw_text <> ''")
    told = F.when(F.col("type") == "paragraph", F.col("raw_text").rlike("附[註注]") & about_publication(F.col("raw_text"))).when(F.col("type") == "back_note", about_publication(F.col("raw_text"))).otherwise(True)
    once = Window.partitionBy("doc_id", "raw_text").orderBy("node_id", "type")
    each = each.filter(told).withColumn("rn", F.row_number().over(once)).filter("rn = 1")
    return each.select("doc_id", "type", "raw_text", classify_byline(F.col("raw_text"), sources).alias("byline_type"))


def first_bylines(nodes: DataFrame) -> DataFrame:
    """doc_id, parent_id, text of the first byline of each division that stands before any of its paragraphs."""
    inside = scanned(nodes, ["byline", "p"], ["byline"])
    first = inside.groupBy("doc_id", "parent_id").agg(F.min_by(F.struct("tag", "text"), "ord").alias("f"))
    return first.filter("f.tag = 'byline'").select("doc_id", "parent_id", "f.text")


def byline_in_bytes(content: Column, start: Column, end: Column, tag: str = "byline", most: int = 5000) -> Column:
    """The text of the first element ``tag`` in the first ``most`` bytes of a range; empty without one."""
    head = F.make_valid_utf8(F.substring(content, (start + 1).cast("int"), F.least(F.lit(most), end - start).cast("int")).cast("string"))
    return F.trim(F.regexp_replace(F.regexp_extract(head, rf"(?s)<{tag}[^>]*>(.*?)</{tag}>", 1), "<[^>]+>", ""))


_NAME_TAGS = ["div", "head", "mulu"]


def _first(tag: str, what: str, at: str = "node_id") -> Column:
    """What the first of a group's rows of a tag holds."""
    return F.min_by(what, F.when(F.col("tag") == tag, F.col(at)))


def headings(nodes: DataFrame, notes: str = "nkr_note_orig_") -> DataFrame:
    """doc_id, node_id, text, anchor of every division: its head without wide spaces, else its mulu, else ''; the id of the head's first anchor if it begins with ``notes``."""
    rows = scanned(nodes, [*_NAME_TAGS, "anchor"], ["head", "mulu"], ("id",))
    above = F.when(F.size("path") > 2, F.get("path", F.size("path") - 3))  # of an anchor: the parent of what holds it
    in_head = F.coalesce(F.get("tags", F.size("tags") - 2) == "head", F.lit(False))
    rows = rows.filter((F.col("tag") != "anchor") | in_head)
    of = F.when(F.col("tag") == "div", F.col("node_id")).when(F.col("tag") == "anchor", above).otherwise(F.col("parent_id"))
    named = rows.withColumn("anchor", F.struct("parent_id", "id")).groupBy("doc_id", of.alias("node_id")).agg(
        F.max(F.col("tag") == "div").alias("division"), strip(_first("head", "text")).alias("head"), strip(_first("mulu", "text")).alias("mulu"),
        F.min(F.when(F.col("tag") == "head", F.col("node_id"))).alias("head_id"), _first("anchor", "anchor").alias("a"),
    )
    head, anchor = F.regexp_replace("head", "　", ""), F.when(F.col("a.parent_id") == F.col("head_id"), F.col("a.id"))
    text = F.coalesce(F.when(head != "", head), F.col("mulu"), F.lit(""))
    return named.filter("division").select("doc_id", "node_id", text.alias("text"), F.when(anchor.startswith(notes), anchor).alias("anchor"))


#: The note that dates an appendix, as （附註）「title」，date；今附於此, and what begins an appendix's title.
_DATED_NOTE = r"(?U)^[（(]附[註注][）)]\s*「.+?」\s*[，,]\s*(.+?)[；;]\s*今附[於于]此"
_APPENDIX = "附"


def appendixes(nodes: DataFrame) -> DataFrame:
    """doc_id, parent_id, node_id, title, date_place of divisions within divisions whose mulu begins as appendixes do.

    The date stands in the first paragraph that is a dating note or byline that is no mere reference (見), in document order; else ''.
    """
    rows = scanned(nodes, [*_NAME_TAGS, "p", "byline"], ["head", "mulu", "p", "byline"])
    said = strip(F.col("text"))
    dates = F.when(F.col("tag") == "p", said.rlike(_DATED_NOTE)).when(F.col("tag") == "byline", (said != "") & ~said.startswith("見")).otherwise(False)
    inside = F.filter(F.arrays_zip("path", "tags"), lambda x: x["tags"] == "div")["path"]  # the divisions that a dating row is in
    of = F.when(F.col("tag") == "div", F.array("node_id")).when(F.col("tag").isin("head", "mulu"), F.array("parent_id")).when(dates, inside)
    rows = rows.withColumn("said", F.when(dates, F.struct("tag", said.alias("text")))).withColumn("parent", F.when((F.col("tag") == "div") & (F.get("tags", F.size("tags") - 2) == "div"), F.col("parent_id")))
    rows = rows.select("doc_id", "node_id", "tag", "text", "said", "parent", F.explode(of).alias("of"))
    found = rows.groupBy("doc_id", "of").agg(
        F.max("parent").alias("parent_id"), strip(_first("head", "text")).alias("head"), strip(_first("mulu", "text")).alias("mulu"),
        F.min_by("said", F.when(F.col("said").isNotNull(), F.col("node_id"))).alias("f"),
    ).filter(F.col("parent_id").isNotNull() & F.col("mulu").startswith(_APPENDIX))
    name = F.coalesce("head", "mulu")
    bare = F.regexp_replace(name, f"^{_APPENDIX}[：　]*", "")
    title = F.when(name.startswith(_APPENDIX) & bare.rlike("^[一-鿿]"), F.concat(F.lit(_APPENDIX + "："), bare)).otherwise(name)
    date = F.when(F.col("f.tag") == "p", appendix_date(F.regexp_extract("f.text", _DATED_NOTE, 1))).otherwise(normalize_byline(F.col("f.text")))
    return found.select("doc_id", "parent_id", F.col("of").alias("node_id"), title.alias("title"), date.alias("date_place"))


def with_appendixes(catalogue: DataFrame, appendixes: DataFrame, key: str = "name") -> DataFrame:
    """Catalogue entries with ``appendix`` and ``n_chars`` of articles (name, appendix, n_chars); of equal names only the first entry, by seq, takes them."""
    first = catalogue.groupBy(key).agg(F.min("seq").alias("seq"))
    once = appendixes.groupBy(key).agg(F.min("appendix").alias("appendix"), F.max("n_chars").alias("n_chars"))
    return catalogue.join(first.join(once, key), [key, "seq"], "left")


def assembled(articles: DataFrame) -> DataFrame:
    """Articles (doc_id, title, front, markdown, notes array, appendix) as whole texts: front matter, title, body, appendix, notes, count of characters."""
    notes = F.array_join(F.transform("notes", lambda x, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), x)), "\n")
    part = lambda head, x: F.when(F.coalesce(x, F.lit("")) != "", F.concat(F.lit(head), x))
    text = F.concat_ws("\n\n", F.col("front"), F.concat(F.lit("# "), "title"), part("", F.col("markdown")), part("## 附\n\n", F.col("appendix")), part("## 註\n\n", notes))
    return articles.select("doc_id", text.alias("text"), count_class(F.col("markdown"), CJK_COMPAT).cast("long").alias("n_chars"))


#: Elements that only hold divisions and blocks, and those that hold no text of the article.
_HOLDERS, _APART = frozenset("TEI text body front html main article section".split()), frozenset("teiHeader back script style".split())
#: White space of HTML; other spaces, as no-break ones, are characters, but at the ends of a text.
_SPACES = re.compile("[\t\n\f\r ]+")
_ENDS = "".join(c for c in map(chr, range(0x3001)) if unicodedata.category(c) == "Zs")


class Renderer:
    """One article's nodes as Markdown: contents, headings, paragraphs, quotations, notes."""

    def __init__(self, rows: list[dict], gap: str = ""):
        self.gap = gap  # what stands for HTML's white space; without one, as in Chinese texts, all white space goes
        self.children: dict[int, list[dict]] = {}
        for r in rows:
            self.children.setdefault(r["parent_id"], []).append(r)
        self.anchors: list[str] = []

    def inline(self, node: dict, pre: bool = False) -> str:
        """Mixed content as one text, its white space put in order once, over the borders of the elements in it."""
        text = self.mixed(node, pre)
        if pre:
            return text
        return _SPACES.sub(self.gap, text).strip(_ENDS) if self.gap else "".join(text.split())

    def mixed(self, node: dict, pre: bool) -> str:
        """Mixed content in order: notes in brackets, anchors numbered, line breaks dropped, bold kept, figures linked."""
        out = [node["text"]]
        for c in self.children.get(node["node_id"], []):
            tag, a = c["tag"], c["attrs"]
            if tag == "note":
                if not (a.get("type") == "add" and a.get("rend") == "hide"):
                    out.append(f"（{self.inline(c)}）" if a.get("place") == "inline" else "")
            elif tag == "anchor":
                self.anchors.append(a.get("id", ""))
                out.append(f"[{len(self.anchors)}]")
            elif tag in ("lb", "pb"):
                out.append("\n" if pre and tag == "lb" else "")
            elif tag == "seg" and "bold" in a.get("rend", ""):
                out.append(f"**{self.inline(c)}**")
            elif tag == "graphic":
                out.append(f"![]({a.get('url', '')})")
            else:
                out.append(self.mixed(c, pre))
            out.append(c["tail"])
        return "".join(out)

    def block(self, node: dict) -> str:
        """A child of a division as a Markdown block."""
        if node["tag"] == "pre" or node["attrs"].get("rend") == "pre":
            return f"```\n{self.inline(node, True)}\n```"
        text = self.inline(node)
        return "" if node["tag"] == "byline" and text.startswith("——") and text.endswith("——") else text

    def render(self, skip) -> str:
        """The contents, then the body; divisions whose heading ``skip`` holds go with all below them."""
        toc, body = [], []

        def walk(node: dict, level: int, quoted: bool) -> None:
            kids = self.children.get(node["node_id"], [])
            head = next((self.inline(k) for k in kids if k["tag"] == "head"), None)
            mulu = next((self.inline(k) for k in kids if k["tag"] == "mulu"), None)
            heading = head or mulu
            if heading and skip(heading):
                return
            if heading:
                toc.append("    " * max(0, level - 2) + f"- {heading}")
                body.append(f"{'#' * min(6, max(2, level))} {heading}")
            for k in kids:
                if k["tag"] in _APART:
                    continue
                if k["tag"] in _HOLDERS:
                    walk(k, level, quoted)
                elif k["tag"] == "div":
                    walk(k, level + bool(heading), k["attrs"].get("type") == "orig")
                elif k["tag"] not in ("head", "mulu"):
                    text = self.block(k)
                    if text:
                        body.append(f"> **{text}**" if quoted else text)

        for top in self.children.get(-1, []):
            walk(top, 2, False)
        parts = ["\n".join(toc), "\n\n".join(body)] if toc else ["\n\n".join(body)]
        return "\n\n".join(p for p in parts if p)


def render_articles(nodes: DataFrame, skip_words: tuple[str, ...] | None = None, gap: str = "") -> DataFrame:
    """doc_id, markdown of every document; one document's nodes are rendered together."""
    from lexmill.functions.text import STRUCTURAL

    words = STRUCTURAL if skip_words is None else skip_words

    def run(table: pa.Table) -> pa.Table:
        rows = [{**r, "attrs": dict(r["attrs"] or [])} for r in table.sort_by("node_id").to_pylist()]
        text = Renderer(rows, gap).render(lambda h: any(w in h for w in words))
        return pa.table({"doc_id": [rows[0]["doc_id"]], "markdown": [text]})

    columns = ["doc_id", "node_id", "parent_id", "tag", "attrs", "text", "tail"]
    return nodes.select(*columns).groupBy("doc_id").applyInArrow(run, "doc_id string, markdown string")


def with_counts(articles: DataFrame, text: str = "markdown", chars: str = CJK_COMPAT) -> DataFrame:
    """Articles with n_chars: the characters of a class in their text."""
    return articles.withColumn("n_chars", count_class(F.col(text), chars))


def kept_headings(toc: DataFrame) -> DataFrame:
    """Headings that are not purely structural."""
    return toc.filter(~is_structural(F.col("text")))
