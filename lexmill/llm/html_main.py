"""Main text of web pages by containers that a host's pages agree on.

Every page names the container that holds its article best, as a path of tags and classes with
digits taken out. The pages of a host vote in Spark, and each page is extracted again by
the path that won. Pages travel only as votes; html is read twice.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import released, stored, utf8
from lexmill.llm.url_filter import parts

#: Winning paths are sent to all executors if all of them have fewer bytes than this; otherwise hosts are joined by a shuffle.
SMALL_BYTES = 1 << 24
#: Containers nested deeper are no candidates themselves; their text belongs to those above.
DEEPEST = 64
#: A container is left for one inside it that holds this share of its text.
SHARE = 0.8

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)>?""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS, _DIGITS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])"), re.compile(r"\d+")

#: Elements whose content is not markup; of none of them text is shown on the page as text.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that never hold article text.
DROPPED = frozenset(
    "nav aside footer form button select option datalist script style textarea title noscript template svg math canvas object embed iframe audio video dialog menu xmp noembed noframes head".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big blink cite code data del dfn em font i ins kbd label mark nobr q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var".split()
)
CONTAINERS = frozenset("body article main section div td center".split())
#: Elements that an open <p> ends before.
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
#: What an opening tag closes, and what bounds the search for it.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
#: Words of class, id and role that name what is not the article.
NOT_ARTICLE = frozenset(
    """nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar ad ads adv advert adverts advertisement advertisements advertising banner promo promotion
    sponsor sponsored cookie cookies consent gdpr notice notices alert alertdialog popup modal overlay newsletter subscribe subscription signup login share sharing
    social related recommended recommendations comment comments disqus respond replies footer contentinfo masthead toolbar pagination pager widget skip search complementary""".split()
)
#: First words that make a class say something about the element, not what it is.
_SAYS = frozenset("has with no is without not".split())
#: Words before "header" that make it the article's own.
_OWN_HEADER = frozenset("article entry post content story".split())


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def _named_away(tag: str, attributes: dict[str, str]) -> tuple[bool, bool]:
    """Whether an element's names say that it is not the article, and whether they say it is a header."""
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return True, False
    if tag in ("html", "body", "main"):
        return False, False
    role, header = attributes.get("role", "").strip().lower(), False
    names = [*attributes.get("class", "").split(), attributes.get("id", ""), role]
    for name in names:
        words = [w.lower() for w in _WORDS.findall(name)]
        if not words or words[0] in _SAYS:
            continue
        if not NOT_ARTICLE.isdisjoint((words[0], words[-1])):
            return True, False
        header |= (words[-1] == "header" and _OWN_HEADER.isdisjoint(words)) or words[0] == "banner"
    return role in ("form", "dialog"), header


class Page:
    """The blocks of a page: what each is, where it hangs, and its text in order."""

    def __init__(self, source: str):
        self.tags, self.parents, self.names, self.dropped, self.inside = ["#"], [-1], [""], [False], [False]
        self.depths = [0]
        self.pieces: list[tuple[int, str, bool]] = []  # block, text, whether it is a link's; a break is (block, " ", False)
        self._read(source)

    def _open(self, tag: str, text: str, parent: int) -> int:
        attributes = _attributes(text) if text and not text.isspace() else {}
        inside = self.inside[parent] or tag in ("article", "main") or attributes.get("role") == "main"
        away, header = _named_away(tag, attributes) if attributes else (False, False)
        gone = self.dropped[parent] or tag in DROPPED or away or ((header or tag == "header") and not self.inside[parent])
        self.tags.append(tag)
        self.parents.append(parent)
        self.names.append(".".join([tag, *sorted(set(_DIGITS.sub("#", attributes.get("class", "")).split()))]))
        self.dropped.append(gone)
        self.inside.append(inside)
        self.depths.append(self.depths[parent] + 1)
        return len(self.tags) - 1

    def _read(self, source: str) -> None:
        tags, pieces = self.tags, self.pieces
        stack, link, at = [0], 0, 0

        def close(position: int) -> None:
            del stack[position:]
            pieces.append((stack[-1], " ", False))

        while True:
            m = _TOKEN.search(source, at)
            end = m.start() if m else len(source)
            if end > at and not self.dropped[stack[-1]]:
                pieces.append((stack[-1], html.unescape(source[at:end]), link > 0))
            if not m:
                return
            at = m.end()
            slash, tag, rest = m.group(1), m.group(2), m.group(3)
            if tag is None:
                continue
            tag = tag.lower()
            if slash:
                if tag == "a":
                    link = 0
                for position in range(len(stack) - 1, 0, -1):
                    if tags[stack[position]] == tag:
                        inline = tag in INLINE
                        del stack[position:]
                        if not inline:
                            pieces.append((stack[-1], " ", False))
                        break
                    if tags[stack[position]] in ("article", "body", "table", "td", "th") and tag in INLINE:
                        break
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    pieces.append((stack[-1], " ", False))
                continue
            if tag in RAW:
                ends = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(source, at)
                at = ends.start() if ends else len(source)
                pieces.append((stack[-1], " ", False))
                continue
            if tag in INLINE:
                link = 1 if tag == "a" else link
                if rest and not rest.isspace() and _named_away(tag, _attributes(rest))[0]:
                    stack.append(self._open(tag, rest, stack[-1]))
                continue
            if tag == "html" or (tag == "body" and any(tags[i] == "body" for i in stack)):
                continue
            if tag == "body":
                del stack[1:]
            elif tags[stack[-1]] == "head" and tag != "head":
                stack.pop()
            if tag in _ENDS_P:
                for position in range(len(stack) - 1, 0, -1):
                    if tags[stack[position]] == "p":
                        close(position)
                        break
                    if tags[stack[position]] not in INLINE:
                        break
            if tag in _CLOSES:
                closed, bound = _CLOSES[tag]
                for position in range(len(stack) - 1, 0, -1):
                    if tags[stack[position]] in bound:
                        break
                    if tags[stack[position]] in closed:
                        close(position)
                        if tag != "tr":
                            break
            stack.append(self._open(tag, rest, stack[-1]))
            pieces.append((stack[-1], " ", False))

    def path(self, i: int) -> str:
        out = []
        while i > 0:
            out.append(self.names[i])
            i = self.parents[i]
        return ">".join(reversed(out))

    def _masses(self) -> tuple[list[float], list[bool]]:
        """The score of each block with all inside it, half for links and for text outside paragraphs, and whether it holds a heading of the first level."""
        mass, first = [0.0] * len(self.tags), [False] * len(self.tags)
        for i, text, linked in self.pieces:
            if not self.dropped[i]:
                n = sum(map(len, text.split()))
                mass[i] += n * (0.25 if linked else 0.5 if self.tags[i] in CONTAINERS else 1.0)
        for i in range(len(self.tags) - 1, 0, -1):
            if not self.dropped[i]:
                first[i] |= self.tags[i] == "h1"
                mass[self.parents[i]] += mass[i]
                first[self.parents[i]] |= first[i]
        return mass, first

    def best(self) -> str | None:
        """The path of the container that holds the article: a dominant article or main element, else the innermost that keeps most of the text and the title."""
        mass, first = self._masses()
        if mass[0] <= 0:
            return None
        paths: dict[str, list[int]] = {"": [0]}
        for i in range(1, len(self.tags)):
            if self.tags[i] in CONTAINERS and not self.dropped[i] and self.depths[i] <= DEEPEST and mass[i] > 0:
                paths.setdefault(self.path(i), []).append(i)
        total = {p: sum(mass[i] for i in at) for p, at in paths.items()}
        titled = {p: any(first[i] for i in at) for p, at in paths.items()}
        inner: dict[str, list[str]] = {}
        for p in paths:
            above = p.rpartition(">")[0]
            while above not in paths:
                above = above.rpartition(">")[0]
            if p:
                inner.setdefault(above, []).append(p)
            if self.tags[paths[p][0]] == "article" and total[p] >= mass[0] / 2:
                return p  # no two can hold half of the page unless one holds the other
        mains = [p for p, at in paths.items() if self.tags[at[0]] == "main" and total[p] >= mass[0] / 2]
        if mains:
            return min(mains)
        here = ""
        while True:
            fit = [p for p in inner.get(here, ()) if total[p] >= SHARE * total[here] and titled[p] == titled[here]]
            if not fit:
                return here
            here = max(fit, key=lambda p: (total[p], p))

    def text(self, path: str | None) -> str | None:
        """The text of all containers at ``path`` (empty or null: of the page), or null if there is none."""
        if not path:
            return " ".join("".join(t for i, t, _ in self.pieces if not self.dropped[i]).split())
        last = path.rpartition(">")[2]
        within = [False] * len(self.tags)
        for i in range(1, len(self.tags)):
            within[i] = within[self.parents[i]] or (self.names[i] == last and self.depths[i] <= DEEPEST and self.path(i) == path)
        if not any(within):
            return None
        return " ".join("".join(t if within[i] else " " for i, t, _ in self.pieces if not self.dropped[i]).split())


def main_text(source: str, path: str | None) -> str:
    """A page's text at its host's ``path``; if the page has no such container or an empty one, at its own best, else all that is not dropped."""
    page = Page(source)
    if path and (found := page.text(path)):
        return found
    return page.text(page.best()) or ""


def _votes(pages: DataFrame) -> DataFrame:
    """host, path: the container of each page that has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = [Page(x.decode()).best() for x in utf8(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(paths, pa.string())], ["host", "path"])

    return pages.mapInArrow(released(run), "host string, path string").filter("path is not null")


def winning_paths(pages: DataFrame) -> DataFrame:
    """host, path, votes, n_pages: the path that most pages of each host name, of equal ones the first by code point.

    ``pages`` has url and html. Hosts are lower-cased; null and relative urls share the empty
    one. Votes are added up before they are shuffled, so a host of any size is a few rows.
    """
    votes = _votes(pages.select(parts(F.col("url"))[0].alias("host"), "html")).groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"))
    ballot = F.struct((-F.col("votes")).alias("less"), "path")
    return votes.groupBy("host").agg(F.min(ballot).alias("won"), F.sum("votes").alias("n_pages")).select(
        "host", F.col("won.path").alias("path"), (-F.col("won.less")).alias("votes"), "n_pages"
    )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, host_path of every row: the main text by the path that the host's pages agree on.

    Text is that of the container's blocks in page order, with character references decoded and
    white space of any kind as one space; menus, headers outside the article, footers,
    sidebars, notices, adverts, forms, scripts, styles and comments are left out by element,
    class, id and role. Null and empty html give ''. A page without its host's container is
    extracted by its own best one. Null and repeated page_ids come back as they are; html of any
    length is read whole; extra columns are ignored; an empty table gives an empty table.
    """
    id_type = pages.schema["page_id"].dataType.simpleString()
    won = stored(winning_paths(pages).select(F.col("host").alias("__host"), F.col("path").alias("__path")))
    size = won.agg(F.sum(F.length("__host") + F.length("__path")).alias("n")).first()["n"] or 0
    rows = pages.select("page_id", "url", "html", parts(F.col("url"))[0].alias("__host"))
    met = rows.join(F.broadcast(won) if 4 * size < SMALL_BYTES else won, "__host", "left").select("page_id", "url", "html", "__path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.decode(), path) for x, path in zip(utf8(b.column(2)), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), b.column(3)], ["page_id", "url", "text", "host_path"])

    return met.mapInArrow(released(run), f"page_id {id_type}, url string, text string, host_path string")


def op12(pages: DataFrame) -> DataFrame:
    """The digest of extract(): page_id, url, text, n_chars (code points)."""
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
