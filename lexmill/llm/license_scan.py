"""Licence scan: a trained paragraph classifier, confirmed by templates.

A multinomial logistic regression over sparse word 1- and 2-grams tells licence families
and an unknown class apart. It is fitted here on notices made from phrases and names and on
the licences' own paragraphs; its temperature is calibrated on rows it has not seen. A prediction
stands if its probability is high enough and the paragraph holds most words of one of the
family's templates: its names and its own paragraphs.

Every word and pair of words of every text is looked up among the model's features. No unit of a
text can be likelier of a family than unknown if all positive evidence of the whole text together is not
enough, so lines and windows are laid out only where the model's own weights leave that possible: an
exact bound, which drops nothing that could stand. Scoring is DataFrame operations only.
"""

from __future__ import annotations

import itertools
import json
import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import let, stored
from lexmill.llm.license_texts import TEXTS

UNKNOWN = "unknown"
#: Names of each family; they are its templates as well, as are its TEXTS.
NAMES = {
    "mit": ["MIT License", "MIT licence", "Expat License"],
    "apache": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 license", "Apache Software License"],
    "gpl": ["GNU General Public License, version 3", "GNU General Public License version 2", "GNU GPL", "GPL-3.0 license", "GPLv3 license"],
    "lgpl": ["GNU Lesser General Public License", "GNU Library General Public License", "LGPL-2.1 license"],
    "agpl": ["GNU Affero General Public License", "AGPL-3.0 license"],
    "bsd": ["BSD License", "3-Clause BSD License", "2-Clause BSD License", "BSD-3-Clause license"],
    "mpl": ["Mozilla Public License, version 2.0", "Mozilla Public License", "MPL-2.0 license"],
    "isc": ["ISC License", "ISC licence"],
    "epl": ["Eclipse Public License, version 2.0", "Eclipse Public License", "EPL-2.0 license"],
    "unlicense": ["The Unlicense", "Unlicense license"],
    "cc-by": ["CC BY 4.0", "CC BY 3.0", "Creative Commons Attribution 4.0"],
    "cc-by-sa": ["CC BY-SA 4.0", "CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 4.0"],
    "cc-by-nc": ["CC BY-NC 4.0", "CC BY-NC 3.0", "Creative Commons Attribution-NonCommercial 4.0"],
    "cc0": ["CC0 1.0 public domain dedication", "Creative Commons Zero"],
    "proprietary": ["All rights reserved"],
}
#: Short names that stand in notices without the word licence, or alone; those of one word are confirmed by "under" or if nothing else is in the paragraph.
SHORT = {
    "mit": ["MIT"], "apache": ["Apache-2.0", "Apache 2.0"], "gpl": ["GPL", "GPLv2", "GPLv3", "GPL-2.0", "GPL-3.0"], "lgpl": ["LGPL", "LGPLv3", "LGPL-2.1", "LGPL-3.0"], "agpl": ["AGPL", "AGPLv3", "AGPL-3.0"],
    "bsd": ["BSD", "BSD-2-Clause", "BSD-3-Clause"], "mpl": ["MPL", "MPL-2.0"], "isc": ["ISC"], "epl": ["EPL", "EPL-1.0", "EPL-2.0"], "unlicense": ["Unlicense"], "cc0": ["CC0", "CC0-1.0"],
}
FRAMES = [
    "Released under the {}.", "Licensed under {}.", "Licensed under the {}.", "This work is licensed under the {}.", "This work is licensed under a {} license.",
    "Distributed under the terms of the {}.", "This program is free software, available under the {}.", "SPDX-License-Identifier: {}", "Copyright holders grant use under the {}.",
    "See the {} for permissions and limitations.", "The content of this page is available under {}.", "You may not use this file except in compliance with the {}.", "{}",
]
#: Paragraphs that speak of licences without granting one.
OTHERS = [
    "The driver lost the license after the accident.", "A licensed doctor will see you now.", "Poetic licence lets the author bend the facts.", "The lecture on copyright law begins at noon.",
    "You need permission to enter the building.", "The police had a warrant for the house.", "The warranty covers parts for two years.", "Fishing licenses are sold at the town hall.",
    "The permission slip must be signed by a parent.", "The bar got its liquor license renewed.", "He was asked for his license and registration.", "Copyright disputes take years to settle.",
    "Donations are redistributed to local groups.", "The license plate was hard to read.", "Apache helicopters flew over the town.", "The general public was invited to the library.",
    "The school has clear rules on permission and licence to leave.", "License to operate a radio station was refused.", "The mozilla foundation met in public.", "A commons is land for the creative use of all.",
    "Er kam mit dem Zug nach Hause.", "Sie sprach mit ihm unter vier Augen.", "She studied at MIT under a famous professor.",
]
#: Ordinary prose, so that common words speak for no family.
PROSE = [
    "The river ran slowly through the valley and nobody in the village knew of it.", "You may see this in any of the files that were made for use by the public under this roof.", "In the morning they had to take all of it with them, as is the rule.",
    "This is the story of a man who was free to go and of those that were not.", "It was distributed by hand, without any notice, in the form of a small book.", "All of us agree that the source of the water is above the town.", "Version two of the play was better than the first, and all copies were sold.",
    "Use of the hall by others is at the discretion of the owner.", "For more, see the next page or the end of this chapter.", "The text of the letter was short and not at all what she had hoped for.", "No one shall be left behind, and each of you must do your part.",
    "Die Kinder liefen durch den Wald und kamen mit dem Abend wieder nach Hause.", "Es war ein Tag wie jeder andere, und die Stadt lag still unter dem Schnee.", "La casa de la abuela era grande y estaba cerca del mar.", "Por la noche se fueron todos con la familia a la plaza.",
    "Le soir, nous sommes partis par la route avec des amis qui attendaient sur le quai.", "Il y a dans ce livre une histoire pour les enfants et pour les autres.", "The software was late, the material was poor and the work was hard to do.", "The names of the contributors and the holders of the prize were read aloud.", "A copy of the list and the conditions of the race hang on the door.",
]
#: Lines that speak of licences; of those without a notice that stands the text is called unknown.
SPEAKS = r"(?i)licen[cs]e|licen[cs]ing|copyright|warrant|permission|redistribut|public domain|rights reserved|\bcc[ 0-]|creative commons|spdx|\bgnu\b|\bl?a?gpl|unencumbered|free to copy"
#: Common words of four languages are no features, and pairs of them neither.
COMMON = frozenset(
    """a about above after all also an and any are as at be been before but by can could did do does each for from had has have he her his if in into is it its may more most must no nor
    not of off on one only or other our out over own shall she should so some such than that the their them then there these they this those to under up upon use used was were what when where which who will with without would you your
    aber als am auf aus bei bin bis das dem den der des die doch durch ein eine einem einen einer er es für hat ich ihm ihr im ist ja mit nach nicht noch nur oder ohne sich sie sind so über um und uns von vor war wie wir zu zum zur
    al con de del el en la las lo los más o para pero por que se sin su un una y au aux avec ce cette dans des du elle est et il je le les leur ne nous ou par pas pour qui sa ses son sont sur une vous""".split()
)
#: What marks the ends of a paragraph in pairs; "mit" alone is a common word of German, in pairs it is not.
BEGIN, FINISH = "^", "$"
IN_PAIRS = frozenset(COMMON - {"mit"} | {BEGIN, FINISH})
WORD = r"[a-z0-9]+(?:\.[0-9]+)*"
#: Probability and share of a template's words that let a prediction stand.
CONFIDENT, SIMILAR = 0.5, 0.8
#: The licences' paragraphs teach in pieces of so many words, each begun halfway through the one before.
PIECE = 12
#: Words and line ends of the windows that are laid over paragraphs of several lines, half a window apart, and how much longer than a text they may be.
WINDOWS = (32, 64, 128, 256, 512)
DILUTED = 8
STEPS, RATE, RIDGE, LASSO = 300, 2.0, 1e-3, 2e-5
#: Weights this small, before calibration, are left out.
LEAST = 0.03


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def features_of(text: str) -> set[str]:
    """Distinct words and pairs of neighbouring words, with marks of the ends; common words do not count."""
    w = words_of(text)
    pairs = itertools.pairwise([BEGIN, *w, FINISH])
    return {*(x for x in w if x not in COMMON), *(f"{a} {b}" for a, b in pairs if a not in IN_PAIRS or b not in IN_PAIRS)}


@dataclass(frozen=True)
class Model:
    """Weights by feature and family, biases, and the temperature they are divided by."""

    families: tuple[str, ...]
    weights: dict[str, tuple[float, ...]]
    bias: tuple[float, ...]

    def probabilities(self, text: str) -> np.ndarray:
        z = np.array(self.bias) + sum((np.array(self.weights[f]) for f in sorted(features_of(text)) if f in self.weights), np.zeros(len(self.bias)))
        e = np.exp(z - z.max())
        return e / e.sum()


def pieces_of(text: str) -> list[str]:
    """Runs of PIECE words, the last one shorter."""
    w = words_of(text)
    return [" ".join(w[i : i + PIECE]) for i in range(0, max(1, len(w) - PIECE // 2), PIECE // 2)]


def notices() -> list[tuple[str, str]]:
    """(paragraph, family) to learn from: every name in every frame, pieces of the licences' own texts, and what grants no licence."""
    made = [(frame.format(name), family) for names_of in (NAMES, SHORT) for family, names in names_of.items() for name in names for frame in FRAMES]
    pieces = [(p, family) for family, texts in TEXTS.items() for t in texts for p in pieces_of(t)]
    shared = {p for p, n in Counter(p for p, _ in {*pieces}).items() if n > 1}  # tell no family
    made += [x for x in pieces if x[0] not in shared]
    # twice each, so that one of both teaches
    made += [(t, family) for family, texts in TEXTS.items() for t in texts for _ in range(2)]
    made += [(t, UNKNOWN) for t in PROSE for _ in range(3)]
    return made + [(f"{a}{b}", UNKNOWN) for a in OTHERS for b in ("", " " + OTHERS[0], " It is so.")]


@lru_cache(maxsize=1)
def trained() -> Model:
    """The fitted model: two of three notices teach, the third sets the temperature. The same each time."""
    data = notices()
    families = (*NAMES, UNKNOWN)
    vocabulary = sorted(set().union(*(features_of(t) for t, _ in data)))
    index = {f: i for i, f in enumerate(vocabulary)}
    x = np.zeros((len(data), len(vocabulary)))
    for r, (text, _) in enumerate(data):
        x[r, [index[f] for f in features_of(text)]] = 1
    y = np.eye(len(families))[[families.index(f) for _, f in data]]
    teach = np.arange(len(data)) % 3 != 2
    w, b = np.zeros((len(vocabulary), len(families))), np.zeros(len(families))

    def soft(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    a, t = x[teach], y[teach]
    for _ in range(STEPS):
        d = (soft(a @ w + b) - t) / len(a)
        w -= RATE * (a.T @ d + RIDGE * w)
        w = np.sign(w) * np.maximum(np.abs(w) - RATE * LASSO, 0)  # most weights are zero
        b -= RATE * d.sum(axis=0)
    w[np.abs(w).max(axis=1) < LEAST] = 0
    z, h = x[~teach] @ w + b, y[~teach]
    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0), key=lambda c: -np.log((soft(z / c) * h).sum(axis=1) + 1e-12).sum())
    w, b = np.round(w / temperature, 4), np.round(b / temperature, 4)
    return Model(families, {f: tuple(w[i].tolist()) for f, i in index.items() if w[i].any()}, tuple(b.tolist()))


def _table(spark, rows: list[dict], schema: str) -> DataFrame:
    """A small table from its JSON text."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("r")).select("r.*")


def _words(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(WORD), F.lit(0))


def _templates() -> list[dict]:
    """Word sets by family, with the phrase for names; the words of a text have none."""
    short = {f: [x for n in SHORT.get(f, []) for x in ([n] if len(words_of(n)) > 1 else [n, f"under {n}", f"under the {n}"])] for f in NAMES}
    named = [{"family": f, "words": sorted(set(words_of(n))), "phrase": f" {' '.join(words_of(n))} "} for f in NAMES for n in NAMES[f] + short[f]]
    return named + [{"family": f, "words": sorted(set(words_of(t)))} for f in NAMES for t in TEXTS[f]]


def named_alone(model: Model) -> list[tuple[str, str, float]]:
    """(family, phrase, probability) of the names of several words that the model gives to their family when they stand alone."""
    phrases = sorted({(t["family"], t["phrase"]) for t in _templates() if len(t.get("phrase", "").split()) > 1})
    told = [(f, p, float(model.probabilities(p)[model.families.index(f)])) for f, p in phrases]
    return [(f, p, c) for f, p, c in told if c >= CONFIDENT]


class Scorer:
    """The model as Column expressions over arrays of words; all tables in them have the model's fixed size."""

    def __init__(self, spark, model: Model):
        names = sorted(model.weights)
        hash_of = lambda xs: spark.sql("SELECT array(" + ", ".join("xxhash64(" + ", ".join(f"'{w}'" for w in x.split(" ")) + ")" for x in xs) + ") AS h").first()["h"]
        # of each feature one word that is in every text which has it
        anchors = sorted({next(x for x in f.split(" ") if x not in (IN_PAIRS if " " in f else COMMON)) for f in names})
        none = model.families.index(UNKNOWN)
        weights = np.array([model.weights[f] for f in names])
        lit = lambda x, kind: F.from_json(F.lit(json.dumps(x)), kind)
        self.anchors, self.hashes = lit(anchors, "array<string>"), lit(hash_of(names), "array<long>")
        self.weights = lit(weights.tolist(), "array<array<double>>")
        self.most = lit(np.maximum(weights - weights[:, [none]], 0).max(axis=1).tolist(), "array<double>")
        self.bias = lit(list(model.bias), "array<double>")
        self.none, self.lead = none, np.array(model.bias) - model.bias[none]
        self.lead[none] = -1e9

    def features(self, words: Column) -> Column:
        """Distinct features, from 1, of an array of words; they are looked for where a word is one that features have."""
        pairs = let(F.concat(F.array(F.lit(BEGIN)), words, F.array(F.lit(FINISH))), lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1))))
        met = F.array_intersect(F.concat(F.transform(words, lambda x: F.xxhash64(x)), pairs), self.hashes)
        ids = F.transform(met, lambda h: F.array_position(self.hashes, h).cast("int"))
        return F.when(F.arrays_overlap(words, self.anchors), ids).otherwise(F.array().cast("array<int>"))

    def possible(self, features: Column) -> Column:
        """Whether some part of a text with these features may be likelier of a family than unknown: all that speaks for a family, and nothing against, is added up."""
        roughly = F.aggregate(features, F.lit(float(self.lead.max())), lambda acc, f: acc + F.get(self.most, f - 1)) >= -1e-6
        above = lambda acc, w: F.zip_with(acc, w, lambda x, y: x + F.greatest(F.lit(0.0), y - F.get(w, F.lit(self.none))))
        each = F.aggregate(features, F.array(*map(F.lit, self.lead.tolist())), lambda acc, f: above(acc, F.get(self.weights, f - 1)))
        return F.when(roughly, F.array_max(each) >= -1e-6).otherwise(F.lit(False))

    def logits(self, features: Column) -> Column:
        return F.aggregate(features, self.bias, lambda acc, f: F.zip_with(acc, F.get(self.weights, f - 1), lambda x, y: x + y))


def _lines(looked: DataFrame, model: Scorer) -> DataFrame:
    """Single lines that speak of licences or may stand, as units -1."""
    lines = looked.select("doc_id", "tie", F.posexplode(F.split("text", "\n", -1)).alias("position", "line"))
    lines = lines.select("doc_id", "tie", "position", F.lit(-1).alias("unit"), F.col("line").rlike(SPEAKS).alias("speaks"), _words(F.col("line")).alias("words"))
    return lines.withColumn("features", let(F.col("words"), model.features)).filter(F.col("speaks") | let(F.col("features"), model.possible))


def _windows(looked: DataFrame, model: Scorer) -> DataFrame:
    """Windows that may stand, over runs of lines that are not blank; ``position`` is the line they begin in, units count from 0.

    A notice of n words and line ends lies whole in a window of at most 4 n, or 32, of them.
    """
    lines = F.split("text", "\n", -1)
    split = looked.select("doc_id", "tie", lines.alias("lines"))
    # lines of marks only, such as those of comments, are blank too
    blank = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: ~F.get("lines", i).rlike(r"[\p{L}\p{N}]"))
    split = split.withColumn("blank", blank)
    ends = F.arrays_zip(F.concat(F.array(F.lit(-1)), "blank").alias("a"), F.concat("blank", F.array(F.size("lines"))).alias("b"))
    runs = split.select("doc_id", "tie", "lines", F.explode(ends).alias("e")).filter("e.b - e.a > 1")
    runs = runs.select("doc_id", "tie", (F.col("e.a") + 1).alias("first"), F.concat_ws("\n", F.slice("lines", F.col("e.a") + 2, F.col("e.b") - F.col("e.a") - 1)).alias("run"))
    plain = lambda w: F.array_remove(w, "\n")
    marked = runs.select("doc_id", "tie", "first", F.regexp_extract_all(F.lower("run"), F.lit(WORD + r"|\n"), F.lit(0)).alias("words"))
    marked = marked.filter(let(let(plain(F.col("words")), model.features), model.possible))
    n = F.size("words")

    def starts(size: int) -> Column:
        """(begin, size) of the windows; larger ones only over what smaller ones do not hold whole."""
        at = F.sequence(F.lit(0), F.greatest(n - size // 2 - 1, F.lit(0)), F.lit(size // 2))
        made = F.transform(at, lambda i: F.struct(i.alias("begin"), F.lit(size).alias("size")))
        return made if size == WINDOWS[0] else F.when(n > size // 2, made).otherwise(F.slice(made, 1, 0))

    held = lambda w: plain(F.slice("words", w["begin"] + 1, w["size"]))
    kept = F.filter(F.concat(*map(starts, WINDOWS)), lambda w: let(let(held(w), model.features), model.possible))
    cut = F.transform(kept, lambda w: F.struct((F.col("first") + F.size(F.filter(F.slice("words", 1, w["begin"]), lambda x: x == "\n"))).alias("position"), held(w).alias("words")))
    laid = marked.select("doc_id", "tie", F.posexplode(cut).alias("unit", "w")).select("doc_id", "tie", F.col("w.position").alias("position"), "unit", F.lit(False).alias("speaks"), F.col("w.words").alias("words"))
    return laid.withColumn("features", let(F.col("words"), model.features))


def paragraphs(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The judged() units that are single lines."""
    return judged(docs, model).filter("unit < 0")


def judged(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, tie, position, unit, speaks, family, confidence, similarity, stands of every line that speaks of licences and every line and window that may stand.

    ``tie`` is a hash of the text, for rows of equal doc_id. In a window a name must stand
    as a phrase, since its words alone may come from anywhere, and so must that of a line's second
    family, which is classified by that phrase alone; every family so named is a row, if it is likelier than unknown.
    Texts confirm the most probable family only.
    """
    model = model or trained()
    spark = docs.sparkSession
    scorer = Scorer(spark, model)
    templates = _table(spark, _templates(), "family:string,words:array<string>,phrase:string")
    whole = F.col("text").rlike(SPEAKS) | let(let(_words(F.col("text")), scorer.features), scorer.possible)
    looked = docs.filter(F.col("text").isNotNull()).filter(whole).select("doc_id", F.xxhash64("text").alias("tie"), "text")
    # stored, since lines and windows read it
    looked = stored(looked)
    key = ["doc_id", "tie", "position", "unit"]
    scored = _lines(looked, scorer).unionByName(_windows(looked, scorer)).withColumn("z", scorer.logits(F.col("features")))
    best = F.array_max("z")
    share = 1 / F.aggregate("z", F.lit(0.0), lambda acc, v: acc + F.exp(v - best))
    family = F.element_at(F.array(*map(F.lit, model.families)), F.array_position("z", best).cast("int"))
    # a window may name several families: each is also weighed against unknown alone
    none = F.element_at("z", model.families.index(UNKNOWN) + 1)
    each = [F.struct(F.lit(f).alias("family"), (1 / (1 + F.exp(none - F.element_at("z", i + 1)))).alias("confidence"), F.lit(False).alias("top")) for i, f in enumerate(model.families) if f != UNKNOWN]
    top = F.struct(family.alias("family"), share.alias("confidence"), F.lit(True).alias("top"))
    # what else a line names is classified by itself, without the rest of the line
    alone = {f: [(p, c) for g, p, c in named_alone(model) if g == f] for f in model.families}
    own = lambda f, line: F.greatest(*(F.when(line.contains(p), F.lit(c)) for p, c in alone[f]), F.lit(0.0))
    named = lambda line: F.array(*(F.struct(F.lit(f).alias("family"), own(f, line).alias("confidence"), F.lit(False).alias("top")) for f in model.families if alone[f]))
    of_line = let(F.concat(F.lit(" "), F.concat_ws(" ", "words"), F.lit(" ")), named)
    others = F.when(F.col("unit") < 0, of_line).otherwise(F.array(*each))
    said = F.concat(F.array(top), F.filter(others, lambda x: (x["confidence"] >= CONFIDENT) & (x["family"] != family)))
    told = scored.select(*key, "speaks", "words", F.explode(said).alias("said")).select(*key, "speaks", "words", "said.*")
    t = templates.groupBy(F.col("family")).agg(F.collect_list(F.struct("words", "phrase")).alias("templates"))
    met = told.join(F.broadcast(t), "family", "left").withColumn("distinct", F.array_distinct("words")).withColumn("whole", F.concat(F.lit(" "), F.concat_ws(" ", "words"), F.lit(" ")))

    def share_of(x: Column) -> Column:
        n, most = F.size(x["words"]), F.size("distinct")
        held = F.size(F.array_intersect(x["words"], F.col("distinct")))
        of_line = held / F.when(n == 1, F.greatest(n, most)).otherwise(n)
        of_window = F.when(x["phrase"].isNotNull(), F.when((n > 1) & F.col("whole").contains(x["phrase"]), 1.0)).when(F.col("top") & (F.size("words") <= DILUTED * n + WINDOWS[0]), held / n)
        return F.when((F.col("unit") < 0) & F.col("top"), of_line).otherwise(F.coalesce(of_window, F.lit(0.0)))

    similar = F.coalesce(F.array_max(F.transform("templates", share_of)), F.lit(0.0))
    stands = (F.col("family") != UNKNOWN) & (F.col("confidence") >= CONFIDENT) & (F.col("similarity") >= SIMILAR)
    # what is not the most probable family of a line is told only if it stands
    found = met.select(*key, "speaks", "family", "confidence", similar.alias("similarity"), "top").withColumn("stands", stands)
    return found.filter(F.col("top") | F.col("stands") | (F.col("unit") >= 0)).drop("top")


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, n_candidates, licence, confidence, similarity, position, licences of every row.

    licence: the family of the most probable paragraph that stands (the first of equals; proprietary
    only if no other does); ``unknown`` if lines speak of licences but none stands; null if none
    speaks of any. Candidates are such lines, and notices that only several lines together make.
    licences: (family, position) of every line that stands, and of the most probable window of
    a family that no line stands for, in this order; empty if none stands.
    Null text has no paragraphs. Rows of equal doc_id are judged by their own texts; null
    doc_ids too. An empty table gives an empty table.
    """
    line, best = F.col("unit") < 0, F.struct("family", "confidence", "similarity", "position")
    first = F.struct("stands", "confidence", (-F.col("position")).alias("p"))
    found = judged(docs).filter("stands or speaks").groupBy("doc_id", "tie", "family").agg(
        F.collect_set(F.when(line, F.col("position"))).alias("lines"), F.max(F.col("stands") & line).alias("by_line"), F.max("stands").alias("stands"),
        F.collect_set(F.when(F.col("stands") & line, F.struct("family", "position"))).alias("places"),
        F.max_by(best, F.when(line, first)).alias("line"), F.max_by(best, F.when(~line, first)).alias("window"),
    )
    # windows hold lines too: they tell of families that no line stands for
    found = found.withColumn("best", F.when(F.col("stands") & ~F.col("by_line"), F.col("window")).otherwise(F.col("line")))
    found = found.withColumn("places", F.when(F.col("stands") & ~F.col("by_line"), F.array(F.struct("family", F.col("window.position").alias("position")))).otherwise(F.col("places")))
    others = F.col("family") != "proprietary"  # all rights are reserved in the head of many a licence
    by_text = found.groupBy(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie")).agg(
        # a line of two families is one candidate
        (F.size(F.array_distinct(F.flatten(F.collect_list("lines")))) + F.sum((F.col("stands") & ~F.col("by_line")).cast("long"))).alias("n_candidates"), F.max("stands").alias("any"),
        F.sort_array(F.flatten(F.collect_list("places"))).alias("licences"),
        F.max_by("best", F.struct("stands", others.alias("o"), F.col("best.confidence").alias("c"), (-F.col("best.position")).alias("p"))).alias("best"),
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).alias("n"), F.col("text").isNull().alias("none"))
    met = rows.join(by_text, rows["doc_id"].eqNullSafe(by_text["__id"]) & (rows["tie"] == by_text["__tie"]), "left")
    only = lambda c: F.when(F.col("any"), F.col(f"best.{c}"))
    return met.select(
        "doc_id", F.when(F.col("none"), 0).otherwise(F.col("n")).cast("long").alias("n_paragraphs"), F.coalesce("n_candidates", F.lit(0)).cast("long").alias("n_candidates"),
        F.when(F.col("any"), F.col("best.family")).when(F.col("n_candidates") > 0, F.lit(UNKNOWN)).alias("licence"),
        F.round(only("confidence"), 6).alias("confidence"), F.round(only("similarity"), 6).alias("similarity"), only("position").alias("position"),
        F.coalesce("licences", F.array().cast("array<struct<family:string,position:int>>")).alias("licences"),
    )


def op6(docs: DataFrame) -> DataFrame:
    """license_scan() of every whole text."""
    return license_scan(docs.select("doc_id", "text"))
