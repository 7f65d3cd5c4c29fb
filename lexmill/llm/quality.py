"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; learned filters slide over the whole text; each filter's largest
answer in every one of overlapping chunks is kept; the mean and the maximum of these
over all chunks give one probability.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import released, utf8

#: Embedding size, bytes in a filter, filters. Filters start at every byte.
DIM, WIDTH, FILTERS = 4, 8, 24
#: Bytes of half a chunk; a chunk is two neighbouring halves, so chunks overlap by half.
HALF = 128
#: The model is fitted on the whole texts of at most so many labelled rows.
TRAIN_ROWS = 2000
EPOCHS, BATCH, RATE, SEED = 10, 32, 0.01, 7
#: Texts are laid out in groups of about so many bytes, and answered so many at once, which bounds memory.
GROUP_BYTES = 1 << 17
#: Rows with this remainder of crc32(doc_id as text) by 4 never teach.
HELD_OUT, FOLDS = 2, 4
ACCEPT = 0.7


def _lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes in one array, each text from a multiple of HALF on and followed by at least WIDTH zeros; halves and bytes of each."""
    sizes = np.array([len(x) for x in texts], np.int64)
    halves = np.maximum(2, -(-(sizes + WIDTH) // HALF))
    flat = np.zeros(int(halves.sum()) * HALF + WIDTH, np.uint8)
    at = 0
    for text, h in zip(texts, halves.tolist(), strict=True):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
        at += h * HALF
    return flat, halves, sizes


@dataclass
class ByteConv:
    """The network's weights, and how to fit and apply them."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out_mean: np.ndarray
    out_max: np.ndarray
    out_bias: np.ndarray
    names: tuple[str, ...] = field(default=("embed", "filters", "bias", "out_mean", "out_max", "out_bias"), repr=False)

    @classmethod
    def fresh(cls, seed: int = SEED) -> ByteConv:
        rng = np.random.default_rng(seed)
        g = lambda *s: rng.standard_normal(s).astype(np.float32)
        embed = 0.5 * g(256, DIM)
        embed[0] = 0
        return cls(embed, g(WIDTH * DIM, FILTERS) / np.float32(np.sqrt(WIDTH * DIM / 4)), np.zeros(FILTERS, np.float32), 0.1 * g(FILTERS), 0.1 * g(FILTERS), np.zeros(1, np.float32))

    def _windows(self, flat: np.ndarray) -> np.ndarray:
        x = self.embed[flat]
        return np.lib.stride_tricks.as_strided(x, (len(flat) - WIDTH, WIDTH * DIM), (DIM * 4, 4))

    def _best(self, flat: np.ndarray, halves: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each half's largest answer of each filter, and at which byte; windows that begin behind a text's end answer 0."""
        first = np.concatenate([[0], np.cumsum(halves)[:-1]])
        dead = np.stack([first * HALF + sizes, (first + halves) * HALF], axis=1)
        total, step = int(halves.sum()), GROUP_BYTES // HALF
        best, where = np.empty((total, FILTERS), np.float32), np.empty((total, FILTERS), np.int64)
        for h in range(0, total, step):
            n = min(step, total - h)
            got = np.maximum(np.ascontiguousarray(self._windows(flat[h * HALF : (h + n) * HALF + WIDTH])) @ self.filters + self.bias, 0)
            for a, b in (dead[(dead[:, 1] > h * HALF) & (dead[:, 0] < (h + n) * HALF)] - h * HALF).tolist():
                got[max(a, 0) : max(b, 0)] = 0
            got = got.reshape(n, HALF, FILTERS)
            where[h : h + n] = got.argmax(axis=1)
            best[h : h + n] = np.take_along_axis(got, where[h : h + n, None], axis=1)[:, 0]
        return best, where

    def _pooled(self, halves_max: np.ndarray, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chunk maxima, the first chunk of each text, and chunks by text; a text of h halves has h - 1 chunks."""
        chunk = np.maximum(halves_max[:-1], halves_max[1:])
        last = np.cumsum(halves) - 1
        keep = np.ones(len(halves_max), bool)
        keep[last] = False
        starts = np.concatenate([[0], np.cumsum(halves - 1)[:-1]])
        return chunk[keep[:-1]], starts, halves - 1

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities of label 1, in double precision."""
        out = np.empty(len(texts), np.float64)
        for at in _groups(texts):
            flat, halves, sizes = _lay_out([texts[i] for i in at])
            chunk, starts, n = self._pooled(self._best(flat, halves, sizes)[0], halves)
            mean = np.add.reduceat(chunk, starts, axis=0) / n[:, None]
            top = np.maximum.reduceat(chunk, starts, axis=0)
            z = (mean @ self.out_mean + top @ self.out_max + self.out_bias).astype(np.float64)
            out[at] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> ByteConv:
        """Adam on the log loss, in a seeded order; the same rows give the same weights."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(getattr(self, k)) for k in self.names}
        second = {k: np.zeros_like(getattr(self, k)) for k in self.names}
        steps, total = 0, max(1, epochs * -(-len(texts) // BATCH))
        share = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
        self.out_bias[:] = np.log(share / (1 - share))
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for a in range(0, len(order), BATCH):
                rows = order[a : a + BATCH]
                grads: dict[str, np.ndarray] = {}
                for at in _groups([texts[i] for i in rows]):
                    for k, g in self._gradients([texts[rows[i]] for i in at], labels[rows[at]]).items():
                        grads[k] = grads.get(k, 0) + g / np.float32(len(rows))
                steps += 1
                rate = RATE * (1 - 0.9 * steps / total)
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    move = first[k] / (1 - 0.9**steps) / (np.sqrt(second[k] / (1 - 0.99**steps)) + 1e-6)
                    getattr(self, k)[...] -= (rate * move).astype(np.float32)
                self.embed[0] = 0
        return self

    def _gradients(self, texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
        """Sums over the texts of the gradients of their losses."""
        flat, halves, sizes = _lay_out(texts)
        best, where = self._best(flat, halves, sizes)
        chunk, starts, n = self._pooled(best, halves)
        mean = np.add.reduceat(chunk, starts, axis=0) / n[:, None]
        top = np.maximum.reduceat(chunk, starts, axis=0)
        z = mean @ self.out_mean + top @ self.out_max + self.out_bias
        d = ((1 / (1 + np.exp(-np.clip(z, -30, 30)))) - labels).astype(np.float32)
        text_of = np.repeat(np.arange(len(texts)), n)
        is_top = chunk == top[text_of]
        is_top = is_top / np.maximum(np.add.reduceat(is_top, starts, axis=0)[text_of], 1)
        d_chunk = d[text_of, None] * (self.out_mean / n[text_of, None] + self.out_max * is_top)
        half = np.delete(np.arange(len(best)), np.cumsum(halves) - 1)
        source = np.where(best[half] >= best[half + 1], half[:, None], half[:, None] + 1)
        k = np.broadcast_to(np.arange(FILTERS), source.shape)
        d_chunk = np.where(best[source, k] > 0, d_chunk, 0).astype(np.float32)
        window = (source * HALF + where[source, k]).ravel()
        live = np.flatnonzero(d_chunk.ravel())
        window, weight, which = window[live], d_chunk.ravel()[live], k.ravel()[live]
        taken = flat[window[:, None] + np.arange(WIDTH)]
        x = self.embed[taken].reshape(-1, WIDTH * DIM)
        d_filters = np.zeros((FILTERS, WIDTH * DIM), np.float32)
        np.add.at(d_filters, which, weight[:, None] * x)
        d_x = (weight[:, None] * self.filters.T[which]).reshape(-1, DIM)
        d_embed = np.stack([np.bincount(taken.ravel(), d_x[:, j], 256) for j in range(DIM)], axis=1)
        return {
            "embed": d_embed, "filters": d_filters.T, "bias": np.bincount(which, weight, FILTERS),
            "out_mean": d @ mean, "out_max": d @ top, "out_bias": d.sum(keepdims=True),
        }


def _groups(texts: list[bytes]) -> Iterator[list[int]]:
    """Row numbers of texts of together about GROUP_BYTES; a longer text is a group of its own."""
    run, n = [], 0
    for i, text in enumerate(texts):
        if run and n + len(text) > GROUP_BYTES:
            yield run
            run, n = [], 0
        run.append(i)
        n += len(text) + 2 * HALF
    if run:
        yield run


def held_out(doc_id) -> bool:
    """Whether a row with this id never teaches; null counts as the text 'None'."""
    return zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> ByteConv:
    """A network fitted on the whole texts of at most ``rows`` labelled rows, the ones of least hash of doc_id.

    Only texts and labels.quality are used. Rows without label, with null id or that are held out
    do not teach. Of rows with equal doc_id each counts towards ``rows``. Without any labelled row the
    network answers as it begins.
    """
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    known = (
        labels.filter("doc_id is not null and quality is not null")
        .filter(crc % FOLDS != HELD_OUT)
        .select("doc_id", F.col("quality").cast("int").alias("y"))
        .orderBy(F.hash("doc_id"), "doc_id", "y")
        .limit(rows)
    )
    # at most ``rows`` labelled ids are sent to all executors, and as many texts come back
    met = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select(F.hash("doc_id").alias("h"), "y", F.coalesce("text", F.lit("")).alias("text"))
    got = met.orderBy("h", "y", F.xxhash64("text"), "text").limit(rows).collect()
    return ByteConv.fresh().fit([r["text"].encode() for r in got], np.array([r["y"] for r in got], np.float32))


def score(docs: DataFrame, model: ByteConv, into: str = "score") -> DataFrame:
    """Every row of ``docs``, all columns kept, with ``into``: the probability of good quality.

    Null text is empty and has a score. A column of the name ``into`` is replaced.
    """
    docs = docs.drop(into)
    weights = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{into}` double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = pa.array(weights.value.scores(utf8(b.column(at))), pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, got], [*b.schema.names, into])

    return docs.mapInArrow(released(run), schema)


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the fitted network gives at least ACCEPT, columns unchanged, one named score too."""
    return score(docs, fit(docs, labels), "__score").filter(F.col("__score") >= ACCEPT).select(*docs.columns)


def op9(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    texts = docs.select("doc_id", "text")
    model = fit(texts, labels)
    weights = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            got = weights.value.scores(utf8(b.column(1)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([held_out(x) for x in ids], pa.bool_()), pa.array(got, pa.float64()), pa.array((got >= ACCEPT).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return texts.mapInArrow(released(run), f"doc_id {id_type}, held_out boolean, score double, predicted int")
