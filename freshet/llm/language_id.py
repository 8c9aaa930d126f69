"""Language identification by a byte convolutional network, in numpy.

A text's UTF-8 is cut into windows of WINDOW bytes, the last one filled with
zeros. Each byte becomes a vector; filters of several widths slide over the
window; every filter keeps its largest answer; softmax over the languages. A
text's probabilities are the means over its windows, weighted with their bytes.

Training: Adam on windows of labelled texts. The sample is bounded: at most
PER_LANGUAGE texts of a language, by the hash of their ids, and of each at most
WINDOWS_EACH windows, evenly spaced over the whole text. Languages are the
distinct values of lang in the training rows; the sample grows with their
number only.

Texts that are null or have no letter are `und` with score 0. Rows with a null
lang or doc_id are never learned from; a null doc_id counts as held out. Repeated
rows are predicted alike. With no training rows every text is `und`. Other
columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.shared import chunks, flat_bytes, fresh

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 8
EMBEDDING = 6
PER_LANGUAGE = 400
WINDOWS_EACH = 16
EPOCHS = 6
SEED = 7
#: Slots for each id that is wanted, from which the smallest hashes are taken.
SLOTS = 64
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")

@dataclass
class Network:
    """Filters of all widths are rows of one matrix over the largest width,
    those of a smaller width zero behind it."""

    languages: list[str]
    embedding: np.ndarray  # (256, E); byte 0 is padding and stays zero
    filters: np.ndarray  # (max width * E, filters)
    bias: np.ndarray
    out: np.ndarray  # (filters, languages)
    out_bias: np.ndarray

    def unfolded(self, windows: np.ndarray) -> np.ndarray:
        """(windows, places, width * E): the vectors under the filters at each place."""
        x = self.embedding[windows]
        n, length, e = x.shape
        width = self.filters.shape[0] // e
        s = x.strides
        return np.lib.stride_tricks.as_strided(x, (n, length - width + 1, width * e), (s[0], s[1], s[2]))

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        parts = []
        for i in range(0, len(windows), 64):
            answers = np.ascontiguousarray(self.unfolded(windows[i : i + 64])) @ self.filters
            parts.append(answers.max(1))
        return np.maximum(np.concatenate(parts) + self.bias, 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return softmax(self.pooled(windows) @ self.out + self.out_bias)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def windows_of(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    out = np.zeros((max(1, -(-len(raw) // WINDOW)), WINDOW), np.uint8)
    out.reshape(-1)[: len(raw)] = raw
    return out


def train(windows: np.ndarray, truth: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """windows (n, WINDOW) bytes; truth (n,) places in languages."""
    rng = np.random.default_rng(seed)
    width, count = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((width, EMBEDDING, count), np.float32)
    for k, w in enumerate(WIDTHS):
        mask[:w, :, k * FILTERS : (k + 1) * FILTERS] = 1
    mask = mask.reshape(width * EMBEDDING, count)
    values = [
        rng.normal(0, 0.5, (256, EMBEDDING)),
        rng.normal(0, 0.3, mask.shape) * mask,
        np.zeros(count),
        rng.normal(0, 0.3, (count, len(languages))),
        np.zeros(len(languages)),
    ]
    values = [v.astype(np.float32) for v in values]
    values[0][0] = 0
    net = Network(languages, *values)
    share = np.bincount(truth, minlength=len(languages)).astype(np.float32)
    weight = (len(truth) / np.maximum(share, 1) / len(languages))[truth]
    first = [np.zeros_like(v) for v in values]
    second = [np.zeros_like(v) for v in values]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), 64):
            rows = order[at : at + 64]
            x, y, n = windows[rows], truth[rows], len(rows)
            under = np.ascontiguousarray(net.unfolded(x))
            answers = under @ net.filters
            top = answers.argmax(1)  # (n, filters)
            best = np.take_along_axis(answers, top[:, None, :], 1)[:, 0] + net.bias
            hidden = np.maximum(best, 0)
            error = softmax(hidden @ net.out + net.out_bias)
            error[np.arange(n), y] -= 1
            error *= (weight[rows] / n)[:, None]
            back = (error @ net.out.T) * (best > 0)  # (n, filters)
            # Only the place of the largest answer learns.
            seen = under[np.arange(n)[:, None], top]  # (n, filters, width * E)
            to_filters = np.einsum("nfk,nf->kf", seen, back) * mask
            to_bytes = back[:, :, None] * net.filters.T[None]  # (n, filters, width * E)
            to_embedding = np.zeros_like(net.embedding)
            for j in range(width):
                touched = x[np.arange(n)[:, None], top + j]
                np.add.at(to_embedding, touched, to_bytes[:, :, j * EMBEDDING : (j + 1) * EMBEDDING])
            to_embedding[0] = 0
            grads = [to_embedding, to_filters, back.sum(0), hidden.T @ error, error.sum(0)]
            step += 1
            for v, g, a, b in zip(values, grads, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                v -= 0.01 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return net


def predict_texts(net: Network, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, score) of whole texts."""
    known = [i for i, t in enumerate(texts) if t and net.languages and _LETTER.search(t)]
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    if not known:
        return out
    flat, at = flat_bytes([texts[i] for i in known])
    sizes = np.diff(at)
    per_text = -(-sizes // WINDOW)
    starts = np.concatenate([[0], np.cumsum(per_text)])
    windows = np.zeros((int(starts[-1]), WINDOW), np.uint8)
    cells = windows.reshape(-1)
    for k in range(len(known)):
        cells[starts[k] * WINDOW : starts[k] * WINDOW + sizes[k]] = flat[at[k] : at[k + 1]]
    filled = np.full(len(windows), WINDOW)
    filled[starts[1:] - 1] = sizes - (per_text - 1) * WINDOW
    weighted = net.probabilities(windows) * filled[:, None]
    means = np.add.reduceat(weighted, starts[:-1], axis=0) / sizes[:, None]
    for k, i in enumerate(known):
        best = int(means[k].argmax())
        out[i] = (net.languages[best], float(min(1.0, means[k][best])))
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def few_ids(rows: DataFrame, per_language: int) -> DataFrame:
    """doc_id, lang: at most per_language ids of a language, those with the smallest hashes.

    Another hash deals the ids to SLOTS slots for each that is wanted, and each slot keeps its
    smallest. So tasks send no more than the slots, whatever the input and however often an id
    is repeated. An id is missed where a smaller one has its slot, of the smallest hashes about
    one in 2 * SLOTS.
    """
    slot = F.pmod(F.hash("doc_id"), F.lit(SLOTS * per_language))
    hashed = rows.select("doc_id", "lang", slot.alias("_slot"), F.xxhash64("doc_id").alias("_hash"))
    least = [F.min("_hash").alias("_hash"), F.min_by("doc_id", "_hash").alias("doc_id")]
    slots = hashed.groupBy("lang", "_slot").agg(*least)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_hash", "doc_id"))
    return slots.withColumn("_rank", rank).filter(F.col("_rank") <= per_language).select("doc_id", "lang")


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, windows_each: int = WINDOWS_EACH) -> Network:
    """A network from the rows of docs (doc_id, text, lang) that are not held out."""
    rows = docs.select("doc_id", "text", "lang").filter(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") > 0)
    )
    chosen = few_ids(rows, per_language).select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"))
    # However often an id is repeated, one of its texts is learned from.
    sample = (
        rows.join(F.broadcast(chosen), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")), "left_semi")
        .groupBy("doc_id", "lang")
        .agg(F.min("text").alias("text"))
    )

    def cut(batches):
        for batch in chunks(batches):
            langs, parts = [], []
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                w = windows_of(text)
                pick = np.unique(np.linspace(0, len(w) - 1, windows_each).astype(int))
                parts += [row.tobytes() for row in w[pick]]
                langs += [lang] * len(pick)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(parts, pa.binary())], ["lang", "bytes"])

    got = sample.select("text", "lang").mapInArrow(cut, "lang string, bytes binary").orderBy("lang", "bytes").toArrow()
    langs = got.column("lang").to_pylist()
    languages = sorted(set(langs))
    place = {v: i for i, v in enumerate(languages)}
    flat = np.frombuffer(b"".join(got.column("bytes").to_pylist()), np.uint8).reshape(-1, WINDOW)
    return train(flat, np.array([place[v] for v in langs], np.int64), languages) if langs else Network([], *[np.zeros(0)] * 5)


def with_language(docs: DataFrame, net: Network, lang: str | None = None, score: str | None = None, text: str = "text") -> DataFrame:
    """The rows with language and score, last: under the given names, which replace columns of theirs, or else
    `lang_pred` and `score`, with underscores in front if docs has them. The network, a few kilobytes, goes with the task."""
    lang, score = lang or fresh(docs, "lang_pred")[0], score or fresh(docs, "score")[0]
    kept = [f for f in docs.schema.fields if f.name not in (lang, score)]
    schema = T.StructType([*kept, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches):
        for batch in chunks(batches, 1 << 20):
            found = predict_texts(net, batch.column(text).to_pylist())
            new = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *new], schema.names)

    return docs.mapInArrow(run, schema)


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_language(rows, net).select("doc_id", "lang_pred", "score")
