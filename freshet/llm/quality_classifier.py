"""Quality classification by attention-based multiple-instance learning.

A text is a bag of passages of PASSAGE bytes, the last one shorter. Every
passage is encoded: shares of pairs of neighbouring byte classes, and how its
words repeat. A hidden layer turns that into the passage's representation h;
gated attention, softmax over the bag of w . (tanh(V h) * sigmoid(U h)), weights
the representations, and the weighted sum is scored. Only documents have labels;
which passages matter is learned from them.

Training: Adam in numpy, on whole documents. The sample is bounded: at most
SAMPLE labelled documents, by the hash of their ids, and of each at most
PASSAGES_EACH passages, evenly spaced over the whole text. Scoring encodes every
passage of every text.

An empty or null text is one empty passage and is scored like any other. Of
several labels of a document the lowest counts; null labels and ids count for
nothing, and a null doc_id counts as held out. Repeated rows are scored alike.
Without both labels in the training rows every score is the share of label 1
(1 if there is none). Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.language_id import held_out
from freshet.llm.shared import chunks, fresh

PASSAGE = 512
#: Longer texts are encoded in blocks, a whole number of passages.
BLOCK = 4 << 20
SAMPLE = 3000
PASSAGES_EACH = 24
HIDDEN = 24
ATTENTION = 12
EPOCHS = 30
SEED = 11
THRESHOLD = 0.3


def _byte_classes() -> np.ndarray:
    """A class for every byte: letters by case, digits, kinds of marks, gaps."""
    out = np.full(256, 15, np.uint8)
    groups = [
        b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b"\t\v\f\r",
        b".", b",;:", b"!?", b"|", b"#*$%&~^", b"<>", b"()[]{}", b"'\"`", b"-_=+/\\@",
    ]
    for k, members in enumerate(groups):
        out[list(members)] = k
    out[128:] = 0  # bytes of letters beyond ASCII, as a rule
    return out


_CLASSES = _byte_classes()
_POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64), dtype=np.uint64)
FEATURES = 256 + 5


def encode_passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(passages, FEATURES) of all texts in order, and where each text begins.

    A text over BLOCK bytes is encoded block by block; a word across two blocks
    counts as two.
    """
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    whole = np.array([len(r) for r in raw], np.int64)
    blocks = np.maximum(1, -(-whole // BLOCK))
    if len(raw) and blocks.max() > 1:
        found = [_encode([r[i * BLOCK : (i + 1) * BLOCK]])[0] for r, n in zip(raw, blocks, strict=True) for i in range(n)]
        x = np.concatenate(found)
    else:
        x = _encode(raw)[0]
    per_text = np.maximum(1, -(-whole // PASSAGE))
    # A text's length, alike for all its passages.
    x[:, 260] = np.repeat(np.log1p(whole) / 10, per_text)
    return x, np.concatenate([[0], np.cumsum(per_text)])


def _encode(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(b"".join(raw), np.uint8)
    sizes = np.array([len(r) for r in raw], np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    per_text = np.maximum(1, -(-sizes // PASSAGE))
    starts = np.concatenate([[0], np.cumsum(per_text)])
    n = int(starts[-1])
    out = np.zeros((n, FEATURES), np.float32)
    if not len(flat):
        return out, starts
    owner = np.repeat(np.arange(len(raw)), sizes)
    place = np.arange(len(flat)) - at[:-1][owner]
    passage = starts[:-1][owner] + place // PASSAGE
    classes = _CLASSES[flat]
    same = passage[1:] == passage[:-1]
    pair = passage[:-1] * 256 + classes[:-1] * np.int64(16) + classes[1:]
    counts = np.bincount(pair[same], minlength=n * 256).reshape(n, 256)
    out[:, :256] = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
    # Words as hashes; one belongs to the passage and text it begins in.
    gap = (classes >= 3) & (classes <= 5)
    begins = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1] | (owner[1:] != owner[:-1])]))
    if len(begins):
        inside = np.zeros(len(flat), np.int64)
        inside[begins[0] :] = np.arange(begins[0], len(flat)) - np.repeat(begins, np.diff(np.append(begins, len(flat))))
        values = np.where(gap, 0, flat.astype(np.uint64) + 1) * _POWERS[inside & 63]
        words = np.add.reduceat(values, begins)
        home, text = passage[begins], owner[begins]
        total = np.maximum(np.bincount(home, minlength=n), 1)

        def share(hit):
            return np.bincount(home[hit], minlength=n) / total

        def back(k):
            hit = np.zeros(len(words), bool)
            hit[k:] = (words[k:] == words[:-k]) & (text[k:] == text[:-k])
            return hit

        order = np.lexsort((words, home))
        again = np.zeros(len(words), bool)
        again[order[1:]] = (words[order[1:]] == words[order[:-1]]) & (home[order[1:]] == home[order[:-1]])
        out[:, 256] = share(back(1))
        out[:, 257] = share(back(2))
        out[:, 258] = share(again)
        out[:, 259] = np.bincount(home, minlength=n) / 100
    return out, starts


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    values: list[np.ndarray]  # W, b, V, U, w, c, d

    def bags(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        w, b, v, u, a, c, d = self.values
        h = np.tanh((x - self.mean) / self.scale @ w + b)
        t, s = np.tanh(h @ v), 1 / (1 + np.exp(-(h @ u)))
        e = (t * s) @ a
        first, counts = starts[:-1], np.diff(starts)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), counts))
        weight = e / np.repeat(np.add.reduceat(e, first), counts)
        z = np.add.reduceat(weight[:, None] * h, first, axis=0)
        return {"h": h, "t": t, "s": s, "weight": weight, "z": z, "score": 1 / (1 + np.exp(-(z @ c + d[0])))}

    def scores(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return self.bags(x, starts)["score"]


def train(x: np.ndarray, starts: np.ndarray, truth: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """x: passages of all bags in order; truth: 0 or 1 for each bag."""
    rng = np.random.default_rng(seed)
    share = float(truth.mean()) if len(truth) else 1.0
    sizes = [(FEATURES, HIDDEN), (HIDDEN,), (HIDDEN, ATTENTION), (HIDDEN, ATTENTION), (ATTENTION,), (HIDDEN,), (1,)]
    values = [rng.normal(0, 0.6 / np.sqrt(s[0]), s).astype(np.float64) for s in sizes]
    values[1][:] = 0
    values[6][:] = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    model = Model(x.mean(0) if len(x) else np.zeros(FEATURES), (x.std(0) + 0.02) if len(x) else np.ones(FEATURES), values)
    if share in (0.0, 1.0):
        values[5][:] = 0
        return model
    first = [np.zeros_like(p) for p in values]
    second = [np.zeros_like(p) for p in values]
    step = 0
    for epoch in range(epochs):
        rate = 0.005 * (1 - epoch / epochs) + 0.0005
        order = rng.permutation(len(truth))
        for at in range(0, len(order), 32):
            rows = order[at : at + 32]
            parts = [np.arange(starts[r], starts[r + 1]) for r in rows]
            bx, counts = x[np.concatenate(parts)], np.array([len(p) for p in parts])
            f = model.bags(bx, np.concatenate([[0], np.cumsum(counts)]))
            w, b, v, u, a, c, d = values
            error = (f["score"] - truth[rows]) / len(rows)
            dz = np.repeat(error, counts)[:, None] * c
            into = (f["h"] * dz).sum(1)
            mean = np.add.reduceat(f["weight"] * into, np.concatenate([[0], np.cumsum(counts)[:-1]]))
            de = f["weight"] * (into - np.repeat(mean, counts))
            dt = de[:, None] * a * f["s"] * (1 - f["t"] ** 2)
            ds = de[:, None] * a * f["t"] * f["s"] * (1 - f["s"])
            dh = (f["weight"][:, None] * dz + dt @ v.T + ds @ u.T) * (1 - f["h"] ** 2)
            scaled = (bx - model.mean) / model.scale
            grads = [
                scaled.T @ dh + 1e-4 * w, dh.sum(0), f["h"].T @ dt, f["h"].T @ ds, (f["t"] * f["s"]).T @ de,
                f["z"].T @ error, np.array([error.sum()]),
            ]
            step += 1
            for p, g, m, q in zip(values, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                q += 0.001 * (g * g - q)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.999**step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, passages_each: int = PASSAGES_EACH) -> Model:
    """A model from labels (doc_id, quality) of documents that are not held out."""
    chosen = (
        labels.filter(~held_out(F.col("doc_id")) & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.min("quality").alias("_quality"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample)
    )
    # At most `sample` ids; of a repeated id one text is learned from.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
        .groupBy("doc_id")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.min("_quality").alias("quality"))
    )

    def cut(batches):
        for batch in chunks(batches):
            x, starts = encode_passages(batch.column(1).to_pylist())
            parts = []
            for k in range(batch.num_rows):
                pick = np.unique(np.linspace(starts[k], starts[k + 1] - 1, passages_each).astype(int))
                parts.append(x[pick].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(2).cast(pa.int32()), pa.array(parts, pa.binary())],
                ["doc_id", "quality", "x"],
            )

    got = rows.mapInArrow(cut, "doc_id long, quality int, x binary").orderBy("doc_id").toArrow()
    bags = [np.frombuffer(b, "<f4").reshape(-1, FEATURES) for b in got.column("x").to_pylist()]
    starts = np.concatenate([[0], np.cumsum([len(b) for b in bags])]).astype(np.int64)
    x = np.concatenate(bags) if bags else np.zeros((0, FEATURES), np.float32)
    return train(x, starts, (np.array(got.column("quality").to_pylist(), float) == 1).astype(float))


def with_score(docs: DataFrame, model: Model, out: str | None = None, text: str = "text") -> DataFrame:
    """The rows with their score, last: `out`, which replaces a column of that name, or else `score`, with
    underscores in front if docs has it. The model, some kilobytes, goes with the task."""
    out = out or fresh(docs, "score")[0]
    kept = [f for f in docs.schema.fields if f.name != out]
    schema = T.StructType([*kept, T.StructField(out, T.DoubleType())])

    def run(batches):
        for batch in chunks(batches, 1 << 20):
            found = model.scores(*encode_passages(batch.column(text).to_pylist()))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(found.astype(float))], schema.names)

    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    return with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).select("doc_id", "score")
