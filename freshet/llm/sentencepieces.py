"""SentencePiece encoding that keeps offsets, and decoding.

Normalisation walks a text through the compiled character map: at every place
the longest prefix that the map holds is replaced, and every byte written
records the source byte it stands for. The normalised text, a dummy space in
front and spaces as U+2581, is cut before runs of that sign; no piece of a
model crosses such a cut (checked when the model is loaded), so each segment is
encoded by itself and remembered. A piece's normalised bytes lead back through
the recorded places to a span of the original bytes.

Spans: starts are inclusive, ends exclusive, in bytes of the original UTF-8; the
dummy space has the empty span at 0, the end id the empty span at the text's end.
Several pieces of one source character (byte pieces, or a character that the map
makes longer) may share its span. Null text is empty: the end id alone. Repeated
rows are encoded each on its own; other columns are carried, whatever their names: a
column is replaced only by an added one whose name is given. An empty table gives no
rows. Very long texts are encoded whole, segment by segment.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.shared import chunks, fresh

#: Segments kept with their pieces in a Python worker, and the bytes of both.
CACHED = 300_000
CACHED_BYTES = 32 << 20
SPACE = "▁"

ENCODED = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("ends", T.ArrayType(T.IntegerType())),
    ]
)


def _fields(message: bytes):
    """(number, value) of the fields of a protocol buffer message."""

    def varint(at):
        value = shift = 0
        while True:
            value |= (message[at] & 0x7F) << shift
            shift, at = shift + 7, at + 1
            if message[at - 1] < 0x80:
                return value, at

    at = 0
    while at < len(message):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = (8, at) if kind == 1 else (4, at) if kind == 5 else varint(at)
            value, at = message[at : at + size], at + size
        yield key >> 3, value


class CharacterMap:
    """A compiled character map: a double-array trie over UTF-8, then the
    replacements, each ended by a zero byte. The layout is the format's."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.texts = blob[4 + size :]

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes matched, replacement) of the longest prefix of source[at:]."""
        units, found, node = self.units, None, 0
        if not units:
            return None
        node ^= _offset(units[0])
        for k in range(at, len(source)):
            node ^= source[k]
            if node >= len(units) or units[node] & 0x800000FF != source[k]:
                break
            leaf = units[node] >> 8 & 1
            node ^= _offset(units[node])
            if leaf:
                value = units[node] & 0x7FFFFFFF
                found = (k + 1 - at, self.texts[value : self.texts.index(0, value)])
        return found


def _offset(unit: int) -> int:
    return unit >> 10 << (unit >> 6 & 8)


class Model:
    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            spec = next((v for k, v in _fields(f.read()) if k == 3), b"")
        # Fields 2 to 5 of the normaliser: map, dummy prefix, extra spaces, escaping.
        said = dict(_fields(spec))
        self.map = CharacterMap(bytes(said.get(2, b"")))
        self.dummy, self.squeeze, escaped = (bool(said.get(k, 1)) for k in (3, 4, 5))
        pieces = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size())]
        if not escaped or any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("pieces of this model cross spaces")
        self.end = self.processor.eos_id()
        self.space = self.processor.piece_to_id(SPACE)
        #: Bytes of each piece in normalised text, a space as one; a byte piece has one.
        self.width = np.array(
            [1 if self.processor.is_byte(i) else len(p.replace(SPACE, " ").encode()) for i, p in enumerate(pieces)]
        )
        self.known: dict[str, bytes] = {}
        self.held = 0

    def normalized(self, text: str) -> tuple[str, np.ndarray | None]:
        """The text after the map and the treatment of spaces, with a dummy
        space; and for each of its bytes and its end the source byte, or None
        where only the dummy space was added."""
        if not self.map.units and not self.squeeze and SPACE not in text:
            return (" " if self.dummy and text else "") + text, None
        source = text.encode("utf-8", "replace")
        out, places, at = bytearray(), [], 0
        while at < len(source):
            found = self.map.longest(source, at)
            if found is None:
                lead = source[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                found = size, source[at : at + size]
            size, put = found
            put = put.replace(SPACE.encode(), b" ")
            out += put
            places += [at] * len(put)
            at += size
        places.append(len(source))
        if self.squeeze:
            keep = [k for k, c in enumerate(out) if c != 32 or (0 < k and out[k - 1] != 32)]
            if keep and out[keep[-1]] == 32:
                keep.pop()
            places = [places[k] for k in keep] + [places[keep[-1] + 1] if keep else len(source)]
            out = bytearray(out[k] for k in keep)
        if self.dummy and out:
            out[:0] = b" "
            places[:0] = [places[0]]
        return out.decode("utf-8", "replace"), np.array(places, np.int64)

    def segments(self, text: str) -> list[str]:
        """Normalised text cut before runs of spaces; the first space of a run is left out."""
        if not text:
            return []
        if text[0] == " " and "  " not in text:
            return text[1:].split(" ")
        return [s[1:] if s[0] == " " else s for s in _SEGMENT.findall(text)]

    def learn(self, segments: set[str]) -> None:
        """Ids of segments not known yet: with a space in front, as the library's
        dummy prefix puts it there, and without for a text that begins otherwise."""
        if len(self.known) > CACHED or self.held > CACHED_BYTES:
            self.known, self.held = {}, 0
        new = [s for s in segments if s not in self.known]
        if self.dummy:
            for s, ids in zip(new, self.processor.encode(new, num_threads=1), strict=True):
                self.known[s] = array("i", ids or [self.space]).tobytes()
        else:
            for s, ids in zip(new, self.processor.encode([" " + s for s in new], num_threads=1), strict=True):
                self.known[s] = array("i", ids).tobytes()
        self.held += sum(len(s) + len(self.known[s]) for s in new)

    def encode_all(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids with the end id, starts and ends of every text."""
        normal = [self.normalized(t) for t in texts]
        cut = [self.segments(plain) for plain, _ in normal]
        self.learn({s for segments in cut for s in segments})
        return [self._placed(t, n, s) for t, n, s in zip(texts, normal, cut, strict=True)]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.encode_all([text])[0]

    def _placed(self, text: str, normal: tuple[str, np.ndarray | None], segments: list[str]):
        plain, places = normal
        if plain and plain[0] != " ":  # without a dummy prefix the first segment has no space
            first = np.array(self.processor.encode(segments[0]), "<i4").tobytes()
            parts = [first, *map(self.known.__getitem__, segments[1:])]
        else:
            parts = map(self.known.__getitem__, segments)
        ids = np.frombuffer(b"".join(parts), "<i4")
        ends = np.cumsum(self.width[ids])
        starts = ends - self.width[ids]
        if places is None:
            shift = 1 if self.dummy and text else 0
            size = int(ends[-1]) - shift if len(ends) else 0
            starts, ends = np.maximum(starts - shift, 0), ends - shift
        else:
            starts, ends, size = places[starts], places[ends], int(places[-1])
        return tuple(np.append(x, v).astype(np.int32) for x, v in ((ids, self.end), (starts, size), (ends, size)))


_SEGMENT = re.compile(" +[^ ]*|^[^ ]+")


@lru_cache(maxsize=1)
def _model(path: str) -> Model:
    return Model(path)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    at = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32)))


def encode(docs: DataFrame, path: str, text: str = "text", out: str | None = None) -> DataFrame:
    """Adds a last column, a struct of ids (with the end id), starts and ends: `out`, which
    replaces one of that name, or else `encoded`, with underscores in front if docs has it."""
    out = out or fresh(docs, "encoded")[0]
    schema = T.StructType([*(f for f in docs.schema.fields if f.name != out), T.StructField(out, ENCODED)])
    kept = [f.name for f in docs.schema.fields if f.name != out]

    def run(batches):
        model = _model(path)
        for batch in chunks(batches):
            rows = model.encode_all([t or "" for t in batch.column(text).to_pylist()])
            arrays = [_lists([r[k] for r in rows]) for k in range(3)]
            pieces = pa.StructArray.from_arrays(arrays, names=["ids", "starts", "ends"])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pieces], schema.names)

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "encoded.ids", out: str | None = None) -> DataFrame:
    """Adds a last column, the text that the ids stand for, null where they are null: `out`,
    which replaces one of that name, or else `decoded`, with underscores in front if it is taken."""
    out = out or fresh(encoded, "decoded")[0]
    kept = [f for f in encoded.schema.fields if f.name != out]
    schema = T.StructType([*kept, T.StructField(out, T.StringType())])
    n = len(kept)
    (wanted,) = fresh(encoded, "_ids")
    df = encoded.withColumn(wanted, F.col(ids)).select(*(F.col(f"`{f.name}`") for f in kept), wanted)

    def run(batches):
        processor = _model(path).processor
        for batch in chunks(batches):
            texts = [None if x is None else processor.decode(x) for x in batch.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(texts, pa.string())], schema.names)

    return df.mapInArrow(run, schema)
