"""Offset-preserving SentencePiece encoding and decoding.

A model's normaliser is run here, not inside the library: at each place the
longest key of the compiled character map that the text continues with is
replaced by its value, and every normalised byte keeps the span of source bytes
that it came from.  The library's segmenter then sees text that is already
normalised (its own normaliser is switched off in a copy of the model), and each
piece it returns is projected through the alignment to a span of original UTF-8
bytes.  Decoding is the library's.

Null texts count as empty.  Whole texts are encoded, however long, one at a
time.  Models with user-defined symbols, which the library does not normalise, or with
white space as a suffix are refused.  Repeated rows come out as often as they went in, an empty table gives an
empty result, and columns that are not asked for are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import lean, short_batches

SPACE = "▁".encode()


class CharacterMap:
    """The compiled map of a normaliser: a double array of 32-bit units, then zero-ended values."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.values = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """(length of the longest key at ``at``, its value), or None."""
        if not self.units:
            return None
        found, node = None, 0
        step = lambda unit: (unit >> 10) << ((unit & (1 << 9)) >> 6)
        base = step(self.units[0])
        for end in range(at, len(text)):
            byte = text[end]
            node = base ^ byte
            if node >= len(self.units) or self.units[node] & 0x800000FF != byte:
                break
            unit = self.units[node]
            base = node ^ step(unit)
            if unit >> 8 & 1:
                found = end + 1 - at, self.units[base] & 0x7FFFFFFF
        if not found:
            return None
        start = found[1]
        return found[0], self.values[start : self.values.index(0, start)]


class Normaliser:
    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.trim, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def _mapped(self, text: bytes) -> Iterator[tuple[int, int, bytes]]:
        """(start, end, normalised bytes) of consecutive stretches of the source."""
        at = 0
        while at < len(text):
            hit = self.map.longest(text, at)
            if hit:
                end, value = at + hit[0], hit[1]
            else:
                first = text[at]
                end = at + (1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4)
                value = text[at:end]
            yield at, end, value
            at = end

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each of them and their end the source byte they begin at."""
        if not text:
            return b"", np.zeros(1, np.int64)
        space = SPACE if self.escape else b" "
        if not self.map.units and not self.trim:
            return self._plain(text, space)
        parts = list(self._mapped(text))
        if self.trim:
            blank = lambda part: part[2].strip(b" ") == b""
            while parts and blank(parts[0]):
                parts.pop(0)
            while parts and blank(parts[-1]):
                parts.pop()
        if not parts:
            return b"", np.full(1, len(text), np.int64)
        out, starts = bytearray(), []
        if self.prefix:
            out += space
            starts += [parts[0][0]] * len(space)
        gap = self.trim
        for start, _, value in parts:
            for k in range(len(value)):
                one = value[k : k + 1]
                if one == b" ":
                    if gap and self.trim and (not out or out.endswith(space)):
                        continue
                    one = space
                gap = self.trim
                out += one
                starts += [start] * len(one)
        while self.trim and out.endswith(space) and len(out) > len(space):
            del out[-len(space) :], starts[-len(space) :]
        starts.append(parts[-1][1])
        return bytes(out), np.array(starts, np.int64)

    def _plain(self, text: bytes, space: bytes) -> tuple[bytes, np.ndarray]:
        """Without a map or trimming, only spaces change their length."""
        source = np.frombuffer(text, np.uint8)
        widths = np.where(source == 32, len(space), 1)
        starts = np.repeat(np.arange(len(text)), widths)
        # The bytes of one character all begin where the character does.
        inner = (source & 0xC0) == 0x80
        head = np.maximum.accumulate(np.where(inner, 0, np.arange(len(text))))
        lead = np.zeros(len(space) if self.prefix else 0, np.int64)
        out = (space if self.prefix else b"") + text.replace(b" ", space)
        return out, np.concatenate((lead, head[starts], [len(text)]))


class Encoder:
    """One model: ids, spans and decoded text of a text."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        if proto.trainer_spec.treat_whitespace_as_suffix or any(p.type == 4 for p in proto.pieces):
            raise ValueError("models with symbols that are never normalised, or with white space as a suffix, are not encoded here")
        self.normalise = Normaliser(proto.normalizer_spec)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        spec = proto.normalizer_spec
        spec.name, spec.precompiled_charsmap = "identity", b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.segment = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        kinds = [p.type for p in proto.pieces]
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        #: Bytes of normalised text that a piece covers; 0 where that is not fixed (unknown).
        self.width = np.array([1 if k == 6 else 0 if k == 2 else len(p.piece.encode()) for p, k in zip(proto.pieces, kinds)], np.int64)

    def ids(self, text: str) -> list[int]:
        """All ids of the whole text, with begin and end."""
        return self.encode(text)[0]

    def encode(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
        """ids with begin and end, and the source byte at which each begins and ends (both the same for begin and end)."""
        normal, starts = self.normalise(text.encode("utf-8", "surrogatepass"))
        found = self.segment.encode(normal.decode("utf-8", "replace"), num_threads=1)
        widths = self.width[found]
        if (widths == 0).any() or widths.sum() != len(normal):
            pieces = self.segment.encode(normal.decode("utf-8", "replace"), return_type="proto").pieces
            widths = np.array([len(p.surface.encode()) for p in pieces], np.int64)
        edges = starts[np.concatenate(([0], np.cumsum(widths))).astype(np.int64)]
        last = starts[-1:]
        return [self.begin, *found, self.end], np.concatenate(([0], edges[:-1], last)), np.concatenate(([0], edges[1:], last))

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(maxsize=2)
def encoder(model: bytes) -> Encoder:
    return Encoder(model)


def encode_documents(docs: DataFrame, model: bytes, *, doc_id: str = "doc_id", text: str = "text", spans: bool = False) -> DataFrame:
    """doc_id, ids array<int>, decoded string, and with ``spans`` begins and ends array<long>: one row per row of ``docs``."""
    short_batches(docs.sparkSession)
    schema = "doc_id long, ids array<int>, decoded string" + ", begins array<long>, ends array<long>" * spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for batch in batches:
            out = [own.encode(t.as_py() or "") for t in batch.column(1)]
            columns = [batch.column(0).cast(pa.int64()), pa.array([x[0] for x in out], pa.list_(pa.int32())), pa.array([own.decode(x[0]) for x in out], pa.string())]
            if spans:
                columns += [pa.array([x[k] for x in out], pa.list_(pa.int64())) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(lean(run), schema)


def digests(docs: DataFrame, model: bytes, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and whether the spans tile the text."""
    short_batches(docs.sparkSession)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, tiled boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text_ = value.as_py() or ""
                ids, begins, ends = own.encode(text_)
                packed = np.array(ids, "<u4").tobytes()
                tiled = bool(begins[0] == 0 and np.array_equal(begins[2:], ends[1:-1]))
                rows.append((len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(own.decode(ids).encode("utf-8", "surrogatepass")).hexdigest(), tiled))
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            kinds = (pa.int64(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))], [x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(lean(run), schema)
