"""Offset-preserving encoding with a sentencepiece model, and decoding.

A text is normalised here: at each place the longest key of the model's compiled
character map (or a user-defined piece) that the rest begins with is replaced, spaces
become the model's space mark, and each byte of the result remembers the byte of the
source its key began at.  The normalised text is cut by the library with its own
normalisation switched off, and every piece is projected through the remembered
places to the bytes of the original text it came from.

The map is the model's own double-array trie; without one each character stands for
itself, which is done for whole texts at once.

No shuffle: documents go through in slices of bounded size.

Defined results: null and empty texts give the end id alone.  Repeated rows and ids give
equal rows; a null id stays null.  Texts of any length are encoded whole, a text longer
than a slice is one slice (about 60 bytes of memory per byte of it).  Other columns of
the input are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyard.llm.byte_words import map_batches, slices, texts
from partyard.llm.common import column

MODEL = "piece_bpe_32k.model"
MARK = "▁".encode()

Aligned = tuple[bytes, np.ndarray]


class CharacterMap:
    """Longest keys of a compiled map: trie units of 32 bits, then texts that end in a zero byte."""

    def __init__(self, compiled: bytes) -> None:
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self.texts = compiled[4 + size :]

    @staticmethod
    def _jump(unit: int) -> int:
        """Distance from a node to its children; a flag says that it is in units of 256."""
        return unit >> 10 << (8 if unit & 0x200 else 0)

    def longest(self, text: bytes, start: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key at ``start``."""
        units, found = self.units, None
        node = self._jump(units[0])
        for place in range(start, len(text)):
            node ^= text[place]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != text[place]:
                break
            node ^= self._jump(unit)
            if unit & 0x100:
                found = place + 1 - start, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        length, at = found
        return length, self.texts[at : self.texts.index(b"\0", at)]


class Normalizer:
    """A text as the model sees it, and for each byte of it the place in the source.

    One more place than bytes: the last is where the source is used up.  Blanks that the
    model drops belong to the piece before them; those at the start to none.
    """

    def __init__(self, spec, kept: list[bytes] = (), suffix: bool = False) -> None:
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.space = MARK if spec.escape_whitespaces else b" "
        self.dummy, self.squeeze, self.suffix = spec.add_dummy_prefix, spec.remove_extra_whitespaces, suffix
        self.kept = set(kept)
        self.kept_lengths = sorted({len(k) for k in kept}, reverse=True)

    def __call__(self, text: bytes) -> Aligned:
        if not text:
            return b"", np.zeros(1, np.int64)
        plain = self.map is None and not self.kept and not self.squeeze
        found, places, lead = self._plain(text) if plain else self._mapped(text)
        if self.dummy and (plain or len(found)):
            extra = len(self.space)
            if self.suffix:
                found, places = found + self.space, np.append(places, np.full(extra, places[-1]))
            else:
                found, places = self.space + found, np.append(np.full(extra, lead), places)
        return found, places

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray, int]:
        """Every character for itself."""
        width = np.where(np.frombuffer(text, np.uint8) == 0x20, len(self.space), 1)
        return text.replace(b" ", self.space), np.append(np.repeat(np.arange(len(text)), width), len(text)), 0

    def _prefix(self, text: bytes, start: int) -> tuple[int, bytes]:
        """Length and replacement of what is taken from the source next."""
        for length in self.kept_lengths:
            if text[start : start + length] in self.kept:
                return length, text[start : start + length]
        if self.map is not None and (found := self.map.longest(text, start)):
            return found
        lead = text[start]
        length = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return length, text[start : start + length]

    def _mapped(self, text: bytes) -> tuple[bytes, np.ndarray, int]:
        """Result, places, and the place behind the blanks that are dropped at the start."""
        out, places, start = bytearray(), [], 0
        after_space, lead = self.squeeze, None
        while start < len(text):
            length, new = self._prefix(text, start)
            if lead is None and not (self.squeeze and new == b" "):
                lead = start
            if after_space:
                new = new.lstrip(b" ")
            if new:
                shown = new.replace(b" ", self.space)
                out += shown
                same = shown == text[start : start + length]
                places += range(start, start + length) if same else [start] * len(shown)
                after_space = self.squeeze and new.endswith(b" ")
            start += length
        used = start
        while self.squeeze and out.endswith(self.space):
            del out[-len(self.space) :]
            used = places[len(out)]
            del places[len(out) :]
        return bytes(out), np.array([*places, used], np.int64), lead or 0


class Codec:
    """Encoder and decoder of one model."""

    def __init__(self, model: bytes, end: bool = True) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        kinds = proto.SentencePiece
        self.normalize = Normalizer(
            proto.normalizer_spec,
            [p.piece.encode() for p in proto.pieces if p.type == kinds.USER_DEFINED],
            proto.trainer_spec.treat_whitespace_as_suffix,
        )
        self.widths = np.array([1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in proto.pieces])
        self.unknown = proto.trainer_spec.unk_id
        self.decoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.end = [self.decoder.eos_id()] if end else []
        proto.normalizer_spec.Clear()
        proto.normalizer_spec.name = "identity"
        proto.normalizer_spec.add_dummy_prefix = False
        proto.normalizer_spec.remove_extra_whitespaces = False
        proto.normalizer_spec.escape_whitespaces = False
        self.cutter = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())

    def _widths(self, ids: np.ndarray, normalised: str) -> np.ndarray:
        """Bytes of the normalised text under every piece; unknown ones are as long as what they stand for."""
        if not (ids == self.unknown).any():
            return self.widths[ids]
        pieces = self.cutter.encode(normalised, return_type="proto").pieces
        return np.array([len(p.surface.encode()) for p in pieces], np.int64)

    def encode(self, found: list[bytes | None]) -> list[tuple[list[int], np.ndarray]]:
        """Ids of every text, and the byte each piece begins at with the end of the last one.

        Piece k covers the bytes from place k to place k + 1 of the source; none, where it
        shares a replaced key with the piece before it, and for the end id.
        """
        aligned = [self.normalize(t or b"") for t in found]
        shown = [a.decode() for a, _ in aligned]
        out = []
        for ids, (_, places), text in zip(self.cutter.encode(shown, num_threads=1), aligned, shown, strict=True):
            widths = self._widths(np.array(ids, np.int64), text)
            ends = np.cumsum(widths)
            if (ends[-1] if len(ends) else 0) != len(places) - 1:
                raise ValueError("pieces do not cover the normalised text")
            bounds = places[np.concatenate([[0], ends]).astype(np.int64)]
            out.append((ids + self.end, np.append(bounds, bounds[-1:].repeat(len(self.end)))))
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.decoder.decode(ids, num_threads=1) if ids else []


@lru_cache(maxsize=2)
def _codec(model: bytes, end: bool) -> Codec:
    return Codec(model, end)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, *, path: str | None = None, end: bool = True) -> DataFrame:
    """Every document's ids, the bounds of its pieces in bytes of its text, and the decoded text.

    ``ids`` has one number per piece and ``bounds`` one more.  The model file (bounded:
    it is one tokenizer) is read on the driver and broadcast.
    """
    model = Path(path or model_path()).read_bytes()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        codec = _codec(shared.value, end)
        for batch in batches:
            for part in slices(batch, "text"):
                encoded = codec.encode(texts(part, "text"))
                yield {
                    "doc_id": part.column("doc_id"),
                    "ids": _lists([np.array(ids, np.int32) for ids, _ in encoded], pa.int32()),
                    "bounds": _lists([bounds for _, bounds in encoded], pa.int64()),
                    "decoded": codec.decode([ids for ids, _ in encoded]),
                }

    read = docs.select(column(docs, "doc_id", "long"), column(docs, "text", "string"))
    return map_batches(read, "doc_id long, ids array<int>, bounds array<long>, decoded string", run)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Rows of numbers as one Arrow list column, without an object per number."""
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate(rows), kind))


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and digests of encoded documents."""
    ids = F.array_join(F.transform("ids", lambda k: k.cast("string")), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.element_at("bounds", -1).alias("n_bytes"),
    )
