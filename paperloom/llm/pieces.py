"""SentencePiece encoding with the source bytes of every piece, and decoding.

The ids are the library's. For the spans, a text is normalised here: at each
position the longest prefix known to the model's compiled character map is
replaced, everything else stays, and every normalised byte remembers the bytes
of the source it came from. Pieces tile the normalised text, so their lengths
give their place in it, and the alignment carries that back to the source.
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
from pyspark.sql import types as T

from paperloom.llm.rows import append_columns

SPACE = "▁".encode()  # fixed value: the library's mark of a space

ENCODED = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("ends", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
    ]
)


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of one protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, message[at : at + size]
            at += size


class CharMap:
    """The compiled map of a normaliser: a double-array trie of byte strings.

    The map holds the size of the trie, its 32-bit units, and the replacements,
    each ended by a zero byte; the value of a key is a place in these.
    """

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.replacements = blob[4 + size :]
        # first bytes of keys: the root's children carry them as labels
        self.first = bytes(b for b in range(256) if self.units and self._child(self._offset(self.units[0]), b))

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _child(self, at: int, byte: int) -> int | None:
        place = at ^ byte
        return place if place < len(self.units) and self.units[place] & 0x800000FF == byte else None

    def longest(self, text: bytes, start: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that begins at ``start``."""
        found, at = None, self._offset(self.units[0])
        for i in range(start, len(text)):
            place = self._child(at, text[i])
            if place is None:
                break
            unit = self.units[place]
            at = place ^ self._offset(unit)
            if unit & 0x100:  # has a value, in the unit at its own offset
                found = i + 1 - start, self.units[at] & 0x7FFFFFFF
        if found is None:
            return None
        end = self.replacements.index(b"\0", found[1])
        return found[0], self.replacements[found[1] : end]


class Normaliser:
    """A model's normalisation that keeps track of where bytes come from."""

    def __init__(self, proto: bytes):
        spec, trainer, self.own_symbols = b"", b"", False
        for number, value in _fields(proto):
            if number == 1:
                self.own_symbols |= dict(_fields(value)).get(3, 1) == 4  # the kind of a user-defined piece
            elif number == 3:
                spec = value
            elif number == 2:
                trainer = value
        given = dict(_fields(spec))
        self.charmap = CharMap(given.get(2, b""))
        self.dummy_prefix = bool(given.get(3, 1))
        self.trim = bool(given.get(4, 1))
        self.escape = bool(given.get(5, 1))
        self.suffix = bool(dict(_fields(trainer)).get(24, 0))

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Normalised bytes, and the first and last + 1 source byte of each."""
        out, low, high = self._mapped(text)
        mark = SPACE if self.escape else b" "
        if self.trim:  # no blanks at the ends, single ones inside
            flat = np.frombuffer(out, np.uint8)
            blank = flat == 32
            again = blank & np.r_[True, blank[:-1]] if len(flat) else blank
            keep = ~again
            if len(flat) and blank[-1]:
                last = np.flatnonzero(~blank)
                keep[last[-1] + 1 if len(last) else 0 :] = False
            out, low, high = flat[keep].tobytes(), low[keep], high[keep]
        if out and self.dummy_prefix:
            if self.suffix:
                out, low, high = out + b" ", np.r_[low, len(text)], np.r_[high, len(text)]
            else:
                out, low, high = b" " + out, np.r_[low[0], low], np.r_[low[0], high]
        if self.escape and b" " in out:
            times = np.where(np.frombuffer(out, np.uint8) == 32, len(mark), 1)
            out, low, high = out.replace(b" ", mark), np.repeat(low, times), np.repeat(high, times)
        return out, low, high

    def _mapped(self, text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        n = len(text)
        if not self.charmap.first:
            return text, np.arange(n), np.arange(1, n + 1)
        flat = np.frombuffer(text, np.uint8)
        maybe = np.flatnonzero(np.isin(flat, np.frombuffer(self.charmap.first, np.uint8)) & (flat & 0xC0 != 0x80))
        parts, low, high, done = [], [], [], 0
        for start in maybe.tolist():
            if start < done:
                continue
            hit = self.charmap.longest(text, start)
            if hit is None:
                continue
            parts += [text[done:start], hit[1]]
            low += [np.arange(done, start), np.full(len(hit[1]), start)]
            high += [np.arange(done + 1, start + 1), np.full(len(hit[1]), start + hit[0])]
            done = start + hit[0]
        parts.append(text[done:])
        low.append(np.arange(done, n))
        high.append(np.arange(done + 1, n + 1))
        return b"".join(parts), np.concatenate(low), np.concatenate(high)


class Encoder:
    """One task's model: ids, spans and decoded text of whole texts."""

    def __init__(self, model: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        self.normalise = Normaliser(self.library.serialized_model_proto())
        size = self.library.get_piece_size()
        kinds = [(i, self.library.id_to_piece(i).encode()) for i in range(size)]
        hidden = [self.library.is_control(i) for i in range(size)]
        # bytes each piece takes of the normalised text
        self.length = np.array([0 if hidden[i] else 1 if self.library.is_byte(i) else len(p) for i, p in kinds], np.int64)
        self.unknown = self.library.unk_id()
        if self.normalise.own_symbols:
            raise ValueError("the model has symbols of its user's own, which no normalisation touches; their spans are not known here")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(i, np.int32) for i in self.library.encode(texts, add_bos=True, add_eos=True, enable_sampling=False, num_threads=1)]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.library.decode([i.tolist() for i in ids], num_threads=1)

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 source byte of each piece, in UTF-8.

        Begin and end ids get empty spans at the ends of the text, a mark that
        stands for no source byte an empty one where it was put.
        """
        source = text.encode()
        normal, low, high = self.normalise(source)
        length = self.length[ids]
        if (ids == self.unknown).any():
            length = self._surfaces(text, ids, length)
        ends = np.cumsum(length)
        if len(ends) and ends[-1] != len(normal):
            raise ValueError("pieces do not tile the normalised text")
        starts = ends - length
        low, high = np.r_[low, len(source)], np.r_[0, high]
        first = low[np.minimum(starts, len(normal))]
        return first, np.maximum(np.where(length > 0, high[ends], first), first)

    def _surfaces(self, text: str, ids: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Lengths where unknown pieces stand for whatever the text holds there."""
        pieces = self.library.encode(text, out_type="immutable_proto").pieces
        inner = np.array([len(p.piece.encode()) if p.id == self.unknown else self.length[p.id] for p in pieces], np.int64)
        out = length.copy()
        out[1 : 1 + len(inner)] = inner
        return out


@lru_cache(maxsize=2)
def _encoder(model: str) -> Encoder:
    return Encoder(model)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(a) for a in arrays])].astype(np.int32)
    values = np.concatenate(arrays).astype(np.int32) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _work(model: str, digest: bool):
    def make():
        encoder = _encoder(model)

        def work(values: pa.Array) -> list:
            texts = [t or "" for t in values.to_pylist()]
            ids, decoded, spans = [], [], []
            for start in range(0, len(texts), 64):  # bounds what is held beside the batch
                block = texts[start : start + 64]
                made = encoder.encode(block)
                back = encoder.decode(made)
                placed = [encoder.spans(t, i) for t, i in zip(block, made)]
                if digest:
                    ids += [(len(i), hashlib.sha256(i.astype("<u4").tobytes()).hexdigest()) for i in made]
                    decoded += [hashlib.sha256(t.encode()).hexdigest() for t in back]
                    spans += [hashlib.sha256(np.stack(s).astype("<u4").tobytes()).hexdigest() for s in placed]
                else:
                    ids += made
                    decoded += back
                    spans += placed
            if digest:
                return [[n for n, _ in ids], [h for _, h in ids], decoded, spans]
            return [_lists(ids), _lists([s for s, _ in spans]), _lists([e for _, e in spans]), decoded]

        return work

    return make


def encode_pieces(docs: DataFrame, model: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``ids, starts, ends, decoded``.

    ``model`` is a path that every executor has. ``ids`` hold the begin and end
    ids; ``starts`` and ``ends`` are bytes of the UTF-8 source, end exclusive.
    A null text counts as empty: begin and end ids only. Texts of any length
    are encoded whole; each row stands for itself, so ties, repeated rows and
    empty tables need no care. New columns replace those of the same name.
    """
    return append_columns(docs, text, _work(model, False), ENCODED, keep)


DIGESTS = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
        T.StructField("spans_sha256", T.StringType()),
    ]
)


def digest_pieces(docs: DataFrame, model: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """As ``encode_pieces``, with digests in place of ids, spans and decoded texts.

    ``spans_sha256`` is over all starts, then all ends, as little-endian
    unsigned 32-bit integers, like the ids.
    """
    return append_columns(docs, text, _work(model, True), DIGESTS, keep)


def restore_spans(encoded: DataFrame, text: str = "text") -> DataFrame:
    """``encoded`` with ``pieces``: the source bytes of every piece."""
    whole = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    cut = F.transform(F.arrays_zip("starts", "ends"), lambda s: F.substring(whole, s["starts"] + 1, s["ends"] - s["starts"]))
    return encoded.withColumn("pieces", cut)
