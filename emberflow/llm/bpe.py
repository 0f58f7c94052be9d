"""Byte-level BPE encoding and decoding (operator 2).

The merges come from a file of ranks (base64 token, rank). Every byte is shown
as a character of its own: visible Latin-1 bytes as themselves, the others as
characters from 256 on; a tokenizers BPE model over these characters merges any
two neighbours whose joint bytes have a rank, lowest rank first. A text is cut
by the splitting pattern and each match is encoded by itself. Each task keeps
the ids of the matches it has met (``CACHE`` at most, then it starts anew) and
lays out the ids of a range of texts by array operations.

``encode`` gives ids and, if asked, every token's character offsets: a token
that holds part of a character covers the whole character, as its neighbour
does. ``decode`` gives the bytes, and the text with U+FFFD where ids cut a
character and the rest is missing.

Defined cases: null text = empty, which has no ids; special tokens' strings are
ordinary text; an id without a token raises an error; null ids = no ids; further
columns stay as they are (one called like an added column gets ``_in`` behind its
name); an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import common, textbytes

CACHE = 400_000


def byte_characters() -> list[str]:
    """The character that shows each byte."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in set(visible)]
    return [chr(b) if b in set(visible) else chr(256 + hidden.index(b)) for b in range(256)]


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer, models

        ranks = read_ranks(path)
        shown = byte_characters()
        self._table = {b: c for b, c in enumerate(shown)}  # Latin-1 character -> shown character
        name = {token: "".join(shown[b] for b in token) for token in ranks}
        merges = [(name[token[:i]], name[token[i:]])
                  for token in sorted(ranks, key=ranks.get) for i in range(1, len(token))
                  if token[:i] in ranks and token[i:] in ranks]
        self._model = Tokenizer(models.BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges, cache_capacity=0))
        self._split = regex.compile(pattern).findall
        byte_of = {c: b for b, c in enumerate(shown)}
        size = max(ranks.values()) + 1
        parts: list[bytes] = [b""] * size
        for token, rank in ranks.items():
            parts[rank] = bytes(byte_of[c] for c in name[token])
        self.known = np.zeros(size, bool)
        self.known[list(ranks.values())] = True
        self.lengths = np.array([len(p) for p in parts], np.int64)
        self._from = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self._bytes = np.frombuffer(b"".join(parts), np.uint8)
        self._reset()

    def _reset(self) -> None:
        self._at: dict[str, int] = {}
        self._ids, self._start, self._count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, pieces: set[str]) -> None:
        fresh = [p for p in pieces if p not in self._at]
        if not fresh:
            return
        found = [e.ids for e in self._model.encode_batch([p.encode().decode("latin-1").translate(self._table) for p in fresh], add_special_tokens=False)]
        count = np.array([len(i) for i in found], np.int64)
        start = len(self._ids) + np.cumsum(count) - count
        self._at.update(zip(fresh, range(len(self._at), len(self._at) + len(fresh))))
        self._ids = np.concatenate([self._ids, np.array([i for ids in found for i in ids], np.int32)])
        self._start, self._count = np.concatenate([self._start, start]), np.concatenate([self._count, count])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the texts' offsets among them."""
        split = [self._split(t) for t in texts]
        if len(self._at) > CACHE:
            self._reset()
        self._learn({p for pieces in split for p in pieces})
        where = np.fromiter((self._at[p] for pieces in split for p in pieces), np.int64)
        count = self._count[where]
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self._ids[np.repeat(self._start[where] - total[:-1], count) + np.arange(total[-1])]
        return ids, total[np.concatenate([[0], np.cumsum([len(p) for p in split], dtype=np.int64)])]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of ids, and the ids' offsets among them."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id has no token")
        count = self.lengths[ids]
        total = np.concatenate([[0], np.cumsum(count)])
        return self._bytes[np.repeat(self._from[ids] - total[:-1], count) + np.arange(total[-1])], total


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _offsets(coder: Codec, ids: np.ndarray, cuts: np.ndarray, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and the one after the last, in its text, of every token."""
    ends = np.cumsum(coder.lengths[ids])
    starts = ends - coder.lengths[ids]
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    first = np.concatenate([character, [character[-1] + 1 if len(character) else 0]])[offs[:-1]]
    base = np.repeat(first, np.diff(cuts))
    return character[starts] - base, character[ends - 1] + 1 - base


def encode(df: DataFrame, path: str, pattern: str, column: str = "text", offsets: bool = True) -> DataFrame:
    """``df`` with ``ids``, and with ``starts`` and ``ends`` if ``offsets``, in place of ``column``."""
    added = ("ids", "starts", "ends")[:3 if offsets else 1]
    return common.shielded(df, (column,), added, lambda d: _encode(d, path, pattern, column, offsets))


def _encode(df: DataFrame, path: str, pattern: str, column: str, offsets: bool) -> DataFrame:
    kept = [c for c in df.columns if c != column]
    shape = T.StructType([df.schema[c] for c in kept] + [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ["ids", "starts", "ends"][:3 if offsets else 1]])

    def lists(cuts, values):
        return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values.astype(np.int32)))

    def emit(batches):
        coder = codec(path, pattern)
        for batch in batches:
            text = batch.column(batch.schema.get_field_index(column))
            data, offs = textbytes.text_buffer(text)
            for i, j in textbytes.chunks(offs):
                ids, cuts = coder.encode([t or "" for t in text.slice(i, j - i).to_pylist()])
                out = [lists(cuts, ids)]
                if offsets:
                    out += [lists(cuts, x) for x in _offsets(coder, ids, cuts, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])]
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)).slice(i, j - i) for c in kept), *out], names=shape.names)

    return df.mapInArrow(emit, shape)


def decode(df: DataFrame, path: str, pattern: str, column: str = "ids", text: bool = True) -> DataFrame:
    """``df`` with ``decoded`` (the bytes of ``column``), and with ``text`` of them if asked."""
    return common.shielded(df, (column,), ("decoded", "text")[:1 + text], lambda d: _decode(d, path, pattern, column, text))


def _decode(df: DataFrame, path: str, pattern: str, column: str, text: bool) -> DataFrame:
    columns = df.columns
    shape = T.StructType([*df.schema.fields, T.StructField("decoded", T.BinaryType())] + [T.StructField("text", T.StringType())] * text)

    def emit(batches):
        coder = codec(path, pattern)
        for batch in batches:
            ids = batch.column(columns.index(column))
            cuts = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy())])
            flat = ids.flatten()
            if flat.null_count:
                raise ValueError("an id is null")
            for i in range(0, batch.num_rows, 256):
                j = min(i + 256, batch.num_rows)
                data, at = coder.decode(flat.slice(cuts[i], cuts[j] - cuts[i]).to_numpy().astype(np.int64))
                ends = at[cuts[i:j + 1] - cuts[i]]
                raw = data.tobytes()
                parts = [raw[a:b] for a, b in zip(ends, ends[1:])]
                out = [pa.array(parts, pa.binary())]
                if text:
                    out.append(pa.array([p.decode("utf-8", "replace") for p in parts], pa.string()))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns), *out], names=shape.names)

    return df.mapInArrow(emit, shape)
