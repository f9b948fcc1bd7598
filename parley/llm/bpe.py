"""Byte-level BPE by tree reduction.

A piece (one match of the splitting pattern) is encoded by halves, and the two encodings are joined: the
bytes of a window of tokens around the seam are encoded again, and the window grows until its first and
last token come out unchanged (or the window reaches the end of the piece).

Why the rest is then final: call two neighbouring tokens settled if their bytes, encoded alone, give
just these two. Merging takes the pair of lowest rank, leftmost first, so inside any stretch that no
merge leaves, it acts as if the stretch were alone. Hence neighbours in an encoding are settled; and
tokens of which all neighbours are settled are the encoding, as the first merge across a token border
would also happen when just the two tokens beside it are encoded. After a join every pair of neighbours
lies in the left encoding, the window or the right encoding.
"""

from __future__ import annotations

import base64
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parley.llm.common import slices, with_columns, without

LEAF_BYTES = 32
SLICE_ROWS = 256
#: Encodings kept per worker; with this many the cache starts anew. Long pieces are never kept.
CACHED_PIECES, CACHED_CHARS = 400_000, 48
#: Characters below this place are told apart by a faster pattern with the same classes spelled out.
PLAIN_BELOW = 0x250
LEAF_IDS = 4096


def ranks_of(path: str) -> dict[bytes, int]:
    """The rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Pieces:
    """Splits text by a pattern as the rank file's library does; white space is Unicode's property."""

    def __init__(self, pattern: str):
        space = r"\p{White_Space}"
        inner = pattern.replace(r"[^\s", f"[^{space}").replace(r"\S", f"[^{space}]")
        self.any = regex.compile(inner.replace(r"\s", space))
        self.plain = re.compile(self._spelled_out(pattern))

    @staticmethod
    def _spelled_out(pattern: str) -> str:
        def ranges(kind: str) -> str:
            chars = [chr(c) for c in range(PLAIN_BELOW) if unicodedata.category(chr(c))[0] == kind]
            return "".join(re.escape(c) for c in chars)

        space = r"\t-\r \x85\xa0"
        inside = {r"\p{L}": ranges("L"), r"\p{N}": ranges("N"), r"\s": space}
        negated = "[^" + inside[r"\s"] + inside[r"\p{L}"] + inside[r"\p{N}"] + "]"
        out = pattern.replace(r"[^\s\p{L}\p{N}]", negated).replace(r"\S", f"[^{space}]")
        for name, chars in inside.items():
            out = out.replace(name, f"[{chars}]")
        return out

    def split(self, text: str) -> list[str]:
        if text.isascii() or ord(max(text)) < PLAIN_BELOW:
            return self.plain.findall(text)
        return self.any.findall(text)


class Encoder(dict):
    """A worker's cache from a piece of text to its packed token ids (little-endian, 32 bits each)."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        self.ranks = ranks_of(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pieces = Pieces(pattern)

    def __missing__(self, piece: str) -> bytes:
        ids = self.piece(piece.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pieces.split(text)))

    def piece(self, data: bytes) -> list[int]:
        known = self.ranks.get(data)  # a piece that is a token is taken whole, whatever its merges
        return [known] if known is not None else [self.ranks[t] for t in self.tree(data)]

    def tree(self, data: bytes) -> list[bytes]:
        """Tokens of ``data`` as bytes. The cut is at a power of two, so that runs fall into line."""
        if len(data) <= LEAF_BYTES:
            return self.merged([data[i : i + 1] for i in range(len(data))])
        cut = 1 << ((len(data) - 1).bit_length() - 1)
        return self.join(self.tree(data[:cut]), self.tree(data[cut:]))

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        width = 1
        while True:
            a, b = left[-width:], right[:width]
            window = b"".join(a) + b"".join(b)
            fresh = self.merged([window[i : i + 1] for i in range(len(window))])
            starts = len(a) == len(left) or fresh[0] == a[0]
            ends = len(b) == len(right) or fresh[-1] == b[-1]
            if starts and ends:
                return left[: len(left) - len(a)] + fresh + right[len(b) :]
            width *= 2

    def merged(self, parts: list[bytes]) -> list[bytes]:
        """Merges the pair of lowest rank, leftmost first, until no pair is a token."""
        if len(parts) > 4 * LEAF_BYTES:
            return self._merged_by_heap(parts)
        get = self.ranks.get
        pairs = [get(a + b, 1 << 40) for a, b in zip(parts, parts[1:])]
        while pairs:
            low = min(pairs)
            if low == 1 << 40:
                break
            i = pairs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], 1 << 40)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], 1 << 40)
        return parts

    def _merged_by_heap(self, parts: list[bytes]) -> list[bytes]:
        """The same in n log n steps: pairs wait in a heap by rank and place."""
        n, get = len(parts), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [
            (r, i, parts[i], parts[i + 1])
            for i in range(n - 1)
            if (r := get(parts[i] + parts[i + 1])) is not None
        ]
        heapify(heap)
        while heap:
            _, i, a, b = heappop(heap)
            j = after[i]
            if parts[i] is not a or j >= n or parts[j] is not b:
                continue  # one of the two has grown or gone
            parts[i], parts[j], after[i] = a + b, b"", after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := get(parts[i] + parts[after[i]])) is not None:
                    heappush(heap, (r, i, parts[i], parts[after[i]]))
            if (h := before[i]) >= 0 and (r := get(parts[h] + parts[i])) is not None:
                heappush(heap, (r, h, parts[h], parts[i]))
        return [p for p in parts if p]

    def decode(self, packed: bytes) -> bytes:
        """The bytes of packed ids: leaves are looked up, neighbours concatenated up the tree."""
        ids = memoryview(packed).cast("I")
        level = [
            b"".join(map(self.tokens.__getitem__, ids[i : i + LEAF_IDS]))
            for i in range(0, len(ids), LEAF_IDS)
        ]
        while len(level) > 1:
            level = [b"".join(level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0] if level else b""


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``token_ids`` (packed little-endian 32-bit ids).

    Whole texts are encoded, each match of ``pattern`` by itself, without special tokens. Null text is
    encoded as the empty one: no ids. Rows, repeated or not, stay as they are; columns named like the
    results are replaced. ``path`` names a rank file that every worker can read.
    """
    docs = without(docs, "n_tokens", "token_ids")
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", T.BinaryType())]
    schema = T.StructType([*docs.schema.fields, *added])
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in slices(batches, SLICE_ROWS):
            packed = [own.encode(t) if t else b"" for t in batch.column(place).to_pylist()]
            yield with_columns(
                batch,
                n_tokens=pa.array([len(p) // 4 for p in packed], pa.int64()),
                token_ids=pa.array(packed, pa.binary()),
            )

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "token_ids") -> DataFrame:
    """``docs`` with ``decoded``, the bytes that packed ids stand for; null ids give no bytes."""
    docs = without(docs, "decoded")
    schema = T.StructType([*docs.schema.fields, T.StructField("decoded", T.BinaryType())])
    place = docs.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in slices(batches, SLICE_ROWS):
            plain = [own.decode(p) if p else b"" for p in batch.column(place).to_pylist()]
            yield with_columns(batch, decoded=pa.array(plain, pa.binary()))

    return docs.mapInArrow(run, schema)
