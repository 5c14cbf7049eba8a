"""Byte-level BPE encoding and decoding with numpy matrices.

Distinct pre-tokens are encoded together. They are bucketed by length and laid out as the rows of a
padded matrix of token ids, with the ranks of all neighbouring pairs beside it. In every round each
row merges its leftmost pair of least rank: the row closes up by one column and only the two pairs
beside the merged one are looked up anew, in a hash table of (left id, right id). Rows without a
known pair are finished and leave the matrix. Pre-tokens of more than LONGEST bytes are
merged one by one with a heap instead, with the same result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoregrid.llm.common import ready
from shoregrid.llm.tokens import CACHED_PIECES, Encoder

LONGEST = 256
NONE = np.int32(2**31 - 1)


class PairTable:
    """(left id, right id) -> rank of the joined token: open addressing in numpy arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> None:
        self.bits = max(4, int(len(rank) * 4 - 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = self._slot(keys)
        todo = np.arange(len(keys))
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = todo[self.keys[at[todo]] == -1]
            first = free[np.unique(at[free], return_index=True)[1]]
            self.keys[at[first]], self.ranks[at[first]] = keys[first], rank[first]
            todo = todo[self.keys[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, NONE for unknown pairs and for padding (-1)."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        at = self._slot(keys)
        found = np.full(keys.shape, NONE, np.int32)
        todo = np.nonzero((left >= 0) & (right >= 0))[0]
        for _ in range(self.probes):
            held = self.keys[at[todo]]
            hit = held == keys[todo]
            found[todo[hit]] = self.ranks[at[todo[hit]]]
            todo = todo[~hit & (held != -1)]
            if not len(todo):
                break
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
        return found


class Vocabulary:
    """The tokens of a rank file; a token's rank is its id."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as file:
            pairs = (line.split() for line in file if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        splits = [
            (self.ranks[t[:k]], self.ranks[t[k:]], r)
            for t, r in self.ranks.items()
            for k in range(1, len(t))
            if t[:k] in self.ranks and t[k:] in self.ranks
        ]
        self.table = PairTable(*np.array(splits or [(0, 0, int(NONE))], np.int64).T)
        self.known: dict[bytes, bytes] = {}

    def _rows(self, tokens: list[bytes], width: int) -> list[bytes]:
        """Ids of pre-tokens of at most `width` bytes."""
        size = np.array([len(t) for t in tokens])
        data = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in tokens), np.uint8)
        ids = self.single[data].reshape(len(tokens), width)
        ids[np.arange(width)[None, :] >= size[:, None]] = -1
        ranks = self.table.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(tokens), width - 1)
        rows = np.arange(len(tokens))
        found: list[bytes] = [b""] * len(tokens)
        while len(rows):
            least = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            best = ranks[np.arange(len(rows)), least] if ranks.shape[1] else np.full(len(rows), NONE)
            done = best == NONE
            for k in np.nonzero(done)[0]:
                found[rows[k]] = ids[k][ids[k] >= 0].astype("<u4").tobytes()
            rows, ids, ranks, least, best = rows[~done], ids[~done], ranks[~done], least[~done], best[~done]
            if not len(rows):
                break
            at, every = least[:, None], np.arange(len(rows))
            ids = np.where(np.arange(ids.shape[1] - 1)[None, :] <= at, ids[:, :-1], ids[:, 1:])
            ids[every, least] = best
            ranks = np.where(np.arange(ranks.shape[1] - 1)[None, :] < at, ranks[:, :-1], ranks[:, 1:])
            columns = ranks.shape[1]
            before = every[least > 0]
            ranks[before, least[before] - 1] = self.table.find(ids[before, least[before] - 1], ids[before, least[before]])
            after = every[least < columns]
            ranks[after, least[after]] = self.table.find(ids[after, least[after]], ids[after, least[after] + 1])
        return found

    def _long(self, token: bytes) -> bytes:
        """Ids of one very long pre-token: the same merges, least rank and leftmost first, from a heap."""
        ids = self.single[np.frombuffer(token, np.uint8)].tolist()
        after = [*range(1, len(ids)), -1]
        before = [-1, *range(len(ids) - 1)]

        def rank(k: int) -> int | None:
            return self.ranks.get(self.tokens[ids[k]] + self.tokens[ids[after[k]]]) if after[k] >= 0 else None

        heap = [(r, k, after[k], ids[k], ids[after[k]]) for k in range(len(ids)) if (r := rank(k)) is not None]
        heapq.heapify(heap)
        while heap:
            r, k, nxt, left, right = heapq.heappop(heap)
            if ids[k] != left or after[k] != nxt or ids[nxt] != right:
                continue
            ids[k], ids[nxt], after[k] = r, -1, after[nxt]
            if after[k] >= 0:
                before[after[k]] = k
            for j in (before[k], k):
                if j >= 0 and (r := rank(j)) is not None:
                    heapq.heappush(heap, (r, j, after[j], ids[j], ids[after[j]]))
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def pre_tokens(self, tokens: list[bytes]) -> list[bytes]:
        """Ids of distinct pre-tokens, as little-endian unsigned 32-bit numbers."""
        found: dict[bytes, bytes] = {}
        buckets: dict[int, list[bytes]] = {}
        for t in tokens:
            if t in self.ranks:
                found[t] = np.array([self.ranks[t]], "<u4").tobytes()
            elif len(t) > LONGEST:
                found[t] = self._long(t)
            else:
                buckets.setdefault(1 << (len(t) - 1).bit_length() if len(t) > 8 else 8, []).append(t)
        for width, bucket in buckets.items():
            for k in range(0, len(bucket), 1 << 14):
                part = bucket[k : k + (1 << 14)]
                found.update(zip(part, self._rows(part, width)))
        return [found[t] for t in tokens]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, each match of the pattern by itself; pre-tokens met before are looked up."""
        cut = [[m.encode() for m in self.pattern.findall(t)] for t in texts]
        if len(self.known) > CACHED_PIECES:
            self.known.clear()
        new = list(set().union(*cut).difference(self.known))
        self.known.update(zip(new, self.pre_tokens(new)))
        return [b"".join(map(self.known.__getitem__, c)) for c in cut]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=1)
def vocabulary(path: str, pattern: str) -> tuple[Vocabulary, Encoder]:
    """One vocabulary per Python worker, kept from task to task."""
    found = Vocabulary(path, pattern)
    return found, Encoder(found.encode, False)


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, ids (little-endian unsigned 32-bit), decoded (the ids' bytes again).

    Null and empty texts have no ids. Repeated rows and null ids stay. Special tokens are not known:
    their strings are ordinary text. Other columns are not read.
    """
    ready(docs.sparkSession)

    def run(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocab, encode = vocabulary(path, pattern)
        for column in columns:
            ids = encode.encode([t or "" for t in column])
            yield pd.DataFrame({"ids": ids, "decoded": [vocab.decode(x) for x in ids]})

    run.__annotations__ = {"columns": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    found = F.pandas_udf(run, "ids binary, decoded binary")("text")
    return docs.select("doc_id", found.alias("found")).select("doc_id", "found.ids", "found.decoded")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the decimal ids (joined by a space) and of the decoded bytes."""

    def run(ids: pd.Series) -> pd.Series:
        decimal = (" ".join(map(str, np.frombuffer(x, "<u4").tolist())) for x in ids)
        return pd.Series([hashlib.sha256(x.encode()).hexdigest() for x in decimal])

    run.__annotations__ = {"ids": pd.Series, "return": pd.Series}
    return encoded(docs, path, pattern).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.pandas_udf(run, "string")("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
