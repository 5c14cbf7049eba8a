"""Nearest neighbours by inner product, with randomly rotated one-bit codes.

Vectors are packed into blocks of a few megabytes as they are read. In each block a vector's offset from the block's mean is rotated by
a fixed random matrix and kept as one bit per dimension, with two scalars: its length and the inner
product of the rotated unit offset with its code. Codes are made once, when a block is packed. Inner products with a query are estimated from
the packed bits alone (bit planes of the rotated query and population counts), and the code's
quality bounds the error. A vector is compared in full only if its estimate plus the bound reaches
what the k best found so far (in a task's first block, the k best by estimate) really have. A task takes a block of queries
past many blocks of vectors and keeps the best lists; those of all tasks are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoregrid.llm.common import map_arrow, ready, written
from shoregrid.session import work_path

NEIGHBOURS = 20
BLOCK_ROWS = 32_768
QUERY_ROWS = 2_048
BLOCK_BYTES, QUERY_BYTES = 1 << 20, 1 << 19
"""A block ends at so many rows or bytes of vectors, whichever comes first: each is one value of a row."""
PAIR_ROWS = 2
"""Pairs of blocks of one Arrow batch."""
ROW_GROUP_BYTES = 8 << 20
TASKS_PER_CORE = 4
PLANES = 6
BOUND = 4
"""Standard deviations that the error bound allows for; of random vectors (200,000, 64 components) 1.5 finds 0.9885 of the 20 nearest, 3 and 4 find 1.000."""
SEED = 11
_STEP = 8
_PACKED = "d int, ids binary, v binary, middle binary, bits binary, length binary, quality binary"


@lru_cache(maxsize=4)
def rotation(dimensions: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    packed = np.zeros((len(bits), -(-bits.shape[1] // 64) * 8), np.uint8)
    packed[:, : -(-bits.shape[1] // 8)] = np.packbits(bits, axis=1, bitorder="little")
    return packed.view(np.uint64)


def encoded(vectors: np.ndarray) -> dict[str, bytes]:
    """The codes of a block of vectors, as `Codes` reads them."""
    middle = vectors.mean(axis=0)
    offset = (vectors - middle) @ rotation(vectors.shape[1])
    length = np.linalg.norm(offset, axis=1)
    unit = offset / np.where(length > 0, length, 1)[:, None]
    quality = np.abs(unit).sum(axis=1) / np.sqrt(vectors.shape[1])
    return {"middle": middle.tobytes(), "bits": _words(unit > 0).tobytes(), "length": length.tobytes(), "quality": quality.tobytes()}


class Codes:
    """A block of vectors with its codes."""

    def __init__(self, d: int, ids: bytes, v: bytes, middle: bytes, bits: bytes, length: bytes, quality: bytes) -> None:
        self.ids, self.vectors = np.frombuffer(ids, np.int64), np.frombuffer(v, np.float64).reshape(-1, d)
        self.middle, self.length = np.frombuffer(middle, np.float64), np.frombuffer(length, np.float64)
        words = np.frombuffer(bits, np.uint64).reshape(len(self.ids), -1)
        self.words = [np.ascontiguousarray(w) for w in words.T]
        self.set = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        quality = np.frombuffer(quality, np.float64)
        quality = np.where(quality > 0, quality, 1)
        self.scale = self.length / quality
        spread = np.sqrt(np.maximum(1 - quality**2, 0)) / quality / np.sqrt(max(d - 1, 1))
        self.parts = np.array([self.scale * self.set, self.scale, self.length * spread])

    def estimates(self, asked: Asked, at: slice) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products with some queries, a row for each, and how far they may be off, as factors of `parts`."""
        d, step = self.vectors.shape[1], asked.step[at]
        kind = np.uint16 if d << PLANES < 1 << 16 else np.int32
        total = np.zeros((len(step), len(self.ids)), kind)
        for plane, parts in enumerate(asked.planes):
            for word, part in zip(self.words, parts[at].T):
                total += np.left_shift(np.bitwise_count(word & part[:, None]), plane, dtype=kind)
        # sum of the query's components where the bit is set, less those where it is not
        set_, constant = 2 * asked.low[at] / np.sqrt(d), -asked.whole[at] / np.sqrt(d)
        estimate = total * self.scale
        estimate *= (2 * step / np.sqrt(d))[:, None]
        estimate += np.array([set_, constant, np.zeros(len(step))]).T @ self.parts
        estimate += (asked.vectors[at] @ self.middle)[:, None]
        # spread of the code's error, and of rounding the query's components
        return estimate, BOUND * np.array([np.zeros(len(step)), step / np.sqrt(12), asked.size[at]]).T


class Asked:
    """A block of queries: their bit planes, and the best vectors found for each so far."""

    def __init__(self, d: int, ids: bytes, v: bytes) -> None:
        self.ids, self.vectors = np.frombuffer(ids, np.int64), np.frombuffer(v, np.float64).reshape(-1, d)
        turned = self.vectors @ rotation(d)
        self.size, self.low = np.linalg.norm(turned, axis=1), turned.min(axis=1)
        step = (turned.max(axis=1) - self.low) / (2**PLANES - 1)
        self.step = np.where(step > 0, step, 1.0)
        level = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        self.planes = [_words((level >> plane & 1).astype(bool)) for plane in range(PLANES)]
        self.whole = self.low * d + self.step * level.sum(axis=1)
        self.found = [(np.zeros(0, np.int64), np.zeros(0))] * len(self.ids)

    def meet(self, block: Codes, k: int) -> None:
        """Take the block's vectors into the best lists: k at most, never the query's own id, ties to the smaller id."""
        for start in range(0, len(self.ids), _STEP):
            at = slice(start, start + _STEP)
            estimates, errors = block.estimates(self, at)
            reached = np.array([self._reached(i, block, e, k) for i, e in enumerate(estimates, start)])
            estimates += errors @ block.parts
            open_ = estimates >= (reached - 1e-9 * np.abs(reached))[:, None]
            for i, some in enumerate(open_, start):
                self._take(i, block, np.nonzero(some)[0], k)

    def _reached(self, i: int, block: Codes, estimate: np.ndarray, k: int) -> float:
        """What k vectors but the query's own reach at least."""
        best = self.found[i][1]
        if len(best) == k:
            return best[-1]
        if len(block.ids) <= k + 1:
            return -np.inf
        first = np.argpartition(-np.where(block.ids == self.ids[i], -np.inf, estimate), k)[:k]
        first = first[block.ids[first] != self.ids[i]]
        return np.einsum("ij,j->i", block.vectors[first], self.vectors[i]).min() if len(first) == k else -np.inf

    def _take(self, i: int, block: Codes, chosen: np.ndarray, k: int) -> None:
        near, best = self.found[i]
        chosen = chosen[block.ids[chosen] != self.ids[i]]
        score = np.einsum("ij,j->i", block.vectors[chosen], self.vectors[i])  # row by row, so equal vectors stay equal
        if len(best) == k:
            good = score >= best[-1]
            chosen, score = chosen[good], score[good]
        if not len(chosen):
            return
        near, score = np.concatenate([near, block.ids[chosen]]), np.concatenate([best, score])
        if len(near) > k:
            good = score >= np.partition(score, len(score) - k)[len(score) - k]
            near, score = near[good], score[good]
        order = np.lexsort((near, -score))[:k]
        self.found[i] = near[order], score[order]


def usable(vectors: DataFrame, columns: list[Column]) -> DataFrame:
    """Rows whose vector is neither null, empty nor zero and holds finite numbers only."""
    v = F.col("embedding").cast("array<double>")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vectors.where("vec_id IS NOT NULL AND size(embedding) > 0").where(finite & F.exists(v, lambda x: x != 0)).select(
        *columns, v.alias("v"), F.size("embedding").alias("d")
    )


def _packed(rows: DataFrame, most: int, most_bytes: int, name: str, encode: bool = False) -> DataFrame:
    """(d, ids, v, codes, n): the rows of each task in blocks of vectors of one length, each packed into one row, with its number n."""

    def block(held: list[tuple[np.ndarray, np.ndarray]], d: int) -> dict:
        ids, v = (np.concatenate(x) for x in zip(*held))
        return {"d": d, "ids": ids.tobytes(), "v": v.tobytes(), **(encoded(v) if encode else {})}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        count = lambda d: sum(len(ids) for ids, _ in held[d])
        out = lambda d: pa.RecordBatch.from_pylist([block(held.pop(d), d)], schema)
        for batch in batches:
            ids, vectors, sizes = batch.column(0), batch.column(1), batch.column(2).to_numpy()
            for d in np.unique(sizes).tolist():
                own = pa.array(sizes == d)
                some, v = ids.filter(own).to_numpy(), vectors.filter(own).flatten().to_numpy().reshape(-1, d)
                rows = max(1, min(most, most_bytes // (8 * d)))
                while len(some):
                    free = rows - (count(d) if d in held else 0)
                    held.setdefault(d, []).append((some[:free], v[:free]))
                    some, v = some[free:], v[free:]
                    if count(d) >= rows:
                        yield out(d)
            while sum(8 * d * count(d) for d in held) > most_bytes:  # many lengths side by side
                yield out(max(held, key=lambda d: d * count(d)))
        for d in list(held):
            yield out(d)

    schema = pa.schema([("d", pa.int32()), *[(c, pa.binary()) for c in ("ids", "v", "middle", "bits", "length", "quality")]])
    packed = map_arrow(rows.select("vec_id", "v", "d"), run, _PACKED).withColumn("n", F.monotonically_increasing_id())
    path = work_path(rows.sparkSession, name)
    # a reader holds a row group
    packed.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return rows.sparkSession.read.schema(packed.schema).parquet(path)


def _query_blocks(rows: DataFrame) -> tuple[DataFrame, int]:
    """(n, qd, qids, q): the queries in even blocks, each in a partition of its own; and how many there are."""
    count, size = rows.agg(F.count(F.lit(1)), F.sum(F.col("d").cast("long") * 8)).first()
    tasks = max(1, -(-count // QUERY_ROWS), -(-(size or 0) // QUERY_BYTES))
    # a task's share is a few rows more or less than the mean
    packed = _packed(rows.repartition(tasks), 2 * QUERY_ROWS, 2 * QUERY_BYTES, "queries")
    blocks = max(1, packed.count())
    queries = packed.select("n", F.col("d").alias("qd"), F.col("ids").alias("qids"), F.col("v").alias("q"))
    return queries.repartitionByRange(blocks, "n"), blocks


def nearest(vectors: DataFrame, asked: Column, k: int = NEIGHBOURS) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows that `asked` selects against all others.

    Scores are inner products of the original vectors in double precision, best first, ties to the
    smaller vec_id; with fewer than k others all are returned. Null, empty and zero vectors and such
    with null or non-finite components take no part, neither do null ids; vectors of different length are
    never compared. Repeated ids are candidates and queries each; a row is never its own id's neighbour.
    Every block of queries meets every block of vectors. A task has one block of queries and reads its share of the
    vectors block by block, so pairs of blocks are neither stored nor shuffled. Vectors are cut into no more shares than keep all cores busy.
    """
    spark = ready(vectors.sparkSession)
    base = _packed(usable(vectors, ["vec_id"]), BLOCK_ROWS, BLOCK_BYTES, "vectors", encode=True)
    queries, blocks = _query_blocks(usable(vectors.where(asked), ["vec_id"]))
    shares = base.drop("n").coalesce(max(1, -(-TASKS_PER_CORE * spark.sparkContext.defaultParallelism // blocks)))
    pairs = shares.hint("shuffle_replicate_nl").join(queries, F.expr("d = qd"))
    columns = ["d", "ids", "v", "middle", "bits", "length", "quality"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, Asked] = {}
        for batch in batches:
            n, qids, q, *block = (batch.column(c) for c in ("n", "qids", "q", *columns))
            for i in range(batch.num_rows):
                number, d = n[i].as_py(), block[0][i].as_py()
                if number not in met:
                    met[number] = Asked(d, qids[i].as_py(), q[i].as_py())
                codes = Codes(d, *(c[i].as_py() for c in block[1:]))
                met[number].meet(codes, k)
        for asked in met.values():
            near, score = (np.concatenate(x) for x in zip(*asked.found))
            own = np.repeat(asked.ids, [len(ids) for ids, _ in asked.found])
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(near), pa.array(score)], ["query_id", "vec_id", "score"])

    ready(spark, PAIR_ROWS)
    partial = written(map_arrow(pairs.select("n", "qids", "q", *columns), search, "query_id long, vec_id long, score double"), "best")
    ready(spark)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
