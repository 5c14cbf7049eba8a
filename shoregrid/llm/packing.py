"""Packing by power-of-two decomposition.

The ids of a document (with an end id) are cut into pieces whose lengths are powers of two: as many of
the greatest length as fit, then one for each bit of the rest, longest first. Every piece is a sequence of its own,
so no sequence crosses documents and none is padded; sequences of equal length form a bucket. It is
one pass over the documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from shoregrid.llm.common import map_arrow, ready, texts
from shoregrid.llm.tokens import encoder

LENGTH = 2048
END_ID = 1
_PARTITION_BITS = 25
_COUNTER_BITS = 34


def pieces(tokens: int, longest: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    found, start = [], 0
    while tokens - start >= longest:
        found.append((start, longest))
        start += longest
    for bit in reversed(range(longest.bit_length() - 1)):
        if (tokens - start) >> bit & 1:
            found.append((start, 1 << bit))
            start += 1 << bit
    return found


def packed(docs: DataFrame, tokenizer: str, longest: int = LENGTH) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, bucket, sequence_id, offset, ids.

    `ids` are little-endian unsigned 32-bit numbers. `bucket` is the binary logarithm of the length.
    `sequence_id` is unique and orders by bucket, then by input partition; a task that runs again
    assigns the same. A null or empty text is the end id alone; repeated rows and null ids
    are packed like any other. Other columns are not read. `longest` is a power of two.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, False).encode
        end = np.array([END_ID], dtype="<u4").tobytes()
        part = TaskContext.get().partitionId()
        used = [0] * longest.bit_length()
        for batch in batches:
            columns: dict[str, list] = {name: [] for name in schema.names}
            for doc_id, data in zip(batch.column(0).to_pylist(), encode(texts(batch))):
                data += end
                total = len(data) // 4
                for start, length in pieces(total, longest):
                    bucket = length.bit_length() - 1
                    number = (bucket << _PARTITION_BITS | part) << _COUNTER_BITS | used[bucket]
                    used[bucket] += 1
                    row = (doc_id, start, length, total, bucket, number, 0, data[4 * start : 4 * (start + length)])
                    for name, value in zip(schema.names, row):
                        columns[name].append(value)
            yield pa.RecordBatch.from_pydict(columns, schema=schema)

    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("doc_tokens", pa.int64()),
            ("bucket", pa.int32()),
            ("sequence_id", pa.int64()),
            ("offset", pa.int64()),
            ("ids", pa.binary()),
        ]
    )
    ddl = "doc_id long, start long, length long, doc_tokens long, bucket int, sequence_id long, `offset` long, ids binary"
    return map_arrow(docs.select("doc_id", "text"), run, ddl)
