"""Token files: independent zstandard frames, a directory and a seek table at the end.

A file holds documents in ascending order of id. Documents are gathered into frames of about
FRAME_BYTES; each frame is compressed by itself. Two skippable frames follow, so that any zstandard
reader can still decompress the whole file: a directory (per frame the first and last id, documents,
tokens), and the seek table of the public seekable format (per frame the two sizes and the low 32
bits of the XXH64 of its content). A reader loads the two tables, then only the frames that it needs.

Frame content: width of an id in bytes (u8), documents (u32), per document a flag (u8, 0: the id is
null), its id (i64) and tokens (u64), then all ids. Numbers are little-endian.
"""

from __future__ import annotations

import io
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoregrid.llm.common import map_arrow, ready, texts, work_path, written
from shoregrid.llm.tokens import encoder

FRAME_BYTES = 1 << 18
END_ID = 1
LEVEL = 3
FRAMES_PER_TASK = 64
MAX_TASKS = 10_000
"""Tasks that the reading is dealt to at most; beyond it a task reads several ranges."""
SUFFIX = ".tok.zst"

# Fixed values of the public frame formats.
_SKIPPABLE_DIRECTORY = 0x184D2A5D
_SKIPPABLE_SEEK_TABLE = 0x184D2A5E
_SEEKABLE_MAGIC = 0x8F92EAB1
_CHECKSUM_FLAG = 0x80

_DOC = np.dtype([("known", "u1"), ("id", "<i8"), ("tokens", "<u8")])
_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
_DIRECTORY = np.dtype([("first", _DOC), ("last", _DOC), ("docs", "<u4"), ("tokens", "<u8")])


class Writer:
    """Writes one file to a binary stream; memory holds one frame and 54 bytes for each earlier one."""

    def __init__(self, out: io.RawIOBase) -> None:
        self.out = out
        self.docs: list[tuple[int, int, int]] = []
        self.ids: list[np.ndarray] = []
        self.size = 0
        self.entries: list[tuple[int, int, int]] = []
        self.directory: list[tuple] = []
        self.zstd = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id is not None, doc_id or 0, len(ids)))
        self.ids.append(ids)
        self.size += 2 * len(ids)
        if self.size >= FRAME_BYTES:
            self.flush()

    def flush(self) -> None:
        if not self.docs:
            return
        docs = np.array(self.docs, _DOC)
        ids = np.concatenate(self.ids)
        width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
        content = struct.pack("<BI", width, len(docs)) + docs.tobytes() + ids.astype(f"<u{width}").tobytes()
        packed = self.zstd.compress(content)
        self.out.write(packed)
        self.entries.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.directory.append((docs[0], docs[-1], len(docs), int(docs["tokens"].sum())))
        self.docs, self.ids, self.size = [], [], 0

    def close(self) -> None:
        self.flush()
        directory = np.array(self.directory, _DIRECTORY).tobytes()
        self.out.write(struct.pack("<II", _SKIPPABLE_DIRECTORY, len(directory)) + directory)
        table = np.array(self.entries, _ENTRY).tobytes()
        table += struct.pack("<IBI", len(self.entries), _CHECKSUM_FLAG, _SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", _SKIPPABLE_SEEK_TABLE, len(table)) + table)
        self.out.close()


class Reader:
    """Random access to a file given as a seekable binary stream."""

    def __init__(self, source: io.RawIOBase) -> None:
        self.source = source
        end = source.seek(0, io.SEEK_END)
        source.seek(end - 9)
        frames, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != _SEEKABLE_MAGIC or flags != _CHECKSUM_FLAG:
            raise ValueError("not a seekable token file")
        table = frames * _ENTRY.itemsize
        directory = frames * _DIRECTORY.itemsize
        source.seek(end - 9 - table - 8 - directory)
        self.directory = np.frombuffer(source.read(directory), _DIRECTORY)
        source.seek(8, io.SEEK_CUR)
        self.entries = np.frombuffer(source.read(table), _ENTRY)
        packed = self.entries["packed"].astype(np.int64)
        self.places = np.cumsum(packed) - packed
        tokens = self.directory["tokens"].astype(np.int64)
        self.starts = np.cumsum(tokens) - tokens
        self.zstd = zstandard.ZstdDecompressor()

    def frame(self, k: int) -> list[tuple[int | None, np.ndarray]]:
        """(id, token ids) of the documents of one frame, its checksum verified."""
        self.source.seek(int(self.places[k]))
        content = self.zstd.decompress(self.source.read(int(self.entries["packed"][k])))
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.entries["check"][k]:
            raise ValueError(f"frame {k} is damaged")
        width, n = struct.unpack_from("<BI", content)
        docs = np.frombuffer(content, _DOC, n, 5)
        ids = np.frombuffer(content, f"<u{width}", -1, 5 + n * _DOC.itemsize)
        cuts = np.cumsum(docs["tokens"].astype(np.int64))[:-1]
        return [(int(d["id"]) if d["known"] else None, x) for d, x in zip(docs, np.split(ids, cuts))] if n else []

    def find(self, doc_id: int) -> list[np.ndarray]:
        """Token ids of all documents with an id; decompresses the frames that can hold it only."""
        first, last = self.directory["first"], self.directory["last"]
        may = np.where(first["known"], first["id"] <= doc_id, True) & (last["known"] > 0) & (last["id"] >= doc_id)
        return [x for k in np.nonzero(may)[0] for d, x in self.frame(int(k)) if d == doc_id]


def write(docs: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """Write all documents below the folder; gives the manifest (part, file, docs, tokens, frames).

    Files are ranges of ids in ascending order (null ids first); rows with one id are ordered by a
    hash of their text and can be split over files, so a repeated id does not end in one task. An
    end id closes every document; a null or empty text is the end id alone. A task that
    runs again writes a new file, only the one in the manifest counts. The folder is a path or URI that
    `pyarrow.fs` and Spark both reach.
    """
    ready(docs.sparkSession)
    order = ["doc_id", "_tie"]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, True).encode
        part = TaskContext.get().partitionId()
        system, base = fs.FileSystem.from_uri(folder)
        writer, total, count, name = None, 0, 0, f"part-{part:06d}-{uuid.uuid4().hex}{SUFFIX}"
        for batch in batches:
            if writer is None:
                system.create_dir(base, recursive=True)
                writer = Writer(system.open_output_stream(f"{base}/{name}", compression=None))
            for doc_id, data in zip(batch.column(0).to_pylist(), encode(texts(batch))):
                ids = np.append(np.frombuffer(data, "<u4"), np.uint32(END_ID))
                writer.add(doc_id, ids)
                total += len(ids)
                count += 1
        if writer is not None:
            writer.close()
            row = {"part": part, "file": name, "docs": count, "tokens": total, "frames": len(writer.entries)}
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema(
        [("part", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()), ("frames", pa.int32())]
    )
    return written(map_arrow(rows, run, "part int, file string, docs long, tokens long, frames int"), "manifest")


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of the files: doc_id, start (tokens of all documents before it), ids, file, frame.

    Work is dealt out by ranges of FRAMES_PER_TASK frames, one a task up to MAX_TASKS tasks. The running sum over
    files is one row per file.
    """
    ready(manifest.sparkSession)
    ranges = manifest.agg(F.sum(F.ceil(F.col("frames") / FRAMES_PER_TASK))).first()[0] or 0
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    work = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    work = work.select(
        "file", "base", "frames", F.explode(F.sequence(F.lit(0), F.col("frames") - 1, F.lit(FRAMES_PER_TASK))).alias("at")
    )
    # with a number, so that adaptive execution does not merge the few small rows into one task
    work = work.repartition(max(1, min(int(ranges), MAX_TASKS)), "file", "at")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = fs.FileSystem.from_uri(folder)
        for frame in frames:
            for row in frame.itertuples():
                with system.open_input_file(f"{base}/{row.file}") as source:
                    reader = Reader(source)
                    for k in range(row.at, min(row.at + FRAMES_PER_TASK, row.frames)):
                        start, rows = row.base + int(reader.starts[k]), []
                        for doc_id, ids in reader.frame(k):
                            rows.append((doc_id, start, ids.astype("<u4").tobytes(), row.file, k))
                            start += len(ids)
                        out = pd.DataFrame(rows, columns=["doc_id", "start", "ids", "file", "frame"])
                        yield out.astype({"doc_id": "Int64"})

    return work.mapInPandas(run, "doc_id long, start long, ids binary, file string, frame int")


def folder(spark: SparkSession) -> str:
    """A fresh folder for token files in the shared folder."""
    return work_path(spark, "token-files")
