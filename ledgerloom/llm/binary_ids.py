"""Token ids in patched frame-of-reference files.

A file holds whole documents in ascending id order.  Its ids are cut in
blocks of ``BLOCK``; a block stores its minimum, the differences packed at
the width that covers ``PERCENTILE`` of them, and the outliers in an
exception list (place and full difference).  An index of block starts leads
to any block without reading the others, and a table gives the documents'
ids and lengths.

    magic "PFR1" | block size, blocks, documents, ids (4 x u64)
    document ids (i64), null flags (u8), lengths (u64) of the documents
    block starts (u64, one more than blocks)
    blocks: minimum u32 | width u8 | exceptions u16 | packed differences |
            places u16 | differences u32

Files are rows of a Parquet table (``part, file, n_docs, n_tokens, data``):
Spark writes and reads them wherever the cluster stores files, and commits
them whole.  Documents are dealt to parts by ranges of their id, whose
bounds are quantiles (at most one a partition); within a part, files are
closed at about ``FILE_TOKENS`` ids, so memory holds one file, not a part.

Defined cases: null text is empty and has only the end id; repeated ids are
ordered by their token ids; a null id comes last; an empty table gives no
files.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, pieces
from ledgerloom.llm.common import columns_of, hand_out, here, partitions, prepare, range_bounds, small, table
from ledgerloom.session import ensure_checkpoint_dir

BLOCK = 4096
PERCENTILE = 0.9
FILE_TOKENS = 1 << 20
END_ID = 2
MAGIC = b"PFR1"


def pack_block(v: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One block of ids (u32, at most 65,535 of them)."""
    low = v.min()
    d = (v - low).astype("<u4")
    at = min(len(d) - 1, int(percentile * len(d)))
    width = int(np.partition(d, at)[at]).bit_length()
    out = np.flatnonzero(d >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    bits = np.unpackbits(d.view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little") if width else np.zeros(0, np.uint8)
    return b"".join([int(low).to_bytes(4, "little"), bytes([width]), len(out).to_bytes(2, "little"),
                     np.packbits(bits.ravel(), bitorder="little").tobytes(), out.astype("<u2").tobytes(), d[out].tobytes()])


def unpack_block(raw: bytes, n: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    low, width, k = int.from_bytes(raw[:4], "little"), raw[4], int.from_bytes(raw[5:7], "little")
    size = (n * width + 7) // 8
    d = np.zeros((n, 4), np.uint8)
    if width:
        bits = np.unpackbits(np.frombuffer(raw, np.uint8, size, 7), count=n * width, bitorder="little").reshape(n, width)
        d[:, :(width + 7) // 8] = np.packbits(bits, axis=1, bitorder="little")
    d = d.view("<u4").ravel()
    if k:
        d[np.frombuffer(raw, "<u2", k, 7 + size)] = np.frombuffer(raw, "<u4", k, 7 + size + 2 * k)
    return d + np.uint32(low)


def pack_file(docs: list[tuple[int | None, np.ndarray]], block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    ids = np.concatenate([i for _, i in docs]).astype("<u4") if docs else np.zeros(0, "<u4")
    blocks = [pack_block(ids[a:a + block], percentile) for a in range(0, len(ids), block)]
    starts = np.cumsum([0, *map(len, blocks)])
    head = np.array([block, len(blocks), len(docs), len(ids)], "<u8").tobytes()
    names = np.array([d or 0 for d, _ in docs], "<i8").tobytes() + bytes([d is None for d, _ in docs])
    lengths = np.array([len(i) for _, i in docs], "<u8").tobytes()
    return b"".join([MAGIC, head, names, lengths, starts.astype("<u8").tobytes(), *blocks])


class TokenFile:
    """Reads a file; ``ids(a, b)`` unpacks only the blocks that it needs."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a token file")
        self.raw = raw
        self.block, self.blocks, n, self.n_tokens = np.frombuffer(raw, "<u8", 4, 4).astype(int).tolist()
        at = 36
        names, nulls = np.frombuffer(raw, "<i8", n, at), np.frombuffer(raw, np.uint8, n, at + 8 * n)
        self.doc_ids = [None if z else d for d, z in zip(names.tolist(), nulls.tolist())]
        self.lengths = np.frombuffer(raw, "<u8", n, at + 9 * n).astype(np.int64)
        self.starts = np.frombuffer(raw, "<u8", self.blocks + 1, at + 17 * n).astype(np.int64)
        self.body = at + 17 * n + 8 * (self.blocks + 1)

    def ids(self, a: int, b: int) -> np.ndarray:
        if a >= b:
            return np.zeros(0, np.uint32)
        first, last = a // self.block, (b - 1) // self.block
        got = []
        for k in range(first, last + 1):
            n = min(self.block, self.n_tokens - k * self.block)
            got.append(unpack_block(self.raw[self.body + self.starts[k]:self.body + self.starts[k + 1]], n))
        return np.concatenate(got)[a - first * self.block:b - first * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Id, place in the file, and ids of each document; blocks are
        unpacked a stretch at a time."""
        begins = np.cumsum(self.lengths) - self.lengths
        lo, held = 0, np.zeros(0, np.uint32)
        for d, a, n in zip(self.doc_ids, begins.tolist(), self.lengths.tolist()):
            if a + n > lo + len(held):
                lo, held = a, self.ids(a, min(self.n_tokens, max(a + n, a + (1 << 17))))
            yield d, a, held[a - lo:a - lo + n]


_Library = pieces.LibraryEncoder


def write_ids(docs: DataFrame, out: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int | None = END_ID, file_tokens: int = FILE_TOKENS) -> None:
    """Encode whole texts and write the token files below ``out``."""
    path = path or bpe.default_path()
    spark = prepare(docs.sparkSession)
    d = columns_of(docs, {"doc_id": id_col, "text": text_col}).withColumn("doc_id", F.col("doc_id").cast("long"))
    parts = partitions(spark)
    bounds = np.array(range_bounds(d, "doc_id", parts), np.int64)

    name = hand_out(spark, path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pieces.library_encoder(here(name))
        # Two bytes an id do on the way where they can hold them all.
        kind = "<u2" if encoder.size <= 1 << 16 else "<u4"
        for b in batches:
            own = b.column("doc_id")
            part = np.searchsorted(bounds, pc.fill_null(own, 0).to_numpy(), "right")
            part[pc.is_null(own).to_numpy(zero_copy_only=False)] = len(bounds)
            for at, ids, counts in encoder.batch_ids(b.column("text")):
                ids, counts = pieces.with_end(ids, counts, end_id)
                n = len(counts)
                columns = [pa.array(part[at:at + n], pa.int32()), own.slice(at, n), pa.array([kind] * n, pa.string()), pieces.binary_column(ids.astype(kind), counts)]
                yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "kind", "ids"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "file", "n_docs", "n_tokens", "data"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        part, file, held, size = None, 0, [], 0

        def done():
            row = (part, file, len(held), size, pack_file(held))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names)

        for b in batches:
            for p, name, kind, ids in zip(*(b.column(n).to_pylist() for n in ("part", "doc_id", "kind", "ids"))):
                if held and (p != part or size >= file_tokens):
                    yield done()
                    file, held, size = (file + 1 if p == part else 0), [], 0
                part = p
                held.append((name, np.frombuffer(ids, kind).astype("<u4")))
                size += len(held[-1][1])
        if held:
            yield done()

    rows = d.mapInArrow(pieces.released(encode), "part int, doc_id long, kind string, ids binary")
    rows = rows.repartitionById(parts, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_last(), "ids")
    rows.mapInArrow(pack, "part int, file long, n_docs long, n_tokens long, data binary").write.parquet(out)


def read_ids(spark: SparkSession, out: str) -> DataFrame:
    """Per document, read from the files: ``doc_id, start, n_tokens,
    ids_crc32``; ``start`` counts the ids of all documents before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "file", "doc_id", "at", "n_tokens", "ids_crc32"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        for b in batches:
            for part, file, raw in zip(b.column("part").to_pylist(), b.column("file").to_pylist(), b.column("data")):
                rows = [(part, file, d, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for d, at, ids in TokenFile(raw.as_py()).documents()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    files = spark.read.parquet(out)
    sizes = files.select("part", "file", "n_tokens")
    # One row a part: at most the number of partitions.
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("base"))
    inside = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("part", "file", inside.alias("inside")).join(parts, "part").select("part", "file", (F.col("base") + F.col("inside")).alias("base"))
    docs = files.select("part", "file", "data").mapInArrow(run, "part int, file long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(small(offsets), ["part", "file"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def query(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = os.path.join(ensure_checkpoint_dir(spark), f"token-ids-{uuid.uuid4().hex}")
    write_ids(table(spark, sf_dir, "documents"), out)
    return read_ids(spark, out)
