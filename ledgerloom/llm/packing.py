"""Best-fit packing of documents by a plan over their length histogram.

Documents are encoded, ended by an end id, and cut into pieces only where
they are longer than a sequence.  What is planned is not the pieces but their
counts by length: lengths are taken from the longest down, and all pieces of
one length go to the open sequences with the least room that still holds one,
as many to each as fit.  Sequences with the same filling are one range of
numbers, so a step places any number of pieces, and the plan's size depends on
the sequence length and not on the corpus.  Pieces then take the planned slots
by joining on their rank within their length.

Ranks need no window over a length, which may hold a third of all pieces: each
written block numbers its own pieces of a length, and the counts of the blocks
before it are added.

Defined cases: a null text is empty and consists of the end id; rows that share
an id, or have none, are packed each for itself; a document of exactly the
sequence length is one piece; an empty table gives no pieces; very long texts
become as many pieces as they need.  Other columns of the table are left out,
whatever their names.
"""

from __future__ import annotations

import bisect
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, pieces
from ledgerloom.llm.common import columns_of, cut, hand_out, here, prepare, small, table
from ledgerloom.session import ensure_checkpoint_dir

SEQUENCE = 2048
END_ID = 0
_PIECE = "block int, nth long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
_SLOT = "length long, first_rank long, n long, first_sequence long, each long, first_offset long"


def plan(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit from the longest down, over counts.  A row ``(length,
    first_rank, n, first_sequence, each, first_offset)`` puts the pieces of
    that length ranked from ``first_rank`` on, ``n`` of them, ``each`` to a
    sequence from ``first_sequence`` on, from ``first_offset`` on."""
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges of sequences (first, number)
    rooms: list[int] = []  # ascending
    slots, used = [], 0

    def leave(left: int, first: int, number: int) -> None:
        if left and number:
            if left not in room:
                room[left] = []
                bisect.insort(rooms, left)
            room[left].append((first, number))

    for length in sorted(histogram, reverse=True):
        rank, count = 0, histogram[length]
        while count:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                left = rooms[at]
                first, number = room[left].pop()
                if not room[left]:
                    del room[left], rooms[at]
            else:
                left, first, number = sequence, used, -(-count // (sequence // length))
                used += number
            fit = left // length
            full = min(number, count // fit)
            last = count - full * fit if full < number and count - full * fit < fit else 0
            for n, each, start, these in ((full * fit, fit, first, full), (last, last, first + full, 1)):
                if n:
                    slots.append((length, rank, n, start, each, sequence - left))
                    leave(left - each * length, start, these)
                    rank, count = rank + n, count - n
            done = full + bool(last)
            leave(left, first + done, number - done)
    return slots


def cut_pieces(docs: DataFrame, out: str, path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Encode ``doc_id, text``, cut the pieces and write them below ``out``:
    ``block`` is the writing task's, ``nth`` the rank within it of a piece
    among those of its length."""
    spark = prepare(docs.sparkSession)
    name = hand_out(spark, path or bpe.default_path())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pieces.library_encoder(here(name))
        kind = "<u2" if encoder.size <= 1 << 16 else "<u4"
        block, seen = TaskContext.get().partitionId(), np.zeros(sequence + 1, np.int64)
        for b in batches:
            for at, ids, counts in encoder.batch_ids(b.column("text")):
                ids, counts = pieces.with_end(ids, counts, end_id)
                n = -(-counts // sequence)
                of = np.repeat(np.arange(len(counts)), n)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * sequence
                length = np.minimum(counts[of] - start, sequence)
                order = np.argsort(length, kind="stable")
                ranks = np.arange(len(of)) - np.searchsorted(length[order], length[order], "left")
                nth = np.empty(len(of), np.int64)
                nth[order] = ranks
                nth += seen[length]
                seen += np.bincount(length, minlength=sequence + 1)
                raw, ends = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B"), 4 * np.cumsum(length)
                crc = [zlib.crc32(raw[a:z]) for a, z in zip((ends - 4 * length).tolist(), ends.tolist())]
                columns = [pa.array(np.full(len(of), block, np.int32)), pa.array(nth), b.column("doc_id").take(pa.array(at + of)), pa.array(piece, pa.int32()),
                           pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pieces.binary_column(ids.astype(kind), length)]
                yield pa.RecordBatch.from_arrays(columns, ["block", "nth", "doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    docs.mapInArrow(pieces.released(run), _PIECE).write.parquet(out)
    return spark.read.schema(_PIECE).parquet(out)


def place(cuts: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Written pieces with ``sequence_id`` and ``offset``."""
    spark = cuts.sparkSession
    sizes = cut(cuts.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n")))
    # At most one row a length; the plan of them is as bounded.
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.createDataFrame(plan(histogram, sequence), _SLOT)
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = cut(sizes.select("block", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    ranked = cuts.join(small(before), ["block", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    slots = F.broadcast(slots.withColumnRenamed("length", "_length"))
    own = (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("n"))
    k = F.col("rank") - F.col("first_rank")
    return ranked.join(slots, own).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.expr("(rank - first_rank) div each")).alias("sequence_id"),
        (F.col("first_offset") + k % F.col("each") * F.col("length")).alias("offset"), "ids")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and
    ``ids`` (little-endian, two bytes each where the vocabulary allows) of
    every piece.  The pieces are written to the shared folder once."""
    spark = prepare(docs.sparkSession)
    d = columns_of(docs, {"doc_id": id_col, "text": text_col}).withColumn("doc_id", F.col("doc_id").cast("long"))
    out = os.path.join(ensure_checkpoint_dir(spark), f"pieces-{uuid.uuid4().hex}")
    return place(cut_pieces(d, out, path, sequence, end_id), sequence)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id, n_tokens, ids`` (at most
    ``SEQUENCE`` ids each) and ``doc_ids``, where each piece begins."""
    held = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("held"))
    ids = F.aggregate("held", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return held.select("sequence_id", "n_tokens", ids.alias("ids"), F.transform("held", lambda x: F.struct(x["offset"], x["doc_id"])).alias("doc_ids"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(prepare(spark), sf_dir, "documents")).drop("ids")
