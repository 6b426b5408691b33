"""Best-fit decreasing packing of whole documents, exactly as over one sorted list, without bringing the documents together.

Pieces of one length are alike, so best-fit decreasing is worked out over the histogram of lengths (at most `capacity`
numbers) and gives a plan: which ranks of a length go to which bins. Every piece then finds its bin by its length and rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geohealth.llm.common import materialize
from geohealth.llm.packing import encoder

SCHEMA = "part int, doc_id long, piece int, start long, length int, local long, ids binary, ids_crc32 long"
PLAN = "length int, first long, count long, each int, bin long, filled int"
_encoders: dict = {}


class CapacityTree:
    """A segment tree over the remaining capacities 0 .. top: how many bins are open at each, and the tightest that fits."""

    def __init__(self, top: int) -> None:
        self.leaves = 1 << top.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, remaining: int, bins: int) -> None:
        at = remaining + self.leaves
        while at:
            self.count[at] += bins
            at //= 2

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity >= length at which a bin is open: up from the leaf, then down to the left."""
        at = length + self.leaves
        if not self.count[at]:
            while at > 1 and (at % 2 or not self.count[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        return at - self.leaves


@dataclass
class Run:
    """Bins first .. first + count - 1, all filled alike."""

    first: int
    count: int
    filled: int


def best_fit_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows of PLAN: of the pieces of a length those of ranks first .. first + count - 1 go, `each` to a bin, to the bins
    from `bin` on, behind the `filled` tokens that are there.

    Lengths fall; each piece goes to the open bin with the least remaining capacity that holds it, or else opens one. Once
    a bin has taken a piece it is itself the tightest while it holds one more, so equal bins take their pieces one bin
    after the other, and a run of equal bins is filled in one step. A length adds at most four runs (the bins it filled,
    one that it filled in part, and the same of new bins), and a bin holds few different lengths, so the plan's size
    depends on the capacity and not on the number of documents.
    """
    tree, runs, plan, bins = CapacityTree(capacity), {}, [], 0

    def put(run: Run) -> None:
        if run.count and run.filled < capacity:
            runs.setdefault(capacity - run.filled, []).append(run)
            tree.add(capacity - run.filled, run.count)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                run = Run(bins, -(-left // (capacity // length)), 0)
                bins += run.count
                remaining = capacity
            else:
                run = runs[remaining].pop()
                tree.add(remaining, -run.count)
            each = remaining // length
            full = min(run.count, left // each)
            if full:
                plan.append((length, rank, full * each, each, run.first, run.filled))
                put(Run(run.first, full, run.filled + each * length))
                rank, left = rank + full * each, left - full * each
            if full < run.count:
                some = left  # fewer than fill one more bin
                if some:
                    plan.append((length, rank, some, some, run.first + full, run.filled))
                    put(Run(run.first + full, 1, run.filled + some * length))
                    rank, left, full = rank + some, 0, full + 1
                put(Run(run.first + full, run.count - full, run.filled))
    return plan


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Rows of SCHEMA: the pieces of each document, numbered within their length and partition (local)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter
        from zlib import crc32

        encode = _encoders.get(tokenizer) or _encoders.setdefault(tokenizer, encoder(tokenizer))
        end, part = end_id.to_bytes(4, "little"), TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64()]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        ready: list[tuple] = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):  # one text at a time
                ids = encode(text.as_py() or "") + end
                n = len(ids) // 4
                start, piece = 0, 0
                while start < n:  # only the first piece may be short
                    length = (n - start - 1) % capacity + 1 if start == 0 else capacity
                    own = ids[4 * start : 4 * (start + length)]
                    ready.append((part, doc_id, piece, start, length, seen[length], own, crc32(own)))
                    seen[length] += 1
                    start, piece = start + length, piece + 1
                if len(ready) >= 2_000:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*ready), kinds)], names=names)
                    ready = []
        if ready:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*ready), kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, SCHEMA)


def pack_best_fit(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (little-endian unsigned 32-bit), ids_crc32, sequence_id, offset.

    A document's ids end with end_id. Documents over the capacity are cut into pieces of it, of which the first may be
    shorter; all others stay whole. The bins are those of best-fit decreasing over all pieces of the table, in whatever
    order pieces of equal length are taken. Only a histogram of at most `capacity` lengths comes to the driver. A piece's
    rank within its length is its number in its partition and the count of those before it, so no length, however common,
    meets in one task: what is summed has a row for each partition and length. Bins are filled from 0 without gaps.

    Null text is empty text (end_id alone). Null ids and repeated rows are packed like others; an empty table gives no
    pieces. Other columns are ignored. The pieces are written once to the shared folder, as ranks need them numbered once.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    pieces = materialize(cut_pieces(docs, tokenizer, capacity, end_id), "pieces")
    spark = pieces.sparkSession
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # a row for each length up to the capacity
    plan = spark.createDataFrame(best_fit_plan(histogram, capacity), PLAN)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("part", "length", before.alias("before"))
    ranked = pieces.join(offsets, ["part", "length"]).withColumn("rank", F.col("before") + F.col("local"))
    at = plan.withColumnRenamed("length", "_length")  # its size is bounded by the capacity
    own = (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("count"))
    nth = F.col("rank") - F.col("first")
    return ranked.join(F.broadcast(at), own).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids", "ids_crc32",
        (F.col("bin") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"), (F.col("filled") + F.pmod(nth, F.col("each").cast("long")) * F.col("length")).cast("long").alias("offset"))


def run(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from geohealth.llm.common import table

    out = pack_best_fit(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
