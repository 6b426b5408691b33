"""Hierarchical weighted hash tree: a document descends region, rack and shard by weighted hash draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geohealth.llm.common import materialize

#: region -> rack -> shard -> weight
Tree = dict[int, dict[int, dict[int, float]]]


def shard_tree(shards: int, racks: int = 2, per_rack: int = 4, weights: dict[int, float] | None = None) -> Tree:
    """Shards 0.. laid out in regions of `racks` x `per_rack`."""
    tree: Tree = {}
    for s in range(shards):
        region, rack = s // (racks * per_rack), s // per_rack % racks
        tree.setdefault(region, {}).setdefault(rack, {})[s] = float((weights or {}).get(s, 1.0))
    return tree


def grow(tree: Tree, weight: float = 1.0) -> Tree:
    """One more shard, in a region of its own: every other node keeps its weight, so rows move into the new shard only."""
    shard = 1 + max(s for racks in tree.values() for rack in racks.values() for s in rack)
    return tree | {1 + max(tree): {0: {shard: weight}}}


def _draw(key: list[Column], level: str, weights: dict[int, float]) -> Column:
    """The child with the earliest arrival, -ln(u)/weight, u from the hash of the key, the level and the child."""
    def arrival(child: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(*key, F.lit(level), F.lit(child)), 11)
        return F.struct((-F.log((bits + F.lit(0.5)) / F.lit(float(2**53))) / F.lit(weight)).alias("at"), F.lit(child).alias("child"))

    live = {c: w for c, w in weights.items() if w > 0}
    if len(live) == 1:
        return F.lit(next(iter(live)))
    return F.array_min(F.array(*[arrival(c, w) for c, w in live.items()]))["child"]


def place(doc_id: Column, tree: Tree) -> tuple[Column, Column, Column]:
    """Column expressions of (region, rack, shard). Each draw is of the children of one node only, with their subtrees'
    weights; a change of weights moves rows only in and out of the subtrees whose weights change."""
    heft = {r: {k: sum(s.values()) for k, s in racks.items()} for r, racks in tree.items()}
    region = _draw([doc_id], "region", {r: sum(k.values()) for r, k in heft.items()})
    rack = F.coalesce(*[F.when(region == r, _draw([doc_id, F.lit(r)], "rack", k)) for r, k in heft.items() if sum(k.values()) > 0])
    shard = F.coalesce(*[
        F.when((region == r) & (rack == k), _draw([doc_id, F.lit(r), F.lit(k)], "shard", s))
        for r, racks in tree.items() for k, s in racks.items() if sum(s.values()) > 0
    ])
    return region, rack, shard


def shard_documents(docs: DataFrame, tree: Tree, grown: Tree | None = None) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, region, rack, shard, slot and grown_shard (null without `grown`).

    Only doc_id and the tree decide the shard; size is the text's UTF-8 bytes plus 16. Slots number a shard's rows from 0
    without gaps. They need no sort of a whole shard: rows are numbered within (shard, task that read them), and the
    counts of these small groups are summed up. Null text: size 16, checksum of no bytes. Null ids share one place.
    Repeated rows each get a slot of their own. An empty table gives an empty result. Other columns are ignored.
    """
    kept = docs.select("doc_id", "text")
    steps = kept.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        *[c.cast("int").alias(n) for c, n in zip(place(F.col("doc_id"), tree), ("region", "rack", "shard"))],
        (place(F.col("doc_id"), grown)[2] if grown else F.lit(None)).cast("int").alias("grown_shard"),
        F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row"),
    )
    rows = materialize(steps, "shards")
    parts = rows.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("shard", "_part").orderBy("_row")
    return (
        rows.withColumn("_within", F.row_number().over(within) - 1).join(parts, ["shard", "_part"])
        .select("doc_id", "size", "text_crc32", "region", "rack", "shard", (F.col("_before") + F.col("_within")).cast("long").alias("slot"), "grown_shard")
    )


def run(spark, sf_dir: str) -> DataFrame:
    from geohealth.llm.common import table

    tree = shard_tree(40)
    out = shard_documents(table(spark, sf_dir, "documents"), tree, grow(tree))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "region", "rack")
