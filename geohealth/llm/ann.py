"""Approximate nearest neighbours: an inverted file whose lists are scanned dimension block by dimension block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geohealth.llm.common import discard, materialize

#: Rows of a cell (the unit of work on the index side) and queries that meet it in one step.
CELL_ROWS, STEP_QUERIES = 4096, 256
#: Bounds of what the centroids and the probe are fitted on: lists, rows a list, components of all rows.
MOST_LISTS, SAMPLE_PER_LIST, SAMPLE_FLOATS = 16_384, 32, 8_000_000
#: Queries of the sample that the probe is fitted on.
TRIED = 400
FOUND = "query_id long, _query long, vec_id long, _row long, score double"


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and v (array of doubles): no nulls or non-finite components, not all zero, of the commonest length."""
    v = F.col(vector).cast("array<double>")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(good)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("v") == (lengths[0][0] if lengths else 0))


def centroids(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """k-means by direction over the sample; the lists' mean vectors."""
    rng = np.random.default_rng(seed)
    unit = (sample / np.linalg.norm(sample, axis=1, keepdims=True)).astype("f4")
    c = unit[rng.choice(len(unit), min(lists, len(unit)), replace=False)]
    for _ in range(rounds):
        own = nearest_list(unit, c)
        sums = np.zeros_like(c)
        np.add.at(sums, own, unit)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), c)
    return c.astype("f8")


def nearest_list(x: np.ndarray, means: np.ndarray) -> np.ndarray:
    return np.concatenate([(x[at : at + 4096] @ means.T).argmax(axis=1) for at in range(0, len(x), 4096)]).astype("int32")


def fitted_probe(sample: np.ndarray, means: np.ndarray, k: int, recall: float) -> float:
    """The least share of the lists, nearest first, that holds the share `recall` of the sample's own k nearest."""
    own = nearest_list(sample, means)
    near = []
    for q in range(0, min(TRIED, len(sample)), 50):
        x = sample[q : min(q + 50, TRIED, len(sample))]
        ip = x @ sample.T
        ip[np.arange(len(x)), q + np.arange(len(x))] = -np.inf
        top = np.argsort(-ip, axis=1, kind="stable")[:, : min(k, len(sample) - 1)]
        place = np.argsort(np.argsort(-(x @ means.T), axis=1, kind="stable"), axis=1)
        near.append(np.take_along_axis(place, own[top], axis=1).ravel())
    ranks = np.sort(np.concatenate(near))
    return float(ranks[int(np.ceil(recall * len(ranks))) - 1] + 1) / len(means) if len(ranks) else 1.0


def scan_cell(x: np.ndarray, x_list: np.ndarray, q: np.ndarray, probes: np.ndarray, tau: np.ndarray, block: int, epsilon: float) -> np.ndarray:
    """Inner products of rotated queries q with rotated rows x, -inf where a list isn't probed or a candidate was abandoned.

    probes: whether a query probes a list (a column for each list in the cell). After each block of dimensions the partial
    squared distance, scaled up to all of them, is tested against the distance at which the inner product would fall to
    tau; where it exceeds that by epsilon / sqrt(dimensions) the candidate is given up. A block is read for all pairs of
    a list while over a quarter of them go on, and from then on for these alone.
    """
    dims = x.shape[1]
    x2, q2 = (x * x).sum(1), (q * q).sum(1)
    out = np.full((len(q), len(x)), -np.inf)
    for one in range(probes.shape[1]):
        xi, qi = np.flatnonzero(x_list == one), np.flatnonzero(probes[:, one])
        if not len(qi) or not len(xi):
            continue
        limit = q2[qi, None] + x2[None, xi] - 2 * tau[qi, None]
        a, b = q[qi], x[xi]
        ip, sq, alive = np.zeros(limit.shape), np.zeros(limit.shape), np.ones(limit.shape, dtype=bool)
        r = c = None
        for at in range(0, dims, block):
            aa, bb, seen = a[:, at : at + block], b[:, at : at + block], min(dims, at + block)
            a2, b2 = (aa * aa).sum(1), (bb * bb).sum(1)
            bound = (1 + epsilon / seen**0.5) ** 2 * seen / dims
            if r is None:
                part = aa @ bb.T
                ip += part
                sq += a2[:, None] + b2[None, :] - 2 * part
                if seen == dims:
                    break
                alive &= sq <= limit * bound + 1e-9
                if alive.mean() <= 0.25:
                    r, c = np.nonzero(alive)
                    ip, sq, limit = ip[r, c], sq[r, c], limit[r, c]
            else:
                part = np.einsum("ij,ij->i", aa[r], bb[c])
                ip = ip + part
                sq = sq + a2[r] + b2[c] - 2 * part
                if seen < dims:
                    go = sq <= limit * bound + 1e-9
                    r, c, ip, sq, limit = r[go], c[go], ip[go], sq[go], limit[go]
        if r is None:
            out[np.ix_(qi, xi)] = np.where(alive, ip, -np.inf)
        else:
            out[qi[r], xi[c]] = ip
    return out


def search(vectors: DataFrame, queries, k: int = 20, vector: str = "embedding", recall: float = 0.97, block: int = 16, epsilon: float = 1.6) -> DataFrame:
    """The k rows of the largest inner product of each query: query_id, rank (from 1), vec_id, score.

    queries is a condition on vec_id; candidates are all rows but the query's own. The index holds every row, rotated
    once, in 2 * sqrt(rows) lists (at most MOST_LISTS); its centroids are fitted on at most SAMPLE_PER_LIST rows a list
    (and SAMPLE_FLOATS components) in the order of a hash. The share of the lists that each query probes, nearest first,
    is the least that holds `recall` of the nearest rows within that sample, so it is small where vectors have clusters
    and large where they have none. The nearest lists come first; the k-th best score there is the bound that the scan of
    the others tests against. A query that has fewer than k rows then goes on with all other lists.

    Neighbouring lists are put in cells of CELL_ROWS rows and large ones, such as a vector with very many copies, are dealt
    to several by a hash. The index is shuffled by cell once; within a task a cell's rows come before the queries that are
    routed to it, which then stream past it: a task holds the rows of one cell and STEP_QUERIES queries, however many there are.

    Scores are sums in double precision over the original components; ties go to the smaller vec_id. Vectors that are
    null, zero, of another length than the commonest, or hold null or non-finite components take no part, nor do rows
    with null vec_id. Rows with the same vec_id are different rows: each is a candidate and, if it is a query, has ranks
    of its own. Tables of fewer than k candidates give all of them; empty tables give no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = materialize(usable(vectors, vector).withColumn("_row", F.monotonically_increasing_id()), "vectors")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = rows.select(F.size("v")).first()[0]
    lists = int(min(MOST_LISTS, max(1, 2 * n**0.5)))
    fitted = max(1, min(lists * SAMPLE_PER_LIST, SAMPLE_FLOATS // dims))
    sample = rows.orderBy(F.xxhash64("_row"), "_row").limit(fitted).select("v").toArrow()
    sample = sample.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dims)
    means = centroids(sample, min(lists, max(1, len(sample) // 4)))
    means = means[np.argsort(means @ means[0], kind="stable")]  # neighbours have near numbers
    lists = len(means)
    take = max(1, int(np.ceil(fitted_probe(sample, means, k, recall) * lists)))
    rotation = np.linalg.qr(np.random.default_rng(11).standard_normal((dims, dims)))[0]
    del sample

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = matrix(b.column("v"))
                blobs = [pa.array([r.tobytes() for r in m], pa.binary()) for m in (x, (x @ rotation).astype("f4"))]
                yield pa.record_batch([pa.array(nearest_list(x, means)), b.column("vec_id"), b.column("_row"), *blobs], names=["list", "vec_id", "_row", "vec", "turned"])

    index = materialize(rows.mapInArrow(assign, "list int, vec_id long, _row long, vec binary, turned binary"), "index")
    # a list's cell: neighbours share one while they have room together; a large list has `parts` of its own
    held = np.zeros(lists, dtype=np.int64)
    for one, count in index.groupBy("list").count().collect():  # at most MOST_LISTS rows
        held[one] = count
    parts = np.maximum(1, -(-held // CELL_ROWS))
    first, at, room = np.zeros(lists, dtype=np.int64), -1, 0
    for one in range(lists):
        if held[one] > room:
            at, room = at + 1, CELL_ROWS
        first[one] = at
        if parts[one] > 1:
            at, room = at + int(parts[one]) - 1, 0
        else:
            room -= int(held[one])
    layout = spark.createDataFrame(pd.DataFrame({"list": np.arange(lists), "first": first, "parts": parts}), "list int, first long, parts long")
    index = index.join(F.broadcast(layout), "list").select((F.col("first") + F.pmod(F.xxhash64("_row"), F.col("parts"))).alias("cell"), "list", "vec_id", "_row", "vec", "turned")

    asked = rows.where(queries(F.col("vec_id")))

    def route(near: int, far: int):
        """Queries with the cells that hold the lists from the near-th to before the far-th of theirs."""
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for start in range(0, b.num_rows, 512):
                    some = b.slice(start, 512)
                    x = matrix(some.column("v"))
                    order = np.argsort(-(x @ means.T), axis=1, kind="stable")[:, near:far]
                    out: list[tuple] = []
                    for i, (vec_id, row) in enumerate(zip(some.column("vec_id").to_pylist(), some.column("_row").to_pylist())):
                        by: dict[int, list[int]] = {}
                        for one in order[i].tolist():
                            for c in range(first[one], first[one] + parts[one]):
                                by.setdefault(c, []).append(one)
                        blob = x[i].tobytes()
                        out += [(c, vec_id, row, blob, ls) for c, ls in by.items()]
                    if out:
                        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32())]
                        yield pa.record_batch([pa.array(v, t) for v, t in zip(zip(*out), kinds)], names=["cell", "query_id", "_query", "q", "probes"])
        return work

    def scan(cell: tuple, some: pa.RecordBatch) -> pa.RecordBatch:
        """The k best rows of a cell for each of some queries."""
        x, turned, ids, own, x_list, number = cell
        q = np.frombuffer(b"".join(some.column("q").to_pylist()), dtype="f8").reshape(-1, dims)
        asks = some.column("_query").to_numpy()
        tau = some.column("tau").to_numpy(zero_copy_only=False).astype("f8")
        tau = np.where(np.isfinite(tau), tau, -1e18)
        probes = np.zeros((len(q), len(number)), dtype=bool)
        for i, ls in enumerate(some.column("probes").to_pylist()):
            probes[i, [number[one] for one in ls if one in number]] = True
        near = scan_cell(turned, x_list, (q @ rotation).astype("f4"), probes, tau, block, epsilon)
        slack = 1e-5 * np.abs(near[np.isfinite(near)]).max(initial=1.0)  # rotated components are single precision
        near[near < tau[:, None] - slack] = -np.inf
        near[asks[:, None] == own[None, :]] = -np.inf
        least = np.full(len(q), -np.inf)
        if near.shape[1] > k:
            least = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
        r, c = np.nonzero((near >= least[:, None] - 2 * slack) & np.isfinite(near))
        score = (q[r] * x[c]).sum(axis=1)
        order = np.lexsort((own[c], ids[c], -score, r))
        r, c, score = r[order], c[order], score[order]
        good = np.arange(len(r)) - np.searchsorted(r, r) < k
        r, c, score = r[good], c[good], score[good]
        return pa.record_batch([pa.array(a) for a in (some.column("query_id").to_numpy()[r], asks[r], ids[c], own[c], score)], names=[c.split()[0] for c in FOUND.split(", ")])

    def gathered(rows: list[pa.RecordBatch]) -> tuple:
        """A cell's rows: vectors, rotated vectors, vec_id, _row, place of their list, and the place of each list."""
        t = pa.Table.from_batches(rows)
        x, turned = (np.frombuffer(b"".join(t.column(c).to_pylist()), dtype=d).reshape(-1, dims) for c, d in (("vec", "f8"), ("turned", "f4")))
        here, x_list = np.unique(t.column("list").to_numpy(), return_inverse=True)
        return x, turned, t.column("vec_id").to_numpy(), t.column("_row").to_numpy(), x_list, {one: i for i, one in enumerate(here.tolist())}

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by cell, those of the index before the queries."""
        now, held, cell = None, [], None
        for b in batches:
            cells, asks = b.column("cell").to_numpy(), b.column("asks").to_numpy()
            cuts = [0, *(np.flatnonzero((cells[1:] != cells[:-1]) | (asks[1:] != asks[:-1])) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if cells[lo] != now:
                    now, held, cell = cells[lo], [], None
                if not asks[lo]:
                    held.append(b.slice(lo, hi - lo))
                elif held:
                    cell = cell or gathered(held)
                    for at in range(lo, hi, STEP_QUERIES):
                        yield scan(cell, b.slice(at, min(STEP_QUERIES, hi - at)))

    best = Window.partitionBy("_query").orderBy(F.desc("score"), "vec_id", "_row")
    none = lambda kind, *names: [F.lit(None).cast(kind).alias(n) for n in names]
    side = index.select("cell", F.lit(0).alias("asks"), "list", "vec_id", "_row", "vec", "turned", *none("long", "query_id", "_query"), *none("binary", "q"), *none("array<int>", "probes"), *none("double", "tau"))

    def probed(asking: DataFrame, near: int, far: int, top: DataFrame | None) -> DataFrame:
        """The k best of each query within the lists from near to far, and in `top`."""
        routed = asking.mapInArrow(route(near, far), "cell long, query_id long, _query long, q binary, probes array<int>")
        if top is None:
            routed = routed.select("*", *none("double", "tau"))
        else:
            routed = routed.join(top.where(F.col("rank") == k).select("_query", F.col("score").alias("tau")), "_query", "left")
        routed = routed.select("cell", F.lit(1).alias("asks"), *none("int", "list"), *none("long", "vec_id", "_row"), *none("binary", "vec", "turned"), "query_id", "_query", "q", "probes", "tau")
        got = side.unionByName(routed).repartition("cell").sortWithinPartitions("cell", "asks").mapInArrow(meet, FOUND)
        got = got if top is None else got.unionByName(top.drop("rank"))
        return materialize(got.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "nearest")

    asking = asked.select("vec_id", "_row", "v")
    ahead = min(take, max(1, int(lists**0.5 / 2)))
    top = probed(asking, 0, ahead, None)
    if take > ahead:
        early, top = top, probed(asking, ahead, take, top)
        discard(early)
    if take < lists:
        enough = top.where(F.col("rank") == k).select(F.col("_query").alias("_row"))
        few = materialize(asking.join(enough, "_row", "left_anti").select("vec_id", "_row", "v"), "few")
        if not few.isEmpty():
            early, top = top, probed(few, take, lists, top)
    return top.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def run(spark, sf_dir: str) -> DataFrame:
    from geohealth.llm.common import table

    return search(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)
