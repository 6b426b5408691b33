"""Benchmark decontamination: a prefix-filtered set join of word shingles, verified over item-sized windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geohealth.llm.common import ascii_lower, discard, materialize, unused

#: A word of lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bits of the filter of prefix shingles: FILTER_SHARE for each, within these bounds (2 MB at most).
FILTER_SHARE, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 24
#: Prefixes that are broadcast at most; more are joined by a shuffle whose keys are salted.
BROADCAST_PREFIXES, SALTS = 200_000, 16


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _shingle(array: Column, at: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(array, at + k) for k in range(length)])


def _shingles(array: Column, size: Column, length: int) -> Column:
    return F.transform(F.sequence(F.lit(0), size - length), lambda i: _shingle(array, i, length))


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """item_id and the text of each of its windows: `window` consecutive words, or all words of a shorter item."""
    w = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - window, F.lit(0))
    return w.select("item_id", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("w", i + 1, window), " "))).alias("win")).distinct()


def prefixes(windows: DataFrame, shingle: int) -> DataFrame:
    """Each distinct window with its rarest shingle: h (hash), at (words before it), len (words of the window).

    A window is contained only where all its shingles are, so one prefix token, the first in the order of rarity, is
    enough. Rarity is the count of the benchmark's windows that hold the shingle; ties go by hash. A window shorter than
    a shingle is one shingle.
    """
    wins = windows.select("win").distinct().select("win", F.split("win", " ").alias("w")).withColumn("len", F.size("w"))
    lengths = sorted({min(shingle, r[0]) for r in wins.select("len").distinct().collect()})  # at most `shingle` values
    parts = [
        wins.where(F.least(F.col("len"), F.lit(shingle)) == k)
        .select("win", "len", F.posexplode(_shingles(F.col("w"), F.col("len"), k)).alias("at", "h"))
        .withColumn("k", F.lit(k))
        for k in lengths
    ]
    if not parts:
        return wins.select("win", "len", F.lit(0).alias("at"), F.lit(0).cast("long").alias("h"), F.lit(0).alias("k")).where(F.lit(False))
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    rarity = every.groupBy("k", "h").agg(F.count(F.lit(1)).alias("n"))
    ranked = every.join(rarity, ["k", "h"]).groupBy("win", "len").agg(F.min(F.struct("n", "h", "at", "k")).alias("m"))
    return ranked.select("win", "len", "m.at", "m.h", "m.k")


def _filter(prefix: DataFrame, bits: int) -> Column:
    """A literal array of bits / 64 longs with the bit of each prefix shingle."""
    bit = F.col("h").bitwiseAND(F.lit(bits - 1))
    got = prefix.groupBy(F.shiftright(bit, 6).alias("i")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast((h & {bits - 1}L) & 63 as int))")).alias("bits"))
    filled = dict(got.collect())  # at most bits / 64 rows
    return F.expr(f"cast(split('{','.join(str(filled.get(i, 0)) for i in range(bits // 64))}', ',') as array<bigint>)")


def scan(docs: DataFrame, prefix: DataFrame, window: int, shingle: int) -> DataFrame:
    """A row for each row of docs: doc_id, th (hash of the text), n (words) and found: the places of shingles that the filter lets through."""
    count = prefix.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (FILTER_SHARE * count).bit_length()))
    kinds = [r[0] for r in prefix.select("k").distinct().collect()]  # at most `shingle` values
    table = _filter(prefix, bits)
    base = docs.select("doc_id", F.xxhash64("text").alias("th"), words(F.col("text")).alias("w")).withColumn("n", F.size("w"))

    def candidates(k: int) -> Column:
        reach = window - k

        def maybe(x: Column) -> Column:
            b = x["h"].bitwiseAND(F.lit(bits - 1))
            return F.call_function("shiftright", F.get(table, F.shiftright(b, 6).cast("int")), b.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

        at = F.transform(F.sequence(F.lit(0), F.col("n") - k), lambda i: F.struct(i.alias("i"), _shingle(F.col("w"), i, k).alias("h")))
        # only the words that a window around the shingle can have go on with it
        near = F.transform(F.filter(at, maybe), lambda x: F.struct(
            x["i"].alias("i"), x["h"].alias("h"), F.greatest(x["i"] - reach, F.lit(0)).alias("from"),
            F.slice("w", F.greatest(x["i"] - reach, F.lit(0)) + 1, 2 * reach + k).alias("ctx"),
            F.lit(k).alias("k")))
        return F.when(F.col("n") >= k, near)

    none = F.array().cast("array<struct<i:int,h:bigint,from:int,ctx:array<string>,k:int>>")
    found = F.concat(*[F.coalesce(candidates(k), none) for k in kinds]) if kinds else none
    return base.select("doc_id", "th", "n", found.alias("found"))


def overlaps(scanned: DataFrame, prefix: DataFrame) -> DataFrame:
    """Every occurrence of a window in a document: doc_id, th, start (word), len, win.

    Few prefixes are broadcast. More are joined by a shuffle: a shingle that stands everywhere, such as a common word that
    is an item by itself, is dealt to SALTS keys.
    """
    c = scanned.where(F.size("found") > 0).select("doc_id", "th", "n", F.explode("found").alias("x")).select("doc_id", "th", "n", "x.*")
    start = F.col("i") - F.col("at")
    fits = (start >= 0) & (start + F.col("len") <= F.col("n"))  # the bounds of length and position
    same = F.array_join(F.slice("ctx", start - F.col("from") + 1, F.col("len")), " ") == F.col("win")
    if prefix.count() <= BROADCAST_PREFIXES:
        met = c.join(F.broadcast(prefix), ["h", "k"])
    else:
        salted = prefix.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = c.withColumn("salt", F.pmod(F.xxhash64("doc_id", "th", "i"), F.lit(SALTS)).cast("int")).join(salted, ["h", "k", "salt"])
    return met.where(fits).where(same).select("doc_id", "th", start.alias("start"), "len", "win")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, items (sorted ids as strings), contaminated.

    Words of an occurrence are hit; occurrences that overlap count a word once. Null text and items without words take no
    part; a document without words has none hit. Null doc_ids are scored like others; rows with equal id and text share
    their result, each in a row of its own. An item whose id is null counts for hits and is not listed. Empty tables give
    no hits or no rows. Texts are read once, whole, in time in proportion to their length. Other columns are ignored.
    """
    wins = materialize(item_windows(benchmark, window), "windows")
    prefix = materialize(prefixes(wins, shingle), "prefixes")
    scanned = materialize(scan(docs, prefix, window, shingle), "scanned")
    hit = materialize(overlaps(scanned, prefix), "overlaps")
    key = ["doc_id", "th"]
    order = Window.partitionBy(*key).orderBy("start", "end")
    spans = hit.select(*key, "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    reached = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    merged = spans.withColumn("new", F.greatest(F.col("end") - F.greatest(reached, F.col("start")), F.lit(0)))
    counts = merged.groupBy(*key).agg(F.sum("new").alias("n_hit"))
    items = hit.select(*key, "win").distinct().join(wins, "win").groupBy(*key).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    got = counts.withColumnsRenamed({"doc_id": "_id", "th": "_th"}).join(items.withColumnsRenamed({"doc_id": "_id2", "th": "_th2"}), F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_th") == F.col("_th2")), "left")
    rows = scanned.select("doc_id", "th", F.col("n").cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.join(got, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs (all columns) without the contaminated rows.

    Null and empty texts hold no window and stay, as do null ids; repeated rows stay or go together. An empty table gives
    an empty one, and without a benchmark all rows stay.
    """
    prefix = materialize(prefixes(item_windows(benchmark, 10), 5), "prefixes")
    own, th = unused(docs, "_id"), unused(docs, "_th")
    scanned = materialize(scan(docs, prefix, 10, 5), "scanned")  # whose places are worked out once
    hit = overlaps(scanned, prefix).select(F.col("doc_id").alias(own), F.col("th").alias(th)).distinct()
    hit = materialize(hit, "hit")
    discard(scanned)
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col(own)) & (F.xxhash64("text") == F.col(th)), "left_anti")


def run(spark, sf_dir: str) -> DataFrame:
    from geohealth.llm.common import table

    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


SQL = r"""
WITH d AS (
  SELECT rowid_ AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT row_number() OVER () AS rowid_, doc_id, text FROM documents)
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, array_to_string(w[i : least(i + 9, len(w))], ' ') AS win, least(10, len(w)) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM iw), dw AS (
  SELECT rid, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hit AS (SELECT dw.rid, dw.i, dw.n, iw.item_id FROM dw JOIN iw USING (win)),
hw AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw ON d.rid = hw.rid LEFT JOIN it ON d.rid = it.rid
"""
