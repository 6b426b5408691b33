"""Helpers that several operators share: scratch tables, input tables, text normalisation."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_own: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Local sessions without one (tests) get one of their own; on a cluster it must be set."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="spark-scratch-"))
        conf = _own[0]
    return conf.rstrip("/")


def _folder(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: the lineage is cut, and a lost executor costs no recomputation.

    The table is deleted when the application ends, or earlier by discard().
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/geohealth/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    files, folder = _folder(spark, path)
    files.deleteOnExit(folder)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of materialize() that nothing reads any more."""
    for t in tables:
        files, folder = _folder(t.sparkSession, t._scratch)
        files.delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as it takes to clash with no column of df."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. lower() does just that for a text of ASCII alone; beyond it translate() does, whatever letters lower() knows."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def crc_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo: the rule that holds rows out of training. Null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of the value, which is computed once however often the body uses it (also within its lambdas)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def labelled_rows(docs: DataFrame, labels: DataFrame, column: str, modulus: int, held: int, rows: int, chars: int = 16_000_000, longest: int = 1_000_000) -> DataFrame:
    """At most `rows` rows of text and label for training, none of them held out, in one partition and in order.

    The ids come from the small labels table in the order of a hash, so that the sample is the same in every run and at
    most `rows` ids are broadcast to the scan of the documents. Null labels, ids and texts take no part. Texts are taken
    whole, in that order, as long as they have `chars` characters together; texts over `longest` are left to others.
    """
    picked = (
        labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
        .where(crc_bucket(F.col("doc_id"), modulus) != held)
        .groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    found = docs.where(F.length("text") <= longest).select("doc_id", "text").join(F.broadcast(picked), "doc_id")  # `rows` ids at most
    first = found.withColumn("_at", F.xxhash64("doc_id")).orderBy("_at", "doc_id", "text").limit(rows)
    so_far = Window.orderBy("_at", "doc_id", "text").rowsBetween(Window.unboundedPreceding, 0)  # over `rows` rows at most
    return first.withColumn("_chars", F.sum(F.length("text")).over(so_far)).where(F.col("_chars") <= chars).select("text", "label")


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, modulus: int, held: int, rows: int, **bounds: int) -> list[tuple[str, int]]:
    """The rows of labelled_rows(), here."""
    return [(r[0], r[1]) for r in labelled_rows(docs, labels, column, modulus, held, rows, **bounds).collect()]
