"""Runs over a growing input that each take what is new, and count only once their output is complete.

A folder holds data/run=N, the output of run N, and manifest/run=N, the keys that it took. The manifest is written last:
a run without a finished manifest hasn't happened, whatever it left behind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from geohealth.operators.imagery import pending
from geohealth.sources.scratch import file_system, stored


def _runs(spark: SparkSession, path: str, kind: str) -> dict[int, bool]:
    """Run number -> whether it was written to its end."""
    files, folder = file_system(spark, f"{path}/{kind}")
    if not files.exists(folder):
        return {}
    names = [f.getPath() for f in files.listStatus(folder) if f.getPath().getName().startswith("run=")]
    return {int(p.getName().removeprefix("run=")): files.exists(file_system(spark, p.toString() + "/_SUCCESS")[1]) for p in names}


def finished_runs(spark: SparkSession, path: str) -> list[int]:
    return sorted(n for n, done in _runs(spark, path, "manifest").items() if done)


def _read(spark: SparkSession, path: str, kind: str) -> DataFrame | None:
    runs = finished_runs(spark, path)
    return spark.read.option("basePath", f"{path}/{kind}").parquet(*[f"{path}/{kind}/run={n}" for n in runs]) if runs else None


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """The keys of all finished runs, with their run; None before the first."""
    return _read(spark, path, "manifest")


def read_output(spark: SparkSession, path: str) -> DataFrame | None:
    """The output of all finished runs, with its run; None before the first."""
    return _read(spark, path, "data")


def run_pending(inputs: DataFrame, path: str, work: Callable[[DataFrame], DataFrame], key: str = "item") -> int | None:
    """Apply work to the inputs whose key no finished run has taken; the run's number, or None if there is nothing new.

    Which keys a run takes is stored first, so that output and manifest agree even while the input grows. A run that was
    stopped leaves nothing that is read, and its keys are taken again by the next one, which clears it away. Runs must
    follow each other, not overlap. Rows without a key can't be remembered and are left out.
    """
    spark = inputs.sparkSession
    done = finished_runs(spark, path)
    for kind in ("data", "manifest"):
        for n in set(_runs(spark, path, kind)) - set(done):
            files, folder = file_system(spark, f"{path}/{kind}/run={n}")
            files.delete(folder, True)
    known = inputs.where(inputs[key].isNotNull())
    new = known if not done else pending(known, read_manifest(spark, path), key)
    taken = stored(new.select(key).distinct(), "pending")
    if not taken.limit(1).count():
        return None
    run = done[-1] + 1 if done else 0
    work(known.join(taken, key, "left_semi")).write.parquet(f"{path}/data/run={run}")
    taken.write.parquet(f"{path}/manifest/run={run}")  # from here on the run counts
    return run
