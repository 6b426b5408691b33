"""Classes and colours of values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLASSES = 5


def class_breaks(df: DataFrame, value: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """least, most, step (a fifth of the range), decimals (4 if the maximum is between 0 and 1, else 2): one row, or one for each layer.

    by: the columns that tell the layers of a table apart. All layers are one aggregate.
    """
    bounds = df.groupBy(*by).agg(F.min(value).alias("least"), F.max(value).alias("most"))
    decimals = F.when((F.col("most") > 0) & (F.col("most") < 1), 4).otherwise(2)
    return bounds.select(*by, "least", "most", ((F.col("most") - F.col("least")) / CLASSES).alias("step"), decimals.alias("decimals"))


def _beside(df: DataFrame, table: DataFrame, by: Sequence[str]) -> DataFrame:
    """df with the columns of its layer's row (one row for all without `by`); NULL is a layer of its own."""
    if not by:
        return df.join(F.broadcast(table))  # one row
    own = table.withColumnsRenamed({c: f"_by_{c}" for c in by})
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
    return df.join(own, on).drop(*[f"_by_{c}" for c in by])


def round_adaptively(value: Column, decimals: Column) -> Column:
    """Half up, to 4 decimals where there are to be 4, else to 2."""
    return F.when(decimals == 4, F.round(value, 4)).otherwise(F.round(value, 2))


def adaptive_round(df: DataFrame, value: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """value rounded half up to its layer's decimals."""
    one = class_breaks(df, value, by).select(*by, F.col("decimals").alias("_d"))
    return _beside(df, one, by).withColumn(value, round_adaptively(F.col(value), F.col("_d"))).drop("_d")


def equal_interval_class(df: DataFrame, value: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """class 1 to 5 and its label within the layer; a class holds its lower break. NULL values have neither."""
    exact = [F.col("least") + F.col("step") * k for k in range(1, CLASSES)]
    fine = F.col("decimals") == 4
    at = F.array(*[F.when(fine, F.round(a, 4)).otherwise(F.round(a, 2)) for a in exact]).alias("_at")
    one = class_breaks(df, value, by).select(*by, at, fine.alias("_fine")).select(
        *by, "_at", F.when(F.col("_fine"), F.transform("_at", lambda a: F.format_string("%.4f", a))).otherwise(F.transform("_at", lambda a: F.format_string("%.2f", a))).alias("_shown"))
    v, joined = F.col(value), _beside(df, one, by)
    kind = (F.size(F.filter("_at", lambda a: v >= a)) + 1).cast("int")
    shown = lambda k: F.element_at("_shown", k)
    label = F.when(kind == 1, F.concat(F.lit("Lower than "), shown(1))).when(kind == CLASSES, F.concat(F.lit("Greater than "), shown(-1)))
    label = label.otherwise(F.concat(F.lit("Between "), F.get("_shown", kind - 2), F.lit(" and "), F.get("_shown", kind - 1)))
    return joined.withColumn("class", F.when(v.isNotNull(), kind)).withColumn("label", F.when(v.isNotNull(), label)).drop("_at", "_shown")


def _palette(palette: list[tuple[float, str]]) -> Column:
    return F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.lit(c).alias("color")) for t, c in palette])


def nearest_color(value: Column, palette: list[tuple[float, str]]) -> Column:
    """Colour of the nearest threshold, the first of equally near ones; NULL for NULL."""
    ranked = F.transform(_palette(palette), lambda p, i: F.struct(F.abs(p["threshold"] - value).alias("far"), i.alias("at"), p["color"].alias("color")))
    return F.when(value.isNotNull(), F.array_min(ranked)["color"])


def bin_color(value: Column, palette: list[tuple[float, str]], clear: str = "transparent") -> Column:
    """Colour of the right-closed bin, the last one for all beyond; `clear` for NULL."""
    below = F.size(F.filter(_palette(palette), lambda p: p["threshold"] < value))
    colors = F.array(*[F.lit(c) for _, c in palette])
    return F.when(value.isNull(), F.lit(clear)).otherwise(F.get(colors, F.least(below, F.lit(len(palette) - 1))))
