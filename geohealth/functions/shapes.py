"""Polygons from flat lists of rings, and their text for databases, as column expressions.

A zone's rings come without structure: whether one is an outer border or a hole, and of which part, follows from how many
others it lies in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of the value, which is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def closed(ring: Column) -> Column:
    """The ring with its first point at its end."""
    first, last = F.get(ring, F.lit(0)), F.get(ring, F.size(ring) - 1)
    return F.when(F.size(ring) == 0, ring).when((first["x"] == last["x"]) & (first["y"] == last["y"]), ring).otherwise(F.concat(ring, F.array(first)))


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a ray from the point crosses the ring's edges an odd number of times. An edge has its lower end, not its upper."""
    after = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    crossed = F.zip_with(ring, after, lambda a, b: ((a["y"] <= y) != (b["y"] <= y)) & (x < a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / (b["y"] - a["y"])))
    return F.size(F.filter(crossed, lambda c: c)) % 2 == 1


def polygons(rings: Column) -> Column:
    """Parts of a multi-polygon, each an outer ring and then its holes, from rings in any order.

    A ring in an even number of others is an outer border, one in an odd number a hole of the border just around it. A
    ring's place is told by the middle of its first edge, so rings may touch at corners. NULL for NULL, nothing for no rings.
    """
    middle = lambda a, b, axis: (a[axis] + b[axis]) / 2

    def marked(ring: Column) -> Column:
        a, b = F.get(ring, F.lit(0)), F.coalesce(F.get(ring, F.lit(1)), F.get(ring, F.lit(0)))
        return F.struct(ring.alias("ring"), middle(a, b, "x").alias("x"), middle(a, b, "y").alias("y"))

    def around(every: Column, one: Column, at: Column) -> Column:
        """Places of the rings that the ring lies in."""
        return F.filter(F.transform(every, lambda o, k: F.when((k != at) & in_ring(one["x"], one["y"], o["ring"]), k)), lambda k: k.isNotNull())

    def parts(known: Column) -> Column:
        """known: ring and the places of the rings around it."""
        outer = F.filter(F.transform(known, lambda r, k: F.when(F.size(r["around"]) % 2 == 0, F.struct(r["ring"].alias("ring"), k.alias("at"), F.size(r["around"]).alias("depth")))), lambda r: r.isNotNull())
        holes = lambda o: F.filter(known, lambda r: (F.size(r["around"]) == o["depth"] + 1) & F.array_contains(r["around"], o["at"]))
        return F.transform(outer, lambda o: F.concat(F.array(o["ring"]), F.transform(holes(o), lambda r: r["ring"])))

    some = F.filter(rings, lambda r: F.size(r) > 0)
    return _let(F.transform(some, marked), lambda every: _let(F.transform(every, lambda r, k: F.struct(r["ring"].alias("ring"), around(every, r, k).alias("around"))), parts))


def multipolygon_text(rings: Column, srid: int | None = None) -> Column:
    """MULTIPOLYGON(((x y, ...), ...), ...) of the rings, closed, with SRID=...; before it if there is one. Coordinates keep all digits."""
    point = lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))
    line = lambda r: F.concat(F.lit("("), F.array_join(F.transform(closed(r), point), ", "), F.lit(")"))
    part = lambda p: F.concat(F.lit("("), F.array_join(F.transform(p, line), ", "), F.lit(")"))
    body = _let(polygons(rings), lambda all_parts: F.when(F.size(all_parts) == 0, F.lit("MULTIPOLYGON EMPTY")).otherwise(F.concat(F.lit("MULTIPOLYGON("), F.array_join(F.transform(all_parts, part), ", "), F.lit(")"))))
    return F.when(rings.isNotNull(), F.concat(F.lit(f"SRID={srid};" if srid is not None else ""), body))


def rings_of_text(text: Column) -> Column:
    """The rings of a (multi-)polygon's text, in a flat list."""
    ring = F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), F.lit(1))
    number = lambda p, k: F.get(F.split(F.trim(p), r"\s+"), F.lit(k)).cast("double")
    return F.transform(ring, lambda r: F.transform(F.split(r, ","), lambda p: F.struct(number(p, 0).alias("x"), number(p, 1).alias("y"))))
