"""The driver's tables seen as the domain's: the same arithmetic in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geohealth.operators.zones import Grid

GRID = Grid(0.0, 0.0, 1.0)
STATION_GRID = Grid(0.25, 0.5, 1.0)
COLUMNS, ROWS = 15, 10
#: Breaks exact ties of rounding, which engines resolve differently.
NUDGE = 3e-7


def r4(c: Column) -> Column:
    return F.round(c + NUDGE, 4)


def sql_r4(x: str) -> str:
    return f"round({x} + 3e-7, 4)"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def obs(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select("event_id", "user_id", (F.col("user_id") % 25).alias("zone_id"), F.to_date("ts").alias("day"), "ts", "event_type", "value")


SQL_OBS = "obs AS (SELECT event_id, user_id, user_id % 25 AS zone_id, CAST(ts AS DATE) AS day, ts, event_type, value FROM events)"


def cells(spark: SparkSession, d: str) -> DataFrame:
    o = obs(spark, d)
    return o.select("day", (F.col("user_id") % COLUMNS).cast("int").alias("i"), (F.floor(F.col("user_id") / COLUMNS) % ROWS).cast("int").alias("j"), "value", "event_type")


SQL_CELLS = f"{SQL_OBS}, cells AS (SELECT day, CAST(user_id % 15 AS INTEGER) AS i, CAST((user_id // 15) % 10 AS INTEGER) AS j, value, event_type FROM obs)"


def cases(spark: SparkSession, d: str) -> DataFrame:
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).select("o_orderkey", F.col("c_nationkey").cast("long").alias("code"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("value"))


SQL_CASES = "cases AS (SELECT o_orderkey, CAST(c_nationkey AS BIGINT) AS code, CAST(o_orderdate AS DATE) AS day, o_totalprice AS value FROM orders JOIN customer ON o_custkey = c_custkey)"


def daily(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select((F.col("l_suppkey") % 25).alias("zone_id"), F.to_date("l_shipdate").alias("day"), F.col("l_quantity").alias("value"), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount", "l_tax")


SQL_DAILY = "daily AS (SELECT l_suppkey % 25 AS zone_id, CAST(l_shipdate AS DATE) AS day, l_quantity AS value, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_discount, l_tax FROM lineitem)"


def stations(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(k.alias("code"), ((k % COLUMNS) + 0.25).alias("lon"), (F.floor(k / COLUMNS) % ROWS + 0.5).alias("lat"), F.col("s_acctbal").alias("value"), F.col("s_nationkey").cast("long").alias("nation"))


SQL_STATIONS = "stations AS (SELECT s_suppkey AS code, CAST((s_suppkey % 15) + 0.25 AS DOUBLE) AS lon, CAST((s_suppkey // 15) % 10 + 0.5 AS DOUBLE) AS lat, s_acctbal AS value, CAST(s_nationkey AS BIGINT) AS nation FROM supplier)"


def station_points(spark: SparkSession) -> DataFrame:
    """The points of STATION_GRID."""
    ij = spark.range(COLUMNS * ROWS).select((F.col("id") % COLUMNS).cast("int").alias("i"), F.floor(F.col("id") / COLUMNS).cast("int").alias("j"))
    return ij.withColumn("lon", F.col("i") + F.lit(0.25)).withColumn("lat", F.col("j") + F.lit(0.5))


SQL_POINTS = "points AS (SELECT CAST(a.i AS INTEGER) AS i, CAST(b.j AS INTEGER) AS j, a.i + 0.25::DOUBLE AS lon, b.j + 0.5::DOUBLE AS lat FROM range(15) a(i), range(10) b(j))"
SQL_IDW = f"{SQL_STATIONS}, {SQL_POINTS}, idw AS (SELECT i, j, sum(w * value) / sum(w) AS value FROM (SELECT i, j, s.value, CASE WHEN p.lon = s.lon AND p.lat = s.lat THEN 1e12 ELSE 1 / ((p.lon - s.lon) ** 2 + (p.lat - s.lat) ** 2) END AS w FROM points p, stations s) GROUP BY i, j)"

#: Corners of a zone's polygon from its south-west corner; odd zones are concave at the fourth.
CORNERS = [(0.2, 0.3), (2.7, 0.1), (2.9, 1.8), (1.45, 1.95), (0.1, 1.7)]
DENT = (1.45, 0.85)


def zones(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey").cast("long")
    x, y = (k % 5) * 3.0, F.floor(k / 5) * 2.0
    points = [F.struct((x + dx).alias("x"), (y + (F.when(k % 2 == 1, DENT[1]).otherwise(dy) if n == 3 else F.lit(dy))).alias("y")) for n, (dx, dy) in enumerate(CORNERS)]
    return table(spark, d, "nation").select(k.alias("zone_id"), F.col("n_name").alias("name"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("uf"), F.array(F.array(*points)).alias("rings"))


SQL_ZONES = """corners AS (SELECT n_nationkey::BIGINT AS zone_id, p, (n_nationkey % 5) * 3.0::DOUBLE + dx AS x, (n_nationkey // 5) * 2.0::DOUBLE + CASE WHEN p = 3 AND n_nationkey % 2 = 1 THEN 0.85 ELSE dy END AS y
  FROM nation, (VALUES (0, 0.2::DOUBLE, 0.3::DOUBLE), (1, 2.7, 0.1), (2, 2.9, 1.8), (3, 1.45, 1.95), (4, 0.1, 1.7)) v(p, dx, dy)),
edges AS (SELECT a.zone_id, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM corners a JOIN corners b ON a.zone_id = b.zone_id AND b.p = (a.p + 1) % 5),
ij AS (SELECT CAST(a.i AS INTEGER) AS i, CAST(b.j AS INTEGER) AS j, a.i + 0.5::DOUBLE AS cx, b.j + 0.5::DOUBLE AS cy FROM range(-1, 17) a(i), range(-1, 12) b(j)),
inside AS (SELECT zone_id, i, j FROM edges, ij WHERE (y1 <= cy) <> (y2 <= cy) GROUP BY zone_id, i, j HAVING count(*) FILTER (WHERE x1 + (cy - y1) * (x2 - x1) / (y2 - y1) > any_value_cx(cx)) % 2 = 1),
touched AS (SELECT DISTINCT zone_id, i, j FROM edges, ij WHERE least(x1, x2) <= cx + 0.5 AND greatest(x1, x2) >= cx - 0.5 AND least(y1, y2) <= cy + 0.5 AND greatest(y1, y2) >= cy - 0.5
  AND abs((x2 - x1) * (cy - y1) - (y2 - y1) * (cx - x1)) <= (abs(x2 - x1) + abs(y2 - y1)) / 2),
members AS (SELECT * FROM inside UNION SELECT * FROM touched)""".replace("any_value_cx(cx)", "cx")

#: A zone far from all cells, beside those of the table.
FAR = 99


def zones_with_far(spark: SparkSession, d: str) -> DataFrame:
    every = zones(spark, d)
    shifted = F.transform("rings", lambda ring: F.transform(ring, lambda p: F.struct((p["x"] + 1000).alias("x"), p["y"].alias("y"))))
    return every.unionByName(every.where("zone_id = 0").select(F.lit(FAR).cast("long").alias("zone_id"), F.lit("FAR").alias("name"), "uf", shifted.alias("rings")))


SQL_FAR = f"layer AS (SELECT CAST(n_nationkey AS BIGINT) AS zone_id FROM nation UNION ALL SELECT CAST({FAR} AS BIGINT))"


def intervals(spark: SparkSession, d: str) -> DataFrame:
    """A custom calendar over the observations: seven days of every ten."""
    span = obs(spark, d).agg(F.min("day").alias("a"), F.max("day").alias("b"))
    k = span.select(F.posexplode(F.sequence("a", "b", F.expr("interval 10 days"))).alias("k", "start_date"))
    return k.select("start_date", F.date_add("start_date", 6).alias("end_date"), (F.col("k") + 1).alias("number"))


#: Needs obs.
SQL_INTERVALS = "cal AS (SELECT CAST(a + CAST(10 * k AS INTEGER) AS DATE) AS a, CAST(a + CAST(10 * k + 6 AS INTEGER) AS DATE) AS b, CAST(k + 1 AS INTEGER) AS number FROM (SELECT a, unnest(range((b - a) // 10 + 1)) AS k FROM (SELECT min(day) AS a, max(day) AS b FROM obs)))"

SUNDAY = "({0} - CAST(dayofweek({0}) AS INTEGER))"


def sql_sunday(d: str) -> str:
    """The Sunday on or before a day, in SQL."""
    return f"CAST({SUNDAY.format(d)} AS DATE)"


def sql_epi_year(d: str) -> str:
    return f"CAST(year({sql_sunday(d)} + 3) AS INTEGER)"


def sql_epi_week(d: str) -> str:
    """Counted in weeks from the week of 4 January."""
    first = f"make_date(year({sql_sunday(d)} + 3), 1, 4)"
    return f"CAST(({sql_sunday(d)} - {sql_sunday(first)}) // 7 + 1 AS INTEGER)"
