"""Hydro tables derived from the star-schema tables, by rules that plain SQL repeats.

Order k >= 16 is a flowpath from node k to node k div 2: eight binary trees with outlets 8..15. Some lines of some orders are
secondary flowpaths from k to k div 3. Each order is also a catchment, a 10 x 10 square in rows of 128.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST = 16
STATS = ("elv_min", "elv_max", "elv_mean", "slope_min", "slope_max", "slope_mean", "north_pct", "south_pct", "east_pct", "west_pct", "flat_pct", "d2w2d_mean", "d2w2d_max")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_X = "CAST((k * 7919) % 3600 AS DOUBLE) / 10 - 180"
_Y = "CAST((k * 10473) % 1600 AS DOUBLE) / 10 - 80"


def flowpaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary and secondary flowpaths with code columns, names, length in hundredths and end points."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    top = orders.agg(F.max("o_orderkey").alias("top"))
    base = orders.filter(F.col("o_orderkey") >= FIRST).join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").crossJoin(F.broadcast(top))
    k = F.col("o_orderkey")
    primary = base.select(
        k.alias("id"),
        k.alias("from_nexus_id"),
        F.expr("o_orderkey div 2").alias("to_nexus_id"),
        F.when((k * 2 > F.col("top")) & (k % 5 == 0), 2).when(k % 7 == 0, 3).when(k % 13 == 0, 4).otherwise(1).cast("int").alias("ef_type"),
        (k % 3).cast("int").alias("ef_subtype"),
        F.lit(1).alias("rank"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("length"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_custkey") % 50).alias("rivernameid1"),
        F.when(F.col("o_orderpriority") == "3-MEDIUM", F.col("o_custkey") % 20).alias("rivernameid2"),
        F.col("c_nationkey").cast("long").alias("aoi_id"),
    )
    lines = table(spark, sf_dir, "lineitem").filter((F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 10 == 0) & (F.col("l_orderkey") >= 48))
    lines = lines.groupBy("l_orderkey").agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("price"))
    secondary = lines.select(
        (F.lit(10**9) + F.col("l_orderkey")).alias("id"),
        F.col("l_orderkey").alias("from_nexus_id"),
        F.expr("l_orderkey div 3").alias("to_nexus_id"),
        F.lit(1).alias("ef_type"),
        F.lit(0).alias("ef_subtype"),
        F.lit(2).alias("rank"),
        F.col("price").alias("length"),
        F.lit(None).cast("long").alias("rivernameid1"),
        F.lit(None).cast("long").alias("rivernameid2"),
        F.lit(None).cast("long").alias("aoi_id"),
    )
    return primary.unionByName(secondary)


def halved(paths: DataFrame, which: str) -> DataFrame:
    """(id, from_nexus_id, to_nexus_id, length) of flowpaths, those that ``which`` names in two parts with a nexus -id of degree 2 between; the lower part's id is -id."""
    p = paths.select("id", "from_nexus_id", "to_nexus_id", "length")
    cut, half = p.filter(which), F.expr("length div 2")
    upper = cut.select("id", "from_nexus_id", (-F.col("id")).alias("to_nexus_id"), half.alias("length"))
    lower = cut.select((-F.col("id")).alias("id"), (-F.col("id")).alias("from_nexus_id"), "to_nexus_id", (F.col("length") - half).alias("length"))
    return p.filter(f"NOT ({which})").union(upper).union(lower)


def with_points(paths: DataFrame) -> DataFrame:
    """Add the end points x1, y1, x2, y2 of a flowpath's straight line."""
    at = lambda rule, c: F.expr(rule.replace("k", c))
    return paths.select(
        "*", at(_X, "from_nexus_id").alias("x1"), at(_Y, "from_nexus_id").alias("y1"), at(_X, "to_nexus_id").alias("x2"), at(_Y, "to_nexus_id").alias("y2")
    )


def catchments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Square catchments with an area and thirteen statistics in whole numbers, null where an order has no lines."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.round(F.col("o_totalprice")).cast("long").alias("area"))
    cents = F.round(F.col("l_extendedprice")).cast("long")
    qty = F.col("l_quantity").cast("long")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.min(cents).alias("elv_min"), F.max(cents).alias("elv_max"), F.sum(cents).alias("elv_mean"), F.min(qty).alias("slope_min"), F.max(qty).alias("slope_max"), F.sum(qty).alias("slope_mean"),
        F.sum((F.col("l_returnflag") == "A").cast("long")).alias("north_pct"), F.sum((F.col("l_returnflag") == "N").cast("long")).alias("south_pct"), F.sum((F.col("l_returnflag") == "R").cast("long")).alias("east_pct"),
        F.sum((F.col("l_linestatus") == "O").cast("long")).alias("west_pct"), F.sum((F.col("l_linestatus") == "F").cast("long")).alias("flat_pct"), F.max(F.col("l_linenumber").cast("long")).alias("d2w2d_mean"), F.count("*").alias("d2w2d_max"),
    )
    k = F.col("id")
    gx, gy = (k % 128) * 10.0, F.expr("id div 128") * 10.0
    kind = F.when(k % 7 == 0, 4).when(k % 11 == 0, 2).when(k % 17 == 0, 3).otherwise(1).cast("int")
    return orders.join(lines, "id", "left").select(
        "id", kind.alias("ec_type"), (k % 4).cast("int").alias("ec_subtype"), "area", gx.alias("minx"), gy.alias("miny"), (gx + 10).alias("maxx"), (gy + 10).alias("maxy"), (k % 2 == 0).alias("is_reservoir"), *STATS
    )


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bilingual names by id."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("name_id"), F.col("p_name").alias("name_en"), F.col("p_type").alias("name_fr"))


def aois(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("aoi_id"), F.col("n_name").alias("short_name"))


def grid(spark: SparkSession, sf_dir: str, columns: int = 16) -> DataFrame:
    """An elevation grid (r, c, z); z is null where there is no data."""
    z = F.when(~F.col("p_size").isin(13, 26), F.round(F.col("p_retailprice")).cast("double"))
    return table(spark, sf_dir, "part").select(F.expr(f"p_partkey div {columns}").alias("r"), (F.col("p_partkey") % columns).alias("c"), z.alias("z"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points (id, x, y), in whole hundredths."""
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.round(e[0].cast("double") * 1000).alias("x"), F.round(e[1].cast("double") * 1000).alias("y"))


#: The same tables as DuckDB common table expressions, to stand behind WITH.
SQL = f"""
flowpaths AS (
  SELECT o_orderkey AS id, o_orderkey AS from_nexus_id, o_orderkey // 2 AS to_nexus_id,
    CASE WHEN o_orderkey * 2 > (SELECT max(o_orderkey) FROM orders) AND o_orderkey % 5 = 0 THEN 2 WHEN o_orderkey % 7 = 0 THEN 3 WHEN o_orderkey % 13 = 0 THEN 4 ELSE 1 END AS ef_type,
    CAST(o_orderkey % 3 AS INT) AS ef_subtype, 1 AS rank, CAST(round(o_totalprice * 100) AS BIGINT) AS length,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_custkey % 50 END AS rivernameid1, CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_custkey % 20 END AS rivernameid2,
    CAST(c_nationkey AS BIGINT) AS aoi_id
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderkey >= {FIRST}
  UNION ALL
  SELECT 1000000000 + l_orderkey, l_orderkey, l_orderkey // 3, 1, 0, 2, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT), NULL, NULL, NULL
  FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 10 = 0 AND l_orderkey >= 48 GROUP BY l_orderkey),
lined AS (SELECT *, {_X.replace('k', 'from_nexus_id')} AS x1, {_Y.replace('k', 'from_nexus_id')} AS y1, {_X.replace('k', 'to_nexus_id')} AS x2, {_Y.replace('k', 'to_nexus_id')} AS y2 FROM flowpaths),
line_stats AS (
  SELECT l_orderkey AS id, min(CAST(round(l_extendedprice) AS BIGINT)) AS elv_min, max(CAST(round(l_extendedprice) AS BIGINT)) AS elv_max, sum(CAST(round(l_extendedprice) AS BIGINT)) AS elv_mean,
    min(CAST(l_quantity AS BIGINT)) AS slope_min, max(CAST(l_quantity AS BIGINT)) AS slope_max, sum(CAST(l_quantity AS BIGINT)) AS slope_mean, count(*) FILTER (l_returnflag = 'A') AS north_pct,
    count(*) FILTER (l_returnflag = 'N') AS south_pct, count(*) FILTER (l_returnflag = 'R') AS east_pct, count(*) FILTER (l_linestatus = 'O') AS west_pct, count(*) FILTER (l_linestatus = 'F') AS flat_pct,
    max(CAST(l_linenumber AS BIGINT)) AS d2w2d_mean, count(*) AS d2w2d_max FROM lineitem GROUP BY 1),
catchments AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN 4 WHEN o_orderkey % 11 = 0 THEN 2 WHEN o_orderkey % 17 = 0 THEN 3 ELSE 1 END AS ec_type, CAST(o_orderkey % 4 AS INT) AS ec_subtype,
    CAST(round(o_totalprice) AS BIGINT) AS area, (o_orderkey % 128) * 10.0::DOUBLE AS minx, (o_orderkey // 128) * 10.0::DOUBLE AS miny, (o_orderkey % 128) * 10.0::DOUBLE + 10 AS maxx, (o_orderkey // 128) * 10.0::DOUBLE + 10 AS maxy,
    o_orderkey % 2 = 0 AS is_reservoir, {', '.join(STATS)}
  FROM orders LEFT JOIN line_stats ON o_orderkey = line_stats.id),
names AS (SELECT p_partkey AS name_id, p_name AS name_en, p_type AS name_fr FROM part),
aois AS (SELECT CAST(n_nationkey AS BIGINT) AS aoi_id, n_name AS short_name FROM nation),
grid AS (SELECT p_partkey // 16 AS r, p_partkey % 16 AS c, CASE WHEN p_size NOT IN (13, 26) THEN CAST(round(p_retailprice) AS DOUBLE) END AS z FROM part),
points AS (SELECT vec_id AS id, round(CAST(embedding[1] AS DOUBLE) * 1000) AS x, round(CAST(embedding[2] AS DOUBLE) * 1000) AS y FROM embeddings)
"""


def oracle(body: str, recursive: bool = False) -> str:
    """DuckDB SQL over the hydro tables: ``body`` may begin with further CTEs as ``name AS (...), ... SELECT``, marked by a leading comma."""
    return f"WITH {'RECURSIVE ' if recursive else ''}{SQL}{body}"
