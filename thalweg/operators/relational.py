"""Scans, predicates, look-ups, searches, aggregates and windows over hydro tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed code tables.
EF_TYPES = {1: "Reach", 2: "Bank", 3: "Skeleton", 4: "Infrastructure"}
EC_TYPES = {1: "Reach", 2: "Bank", 3: "Empty", 4: "Water", 5: "BuiltUpArea"}
RANKS = {1: "Primary", 2: "Secondary"}
WATER_DEFINITIONS = {4: "Lake", 9: "Pond", 6: "River", 1: "Canal"}
#: Features that an export holds at most (a fixed value).
MOST_EXPORTED = 500_000
#: Rank and type names in the order in which greater and less compare them.
ORDINALS = {"type": ("observed", "constructed", "inferred", "bank", "unknown"), "rank": ("primary", "secondary", "unknown")}
MAX_RESULTS = 5000


def decode(code: Column, table: dict[int, str], default: str | None = None) -> Column:
    """A code's name by a fixed table; ``default`` for codes it lacks and null."""
    return reduce(lambda c, kv: c.when(code == kv[0], F.lit(kv[1])), list(table.items())[1:], F.when(code == next(iter(table)), F.lit(table[next(iter(table))]))).otherwise(F.lit(default))


# ---- predicates


def type_in(column: str, codes: list[int]) -> Column:
    return F.col(column).isin(*codes)


def predicate(column: Column, op: str, value, ordinals: tuple[str, ...] | None = None) -> Column:
    """equals, notEquals, greaterThan or lessThan, whatever the case of ``op``; a null property never fits. Names of an enumeration compare by place."""
    if ordinals:
        place = {n: i for i, n in enumerate(ordinals)}
        column, value = reduce(lambda c, n: c.when(F.lower(column) == n, place[n]), ordinals, F.when(F.lit(False), -1)), place[str(value).lower()]
    ops = {"equals": column == value, "notequals": column != value, "greaterthan": column > value, "lessthan": column < value}
    if op.lower() not in ops:
        raise ValueError(f"unknown predicate {op}")
    return F.coalesce(ops[op.lower()], F.lit(False))


def all_of(conditions: list[Column]) -> Column:
    """All conditions; true of none."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def bbox_intersects(minx: float, miny: float, maxx: float, maxy: float, prefix: str = "") -> Column:
    """Envelope columns meet a box, edges included; corners may come in any order."""
    minx, maxx, miny, maxy = min(minx, maxx), max(minx, maxx), min(miny, maxy), max(miny, maxy)
    c = lambda n: F.col(prefix + n)
    return (c("minx") <= maxx) & (c("maxx") >= minx) & (c("miny") <= maxy) & (c("maxy") >= miny)


def like_pattern(text: str, match: str = "exact") -> str:
    """A LIKE pattern for a literal text: ``exact`` or ``contains``; its own wildcards are escaped."""
    safe = text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    if match not in ("exact", "contains"):
        raise ValueError(f"unknown match type {match}")
    return f"%{safe}%" if match == "contains" else safe


def name_matches(text: str, match: str = "exact", columns: tuple[str, ...] = ("name_en", "name_fr")) -> Column:
    """Either language's name is like the text, whatever the case."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c).ilike(like_pattern(text, match)), F.lit(False)) for c in columns])


def feature_type_filter(kind: str | None) -> Column:
    """Catchments of a feature type: waterbody (type 4), catchment (all others) or any."""
    return {"waterbody": F.col("ec_type") == 4, "catchment": F.col("ec_type") != 4, None: F.lit(True)}[kind]


def find_by_id(layers: list[tuple[str, DataFrame]], wanted: int) -> DataFrame:
    """(layer, id) of a feature in the first layer that has it; no row if none has."""
    found = reduce(DataFrame.unionByName, [d.filter(F.col("id") == wanted).select(F.lit(i).alias("place"), F.lit(n).alias("layer"), "id") for i, (n, d) in enumerate(layers)])
    return found.orderBy("place").limit(1).select("layer", "id")


def guarded(df: DataFrame, most: int) -> DataFrame:
    """``df`` if it has at most so many rows, else an error."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} features")
    return df


# ---- look-ups and joins


def with_lookups(paths: DataFrame, names: DataFrame, aois: DataFrame) -> DataFrame:
    """Flowpaths with names of type, rank, both rivers (two languages) and area; small code tables are expressions, names join on their key."""
    n1 = names.select(F.col("name_id").alias("rivernameid1"), F.col("name_en").alias("river1_en"), F.col("name_fr").alias("river1_fr"))
    n2 = names.select(F.col("name_id").alias("rivernameid2"), F.col("name_en").alias("river2_en"), F.col("name_fr").alias("river2_fr"))
    out = paths.join(n1, "rivernameid1", "left").join(n2, "rivernameid2", "left").join(aois, "aoi_id", "left")
    return out.select("id", decode(F.col("ef_type"), EF_TYPES).alias("type_name"), decode(F.col("rank"), RANKS).alias("rank_name"), "river1_en", "river1_fr", "river2_en", "river2_fr", "short_name", "length")


def area_links(paths: DataFrame) -> DataFrame:
    """Distinct pairs of areas that a primary flow crosses."""
    p = paths.filter("rank = 1 AND aoi_id IS NOT NULL")
    a = p.select(F.col("from_nexus_id").alias("n"), F.col("aoi_id").alias("src"))
    b = p.select(F.col("to_nexus_id").alias("n"), F.col("aoi_id").alias("dst"))
    return a.join(b, "n").filter("src <> dst").select("src", "dst").distinct()


def used_nexuses(nexuses: DataFrame, paths: DataFrame) -> DataFrame:
    """Nexuses at either end of any of the flowpaths."""
    ends = paths.select(F.col("from_nexus_id").alias("id")).union(paths.select(F.col("to_nexus_id").alias("id")))
    return nexuses.join(ends, "id", "left_semi")


def order_view(paths: DataFrame, orders: DataFrame) -> DataFrame:
    """Flowpaths with their order properties; those without have no row."""
    return paths.join(orders, "id")


# ---- name search


def search_all(paths: DataFrame, catchments: DataFrame, names: DataFrame, text: str, match: str = "contains", most: int = MAX_RESULTS) -> DataFrame:
    """Flowpaths, then catchments, with a matching name, at most ``most`` in all."""
    hits = names.filter(name_matches(text, match)).select("name_id")
    # a row for each of a flowpath's names, so that the join is on the key
    either = paths.select("id", F.explode(F.array("rivernameid1", "rivernameid2")).alias("name_id")).join(hits, "name_id", "left_semi")
    a = either.select(F.lit(0).alias("place"), F.lit("flowpath").alias("kind"), "id").distinct()
    b = catchments.join(hits, F.col("lakenameid1") == F.col("name_id"), "left_semi").select(F.lit(1).alias("place"), F.when(F.col("ec_type") == 4, "waterbody").otherwise("catchment").alias("kind"), "id")
    return a.unionByName(b).orderBy("place", "id").limit(most).select("kind", "id")


def search_grouped(features: DataFrame, names: DataFrame, text: str, match: str = "contains", by_type: bool = False) -> DataFrame:
    """Matching features (name_id, kind, minx, miny, maxx, maxy) by name, and by type if asked: their count and extent."""
    hits = names.filter(name_matches(text, match))
    keys = ["name_id", "name_en", "name_fr"] + (["kind"] if by_type else [])
    return features.join(hits, "name_id").groupBy(*keys).agg(F.count("*").alias("n"), F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))


def name_table(layers: list[tuple[DataFrame, list[tuple[str, str]]]]) -> DataFrame:
    """Distinct (name_id, name) of every (id column, name column) of all layers, without nulls and empty names."""
    arms = [d.select(F.col(i).alias("name_id"), F.col(n).alias("name")) for d, pairs in layers for i, n in pairs]
    return reduce(DataFrame.union, arms).filter("name_id IS NOT NULL AND name IS NOT NULL AND name <> ''").distinct()


# ---- aggregates


def duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def drainage_stats(catchments: DataFrame, keys: list[str] | None = None, nulls_weigh: bool = True) -> DataFrame:
    """Area, extremes and area-weighted means of catchments by ``keys``.

    The weight of a mean is the area of all catchments of the group, those without the statistic included, unless
    ``nulls_weigh`` is false.
    """
    area = F.sum("area")
    aggs = [area.alias("area"), *(F.min(c).alias(c) for c in ("elv_min", "slope_min")), *(F.max(c).alias(c) for c in ("elv_max", "slope_max", "d2w2d_max"))]
    for c in ("elv_mean", "slope_mean", "north_pct", "south_pct", "east_pct", "west_pct", "flat_pct", "d2w2d_mean"):
        weight = area if nulls_weigh else F.sum(F.when(F.col(c).isNotNull(), F.col("area")))
        aggs.append(F.round(F.sum(F.col(c) * F.col("area")).cast("double") / weight, 6).alias(c))
    return (catchments.groupBy(*keys) if keys else catchments.groupBy()).agg(*aggs)


def catchment_orders(paths: DataFrame) -> DataFrame:
    """By catchment: greatest Strahler and Horton, least Hack, and the name of the named flowpath of greatest Horton (lowest id of equals)."""
    best = F.min_by("name", F.when(F.col("name").isNotNull(), F.struct(-F.col("horton"), F.col("id"))))
    return paths.groupBy("ecatchment_id").agg(F.max("strahler").alias("strahler"), F.max("horton").alias("horton"), F.min("hack").alias("hack"), best.alias("name"))


def node_degrees(paths: DataFrame) -> DataFrame:
    """In and out degree and counts of bank flows at each node."""
    bank = (F.col("ef_type") == 2).cast("long")
    outs = paths.select(F.col("from_nexus_id").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o"), bank.alias("b"))
    ins = paths.select(F.col("to_nexus_id").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o"), bank.alias("b"))
    return outs.union(ins).groupBy("id").agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"), F.sum("b").alias("n_bank"))


def cache_evictions(tiles: DataFrame, limit: int, spare: int) -> DataFrame:
    """Keys to delete, oldest first, until the cache is ``spare`` bytes below ``limit``; none if it isn't over the limit.

    Sizes are first summed by day, so that only days, not tiles, are ranked by one task.
    """
    day = F.date_trunc("day", "last_accessed")
    days = tiles.groupBy(day.alias("day")).agg(F.sum("size").alias("day_size"))
    w = Window.orderBy("day")
    days = days.select("day", (F.sum("day_size").over(w) - F.col("day_size")).alias("before"))
    total = tiles.agg(F.sum("size").alias("total"))
    inside = Window.partitionBy("day").orderBy("last_accessed", "key").rowsBetween(Window.unboundedPreceding, 0)
    placed = tiles.withColumn("day", day).join(days, "day").withColumn("running", F.col("before") + F.sum("size").over(inside))
    return placed.crossJoin(F.broadcast(total)).filter((F.col("total") > limit) & (F.col("running") - F.col("size") < F.col("total") - (limit - spare))).select("key", "running")


def places_in_group(rows: DataFrame, key: str, value: str, tie: str, width: int) -> DataFrame:
    """Add n, the place from 0 in the group by falling ``value``, then ``tie``; a task ranks one range of ``width`` values of a group, after the counts of higher ones."""
    ranged = rows.withColumn("_range", F.floor(F.col(value) / width))
    counts = ranged.groupBy(key, "_range").agg(F.count("*").alias("_n"))
    above = F.sum("_n").over(Window.partitionBy(key).orderBy(F.col("_range").desc())) - F.col("_n")
    before = counts.select(F.col(key).alias("_key"), F.col("_range").alias("_at"), above.alias("_before"))
    inside = F.row_number().over(Window.partitionBy(key, "_range").orderBy(F.col(value).desc(), tie)) - 1
    both = ranged.withColumn("_inside", inside).join(before, F.col(key).eqNullSafe(F.col("_key")) & F.col("_range").eqNullSafe(F.col("_at")))
    return both.withColumn("n", F.col("_before") + F.col("_inside")).drop("_range", "_inside", "_key", "_at", "_before")


def letters(n: Column) -> Column:
    """0, 1, ... as A, ..., Z, AA, ...: as many letters as the number takes (14 for the largest long)."""

    def step(s: Column, _: Column) -> Column:
        more = s["n"] >= 0
        name = F.concat(F.chr(F.lit(65) + (s["n"] % 26).cast("int")), s["name"])
        return F.struct(F.when(more, F.call_function("div", s["n"], F.lit(26)) - 1).otherwise(s["n"]).alias("n"), F.when(more, name).otherwise(s["name"]).alias("name"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(14)), F.struct(n.cast("long").alias("n"), F.lit("").alias("name")), step, lambda s: s["name"])


def most_order(catchments: DataFrame, orders: DataFrame) -> DataFrame:
    """(id, strahler): the greatest Strahler order of the flowpaths (ecatchment_id, strahler) in each catchment (id); null where none has one."""
    most = orders.groupBy(F.col("ecatchment_id").alias("id")).agg(F.max("strahler").alias("strahler"))
    return catchments.select("id").join(most, "id", "left")


def best_rank(catchments: DataFrame, paths: DataFrame) -> DataFrame:
    """(id, rank): the best rank code of the flowpaths (ecatchment_id, rank by name) in each catchment; unknown ranks don't count, null where none does."""
    code = reduce(lambda c, kv: c.when(F.lower("rank") == kv[1].lower(), kv[0]), RANKS.items(), F.when(F.lit(False), 0))
    best = paths.groupBy(F.col("ecatchment_id").alias("id")).agg(F.min(code).alias("rank"))
    return catchments.select("id").join(best, "id", "left")


def first_places(rows: DataFrame, order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows in an order that leaves no ties, with their places from 1."""
    return rows.orderBy(*order).limit(most).withColumn("place", F.row_number().over(Window.orderBy(*order)))


def equal_sets(a: DataFrame, b: DataFrame, key: str, member: str) -> DataFrame:
    """(key, equal): whether both tables have the same members of a key; false where only one has any.

    Members are compared as sets without being gathered: each (key, member) says which tables have it.
    """
    side = lambda t, n: t.select(key, member, F.lit(n).alias("_side")).distinct()
    own = side(a, 1).union(side(b, 2)).groupBy(key, member).agg(F.sum("_side").alias("_in"))
    return own.groupBy(key).agg((F.min("_in") == 3).alias("equal"))


def with_bounds(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows with the columns of a table of one row; more than one are an error."""
    found = bounds.limit(2).collect()
    if len(found) != 1:
        raise ValueError("bounds have one row")
    return rows.withColumns({c: F.lit(found[0][c]).cast(t) for c, t in bounds.dtypes})
