"""Pourpoints: points on flowpaths, what they drain and how they lie to each other.

Points are rows (point, edge): the flowpath that a point stands on. Results come in long form (from, to, value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thalweg.operators.components import connected_components
from thalweg.operators.network import catchment_links, flow_links, primary, reachable
from thalweg.operators.spatial import nearest
from thalweg.session import stage_table


def crowded(points: DataFrame) -> DataFrame:
    """Flowpaths with more than one point, which later steps don't allow."""
    return points.groupBy("edge").agg(F.count("*").alias("n")).filter("n > 1")


def reach(paths: DataFrame, points: DataFrame) -> DataFrame:
    """(point, node, least, most): every node downstream of a point with the shortest and longest way from the lower end of its flowpath.

    Rounds go on until no range widens. On a cycle ranges never settle: more rounds than there are flowpaths are an error.
    """
    links = stage_table(paths.select(F.col("from_nexus_id").alias("src"), F.col("to_nexus_id").alias("dst"), "length"), "links")
    known = changed = stage_table(
        points.join(paths, F.col("edge") == F.col("id")).select("point", F.col("to_nexus_id").alias("node"), F.lit(0).cast("long").alias("least"), F.lit(0).cast("long").alias("most")), "pp-reach"
    )
    for _ in range(links.count() + 2):
        offers = changed.join(links, F.col("node") == F.col("src")).groupBy("point", F.col("dst").alias("node")).agg(F.min(F.col("least") + F.col("length")).alias("a"), F.max(F.col("most") + F.col("length")).alias("b"))
        merged = offers.join(known, ["point", "node"], "left").filter("least IS NULL OR a < least OR b > most")
        changed = stage_table(merged.select("point", "node", F.least("a", F.coalesce("least", "a")).alias("least"), F.greatest("b", F.coalesce("most", "b")).alias("most")), "pp-reach")
        if changed.isEmpty():
            return known
        known = stage_table(known.union(changed).groupBy("point", "node").agg(F.min("least").alias("least"), F.max("most").alias("most")), "pp-reach")
    raise ValueError("ranges don't settle: flowpaths make a cycle")


def distances(paths: DataFrame, points: DataFrame, only_primary: bool = False) -> DataFrame:
    """(from, to, least, most) for pairs of points of which the second lies downstream of the first: the way from one's lower end to the other's."""
    ranges = reach(primary(paths) if only_primary else paths, points)
    there = points.join(paths, F.col("edge") == F.col("id")).select(F.col("point").alias("to"), F.col("from_nexus_id").alias("node"), F.col("length").alias("own"))
    return ranges.join(there, "node").filter("point <> to").select(F.col("point").alias("from"), "to", (F.col("least") + F.col("own")).alias("least"), (F.col("most") + F.col("own")).alias("most"))


def relations(paths: DataFrame, points: DataFrame) -> DataFrame:
    """(from, to, relation): 1 where ``to`` lies downstream of ``from``, -1 where upstream; pairs of no relation have no row."""
    down = distances(paths, points).select("from", "to")
    return down.withColumn("relation", F.lit(1)).union(down.select(F.col("to").alias("from"), F.col("from").alias("to"), F.lit(-1)))


def drained(paths: DataFrame, points: DataFrame) -> DataFrame:
    """(point, catchment, hop) of all catchments upstream of each point, its own at hop 0."""
    links = stage_table(catchment_links(paths).select(F.col("dst").alias("src"), F.col("src").alias("dst")), "links")
    known = frontier = stage_table(points.join(paths, F.col("edge") == F.col("id")).select("point", F.col("ecatchment_id").alias("catchment")).distinct(), "pp-drained")
    while True:
        found = frontier.join(links, F.col("catchment") == F.col("src")).select("point", F.col("dst").alias("catchment")).distinct()
        frontier = stage_table(found.join(known, ["point", "catchment"], "left_anti"), "pp-drained")
        if frontier.isEmpty():
            return known
        known = stage_table(known.union(frontier), "pp-drained")


def unique_catchments(paths: DataFrame, points: DataFrame) -> DataFrame:
    """(point, catchment) upstream of a point without passing another point's catchment."""
    own = points.join(paths, F.col("edge") == F.col("id")).select("point", F.col("ecatchment_id").alias("catchment")).distinct()
    links = catchment_links(paths).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    open_links = stage_table(links.join(own.select(F.col("catchment").alias("dst")), "dst", "left_anti").select("src", "dst"), "links")
    known = frontier = stage_table(own, "pp-unique")
    while True:
        found = frontier.join(open_links, F.col("catchment") == F.col("src")).select("point", F.col("dst").alias("catchment")).distinct()
        frontier = stage_table(found.join(known, ["point", "catchment"], "left_anti"), "pp-unique")
        if frontier.isEmpty():
            return known
        known = stage_table(known.union(frontier), "pp-unique")


def shared_catchments(paths: DataFrame, points: DataFrame) -> DataFrame:
    """(point, catchment) upstream of a point but behind another."""
    return drained(paths, points).join(unique_catchments(paths, points), ["point", "catchment"], "left_anti")


def containment(paths: DataFrame, points: DataFrame) -> DataFrame:
    """(from, to, relation): -1 where the first point's own catchment drains to the second, 1 the other way."""
    all_of = drained(paths, points)
    own = points.join(paths, F.col("edge") == F.col("id")).select(F.col("point").alias("other"), F.col("ecatchment_id").alias("catchment"))
    inside = all_of.join(own, "catchment").filter("point <> other").select(F.col("other").alias("from"), F.col("point").alias("to"))
    return inside.withColumn("relation", F.lit(-1)).union(inside.select(F.col("to").alias("from"), F.col("from").alias("to"), F.lit(1)))


def signed(pairs: DataFrame, value: str) -> DataFrame:
    """(from, to, value) both ways: positive where ``to`` lies downstream of ``from``, negative where upstream."""
    one = pairs.select("from", "to", value)
    return one.union(one.select("to", "from", -F.col(value)))


def parents(paths: DataFrame, points: DataFrame) -> DataFrame:
    """(point, parent): the nearest point downstream along primary flows, null if none."""
    down = distances(paths, points, only_primary=True)
    best = down.groupBy(F.col("from").alias("point")).agg(F.min_by("to", F.struct("least", "to")).alias("parent"))
    return points.select("point").join(best, "point", "left")


def point_sets(paths: DataFrame, points: DataFrame, horton: DataFrame) -> DataFrame:
    """(members, own, horton): every set of points whose water flows together somewhere along the primary flows.

    ``own`` is the point whose flowpath begins the stretch that only this set flows along, null where a confluence begins it, and ``horton``
    the order of the stretch's last flowpath. A stretch ends where the set grows, so there are less than twice as many sets as points.
    """
    net = primary(paths)
    ways = reach(net, points).select("point", "node", F.col("least").alias("d"))
    first = points.join(paths, F.col("edge") == F.col("id")).select("point", "id", F.lit(True).alias("own"), F.lit(-1).cast("long").alias("d"))
    later = ways.join(net, F.col("node") == F.col("from_nexus_id")).select("point", "id", F.lit(False).alias("own"), "d")
    on = first.union(later).groupBy("point", "id").agg(F.max("own").alias("own"), F.min("d").alias("d"))
    flows = on.groupBy("id").agg(F.array_sort(F.collect_set("point")).alias("members"), F.min(F.when(F.col("own"), F.col("point"))).alias("own"), F.max("d").alias("d"))
    flows = flows.join(horton.select("id", "horton"), "id", "left")
    return flows.groupBy("members").agg(F.max("own").alias("own"), F.max_by("horton", "d").alias("horton"))


def relation_tree(sets: DataFrame) -> str:
    """Sets of ``point_sets`` as nested text: a point or confluence before what flows to it, by rising Horton order, trees joined by ``;``.

    Sets contain each other or have no point in common. Points are those of a request, and few; the text is built by the driver.
    """
    rows = [(frozenset(r["members"]), r["own"], r["horton"]) for r in sets.collect()]
    rows.sort(key=lambda r: (-len(r[0]), min(r[0])))
    children: dict[frozenset | None, list] = {}
    for k, row in enumerate(rows):
        around = [r[0] for r in rows[:k] if row[0] < r[0]]
        children.setdefault(min(around, key=len) if around else None, []).append(row)
    count = 0

    def text(row: tuple) -> str:
        nonlocal count
        members, own, _ = row
        below = sorted(children.get(members, []), key=lambda r: (-1 if r[2] is None else r[2], min(r[0])))
        name, many = ("", len(below) > 1)
        if many:
            count += 1
            name = f"x{count}"
        inner = ",".join(map(text, below))
        if many:
            inner = f"{name}({inner})"
        if own is None:
            return inner
        return f"{own}({inner})" if inner else str(own)

    return ";".join(text(r) for r in sorted(children.get(None, []), key=lambda r: min(r[0])))


# ---- pieces that can be traversed one after another


def partition(paths: DataFrame, points: DataFrame, order: DataFrame) -> DataFrame:
    """(point, piece, catchment): the catchments of each point in pieces within which the same points lie downstream.

    A catchment that several points claim goes to the one that comes first in ``order`` (point, place). Catchments belong together if one
    flows to the other and the points downstream are the same; where they change, at a stop catchment, what flows into it from one
    point's area belongs together. A piece is named by its smallest catchment.
    """
    all_of = stage_table(drained(paths, points), "pp-all")
    marks = stage_table(all_of.groupBy("catchment").agg(F.array_sort(F.collect_set("point")).cast("string").alias("mark")), "pp-marks")
    claims = unique_catchments(paths, points).join(order, "point")
    owner = stage_table(claims.groupBy("catchment").agg(F.min_by("point", F.struct("place", "point")).alias("point")), "pp-owners")
    flows = paths.select("ecatchment_id", "from_nexus_id", "to_nexus_id")
    into = flows.select(F.col("ecatchment_id").alias("up"), F.col("to_nexus_id").alias("node")).distinct()
    out = flows.select(F.col("ecatchment_id").alias("down"), F.col("from_nexus_id").alias("node")).distinct()
    mark = lambda c: marks.select(F.col("catchment").alias(c), F.col("mark").alias(f"{c}_mark"))
    links = stage_table(into.join(out, "node").filter("up <> down").join(mark("up"), "up").join(mark("down"), "down"), "pp-flows")
    stops = links.filter("up_mark <> down_mark").select("down").distinct()
    own = lambda c: owner.select(F.col("catchment").alias(c), F.col("point").alias(f"{c}_point"))
    same = links.join(stops, "down", "left_anti").join(own("up"), "up").join(own("down"), "down").filter("up_point = down_point").select(F.col("up").alias("src"), F.col("down").alias("dst"))
    # what flows into a stop catchment's upper nodes from one point's area hangs on the smallest of it
    beside = links.join(stops, "down", "left_semi").select("node", "up").distinct().join(own("up"), "up")
    low = beside.groupBy("node", "up_point").agg(F.min("up").alias("low"))
    tied = beside.join(low, ["node", "up_point"]).filter("up <> low").select(F.col("up").alias("src"), F.col("low").alias("dst"))
    comp = connected_components(same.union(tied))
    return owner.join(comp.withColumnRenamed("id", "catchment"), "catchment", "left").select("point", F.coalesce("component", "catchment").alias("piece"), "catchment")


def piece_relations(paths: DataFrame, pieces: DataFrame) -> DataFrame:
    """(from, to, relation) of pieces: -1 where ``to`` lies upstream of ``from``, 1 where downstream, whatever lies between; other pairs have no row."""
    flows = paths.select("ecatchment_id", "from_nexus_id", "to_nexus_id")
    of = pieces.select(F.col("catchment").alias("ecatchment_id"), "piece")
    a = flows.join(of, "ecatchment_id").select(F.col("to_nexus_id").alias("node"), F.col("piece").alias("src"))
    b = flows.join(of, "ecatchment_id").select(F.col("from_nexus_id").alias("node"), F.col("piece").alias("dst"))
    links = stage_table(a.join(b, "node").filter("src <> dst").select("src", "dst").distinct(), "piece-links")
    known = frontier = links
    while True:
        found = frontier.join(links.select(F.col("src").alias("dst"), F.col("dst").alias("next")), "dst").select("src", F.col("next").alias("dst")).distinct()
        frontier = stage_table(found.filter("src <> dst").join(known, ["src", "dst"], "left_anti"), "piece-links")
        if frontier.isEmpty():
            break
        known = stage_table(known.union(frontier), "piece-links")
    down = known.select(F.col("src").alias("from"), F.col("dst").alias("to"))
    return down.withColumn("relation", F.lit(1)).union(down.select("to", "from", F.lit(-1)))


# ---- placing points on flowpaths


def slide_ends(paths: DataFrame, nexus_types: DataFrame) -> DataFrame:
    """(id, end): the last flowpath that a point on ``id`` slides down to: through nodes of kind FLOWPATH with one flow in and one out, within one catchment.

    Every round doubles the way, so long chains take few rounds.
    """
    into = paths.groupBy(F.col("to_nexus_id").alias("node")).agg(F.count("*").alias("i"), F.min("id").alias("id"), F.min("ecatchment_id").alias("up"))
    out = paths.groupBy(F.col("from_nexus_id").alias("node")).agg(F.count("*").alias("o"), F.min("id").alias("next"), F.min("ecatchment_id").alias("down"))
    plain = nexus_types.filter("nexus_type = 'FLOWPATH'").select(F.col("id").alias("node"))
    step = into.join(out, "node").join(plain, "node", "left_semi").filter("i = 1 AND o = 1 AND up = down").select("id", "next")
    jump = stage_table(paths.select("id").join(step, "id", "left").select("id", F.coalesce("next", "id").alias("end")), "slide")
    while True:
        further = jump.join(jump.select(F.col("id").alias("end"), F.col("end").alias("far")), "end").select("id", F.col("far").alias("end"), (F.col("far") != F.col("end")).alias("moved"))
        further = stage_table(further, "slide")
        if further.filter("moved").isEmpty():
            return jump
        jump = further.select("id", "end")


def project(points: DataFrame, paths: DataFrame, inside: DataFrame, nodes: DataFrame, inflows: DataFrame, nexus_types: DataFrame, radius: float) -> DataFrame:
    """(point, edge, problem): the flowpaths that points (point, x, y, c) stand on by their code; several for code 0, none where there is a problem.

    Code -2 takes the flowpath that ``inside`` (id, line) gives for the point in its catchment; 0 all flows into the nearest node of ``nodes`` (id, x, y)
    that aren't bank flows; 1 to 9 the c-th of these in the order of ``inflows`` (node, id, place), clockwise from the primary outflow. -1
    and other codes are a problem, and so is a point without catchment, node within ``radius`` or flow. A single flowpath slides
    down as ``slide_ends`` says.
    """
    coded = points.withColumn("problem", F.when((F.col("c") == -1) | (F.col("c") < -2) | (F.col("c") > 9), F.concat(F.lit("code "), F.col("c").cast("string"))))
    one = coded.filter("c = -2").join(inside.select(F.col("id").alias("point"), F.col("line").alias("edge")), "point", "left")
    one = one.select("point", "c", "edge", F.when(F.col("edge").isNull(), "in no catchment").alias("problem"))
    usable = nodes.join(nexus_types.filter("nexus_type <> 'BANK'").select("id"), "id", "left_semi")
    asked = coded.filter("c BETWEEN 0 AND 9")
    near = nearest(asked.select(F.col("point").alias("id"), "x", "y"), usable, 1, radius).select(F.col("id").alias("point"), F.col("target").alias("node"))
    flows = paths.filter("ef_type <> 2").select(F.col("to_nexus_id").alias("node"), F.col("id").alias("edge"))
    count = flows.groupBy("node").agg(F.count("*").alias("flows"), F.min("edge").alias("only"))
    # places among the flows that aren't bank flows
    w = Window.partitionBy("node").orderBy("place")
    placed = inflows.withColumnRenamed("id", "edge").join(flows, ["node", "edge"]).withColumn("nth", F.row_number().over(w)).select("node", "edge", "nth")
    at = asked.join(near, "point", "left").join(count, "node", "left")
    every = at.filter("c = 0").join(flows, "node", "left").select("point", "c", "edge", F.when(F.col("node").isNull(), "no node near").when(F.col("edge").isNull(), "no flows").alias("problem"))
    nth = at.filter("c > 0").join(placed.withColumnRenamed("nth", "c"), ["node", "c"], "left")
    picked = F.when((F.col("flows") == 1) & (F.col("c") == 1), F.col("only")).otherwise(F.col("edge"))
    single = nth.select("point", "c", picked.alias("edge"), F.when(F.col("node").isNull(), "no node near").when(F.coalesce("flows", F.lit(0)) < F.col("c"), "no flows").when(picked.isNull(), "no outflow").alias("problem"))
    wrong = coded.filter("problem IS NOT NULL").select("point", "c", F.lit(None).cast(dict(paths.dtypes)["id"]).alias("edge"), "problem")
    found = one.union(every).union(single).union(wrong)
    counted = found.join(found.groupBy("point").agg(F.count("edge").alias("n")), "point")
    slid = counted.join(slide_ends(paths, nexus_types).withColumnRenamed("id", "edge"), "edge", "left")
    return slid.select("point", F.when(F.col("n") == 1, F.coalesce("end", "edge")).otherwise(F.col("edge")).alias("edge"), "problem")


def outputs(paths: DataFrame, points: DataFrame, order: DataFrame, wanted: set[str] = frozenset()) -> dict[str, DataFrame]:
    """What a request asks for, by its short names; all of them if it names none; an unknown name is an error."""
    def far(value: str) -> DataFrame:
        return signed(distances(paths, points), value)

    known = {
        "op": lambda: relations(paths, points),
        "opdmin": lambda: far("least"),
        "opdmax": lambda: far("most"),
        "opdprimary": lambda: signed(distances(paths, points, only_primary=True), "least"),
        "c": lambda: unique_catchments(paths, points),
        "ccr": lambda: containment(paths, points),
        "sc": lambda: shared_catchments(paths, points),
        "pc": lambda: partition(paths, points, order),
        "pcr": lambda: piece_relations(paths, partition(paths, points, order)),
    }
    if unknown := set(wanted) - set(known):
        raise ValueError(f"unknown outputs {sorted(unknown)}")
    return {name: make() for name, make in known.items() if not wanted or name in wanted}


def upstream_flowpaths(paths: DataFrame, points: DataFrame) -> DataFrame:
    """Ids of flowpaths upstream of any point."""
    return reachable(flow_links(paths, upstream=True), points.select(F.col("edge").alias("id"))).select("id")
