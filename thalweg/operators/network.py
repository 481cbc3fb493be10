"""The drainage graph: traversal, stream orders, classification, checks and shortest paths.

Edges are rows (id, from_nexus_id, to_nexus_id, ef_type, rank, length, ...); nodes may have ids of any type. Loops run over a frontier,
cut lineage into the shared folder each round, and end when a round finds nothing new; no number of rounds is too many.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.operators.components import AT_ONCE, connected_components
from thalweg.session import dealt, stage_table

#: Edges of one component that a single task folds; larger ones are folded level by level over the cluster.
COMPONENT_EDGES = 5_000_000
PRIMARY = "rank = 1 AND ef_type <> 2"


def primary(paths: DataFrame) -> DataFrame:
    """The network that orders follow: primary and not along a bank."""
    return paths.filter(PRIMARY)


def _walk(frames: Iterator[pd.DataFrame], within: int | None) -> Iterator[pd.DataFrame]:
    """Breadth-first search over rows (a, b, first): links, and starts as b of first rows, all in one task. Ids may be of any type."""
    held = list(frames)
    if not held:
        return
    whole = pd.concat(held)
    is_start = whole["first"].to_numpy(bool)
    codes, ids = pd.factorize(pd.concat([whole["a"][~is_start], whole["b"]]))
    src, end = codes[: len(whole) - is_start.sum()], codes[len(whole) - is_start.sum() :]
    dst = end[~is_start]
    order = np.argsort(src, kind="stable")
    src, dst = src[order], dst[order]
    frontier = np.unique(end[is_start])
    seen = np.zeros(len(ids), bool)
    seen[frontier] = True
    hop = 0
    while len(frontier):
        yield pd.DataFrame({"id": ids[frontier], "hop": np.full(len(frontier), hop, np.int32)})
        if hop == within:
            return
        lo, hi = np.searchsorted(src, frontier, "left"), np.searchsorted(src, frontier, "right")
        size = hi - lo
        at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        frontier = np.unique(dst[at])
        frontier = frontier[~seen[frontier]]
        seen[frontier] = True
        hop += 1


def reachable(links: DataFrame, starts: DataFrame, within: int | None = None, at_once: int = AT_ONCE) -> DataFrame:
    """(id, hop) of every node that ``links`` (src, dst) lead to from ``starts`` (id), starts at hop 0; cycles are safe, nulls are ignored.

    Up to ``at_once`` links and starts are walked by one task, more in rounds over the cluster; the answer is the same, for ids of any type.
    """
    kind = dict(starts.dtypes)["id"]
    links = stage_table(links.select("src", "dst").dropna().distinct(), "links")
    starts = starts.select("id").dropna().distinct()
    if at_once and links.count() <= at_once and starts.count() <= at_once:
        rows = links.select(F.col("src").cast(kind).alias("a"), F.col("dst").cast(kind).alias("b"), F.lit(False).alias("first"))
        rows = rows.union(starts.select("id", "id", F.lit(True)))  # without nulls, which pandas would make floats of
        return rows.repartition(1).mapInPandas(lambda frames: _walk(frames, within), f"id {kind}, hop int")
    seen = frontier = stage_table(starts.withColumn("hop", F.lit(0)), "reach")
    for hop in count(1):
        if within is not None and hop > within:
            return seen
        found = frontier.join(links, F.col("id") == F.col("src")).select(F.col("dst").alias("id")).distinct().join(seen, "id", "left_anti")
        frontier = stage_table(found.withColumn("hop", F.lit(hop)), "reach")
        if frontier.isEmpty():
            return seen
        seen = seen.union(frontier)
        if hop % 16 == 0:
            seen = stage_table(seen, "reach")
    raise AssertionError


def flow_links(paths: DataFrame, upstream: bool = False) -> DataFrame:
    """Links between flowpaths that follow each other."""
    a = paths.select(F.col("id").alias("src"), F.col("to_nexus_id").alias("n"))
    b = paths.select(F.col("id").alias("dst"), F.col("from_nexus_id").alias("n"))
    links = a.join(b, "n").select("src", "dst")
    return links.select(F.col("dst").alias("src"), F.col("src").alias("dst")) if upstream else links


def trace(paths: DataFrame, starts: DataFrame, upstream: bool = False, most: int | None = None) -> DataFrame:
    """(id, hop) of flowpaths up- or downstream of ``starts`` (id), themselves included; nearest first if at most ``most``."""
    out = reachable(flow_links(paths, upstream), starts)
    return out if most is None else out.orderBy("hop", "id").limit(most)


# ---- stream orders


def fold_component(edges: pd.DataFrame, named: bool = False, isolated_hack: int | None = None, boundary: set | None = None) -> pd.DataFrame:
    """Orders of one component's edges by one pass down and one pass up the tree.

    ``edges``: id, from, to, length, name, at most one out of each node. What leads to a cycle gets nulls.
    With ``isolated_hack`` outlets that aren't in ``boundary`` begin with that Hack order.
    """
    edges = edges[["id", "from", "to", "length", *["name"] * named]].sort_values("id", kind="stable").reset_index(drop=True)
    flat, nodes = pd.factorize(pd.concat([edges["from"], edges["to"]]), sort=True)
    # flat arrays throughout: lists of whole numbers and tuples would take some 600 bytes an edge
    n, m = len(nodes), len(edges)
    kind = "d" if edges["length"].dtype.kind == "f" else "q"
    full = lambda value, size=n, of="q": array(of, [value]) * size
    flatly = lambda x, of="q": array(of, x.astype({"q": np.int64, "d": np.float64}[of]).tobytes())
    tail, head, length = flatly(flat[:m]), flatly(flat[m:]), flatly(edges["length"].to_numpy(), kind)
    missing = flatly(np.bincount(flat[m:], minlength=n))
    down = np.full(n, -1)
    down[flat[:m]] = np.arange(m)
    out = flatly(down)
    if named:
        name = flatly(pd.factorize(edges["name"])[0])  # -1 where there is none
    del flat, down
    strahler, times, shreve, far, stem = full(1, of="i"), full(0, of="i"), full(0), full(0, of=kind), full(-1)
    # of the edges into a node the best so far: how its name fits, its way up and the edge
    fit, way, best = bytearray(n), full(0, of=kind), full(-1)
    source = bytearray((np.frombuffer(missing, np.int64) == 0).tobytes())
    ready, order = flatly(np.flatnonzero(np.frombuffer(source, np.uint8))), array("q")
    while ready:
        u = ready.pop()
        order.append(u)
        if source[u]:
            shreve[u], stem[u] = 1, u
        else:
            strahler[u] += times[u] >= 2
            stem[u] = stem[tail[best[u]]]
        e = out[u]
        if e >= 0:
            v = head[e]
            if times[v] == 0 or strahler[u] > strahler[v]:
                strahler[v], times[v] = strahler[u], 1
            elif strahler[u] == strahler[v]:
                times[v] += 1
            shreve[v] += shreve[u]
            reach = far[u] + length[e]
            far[v] = max(far[v], reach)
            suits = 2 * (out[v] >= 0 and name[e] == name[out[v]]) + 1 if named and name[e] >= 0 else 0
            if best[v] < 0 or (suits, reach, -e) > (fit[v], way[v], -best[v]):
                fit[v], way[v], best[v] = suits, reach, e
            missing[v] -= 1
            if not missing[v]:
                ready.append(v)
    del times, fit, way, best, missing, ready
    hack, horton, seq, ends = full(0), full(0, of="i"), full(0), bytearray(n)
    for u in reversed(order):
        e = out[u]
        ends[u] = e < 0 or ends[head[e]]
        if not ends[u]:
            continue
        if e < 0:
            start = 1 if isolated_hack is None or (boundary and nodes[u] in boundary) else isolated_hack
            hack[u], horton[u] = start, strahler[u]
            continue
        v = head[e]
        if stem[u] == stem[v]:
            hack[u], horton[u], seq[u] = hack[v], horton[v], seq[v] + 1
        else:
            hack[u], horton[u], seq[u] = hack[v] + 1, strahler[u], 1
    at = np.frombuffer(tail, np.int64)
    none = np.frombuffer(ends, np.uint8)[at] == 0
    of_tail = lambda values: np.frombuffer(values, values.typecode)[at]
    pick = lambda values: pd.arrays.IntegerArray(of_tail(values).astype(np.int64), none.copy()) if values.typecode != "d" else pd.array(np.where(none, np.nan, of_tail(values)), "Float64").astype("Int64")
    headwater = np.asarray(nodes)[np.where(none, 0, of_tail(stem))]
    if headwater.dtype.kind == "i":
        headwater = pd.arrays.IntegerArray(headwater.astype(np.int64), none.copy())
    else:
        headwater = pd.Series(np.where(none, None, headwater.astype(object)), dtype=object)
    return pd.DataFrame({"id": edges["id"], "strahler": pick(strahler), "shreve": pick(shreve), "max_uplength": pick(far), "mainstem": headwater, "hack": pick(hack), "horton": pick(horton), "mainstem_seq": pick(seq)})


ORDER_SCHEMA = "id long, strahler long, shreve long, max_uplength long, mainstem long, hack long, horton long, mainstem_seq long"


def fold_levels(edges: DataFrame, named: bool = False, isolated_hack: int | None = None, boundary: set | None = None) -> DataFrame:
    """``fold_component`` for networks of any size: a job for each step of distance from the outlets, first down, then up.

    ``edges``: id, from, to, length, name, at most one out of each node; what leads to a cycle has no row.
    """
    flat = edges.select("id", F.col("from").alias("from_nexus_id"), F.col("to").alias("to_nexus_id"), F.lit(1).alias("rank"), F.lit(1).alias("ef_type"))
    hops = hops_to_outlet(flat)
    level = stage_table(edges.join(hops.select(F.col("id").alias("from"), "hop"), "from"), "levels")
    nodes = stage_table(hops.select(F.col("id").alias("node"), "hop").join(level.select(F.col("from").alias("node"), F.col("name").alias("own")), "node", "left"), "levels")
    depth = nodes.agg(F.max("hop")).first()[0]
    if depth is None:
        return edges.sparkSession.createDataFrame([], ORDER_SCHEMA)
    values: dict[int, DataFrame] = {}
    below = None
    for hop in range(depth, -1, -1):
        here = nodes.filter(F.col("hop") == hop).select("node", "own")
        if below is None:
            folded = here.select("node", F.lit(1).alias("strahler"), F.lit(1).cast("long").alias("shreve"), F.lit(0).cast("long").alias("far"), F.col("node").alias("stem"))
        else:
            into = level.filter(F.col("hop") == hop + 1).join(below, F.col("from") == F.col("node")).drop("node").withColumnRenamed("to", "node").withColumn("reach", F.col("far") + F.col("length"))
            same = [F.coalesce(F.col("name") == F.col("own"), F.lit(False)), F.col("name").isNotNull()] if named else []
            into = into.join(here, "node")
            each = into.groupBy("node", "strahler").agg(
                F.count("*").alias("times"), F.sum("shreve").alias("shreve"), F.max("reach").alias("far"), F.max(F.struct(*[c.alias(f"k{i}") for i, c in enumerate([*same, F.col("reach"), -F.col("id")])], "stem")).alias("best")
            )
            agg = each.groupBy("node").agg(F.max(F.struct("strahler", "times")).alias("top"), F.sum("shreve").alias("shreve"), F.max("far").alias("far"), F.max("best").alias("best"))
            folded = here.join(agg, "node", "left").select(
                "node", F.coalesce(F.col("top.strahler") + (F.col("top.times") >= 2).cast("int"), F.lit(1)).alias("strahler"), F.coalesce("shreve", F.lit(1)).alias("shreve"), F.coalesce("far", F.lit(0)).alias("far"), F.coalesce("best.stem", "node").alias("stem")
            )
        values[hop] = below = stage_table(folded, "fold")
    first = F.lit(1)
    if isolated_hack is not None:
        first = F.when(F.col("node").isin(*boundary), 1).otherwise(isolated_hack) if boundary else F.lit(isolated_hack)
    above = stage_table(values[0].select("node", "stem", first.alias("hack"), F.col("strahler").alias("horton"), F.lit(0).alias("seq")), "fold")
    out = None
    for hop in range(1, depth + 1):
        up = above.select(F.col("node").alias("to"), F.col("stem").alias("up_stem"), F.col("hack").alias("up_hack"), F.col("horton").alias("up_horton"), F.col("seq").alias("up_seq"))
        here = level.filter(F.col("hop") == hop).select("id", F.col("from").alias("node"), "to").join(values[hop], "node").join(up, "to")
        same = F.col("stem") == F.col("up_stem")
        rows = here.select(
            "id", "node", "strahler", "shreve", "far", "stem", F.when(same, F.col("up_hack")).otherwise(F.col("up_hack") + 1).alias("hack"), F.when(same, F.col("up_horton")).otherwise(F.col("strahler")).alias("horton"),
            F.when(same, F.col("up_seq") + 1).otherwise(1).alias("seq"),
        )
        above = stage_table(rows, "fold")
        out = above if out is None else out.union(above)
    if out is None:
        return edges.sparkSession.createDataFrame([], ORDER_SCHEMA)
    long = lambda c, n: F.col(c).cast("long").alias(n)
    return out.select("id", long("strahler", "strahler"), long("shreve", "shreve"), long("far", "max_uplength"), long("stem", "mainstem"), long("hack", "hack"), long("horton", "horton"), long("seq", "mainstem_seq"))


def stream_orders(paths: DataFrame, name: str | None = None, isolated_hack: int | None = None, boundary: list | None = None, most: int = COMPONENT_EDGES) -> DataFrame:
    """Orders of every flowpath, those of its upper end; null for secondary and bank flowpaths and where the way down leads to a cycle.

    ``name`` is a column whose values keep a mainstem together; without it the longest way up does. A mainstem's id is its
    headwater node. ``component`` is the smallest node that any flowpaths connect. The flowpaths of a component of two nodes all have the orders of a
    lone headwater, whatever their rank and type. Water leaves a node by its primary flowpath of lowest id; others out of
    the node have its orders too but bring nothing to their lower end. A component of at most ``most`` such flowpaths goes to one task; larger ones
    are folded step by step over the whole cluster, with the same result.
    """
    comp = connected_components(paths, "from_nexus_id", "to_nexus_id")
    pairs = comp.groupBy("component").agg(F.count("*").alias("nodes"))
    # the flowpath that water leaves the node by
    first = primary(paths).groupBy("from_nexus_id").agg(F.min("id").alias("tree"))
    known = stage_table(
        paths.join(comp.withColumnRenamed("id", "from_nexus_id"), "from_nexus_id").join(pairs, "component").join(first, "from_nexus_id", "left").select(
            "id", F.when(F.expr(PRIMARY), F.col("tree")).alias("tree"), F.col("from_nexus_id").alias("from"), F.col("to_nexus_id").alias("to"), "length", (F.col(name) if name else F.lit(None)).cast("string").alias("name"), "component", "nodes"
        ),
        "order-edges",
    )
    trees = known.filter("id = tree AND nodes <> 2")
    sizes = trees.groupBy("component").agg(F.count("*").alias("n"))
    large = stage_table(sizes.filter(F.col("n") > most).select("component"), "large")
    marks = set(boundary or ())
    node = dict(paths.dtypes)["from_nexus_id"]
    schema = ORDER_SCHEMA.replace("mainstem long", f"mainstem {node}")

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        return fold_component(frame, name is not None, isolated_hack, marks)

    folded = trees.join(large, "component", "left_anti").select("id", "from", "to", "length", "name", "component").groupBy("component").applyInPandas(fold, schema)
    if not large.isEmpty():
        rows = stage_table(trees.join(large, "component", "left_semi").select("id", "from", "to", "length", "name"), "large-edges")
        folded = folded.union(fold_levels(rows, name is not None, isolated_hack, marks))
    orders = [c for c in folded.columns if c != "id"]
    out = known.filter("nodes <> 2").select("id", "component", "tree").join(folded.withColumnRenamed("id", "tree"), "tree", "left").select("id", "component", *orders)
    one = lambda v, n: F.lit(v).cast("long").alias(n)
    small = known.filter("nodes = 2").select(
        "id", "component", one(1, "strahler"), one(1, "shreve"), one(0, "max_uplength"), F.col("component").alias("mainstem"), one(1, "hack"), one(1, "horton"), one(1, "mainstem_seq")
    )
    return out.unionByName(small)


def hops_to_outlet(paths: DataFrame) -> DataFrame:
    """(id, hop) of nodes by distance against the flow from nodes without a primary out-edge."""
    p = primary(paths)
    ends = p.select(F.col("to_nexus_id").alias("id")).distinct().join(p.select(F.col("from_nexus_id").alias("id")), "id", "left_anti")
    return reachable(p.select(F.col("to_nexus_id").alias("src"), F.col("from_nexus_id").alias("dst")), ends)


# ---- classification and checks


def classify_nexuses(paths: DataFrame, boundary: DataFrame) -> DataFrame:
    """(id, nexus_type) from degrees, kinds of flow and ``boundary`` (id): a chain of rules, first fit."""
    bank, inferred = (F.col("ef_type") == 2).cast("long"), F.col("ef_type").isin(3).cast("long")
    part = lambda node, i, o: paths.select(F.col(node).alias("id"), F.lit(i).alias("i"), F.lit(o).alias("o"), (bank * o).alias("bo"), (inferred * i).alias("ii"), (inferred * o).alias("io"), (bank + inferred).alias("bi"))
    d = part("from_nexus_id", 0, 1).union(part("to_nexus_id", 1, 0)).groupBy("id").agg(*[F.sum(c).alias(c) for c in ("i", "o", "bo", "ii", "io", "bi")])
    d = d.join(boundary.select("id", F.lit(True).alias("edge")), "id", "left")
    kind = (
        F.when((F.col("i") == 0) & (F.col("o") == 1) & (F.col("bo") == 1), "BANK")
        .when(F.col("i") == 0, "HEADWATER")
        .when((F.col("o") == 0) & F.col("edge"), "TERMINAL_BOUNDARY")
        .when(F.col("o") == 0, "TERMINAL_ISOLATED")
        .when((F.col("i") == 1) & (F.col("o") == 1) & (F.col("ii") == 1) & (F.col("io") == 1), "INFERRED")
        .when(F.col("bi") == F.col("i") + F.col("o"), "INFERRED")
        .otherwise("FLOWPATH")
    )
    return d.select("id", kind.alias("nexus_type"))


def invalid_sources_sinks(paths: DataFrame, terminals: DataFrame) -> DataFrame:
    """Nodes of several flows that all leave or all arrive, other than ``terminals`` (id)."""
    ends = paths.select(F.col("from_nexus_id").alias("id"), F.lit(1).alias("o")).union(paths.select(F.col("to_nexus_id"), F.lit(0)))
    d = ends.groupBy("id").agg(F.count("*").alias("n"), F.sum("o").alias("n_out"))
    bad = d.filter((F.col("n") > 1) & ((F.col("n_out") == 0) | (F.col("n_out") == F.col("n"))))
    return bad.join(terminals, "id", "left_anti").select("id", F.when(F.col("n_out") == 0, "sink").otherwise("source").alias("problem"))


def forked_nodes(paths: DataFrame) -> DataFrame:
    """Nodes of more than one primary out-edge, which orders don't allow."""
    return primary(paths).groupBy(F.col("from_nexus_id").alias("id")).agg(F.count("*").alias("n_out")).filter("n_out > 1")


def peel(paths: DataFrame) -> DataFrame:
    """What remains when nodes without inflow are taken away again and again: edges on cycles or behind them."""
    left = stage_table(paths.select("id", "from_nexus_id", "to_nexus_id"), "peel")
    size = left.count()
    while True:
        if not size:
            return left
        fed = left.select(F.col("to_nexus_id").alias("from_nexus_id")).distinct()
        left = stage_table(left.join(fed, "from_nexus_id", "left_semi").select("id", "from_nexus_id", "to_nexus_id"), "peel")
        now = left.count()
        if now == size:
            return left
        size = now


def has_cycle(paths: DataFrame) -> bool:
    return not peel(paths).isEmpty()


def without_parallel(paths: DataFrame) -> DataFrame:
    """One edge for each pair of nodes in either direction, the lowest id; a self-loop is an error."""
    loops = paths.filter("from_nexus_id = to_nexus_id").limit(1).count()
    if loops:
        raise ValueError("an edge joins a node to itself")
    key = [F.least("from_nexus_id", "to_nexus_id").alias("a"), F.greatest("from_nexus_id", "to_nexus_id").alias("b")]
    return paths.groupBy(*key).agg(F.min("id").alias("id"), F.count("*").alias("n"))


def trim(paths: DataFrame, keep: DataFrame) -> DataFrame:
    """Edges left when dead ends are taken away again and again, other than at ``keep`` (id)."""
    left = stage_table(paths.select("id", "from_nexus_id", "to_nexus_id"), "trim")
    size = left.count()
    while True:
        ends = left.select(F.explode(F.array("from_nexus_id", "to_nexus_id")).alias("node"))
        dead = ends.groupBy("node").count().filter("count = 1").join(keep.select(F.col("id").alias("node")), "node", "left_anti").select("node")
        step = left.join(dead.select(F.col("node").alias("from_nexus_id")), "from_nexus_id", "left_anti").join(dead.select(F.col("node").alias("to_nexus_id")), "to_nexus_id", "left_anti")
        left = stage_table(step.select("id", "from_nexus_id", "to_nexus_id"), "trim")
        now = left.count()
        if now == size:
            return left
        size = now


def shortest_distances(links: DataFrame, sinks: DataFrame) -> DataFrame:
    """(id, distance) to the nearest of ``sinks`` (id) along ``links`` (src, dst, length): rounds of relaxation until nothing improves."""
    links = stage_table(links.select("src", "dst", "length"), "links")
    known = changed = stage_table(sinks.select("id").distinct().withColumn("distance", F.lit(0).cast("long")), "distance")
    while True:
        offers = changed.join(links, F.col("id") == F.col("dst")).groupBy(F.col("src").alias("id")).agg(F.min(F.col("distance") + F.col("length")).alias("offer"))
        better = offers.join(known, "id", "left").filter(F.col("distance").isNull() | (F.col("offer") < F.col("distance")))
        changed = stage_table(better.select("id", F.col("offer").alias("distance")), "distance")
        if changed.isEmpty():
            return known
        known = stage_table(known.union(changed).groupBy("id").agg(F.min("distance").alias("distance")), "distance")


def merge_chains(paths: DataFrame) -> DataFrame:
    """(first, last, n, length) of maximal chains through nodes of one inflow and one outflow, first and last being nodes."""
    ins = paths.groupBy(F.col("to_nexus_id").alias("node")).agg(F.count("*").alias("i"))
    outs = paths.groupBy(F.col("from_nexus_id").alias("node")).agg(F.count("*").alias("o"))
    inner = ins.join(outs, "node").filter("i = 1 AND o = 1").select("node")
    p = paths.select("id", F.col("from_nexus_id").alias("a"), F.col("to_nexus_id").alias("b"), "length")
    links = p.select(F.col("id").alias("x"), F.col("b").alias("node")).join(inner, "node").join(p.select(F.col("id").alias("y"), F.col("a").alias("node")), "node")
    comp = connected_components(links, "x", "y").select("id", "component")
    q = p.join(comp, "id", "left").withColumn("chain", F.coalesce("component", "id"))
    first = q.join(inner.withColumnRenamed("node", "a"), "a", "left_anti").select("chain", F.col("a").alias("first"))
    last = q.join(inner.withColumnRenamed("node", "b"), "b", "left_anti").select("chain", F.col("b").alias("last"))
    sums = q.groupBy("chain").agg(F.count("*").alias("n"), F.sum("length").alias("length"))
    return sums.join(first, "chain").join(last, "chain").select("first", "last", "n", "length")


def sink_points(paths: DataFrame, terminals: DataFrame, shore: DataFrame, outputs: DataFrame) -> DataFrame:
    """Nodes that water leaves by: output terminals, nodes on the shore, output construction points (``outputs``, id) where one flow ends, and nodes all
    of whose flows are known and arrive. Bank flows don't count."""
    p = paths.filter("ef_type <> 2")
    ends = p.select(F.col("from_nexus_id").alias("id"), F.lit(1).alias("bad")).union(p.select(F.col("to_nexus_id"), (F.col("direction_known") != 1).cast("int")))
    nodes = ends.groupBy("id").agg(F.sum("bad").alias("bad"), F.count("*").alias("degree"))
    listed = terminals.select("id").union(shore.select("id")).distinct().withColumn("listed", F.lit(True))
    out = outputs.select("id").distinct().withColumn("output", F.lit(True))
    marked = nodes.join(listed, "id", "left").join(out, "id", "left")
    return marked.filter("bad = 0 OR listed OR output AND degree = 1").select("id")


# ---- catchment graph and drainage


def catchment_links(paths: DataFrame) -> DataFrame:
    """Links between catchments whose flowpaths follow each other."""
    a = paths.select(F.col("ecatchment_id").alias("src"), F.col("to_nexus_id").alias("n"))
    b = paths.select(F.col("ecatchment_id").alias("dst"), F.col("from_nexus_id").alias("n"))
    return a.join(b, "n").filter("src <> dst").select("src", "dst").distinct()


def drainage(paths: DataFrame, catchments: DataFrame, starts: DataFrame, upstream: bool = True) -> DataFrame:
    """The catchments up- or downstream of ``starts`` (id), themselves included."""
    links = catchment_links(paths)
    if upstream:
        links = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return catchments.join(reachable(links, starts).select("id"), "id", "left_semi")


# ---- bridges and groups without bridges


def whole_groups(frames: Iterator[pd.DataFrame], key: str, least: int = 100_000) -> Iterator[pd.DataFrame]:
    """Frames in the order of ``key`` as frames of whole groups: many small ones together, ``least`` rows or more at a time, or a large one."""
    held: list[pd.DataFrame] = []
    rows = 0
    for frame in frames:
        held.append(frame)
        rows += len(frame)
        if rows < least or not len(frame) or held[0][key].iloc[0] == frame[key].iloc[-1]:
            continue
        whole = pd.concat(held, ignore_index=True)
        last = whole[key].to_numpy() == whole[key].iloc[-1]
        yield whole[~last]
        held = [whole[last]]
        rows = len(held[0])
    if rows:
        yield pd.concat(held, ignore_index=True)


def component_bridges(edges: pd.DataFrame) -> pd.DataFrame:
    """Bridges of undirected components by low points, without recursion; parallel edges are never bridges."""
    nodes, flat = np.unique(np.concatenate([edges["a"].to_numpy(), edges["b"].to_numpy()]), return_inverse=True)
    m, n = len(edges), len(nodes)
    # the ends of edges by their node, as flat arrays: lists of tuples would take some 500 bytes an edge
    order = np.argsort(flat, kind="stable")
    flatly = lambda x: array("q", x.astype(np.int64).tobytes())
    start = flatly(np.searchsorted(flat[order], np.arange(n + 1)))
    other, edge = flatly(np.concatenate([flat[m:], flat[:m]])[order]), flatly(order % max(m, 1))
    at, seen, low, clock = start[:], array("q", bytes(8 * n)), array("q", bytes(8 * n)), 0
    found = np.zeros(m, bool)
    for root in range(n):
        if seen[root]:
            continue
        clock += 1
        seen[root] = low[root] = clock
        stack = [(root, -1)]
        while stack:
            u, via = stack[-1]
            k = at[u]
            if k < start[u + 1]:
                at[u] = k + 1
                if edge[k] == via:
                    continue
                v = other[k]
                if seen[v]:
                    low[u] = min(low[u], seen[v])
                else:
                    clock += 1
                    seen[v] = low[v] = clock
                    stack.append((v, edge[k]))
            else:
                stack.pop()
                if stack:
                    p = stack[-1][0]
                    low[p] = min(low[p], low[u])
                    found[via] = low[u] > seen[p]
    return pd.DataFrame({"id": np.sort(edges["id"].to_numpy()[found]).astype(np.int64)})


def bridges(paths: DataFrame) -> DataFrame:
    """Ids of edges whose loss disconnects what they join."""
    comp = connected_components(paths, "from_nexus_id", "to_nexus_id").withColumnRenamed("id", "a")
    rows = paths.select("id", F.col("from_nexus_id").alias("a"), F.col("to_nexus_id").alias("b")).join(comp, "a")
    kernel = lambda frames: map(component_bridges, whole_groups(frames, "component"))
    return dealt(rows, "component").sortWithinPartitions("component").mapInPandas(kernel, "id long")


def loop_groups(paths: DataFrame) -> DataFrame:
    """(id, component) of nodes: pieces that hang together without any bridge."""
    rest = paths.join(bridges(paths), "id", "left_anti")
    ends = paths.select(F.col("from_nexus_id").alias("id")).union(paths.select("to_nexus_id")).distinct()
    comp = connected_components(rest, "from_nexus_id", "to_nexus_id")
    return ends.join(comp, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


# ---- rank


def angle_scores(paths: DataFrame) -> DataFrame:
    """(id, score) of out-edges at forks: the greatest angle between an inflow's and the out-edge's direction, as a share of half a turn (planar); 0 without inflow."""
    out = paths.select("id", F.col("from_nexus_id").alias("n"), F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")).alias("t"))
    into = paths.select(F.col("to_nexus_id").alias("n"), F.atan2(F.col("y1") - F.col("y2"), F.col("x1") - F.col("x2")).alias("s"))
    forks = paths.groupBy(F.col("from_nexus_id").alias("n")).agg(F.count("*").alias("k")).filter("k > 1").select("n")
    turn = F.abs(F.col("t") - F.col("s"))
    folded = F.when(turn > np.pi, 2 * np.pi - turn).otherwise(turn)
    return out.join(forks, "n").join(into, "n", "left").groupBy("n", "id").agg(F.round(F.coalesce(F.max(folded), F.lit(0.0)) / np.pi, 6).alias("score"))


def rank_by_angle(paths: DataFrame) -> DataFrame:
    """(id, rank): at each fork the straightest out-edge (lowest id of equals) is primary, others secondary; all else primary."""
    best = angle_scores(paths).groupBy("n").agg(F.max(F.struct("score", -F.col("id"))).alias("b")).select("n", (-F.col("b.col2")).alias("best"))
    return paths.join(best, F.col("from_nexus_id") == F.col("n"), "left").select("id", F.when(F.col("best").isNull() | (F.col("best") == F.col("id")), 1).otherwise(2).alias("rank"))
