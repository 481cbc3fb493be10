"""Directions of flow: trees, loops, pieces without a sink, straight and short ways, rank with channel widths, and catchment kinds.

Edges are rows (id, from_nexus_id, to_nexus_id, length, x1, y1, x2, y2, ...); ``known`` says that an edge already runs the right way.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thalweg.operators.components import connected_components
from thalweg.operators.network import angle_scores, loop_groups, peel, reachable, whole_groups
from thalweg.session import dealt, stage_table

#: Share of the channel's width in a fork's score inside a waterbody (a fixed value).
WIDTH_WEIGHT = 0.7


def both_ways(edges: DataFrame) -> DataFrame:
    """Links (src, dst, length, id) in the directions that an edge may have: both, or its own if that is known."""
    one = edges.select(F.col("from_nexus_id").alias("src"), F.col("to_nexus_id").alias("dst"), "length", "id", "known")
    back = one.filter("NOT known").select("dst", "src", "length", "id", "known")
    return one.union(back).drop("known")


def shortest_ways(edges: DataFrame, sinks: DataFrame) -> DataFrame:
    """(id, distance, edge, next): each node's way to the nearest of ``sinks`` (id): its length, its first edge and the node behind it; nulls at sinks.

    Edges of known direction are only gone along. Of equally short ways the one by the lowest edge counts. Rounds go on until nothing improves.
    """
    links = stage_table(both_ways(edges), "way-links")
    kind = dict(links.dtypes)
    none = lambda c, n: F.lit(None).cast(kind[c]).alias(n)
    known = changed = stage_table(sinks.select("id").distinct().select("id", F.lit(0).cast("long").alias("distance"), none("id", "edge"), none("src", "next")), "ways")
    while True:
        offers = changed.select(F.col("id").alias("dst"), "distance").join(links, "dst")
        best = offers.groupBy(F.col("src").alias("id")).agg(F.min(F.struct((F.col("distance") + F.col("length")).alias("distance"), F.col("id").alias("edge"), F.col("dst").alias("next"))).alias("b")).select("id", "b.*")
        old = known.select("id", F.col("distance").alias("old"), F.col("edge").alias("old_edge"))
        better = best.join(old, "id", "left").filter("old IS NULL OR distance < old OR distance = old AND edge < old_edge").select("id", "distance", "edge", "next")
        changed = stage_table(better, "ways")
        if changed.isEmpty():
            return known
        known = stage_table(known.join(changed.select("id"), "id", "left_anti").union(changed), "ways")


def way_from(ways: DataFrame, starts: DataFrame) -> DataFrame:
    """(start, step, id, edge): the nodes of the ways of ``shortest_ways`` from ``starts`` (id), with the edge that leaves each; null at the sink."""
    at = ways.select("id", "edge", "next")
    out = frontier = stage_table(starts.select(F.col("id").alias("start"), F.lit(0).alias("step"), "id").join(at, "id").select("start", "step", "id", "edge", "next"), "way")
    step = 0
    while True:
        step += 1
        frontier = stage_table(frontier.filter("next IS NOT NULL").select("start", F.lit(step).alias("step"), F.col("next").alias("id")).join(at, "id").select("start", "step", "id", "edge", "next"), "way")
        if frontier.isEmpty():
            return out.drop("next")
        out = out.union(frontier)


def trees_directed(edges: DataFrame, sinks: DataFrame) -> DataFrame:
    """(id, from_nexus_id, to_nexus_id): a forest's edges turned towards the nearest of ``sinks`` (id) by steps; edges of known direction stay as they are.

    Edges that no sink is reached by are left out.
    """
    ends = edges.select("id", F.col("from_nexus_id").alias("a"), F.col("to_nexus_id").alias("b"), "known")
    pairs = ends.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(ends.select("b", "a"))
    hops = stage_table(reachable(pairs, sinks), "tree-hops")
    # tables that grow with the network are small as files but not in the driver, which would hold several at once for broadcasts
    h = lambda c: hops.select(F.col("id").alias(c), F.col("hop").alias(f"hop_{c}")).hint("merge")
    keep = F.col("known") | (F.col("hop_a") > F.col("hop_b"))
    return ends.join(h("a"), "a").join(h("b"), "b").select("id", F.when(keep, F.col("a")).otherwise(F.col("b")).alias("from_nexus_id"), F.when(keep, F.col("b")).otherwise(F.col("a")).alias("to_nexus_id"))


def direct_group(edges: pd.DataFrame, sinks: set, turn: float, fed: set | None = None) -> pd.DataFrame:
    """Directions in one group of loops: columns id, a, b, length, known, x1, y1, x2, y2; rows id, flip.

    Nodes are ranged by their shortest way to the group's sinks, against no known edge, and unknown edges lead from the farther node to the nearer
    one; where known edges want another order they have it, so no cycle can come up. Then an unknown edge is turned if that brings its flow straighter by more than
    ``turn`` radians at both of its ends together, as long as no cycle comes up. With ``fed``, the nodes by which water comes in, any other node
    without inflow is fed before that, by turning a way of unknown edges from it to one that has some, if one closes no cycle.
    """
    rows = edges.sort_values("id", kind="stable").reset_index(drop=True)
    n = len(rows)
    a, b, known, length = rows["a"].tolist(), rows["b"].tolist(), rows["known"].tolist(), rows["length"].tolist()
    into: dict = {}
    for e in range(n):
        into.setdefault(b[e], []).append((a[e], e))
        if not known[e]:
            into.setdefault(a[e], []).append((b[e], e))
    nodes = set(a) | set(b)
    ends = sorted(sinks & nodes) or [min(nodes)]
    far = {s: 0 for s in ends}
    heap = [(0, s) for s in ends]
    while heap:
        d, v = heapq.heappop(heap)
        if d > far[v]:
            continue
        for u, e in into.get(v, ()):
            if d + length[e] < far.get(u, math.inf):
                far[u] = d + length[e]
                heapq.heappush(heap, (far[u], u))
    # all nodes in a row, farthest first, but none before those that known edges come from: unknown edges lead along it
    rank = {v: k for k, v in enumerate(sorted(nodes))}
    waits = dict.fromkeys(nodes, 0)
    down: dict = {}
    for e in range(n):
        if known[e]:
            waits[b[e]] += 1
            down.setdefault(a[e], []).append(b[e])
    ready = [(-far.get(v, math.inf), -rank[v], v) for v in nodes if not waits[v]]
    heapq.heapify(ready)
    place: dict = {}
    while ready:
        v = heapq.heappop(ready)[2]
        place[v] = len(place)
        for w in down.get(v, ()):
            waits[w] -= 1
            if not waits[w]:
                heapq.heappush(ready, (-far.get(w, math.inf), -rank[w], w))
    if len(place) < len(nodes):
        raise ValueError("edges of known direction make a cycle")
    flip = [not known[e] and place[a[e]] > place[b[e]] for e in range(n)]
    head = lambda e: a[e] if flip[e] else b[e]
    tail = lambda e: b[e] if flip[e] else a[e]
    x1, y1, x2, y2 = (rows[c].to_numpy() for c in ("x1", "y1", "x2", "y2"))
    bearing = np.arctan2(y2 - y1, x2 - x1)
    around: dict = {}
    for e in range(n):
        around.setdefault(a[e], []).append(e)
        around.setdefault(b[e], []).append(e)

    def way(e: int, turned: bool) -> float:
        return bearing[e] + (math.pi if flip[e] != turned else 0.0)

    def bend(e: int, turned: bool) -> float:
        """How far the flow bends at both ends, at best."""
        start, end = (head(e), tail(e)) if turned else (tail(e), head(e))
        total = 0.0
        for node, inward in ((start, True), (end, False)):
            near = [f for f in around[node] if f != e and (head(f) == node) == inward]
            if not near:
                return math.inf
            total += min(abs((way(e, turned) - way(f, False) + math.pi) % (2 * math.pi) - math.pi) for f in near)
        return total

    def reaches(starts: set, v, without: set) -> bool:
        seen, stack = set(starts), list(starts)
        while stack:
            w = stack.pop()
            if w == v:
                return True
            for f in around[w]:
                if f not in without and tail(f) == w and head(f) not in seen:
                    seen.add(head(f))
                    stack.append(head(f))
        return False

    def feeding(v) -> set:
        """A way of unknown edges from a node without inflow to one with other inflow, whose turning closes no cycle; empty if there is none."""
        back, queue = {v: None}, [v]
        for x in queue:  # grows on the way
            for e in around[x]:
                y = head(e)
                if known[e] or tail(e) != x or y in back or y in ends:
                    continue
                way_back, at = {e}, x
                while back[at] is not None:
                    way_back.add(back[at])
                    at = tail(back[at])
                if y not in fed and not any(head(f) == y and f != e for f in around[y]):
                    back[y] = e
                    queue.append(y)
                elif not reaches({tail(f) for f in way_back}, y, way_back):
                    return way_back
        return set()

    if fed is not None:
        for v in sorted(nodes, key=place.get):
            if v not in fed and all(tail(e) == v for e in around[v]):
                for e in feeding(v):
                    flip[e] = not flip[e]
    for e in range(n):
        if not known[e] and head(e) not in ends and bend(e, False) - bend(e, True) > turn and not reaches({tail(e)}, head(e), {e}):
            flip[e] = not flip[e]
    return pd.DataFrame({"id": rows["id"], "flip": flip})


def loops_directed(edges: DataFrame, sinks: DataFrame, turn: float = math.pi / 3, group: DataFrame | None = None, feed: bool = False) -> DataFrame:
    """(id, from_nexus_id, to_nexus_id) of the edges inside groups of loops, which ``group`` (id, component) holds if they are known; a group is one task's work.

    A group's sinks are those of ``sinks`` (id) in it and the nodes by which water leaves it: from which a bridge leads to a sink or a known
    edge goes out. A group without any drains to its smallest node. With ``feed`` nodes that no bridge leads to get inflow from within the group.
    """
    if group is None:
        group = stage_table(loop_groups(edges), "loop-groups")
    g = lambda c: group.select(F.col("id").alias(f"{c}_nexus_id"), F.col("component").alias(f"g_{c}")).hint("merge")
    e = edges.join(g("from"), "from_nexus_id").join(g("to"), "to_nexus_id")
    inner = stage_table(e.filter("g_from = g_to").withColumnRenamed("g_from", "g"), "loop-edges")
    bridges = stage_table(e.filter("g_from <> g_to"), "loop-bridges")
    # over the tree of groups, which way every bridge leads
    ends = group.join(sinks, "id", "left_semi").select(F.col("component").alias("id")).distinct()
    tree = trees_directed(bridges.select("id", F.col("g_from").alias("from_nexus_id"), F.col("g_to").alias("to_nexus_id"), "known"), ends)
    out = bridges.select("id", "from_nexus_id", "to_nexus_id", "g_from", "g_to").join(tree.select("id", F.col("from_nexus_id").alias("leaves")).hint("merge"), "id")
    side = lambda g, same: out.select(g.alias("g"), F.when(same, F.col("from_nexus_id")).otherwise(F.col("to_nexus_id")).alias("node"))
    doors = side(F.col("leaves"), F.col("leaves") == F.col("g_from")).union(group.join(sinks, "id", "left_semi").select("component", "id")).groupBy("g").agg(F.collect_set("node").alias("doors"))
    fed = side(F.when(F.col("leaves") == F.col("g_from"), F.col("g_to")).otherwise(F.col("g_from")), F.col("leaves") != F.col("g_from")).groupBy("g").agg(F.collect_set("node").alias("fed"))
    kind = dict(edges.dtypes)["id"]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        listed = lambda c: set() if frame[c].iloc[0] is None else set(frame[c].iloc[0])
        return direct_group(frame, listed("doors"), turn, listed("fed") if feed else None)

    rows = inner.join(doors, "g", "left").join(fed, "g", "left").select("g", "id", F.col("from_nexus_id").alias("a"), F.col("to_nexus_id").alias("b"), "length", "known", "x1", "y1", "x2", "y2", "doors", "fed")
    flips = rows.groupBy("g").applyInPandas(run, f"id {kind}, flip boolean")
    turned = inner.select("id", "from_nexus_id", "to_nexus_id").join(flips, "id")
    at = lambda x, y: F.when(F.col("flip"), F.col(y)).otherwise(F.col(x)).alias(x)
    return turned.select("id", at("from_nexus_id", "to_nexus_id"), at("to_nexus_id", "from_nexus_id"))


def directed(edges: DataFrame, sinks: DataFrame, turn: float = math.pi / 3, feed: bool = False) -> DataFrame:
    """(id, from_nexus_id, to_nexus_id): all edges of a network directed: bridges between groups of loops as a tree, the groups each by itself.

    Components without any of ``sinks`` drain to the node that ``chosen_sinks`` picks. ``feed`` is that of ``loops_directed``.
    """
    own = stage_table(sinks.select("id").union(chosen_sinks(edges, sinks).select("id")), "all-sinks")
    group = stage_table(loop_groups(edges), "loop-groups")
    g = lambda c: group.select(F.col("id").alias(f"{c}_nexus_id"), F.col("component").alias(f"g_{c}")).hint("merge")
    between = edges.join(g("from"), "from_nexus_id").join(g("to"), "to_nexus_id").filter("g_from <> g_to")
    ends = group.join(own, "id", "left_semi").select(F.col("component").alias("id")).distinct()
    tree = trees_directed(between.select("id", F.col("g_from").alias("from_nexus_id"), F.col("g_to").alias("to_nexus_id"), "known"), ends)
    way = between.select("id", "from_nexus_id", "to_nexus_id", "g_from").join(tree.select("id", F.col("from_nexus_id").alias("leaves")).hint("merge"), "id")
    same = F.col("leaves") == F.col("g_from")
    bridges = way.select("id", F.when(same, F.col("from_nexus_id")).otherwise(F.col("to_nexus_id")).alias("from_nexus_id"), F.when(same, F.col("to_nexus_id")).otherwise(F.col("from_nexus_id")).alias("to_nexus_id"))
    return bridges.union(loops_directed(edges, own, turn, group, feed))


def chosen_sinks(edges: DataFrame, sinks: DataFrame) -> DataFrame:
    """(component, id, why): a sink for every component that has none of ``sinks`` (id), by the first rule that a node fits, lowest id of several.

    A dead end that a known edge leads to; a dead end of a skeleton (ef_type 3); any dead end; any node.
    """
    comp = stage_table(connected_components(edges, "from_nexus_id", "to_nexus_id"), "sink-components")
    without = comp.join(comp.join(sinks, "id", "left_semi").select("component").distinct(), "component", "left_anti")
    end = lambda c, down: edges.select(F.col(c).alias("id"), (F.col("known") & F.lit(down)).cast("int").alias("down"), (F.col("ef_type") == 3).cast("int").alias("skeleton"))
    nodes = end("from_nexus_id", False).union(end("to_nexus_id", True)).groupBy("id").agg(F.count("*").alias("degree"), F.max("down").alias("down"), F.max("skeleton").alias("skeleton"))
    dead = F.col("degree") == 1
    rule = F.when(dead & (F.col("down") == 1), 1).when(dead & (F.col("skeleton") == 1), 2).when(dead, 3).otherwise(4)
    best = without.join(nodes, "id").groupBy("component").agg(F.min(F.struct(rule.alias("why"), "id")).alias("b"))
    return best.select("component", "b.id", "b.why")


# ---- straight ways and short edges


def _bearing(dx: str = "x", dy: str = "y") -> Column:
    return F.atan2(F.col(f"{dy}2") - F.col(f"{dy}1"), F.col(f"{dx}2") - F.col(f"{dx}1"))


def _fold(turn: Column) -> Column:
    """A difference of directions, from 0 to pi."""
    a = F.abs(turn)
    return F.when(a > math.pi, 2 * math.pi - a).otherwise(a)


def straightest_next(edges: DataFrame) -> DataFrame:
    """(id, next, turn): the edge out of each edge's lower node that bends least, lowest id of equals; edges that end a way have no row."""
    a = edges.select("id", F.col("to_nexus_id").alias("node"), _bearing().alias("in"))
    b = edges.select(F.col("id").alias("next"), F.col("from_nexus_id").alias("node"), _bearing().alias("out"))
    pairs = a.join(b, "node").select("id", "next", F.round(_fold(F.col("in") - F.col("out")), 6).alias("turn"))
    return pairs.groupBy("id").agg(F.min(F.struct("turn", "next")).alias("b")).select("id", "b.next", "b.turn")


def straightest_ways(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """(start, step, id): the ways from edges ``starts`` (id) on that always take the straightest edge; a way that meets itself has no row."""
    step = straightest_next(edges).select("id", "next")
    out = frontier = stage_table(starts.select(F.col("id").alias("start"), F.lit(0).alias("step"), "id"), "straight")
    at = 0
    while True:
        at += 1
        more = frontier.join(step, "id").select("start", F.lit(at).alias("step"), F.col("next").alias("id"))
        again = more.join(out.select("start", "id"), ["start", "id"], "left_semi").select("start").distinct()
        frontier = stage_table(more.join(again, "start", "left_anti").select("start", "step", "id"), "straight")
        looped = stage_table(again, "straight-loops")
        if not looped.isEmpty():
            out = stage_table(out.join(looped, "start", "left_anti").select("start", "step", "id"), "straight")
        if frontier.isEmpty():
            return out
        out = out.union(frontier)


def short_flips(edges: DataFrame, most: float) -> DataFrame:
    """(id): unknown edges shorter than ``most`` between nodes of degree three or more that run against the mean bearing of their neighbours.

    The mean is that of all other edges at its two nodes, as they run; more than a right angle off is against it. Flips that would close a
    cycle are left out, all of a cycle's together.
    """
    e = edges.select("id", "from_nexus_id", "to_nexus_id", "length", "known", _bearing().alias("t"))
    ends = e.select(F.col("from_nexus_id").alias("node")).union(e.select("to_nexus_id")).groupBy("node").agg(F.count("*").alias("degree")).filter("degree >= 3").select("node")
    node = lambda c: ends.withColumnRenamed("node", c)
    short = e.filter(~F.col("known") & (F.col("length") < most)).join(node("from_nexus_id"), "from_nexus_id", "left_semi").join(node("to_nexus_id"), "to_nexus_id", "left_semi")
    around = e.select(F.explode(F.array("from_nexus_id", "to_nexus_id")).alias("node"), F.col("id").alias("other"), F.cos("t").alias("cx"), F.sin("t").alias("cy"))
    near = short.select("id", "t", F.explode(F.array("from_nexus_id", "to_nexus_id")).alias("node")).join(around, "node").filter("other <> id")
    mean = near.groupBy("id").agg(F.first("t").alias("t"), F.sum("cx").alias("cx"), F.sum("cy").alias("cy"))
    against = stage_table(mean.filter(F.round(F.col("cx") * F.cos("t") + F.col("cy") * F.sin("t"), 9) < 0).select("id"), "short-flips")
    mark = edges.select("id", "from_nexus_id", "to_nexus_id").join(against.withColumn("f", F.lit(True)), "id", "left")
    turn = lambda a, b: F.when(F.col("f"), F.col(b)).otherwise(F.col(a)).alias(a)
    flipped = mark.select("id", turn("from_nexus_id", "to_nexus_id"), turn("to_nexus_id", "from_nexus_id"))
    # what is left after peeling from both sides lies on cycles or between them
    down = peel(flipped)
    looped = peel(down.select("id", F.col("to_nexus_id").alias("from_nexus_id"), F.col("from_nexus_id").alias("to_nexus_id")))
    return against.join(looped.select("id"), "id", "left_anti")


# ---- rank


def ranked(paths: DataFrame, weight: float = WIDTH_WEIGHT) -> DataFrame:
    """(id, rank): 2 for secondary flowpaths, else 1.

    At a fork a flowpath's score is its angle's (``angle_scores``), in a waterbody, where the channel's ``width`` is known, joined with its share of the
    fork's widths by ``weight``; all but the highest (lowest id of equals) are secondary. The mark goes on downstream through nodes
    of one flow in and one out, and through nodes all of whose inflows but bank flows are secondary.
    """
    scores = angle_scores(paths).join(paths.select("id", "width"), "id")
    share = F.col("width") / F.sum("width").over(Window.partitionBy("n"))
    score = F.round(F.when(F.col("width").isNull(), F.col("score")).otherwise(weight * share + (1 - weight) * F.col("score")), 6)
    best = scores.withColumn("score", score).groupBy("n").agg(F.max(F.struct("score", -F.col("id"))).alias("b")).select(F.col("n").alias("from_nexus_id"), (-F.col("b.col2")).alias("best"))
    p = paths.select("id", "from_nexus_id", "to_nexus_id", "ef_type").join(best, "from_nexus_id", "left")
    marked = stage_table(p.filter("best IS NOT NULL AND best <> id").select("id"), "secondary")
    flows = stage_table(p.filter("ef_type <> 2").select("id", "from_nexus_id", "to_nexus_id"), "rank-flows")
    single = flows.groupBy("from_nexus_id").agg(F.count("*").alias("n"), F.min("id").alias("id")).filter("n = 1").select(F.col("from_nexus_id").alias("node"), "id")
    total = flows.groupBy(F.col("to_nexus_id").alias("node")).agg(F.count("*").alias("all"))
    while True:
        into = flows.join(marked, "id", "left_semi").groupBy(F.col("to_nexus_id").alias("node")).agg(F.count("*").alias("secondary"))
        new = into.join(total, "node").filter("secondary = all").join(single, "node").select("id").join(marked, "id", "left_anti")
        new = stage_table(new, "secondary")
        if new.isEmpty():
            return paths.select("id").join(marked.withColumn("rank", F.lit(2)), "id", "left").select("id", F.coalesce("rank", F.lit(1)).alias("rank"))
        marked = stage_table(marked.union(new), "secondary")


# ---- catchments, pieces and paths


def classified_catchments(catchments: DataFrame, flows: DataFrame, touches: DataFrame, nexus_types: DataFrame) -> DataFrame:
    """(id, kind, nexus): the kind of catchments (id, ec_type or null for unknown) by the flowpaths (catchment) in them and the nodes (catchment, nexus) on their boundary.

    Without flowpaths: EMPTY if no node touches, BANK with that node if just one bank node does, else UNKNOWN. With flowpaths an unknown one is
    a REACH; one of a known type keeps it.
    """
    inside = flows.groupBy(F.col("catchment").alias("id")).agg(F.count("*").alias("flows"))
    on = touches.join(nexus_types.select(F.col("id").alias("nexus"), "nexus_type"), "nexus", "left").groupBy(F.col("catchment").alias("id"))
    on = on.agg(F.count("*").alias("touches"), F.count_if(F.col("nexus_type") == "BANK").alias("banks"), F.min(F.when(F.col("nexus_type") == "BANK", F.col("nexus"))).alias("nexus"))
    kind = F.when(F.col("flows").isNotNull(), F.coalesce(F.col("ec_type").cast("string"), F.lit("REACH"))).when(F.col("touches").isNull(), "EMPTY").when(F.col("banks") == 1, "BANK").otherwise("UNKNOWN")
    return catchments.select("id", "ec_type").join(inside, "id", "left").join(on, "id", "left").select("id", kind.alias("kind"), F.when(kind == "BANK", F.col("nexus")).alias("nexus"))


def subgraph(paths: DataFrame, node: DataFrame) -> DataFrame:
    """The flowpaths that any way joins to ``node`` (id), whatever their direction."""
    pairs = paths.select(F.col("from_nexus_id").alias("src"), F.col("to_nexus_id").alias("dst"))
    there = reachable(pairs.union(pairs.select("dst", "src")), node).select(F.col("id").alias("from_nexus_id"))
    return paths.join(there, "from_nexus_id", "left_semi").select(*paths.columns)


def longest_way(ways: DataFrame, component: DataFrame) -> DataFrame:
    """(component, id, distance): the start of the longest of the ways (id, distance) in each component (id, component), lowest id of equals."""
    best = F.max(F.struct("distance", -F.col("id"))).alias("b")
    return ways.join(component, "id").groupBy("component").agg(best).select("component", (-F.col("b.col2")).alias("id"), "b.distance")


def contracted(paths: DataFrame, least: float) -> DataFrame:
    """(id, from_nexus_id, to_nexus_id, length) when unknown edges shorter than ``least`` between nodes of degree three or more are contracted.

    A contracted group takes its smallest node's id; other edges that come to lie inside one go too.
    """
    ends = paths.select(F.col("from_nexus_id").alias("node")).union(paths.select("to_nexus_id")).groupBy("node").agg(F.count("*").alias("d")).filter("d > 2").select("node")
    node = lambda c: ends.withColumnRenamed("node", c)
    short = paths.filter((F.col("length") < least) & ~F.col("known")).join(node("from_nexus_id"), "from_nexus_id", "left_semi").join(node("to_nexus_id"), "to_nexus_id", "left_semi")
    short = stage_table(short.select("id", "from_nexus_id", "to_nexus_id"), "short-edges")
    comp = connected_components(short, "from_nexus_id", "to_nexus_id")
    moved = lambda c: comp.select(F.col("id").alias(c), F.col("component").alias(f"new_{c}"))
    out = paths.join(short, "id", "left_anti").join(moved("from_nexus_id"), "from_nexus_id", "left").join(moved("to_nexus_id"), "to_nexus_id", "left")
    new = lambda c: F.coalesce(f"new_{c}", c).alias(c)
    both = F.col("new_from_nexus_id").isNotNull() & F.col("new_from_nexus_id").eqNullSafe(F.col("new_to_nexus_id"))
    return out.filter(~both).select("id", new("from_nexus_id"), new("to_nexus_id"), "length")


# ---- names of skeletons in waterbodies


class _Flow(NamedTuple):
    id: object
    a: object
    b: object
    length: int
    rank: int


def name_waterbody(edges: pd.DataFrame, ends: pd.DataFrame, own: list) -> list[tuple]:
    """(edge, name) pairs for one waterbody: edges id, a, b, length, rank; ends node, name, way ('in' or 'out'); the waterbody's own names."""
    columns = lambda df, *names: zip(*[df[c].tolist() for c in names], strict=True)
    return named_ways([_Flow(*r) for r in columns(edges, *_Flow._fields)], [r for r in columns(ends, "node", "name", "way") if pd.notna(r[1])], own)


def named_ways(edges: list[_Flow], ends: list[tuple], own: list) -> list[tuple]:
    """(edge, name) pairs for one waterbody: its edges, the named flows (node, name, 'in' or 'out') at it, and its own names.

    For each name the counts of named flows in and out decide: with none and the water's own name, the longest primary way; one in and the water's
    name, the primary way down from it; one out and the water's name, the longest of the shortest ways to it; one in and one out, the
    primary way between them, else any; several on both sides, the longest primary way of all pairs, else the longest shortest one;
    several on one side alone name nothing.
    """
    out_of: dict = {}
    for r in sorted(edges, key=lambda r: r.id):
        out_of.setdefault(r.a, []).append(r)
    heads = {r.b for r in edges}

    def primary_way(start) -> list:
        way, seen, node = [], {start}, start
        while (nxt := next((r for r in out_of.get(node, ()) if r.rank == 1), None)) is not None and nxt.b not in seen:
            way.append(nxt)
            node = nxt.b
            seen.add(node)
        return way

    def shortest(start) -> dict:
        best, back, heap = {start: 0}, {}, [(0, start)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > best[u]:
                continue
            for r in out_of.get(u, ()):
                if d + r.length < best.get(r.b, math.inf):
                    best[r.b], back[r.b] = d + r.length, r
                    heapq.heappush(heap, (best[r.b], r.b))
        return back

    def way_to(back: dict, node) -> list | None:
        way = []
        while node in back:
            way.append(back[node])
            node = back[node].a
        return way[::-1] or None

    size = lambda way: sum(r.length for r in way)
    longest = lambda ways: max(sorted(ways, key=lambda w: [str(r.id) for r in w]), key=size, default=None)
    sources = sorted({r.a for r in edges} - heads)
    found = []
    for name in sorted({n for _, n, _ in ends} | set(own)):
        ins, outs = (sorted({node for node, n, w in ends if n == name and w == way}) for way in ("in", "out"))

        def between() -> list | None:
            ways = []
            for i in ins:
                down = primary_way(i)
                nodes = [r.b for r in down]
                ways += [down[: nodes.index(o) + 1] for o in outs if o in nodes]
            if not ways:
                ways = [w for i in ins for w in [way_to(shortest(i), o) for o in outs] if w]
            return longest(ways)

        way = None
        if not ins and not outs and name in own:
            way = longest([w for w in map(primary_way, sources) if w])
        elif len(ins) == 1 and not outs and name in own:
            way = primary_way(ins[0])
        elif not ins and len(outs) == 1 and name in own:
            way = longest([w for w in (way_to(shortest(s), outs[0]) for s in sources) if w])
        elif ins and outs:
            way = between()
        found += [(r.id, name) for r in way or ()]
    return found


def named_skeletons(edges: DataFrame, ends: DataFrame, waterbodies: DataFrame) -> DataFrame:
    """(id, name): names of skeletons (water, id, from_nexus_id, to_nexus_id, length, rank) by the named flows (water, node, name, way) into and out of their waterbody
    and its own name (water, name); a waterbody is one task's work. An edge that several names claim has a row for each."""
    # ids, nodes and names are texts here: pandas would make floats of whole numbers with nulls
    text = lambda c, n: F.col(c).cast("string").alias(n)
    none = lambda n: F.lit(None).cast("string").alias(n)
    zero = lambda n, kind: F.lit(0).cast(kind).alias(n)
    kinds = dict(edges.dtypes)
    blank = [none("id"), none("a"), none("b"), zero("length", kinds["length"]), zero("rank", kinds["rank"])]
    rows = edges.select(text("water", "water"), text("id", "id"), text("from_nexus_id", "a"), text("to_nexus_id", "b"), "length", "rank", none("node"), none("name"), F.lit("edge").alias("way"))
    rows = rows.union(ends.select(text("water", "water"), *blank, text("node", "node"), text("name", "name"), "way")).union(waterbodies.select(text("water", "water"), *blank, none("node"), text("name", "name"), F.lit("own")))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, "water"):
            found: list[tuple] = []
            for _, group in groupby(zip(*[frame[c].tolist() for c in frame.columns], strict=True), key=itemgetter(0)):
                own, flows, edge = [], [], []
                for _, i, a, b, length, rank, node, name, way in group:
                    if way == "edge":
                        edge.append(_Flow(i, a, b, length, rank))
                    elif name is not None:
                        own.append(name) if way == "own" else flows.append((node, name, way))
                found += named_ways(edge, flows, own) if edge else []
            yield pd.DataFrame(found, columns=["id", "name"]).astype(object)

    named = dealt(rows.filter("water IS NOT NULL"), "water").sortWithinPartitions("water").mapInPandas(run, "id string, name string")
    return named.select(F.col("id").cast(kinds["id"]).alias("id"), F.col("name").cast("long").alias("name"))
