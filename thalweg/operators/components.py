"""Connected components by hanging local maxima on their neighbours, then at once or by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.session import stage_table

#: Rounds grow with the logarithm of a component's size; reaching this many is an error, never a silent stop.
MAX_ROUNDS = 60


#: Up to so many edges, 16 bytes each, a graph is done by one task; rounds over the cluster only pay beyond.
AT_ONCE = 2_000_000


def label(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node each is connected with, by smallest neighbours and pointer jumping."""
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return nodes, nodes[root]


def _label_all(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = list(frames)
    if held:
        whole = pd.concat(held)
        nodes, low = label(whole["u"].to_numpy(), whole["v"].to_numpy())
        yield pd.DataFrame({"id": nodes, "component": low})


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", at_once: int = AT_ONCE) -> DataFrame:
    """Return ``(id, component)`` for every endpoint; ``component`` is the smallest id reachable.

    Self-loops count as a node of their own, repeated edges count once, edges with a null end are
    ignored, and no edges give no rows. Neighbour lists are never gathered: each step is a minimum
    per node (combined before the shuffle) and a join that adaptive execution may split. A graph of at most ``at_once``
    edges with whole-number ids goes to a single task instead; a larger one is hung up first, as long as that makes it clearly smaller.
    """
    pairs = (
        edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
        .filter(F.col("u").isNotNull() & F.col("v").isNotNull())
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    pairs = stage_table(pairs, "cc-edges")
    kind = dict(pairs.dtypes)["u"]
    fits = lambda n: at_once and kind in ("bigint", "int") and n <= at_once
    now = pairs.count()
    if not at_once or fits(now):
        return _settled(pairs, fits(now))
    links = stage_table(pairs.filter("u <> v"), "cc-links")
    alone = stage_table(pairs.filter("u = v").join(links, "u", "left_anti").select(F.col("u").alias("id")).join(links.select(F.col("v").alias("id")), "id", "left_anti"), "cc-alone")
    hung: list[DataFrame] = []
    now = links.count()
    while now and not fits(now):
        up, rest = _hung(links)
        before, now = now, rest.count()
        hung.append(up)
        links = rest
        if now > before * 7 // 8:
            break
    parts = alone.select("id", F.col("id").alias("component"))
    if now:
        parts = parts.union(stage_table(_settled(links, fits(now)), "cc-core"))
    for up in reversed(hung):  # what the last hung on ended up in the core, or is the smallest of all
        found = up.join(parts.select(F.col("id").alias("on"), "component"), "on", "left").select("id", "on", F.coalesce("component", "on").alias("component"))
        roots = up.select(F.col("on").alias("id")).distinct().join(parts, "id", "left_anti").select("id", F.col("id").alias("component"))
        parts = parts.union(stage_table(found.select("id", "component").union(roots), "cc-hung"))
    return parts


def _hung(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hang every node without a larger neighbour on its smallest one: rows (id, on), and the links (u, v), u > v, that are left, its others now the smallest one's."""
    ends = links.select(F.col("u").alias("id"), F.col("v").alias("on")).union(links.select(F.col("v"), F.lit(None).cast(dict(links.dtypes)["v"])))
    up = stage_table(ends.groupBy("id").agg(F.min("on").alias("on"), F.bool_or(F.col("on").isNull()).alias("below")).filter("NOT below").select("id", "on"), "cc-up")
    moved = links.join(up.withColumnRenamed("id", "u"), "u", "left").select(F.coalesce("on", "u").alias("u"), "v").filter("u <> v")
    return up, stage_table(moved.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-links")


def _settled(pairs: DataFrame, whole: bool) -> DataFrame:
    """Components of distinct pairs (u, v), u >= v, by one task if ``whole``, else in rounds."""
    if whole:
        kind = dict(pairs.dtypes)["u"]
        return pairs.repartition(1).mapInPandas(_label_all, f"id {kind}, component {kind}")
    nodes = pairs.select(F.col("u").alias("id")).union(pairs.select(F.col("v").alias("id"))).distinct()
    loops = pairs.filter("u <> v")
    before = None
    for _ in range(MAX_ROUNDS):
        # large star: every larger neighbour goes to the smallest node around
        both = loops.select("u", "v").union(loops.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        loops = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        low = loops.groupBy("u").agg(F.min("v").alias("m"))
        loops = (
            loops.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u <> v")
            .distinct()
        )
        loops = stage_table(loops, "cc-round")
        # the edge multiset is a fixed point exactly when every node hangs on its root
        now = loops.agg(
            F.count("*").alias("n"), F.countDistinct("u").alias("d"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if now == before:
            return nodes.join(loops.select(F.col("u").alias("id"), F.col("v").alias("component")), "id", "left").select(
                "id", F.coalesce("component", "id").alias("component")
            )
        before = now
    raise RuntimeError(f"connected components did not settle in {MAX_ROUNDS} rounds")
