"""URL filters by a cascade of Bloom filters with exact membership over a closed key universe.

Level 0 holds the listed keys; level 1 the keys of the corpus that level 0 takes wrongly; level 2 the listed
keys that level 1 takes wrongly, and so on until a level takes nothing wrongly. A key of the universe is
listed exactly if the first level that rejects it is an odd one. No join is needed to ask: the levels travel
to the workers as a few bitmaps.

The bits of level 0 follow the ratio of universe to list, so that about as many wrong keys remain as keys are
listed; the cascade then grows with the list and only logarithmically with the corpus. Its size is known
before it is built; ``verdicts`` splits a list that would make it too large by hash of key.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thalweg.llm.bytesops import mix64
from thalweg.session import stage_table

MAX_BYTES = 64 << 20
MAX_LEVELS = 64
#: Bits of a bitmap that one task draws.
STRETCH = 1 << 22
_ASCII = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains and a prefix of the path."""

    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: np.ndarray

    def holds(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for k in range(self.hashes):
            p = _place(keys, k, self.bits)
            out &= (self.words[p >> 5] >> (p & 31).astype(np.uint32)) & np.uint32(1) == 1
        return out


def _place(keys: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The k-th bit of each 64-bit key hash."""
    salt = np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & 0xFFFFFFFFFFFFFFFF)
    return (mix64(keys.view(np.uint64) ^ salt) % np.uint64(bits)).astype(np.int64)


def level_shape(keys: int, false_rate: float) -> tuple[int, int]:
    """Bits and hash functions for a count of keys and a rate of wrong answers."""
    bits = max(64, math.ceil(keys * -math.log(min(0.5, false_rate)) / math.log(2) ** 2))
    return bits, max(1, round(bits / max(1, keys) * math.log(2)))


@dataclass(frozen=True)
class Cascade:
    """Levels from listed keys outwards; ``holds`` is exact for the keys of the universe it was built over."""

    levels: tuple[Level, ...]

    def holds(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), bool)
        alive = np.arange(len(keys))
        for depth, level in enumerate(self.levels):
            passed = level.holds(keys[alive])
            out[alive[~passed]] = depth % 2 == 1
            alive = alive[passed]
        out[alive] = len(self.levels) % 2 == 1
        return out

    @property
    def size(self) -> int:
        return sum(x.words.nbytes for x in self.levels)


def _build_level(hashes: DataFrame, count: int, false_rate: float) -> Level:
    """Bits are set in the workers, a stretch of the bitmap a task; what reaches the driver is the bitmap, as bytes."""
    bits, k = level_shape(count, false_rate)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False)
            p = np.concatenate([_place(h, i, bits) for i in range(k)]) if len(h) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(p // STRETCH), pa.array((p % STRETCH).astype(np.int32))], names=["s", "p"])

    def draw(frame: pd.DataFrame) -> pd.DataFrame:
        ones = np.zeros(STRETCH, np.uint8)
        ones[frame["p"].to_numpy()] = 1
        return pd.DataFrame({"s": frame["s"].iloc[:1], "b": [np.packbits(ones, bitorder="little").tobytes()]})

    # a stretch gets about as many places as it has bits at most, whatever the keys: they are hashed
    rows = hashes.select("h").mapInArrow(places, "s long, p int").groupBy("s").applyInPandas(draw, "s long, b binary").collect()
    words = np.zeros((bits // STRETCH + 1) * STRETCH // 32, np.uint32)
    for s, b in rows:
        words[s * STRETCH // 32 : (s + 1) * STRETCH // 32] = np.frombuffer(b, "<u4")
    return Level(bits, k, words[: bits // 32 + 1].copy())


def _asks(level: Level):
    @F.arrow_udf("boolean")
    def holds(keys: pa.Array) -> pa.Array:
        return pa.array(level.holds(keys.to_numpy(zero_copy_only=False)))

    return holds


def expected_bytes(listed: int, universe: int) -> int:
    """The size of a cascade, levels below the first together as large as one more of the second kind."""
    rate = min(0.5, listed / (math.sqrt(2) * max(1, universe)))
    return 2 * sum(level_shape(n, p)[0] for n, p in ((listed, rate), (listed, 0.5))) // 8


def build_cascade(listed: DataFrame, universe: DataFrame, size: int | None = None) -> Cascade:
    """A cascade for the keys ``h`` (64-bit hashes) of ``listed`` over those of ``universe``.

    The universe is read once: level 0 lets only about as many of its keys pass as are listed, and later
    levels look at these alone. Nulls in ``h`` are ignored, an empty list gives a cascade that holds nothing. ``size``
    is about how many distinct keys the universe has, counted if not given; it only sets the bits of level 0.
    """
    listed = stage_table(listed.filter("h is not null").distinct(), "cascade-listed")
    r = listed.count()
    if not r:
        return Cascade((Level(64, 1, np.zeros(3, np.uint32)),))
    s = max(1, universe.agg(F.approx_count_distinct("h")).first()[0] if size is None else size)
    levels = [_build_level(listed, r, min(0.5, r / (math.sqrt(2) * s)))]
    wrong = universe.filter("h is not null").filter(_asks(levels[0])("h")).select("h").distinct().join(listed, "h", "left_anti")
    inside, outside = listed, stage_table(wrong, "cascade-wrong")
    while n := outside.count():
        if len(levels) == MAX_LEVELS:
            raise RuntimeError(f"a cascade did not end in {MAX_LEVELS} levels")
        level = _build_level(outside, n, 0.5)
        levels.append(level)
        inside, outside = outside, stage_table(inside.filter(_asks(level)("h")), "cascade-wrong")
    return Cascade(tuple(levels))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return F.translate(F.regexp_extract(_rest(url), r"\A[^/?#]*", 0), _ASCII, _ASCII.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _shapes(rules: Iterable[Rule]) -> list[tuple[int, int]]:
    """The distinct (host labels, path characters) of rules: a url has one key of each."""
    return sorted({_shape(r) for r in rules})


def _shape(rule: Rule) -> tuple[int, int]:
    return rule.host.count(".") + 1, len(rule.path)


def _probes(shapes: list[tuple[int, int]]) -> Column:
    """A url's possible rule keys from columns ``host`` and ``path``, longest first (of equals the one with the longer host)."""
    parts = F.split("host", r"\.")
    found = []
    for number, (labels, chars) in enumerate(shapes):
        # a host has at least so many labels and its path so many characters, else no rule of this shape fits
        host = F.substring_index("host", ".", -labels)
        key = F.concat(host, F.substring("path", 1, chars)) if chars else host
        probe = F.struct((-F.length(key)).alias("size"), (-F.length(host)).alias("host_size"), key.alias("key"), F.lit(number).alias("shape"))
        found.append(F.when((F.size(parts) >= labels) & (F.length("path") >= chars) & (F.col("host") != ""), probe))
    return F.array_sort(F.array_compact(F.array(*found)))


def verdicts(pages: DataFrame, rules: list[Rule], default: str = "allow", max_bytes: int = MAX_BYTES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages`` (page_id, url, any more columns).

    A rule fits its host and all subdomains if the path starts with the rule's; the longest fitting key (host and path
    together) wins, of equally long ones that of the longer host. ``rule`` is null and ``verdict`` the default where no key of the url is
    listed, and so for null, empty and foreign texts. Rows repeat as they come; a rule listed twice must have one verdict.

    Each verdict has a cascade of its own. A list whose cascade would exceed ``max_bytes`` is split by hash of key into as many
    cascades as fit, which are asked one after another over the table, so that no task holds more than one.
    """
    spark = pages.sparkSession
    by_key: dict[str, str] = {}
    for r in rules:
        if by_key.setdefault(r.key, r.verdict) != r.verdict:
            raise ValueError(f"two verdicts for {r.key}")
    shapes = _shapes(rules)
    url = F.col("url").cast("string")
    base = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    if not shapes:
        return base.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    base = base.withColumn("probes", _probes(shapes))
    base = base.withColumn("h", F.transform("probes", lambda p: F.xxhash64(p["shape"], p["key"])))
    universe = base.select(F.explode("h").alias("h"))
    size = universe.agg(F.approx_count_distinct("h")).first()[0]
    firsts = {v: f"in_{k}" for k, v in enumerate(sorted(set(by_key.values())))}
    for verdict, name in firsts.items():
        listed = _listed(spark, [r for r in rules if r.verdict == verdict], shapes).select("h")
        parts = -(-expected_bytes(sum(v == verdict for v in by_key.values()), size) // max_bytes)
        base = base.withColumn(name, F.lit(None).cast("int"))  # the place of the first probe that is listed
        for part in range(parts):
            own = F.pmod(F.col("h"), F.lit(parts)) == part
            cascade = build_cascade(listed.filter(own), universe.filter(own), -(-size // parts))
            base = base.withColumn(name, F.least(name, _first_held(cascade, part, parts)("h")))
            if parts > 1:
                base = stage_table(base, "url-places")
    place = F.least(*firsts.values(), F.lit(None).cast("int"))
    verdict = F.coalesce(*[F.when(F.col(name) == place, v) for v, name in firsts.items()], F.lit(default))
    return base.select("page_id", "host", "path", F.get("probes", place)["key"].alias("rule"), verdict.alias("verdict"))


def _listed(spark: SparkSession, rules: Iterable[Rule], shapes: list[tuple[int, int]]) -> DataFrame:
    rows = [(shapes.index(_shape(r)), r.key) for r in rules]
    return spark.createDataFrame(rows, "shape int, key string").distinct().withColumn("h", F.xxhash64("shape", "key"))


def _first_held(cascade: Cascade, part: int, parts: int):
    """The place of the first of a list of keys that the cascade holds, of those that are its part; null if none."""

    @F.arrow_udf("int")
    def first(lists: pa.Array) -> pa.Array:
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        held = np.zeros(len(flat), bool)
        own = np.flatnonzero(flat % parts == part)
        held[own] = cascade.holds(flat[own])
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        marks = np.append(np.flatnonzero(held), len(flat))
        at = marks[np.searchsorted(marks, ends[:-1])]
        return pa.array((at - ends[:-1]).astype(np.int32), mask=at >= ends[1:])

    return first
