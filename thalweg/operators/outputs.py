"""Versions of tables that writers leave behind, and text formats of features and matrices."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thalweg.session import stage_table

#: States that a block of work may have (fixed values).
BLOCK_STATES = ("READY", "EXTRACTED", "DISABLED", "COMPLETE", "FAILEDQA", "ERROR")


# ---- new versions of tables


def prepared(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A copy of each input table in the shared folder, on which a job works; inputs are never changed."""
    return {name: stage_table(df, f"output-{name}") for name, df in tables.items()}


def appended(df: DataFrame, new: DataFrame) -> DataFrame:
    """``df`` with the rows of ``new``; columns that ``new`` lacks are null there, those that ``df`` lacks are left out."""
    have = set(new.columns)
    return df.union(new.select(*[F.col(c).cast(t) if c in have else F.lit(None).cast(t).alias(c) for c, t in df.dtypes]))


def replaced(df: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``df`` without the rows whose ``key`` is in ``new``, and the rows of ``new``."""
    return df.join(new.select(key).distinct(), key, "left_anti").select(*df.columns).unionByName(new.select(*df.columns))


def new_catchments(df: DataFrame, new: DataFrame, kinds: tuple[int, ...] = (1, 2)) -> DataFrame:
    """Catchments with all of the delineated ``kinds`` (reach and bank) gone and the new ones in their place."""
    return appended(df.filter(~F.coalesce(F.col("ec_type").isin(*kinds), F.lit(False))), new)


def with_stats(catchments: DataFrame, stats: DataFrame, columns: list[str]) -> DataFrame:
    """Catchments with the columns of ``stats`` (id, ...) in place of their own; null where it has no row."""
    kept = [c for c in catchments.columns if c not in columns]
    return catchments.select(*kept).join(stats.select("id", *columns), "id", "left")


def by_block(df: DataFrame, size: float) -> DataFrame:
    """Write rows (with minx, miny) under their block (bx, by), a folder each, and return the table: a filter on the block reads only its folder."""
    placed = df.withColumn("bx", F.floor(F.col("minx") / size)).withColumn("by", F.floor(F.col("miny") / size)).withColumn("block", F.concat_ws("_", "bx", "by"))
    return stage_table(placed.select(*[c for c in placed.columns if c != "block"], "block"), "blocks", "block")


def block_states(blocks: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(block, state, message) after ``outcomes`` (block, state, message); an unknown state is an error, a block without an outcome stays as it is."""
    known = F.col("_state").isin(*BLOCK_STATES) | F.col("_state").isNull()
    joined = blocks.join(outcomes.select("block", F.col("state").alias("_state"), F.col("message").alias("_message")), "block", "left")
    state = F.when(known, F.coalesce("_state", "state")).otherwise(F.raise_error(F.concat(F.lit("unknown state "), F.col("_state"))))
    return joined.select("block", state.alias("state"), F.when(F.col("_state").isNotNull(), F.col("_message")).otherwise(F.col("message")).alias("message"))


def error_log(process: str, kinds: list[tuple[str, DataFrame, Column, Column]]) -> DataFrame:
    """(process, type, message, x, y) rows of what went wrong: for each kind its type, rows (with x, y), message and whether a row counts."""
    arms = [df.filter(wrong).select(F.lit(process).alias("process"), F.lit(kind).alias("type"), message.alias("message"), "x", "y") for kind, df, message, wrong in kinds]
    return reduce(DataFrame.unionByName, arms)


# ---- the tile cache: (key, tile, last_accessed), a batch of calls at a time


def tiles_touched(cache: DataFrame, keys: DataFrame, now: Column) -> DataFrame:
    """The cache after its ``keys`` (key) were asked for at ``now``."""
    asked = keys.select("key", F.lit(True).alias("_asked")).distinct()
    return cache.join(asked, "key", "left").select("key", "tile", F.when(F.col("_asked"), now).otherwise(F.col("last_accessed")).alias("last_accessed"))


def tiles_found(cache: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, found, tile) for each of ``keys`` (key); null where the cache lacks it."""
    return keys.select("key").distinct().join(cache.select("key", "tile", F.lit(True).alias("_found")), "key", "left").select("key", F.coalesce("_found", F.lit(False)).alias("found"), "tile")


def tiles_set(cache: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """The cache with ``new`` tiles (key, tile), which take the place of older ones."""
    return replaced(cache, new.select("key", "tile", now.alias("last_accessed")), "key")


def tiles_removed(cache: DataFrame, keys: DataFrame) -> DataFrame:
    return cache.join(keys.select("key"), "key", "left_anti").select("key", "tile", "last_accessed")


# ---- text formats


def json_text(fields: dict[str, Column]) -> Column:
    """A JSON object of the fields that aren't null, in order."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def jsonp_text(callback: str, json: Column) -> Column:
    """A call of ``callback`` with a JSON text; the name must be that of a function."""
    if not re.fullmatch(r"[A-Za-z_$][\w$.]*", callback):
        raise ValueError(f"not the name of a function: {callback}")
    return F.concat(F.lit(f"{callback}("), json, F.lit(");"))


def html_escaped(text: Column) -> Column:
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(mark), F.lit(name))
    return text


def html_rows(title: Column, fields: dict[str, Column]) -> Column:
    """An HTML table of a feature: a heading and a row a field; nulls are empty."""
    rows = [F.concat(F.lit(f"<tr><td>{n}</td><td>"), html_escaped(F.coalesce(c.cast("string"), F.lit(""))), F.lit("</td></tr>")) for n, c in fields.items()]
    return F.concat(F.lit("<table><caption>"), html_escaped(title), F.lit("</caption>"), *rows, F.lit("</table>"))


def matrix_rows(pairs: DataFrame, points: list, value: str) -> DataFrame:
    """(point, headers, row): a matrix of (from, to, value) as a row of text a point, in the order of ``points``; null where there is no value.

    Points are those of a request, and few.
    """
    wide = pairs.groupBy("from").agg(F.map_from_entries(F.collect_list(F.struct("to", value))).alias("_m"))
    names = pairs.sparkSession.createDataFrame([(p,) for p in points], f"point {dict(pairs.dtypes)['from']}")
    cells = [F.coalesce(F.try_element_at("_m", F.lit(p)).cast("string"), F.lit("null")) for p in points]
    headers = F.lit("[" + ",".join(str(p) for p in points) + "]")
    return names.join(wide, F.col("point") == F.col("from"), "left").select("point", headers.alias("headers"), F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]")).alias("row"))
