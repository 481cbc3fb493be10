"""Values that stand in texts: ids, points and boxes, and columns by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def is_uuid(text: Column) -> Column:
    """Whether a text is a UUID in its usual form; false for null."""
    return F.coalesce(text.rlike(_UUID), F.lit(False))


def parsed_uuid(text: Column) -> Column:
    """A UUID in lower case, with or without its dashes in the input; null of anything else."""
    bare = F.lower(F.replace(F.trim(text), F.lit("-"), F.lit("")))
    spans = [F.substring(bare, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(bare.rlike("^[0-9a-f]{32}$"), F.concat_ws("-", *spans))


def parsed_points(text: Column) -> Column:
    """Groups of four, ``id,x,y,c``, in a row: an array of struct<id, x, y, c>; a list that is no multiple of four is an error, null or blank is empty."""
    parts = F.transform(F.split(text, ","), lambda t: F.trim(t))
    count = F.size(parts)
    groups = F.transform(
        F.sequence(F.lit(0), F.call_function("div", count, F.lit(4)).cast("int") - 1),
        lambda i: F.struct(F.get(parts, 4 * i).alias("id"), F.get(parts, 4 * i + 1).cast("double").alias("x"), F.get(parts, 4 * i + 2).cast("double").alias("y"), F.get(parts, 4 * i + 3).cast("int").alias("c")),
    )
    empty = F.array().cast("array<struct<id:string,x:double,y:double,c:int>>")
    return F.when(F.coalesce(F.trim(text), F.lit("")) == "", empty).when(count % 4 != 0, F.raise_error(F.lit("points come in groups of four: id,x,y,c"))).otherwise(groups)


def parsed_bounds(text: str, lowest: tuple[float, float] = (-180.0, -90.0), highest: tuple[float, float] = (180.0, 90.0)) -> tuple[float, float, float, float]:
    """minx, miny, maxx, maxy of ``x1,y1,x2,y2``; corners may come in any order; what is no box within the bounds is an error."""
    try:
        x1, y1, x2, y2 = (float(v) for v in text.split(","))
    except (ValueError, AttributeError):
        raise ValueError(f"not four numbers: {text}") from None
    box = min(x1, x2), min(y1, y2), max(x1, x2), max(y1, y2)
    if not (lowest[0] <= box[0] and lowest[1] <= box[1] and box[2] <= highest[0] and box[3] <= highest[1]):
        raise ValueError(f"outside of {lowest} to {highest}: {text}")
    return box


def resolved(df: DataFrame, wanted: list[str], optional: list[str] = ()) -> DataFrame:
    """The ``wanted`` columns by name, whatever the case; an ``optional`` one that is missing is null, another one an error, two that differ in case only too."""
    found: dict[str, list[str]] = {}
    for c in df.columns:
        found.setdefault(c.lower(), []).append(c)
    out = []
    for name in wanted:
        own = found.get(name.lower(), [])
        if len(own) > 1 or not own and name not in optional:
            raise ValueError(f"{len(own)} columns are named {name}")
        out.append(F.col(f"`{own[0]}`").alias(name) if own else F.lit(None).cast("string").alias(name))
    return df.select(*out)
