"""Scalar functions (F1-F13) on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: File endings that count as images.
IMAGE_ENDINGS = (".tif", ".tiff", ".lif", ".czi", ".nd2", ".lsm", ".oib", ".ims")
COLUMN_NAME = r"^(spine|head|neck)_C(\d+)_(mean_int|max_int|int_density)$"


def stem(name: Column) -> Column:
    """without a .tif at the end."""
    return F.regexp_replace(name, r"\.tif$", "")


def is_image(name: Column, endings: tuple[str, ...] = IMAGE_ENDINGS) -> Column:
    """F1."""
    out = F.lit(False)
    for e in endings:
        out |= name.endswith(e)
    return out


def short_title(name: Column) -> Column:
    """F2: without the last four characters; brackets, signs and spaces as underscores."""
    return F.translate(F.substring(name, F.lit(1), F.length(name) - 4), "()-+ ", "_____")


def model_name(name: Column) -> Column:
    """with _0000 at the end, once."""
    return F.when(name.endswith("_0000"), name).otherwise(F.concat(name, F.lit("_0000")))


def tile_name(name: Column, index: Column) -> Column:
    """F3."""
    return F.format_string("%s_patch%04d_0000.tif", name, index)


def case_name(name: Column) -> Column:
    """without a nine-character ending."""
    return F.substring(name, F.lit(1), F.length(name) - 9)


def dataset_id(path: Column) -> Column:
    """the first run of three digits in the last part of a path, null without one."""
    found = F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"(\d{3})", 1)
    return F.when(found != "", found)


def column_parts(name: Column) -> Column:
    """struct(region, channel, stat) of a measurement's name, null for others."""
    part = [F.regexp_extract(name, COLUMN_NAME, i) for i in (1, 2, 3)]
    return F.when(name.rlike(COLUMN_NAME), F.struct(part[0].alias("region"), part[1].try_cast("int").alias("channel"), part[2].alias("stat")))


def progress(line: Column) -> Column:
    """`NN% [Time left: mm:ss]` from a progress line, other lines as they are."""
    pattern = r"(\d+)%.*?([\d:]+)"
    return F.when(line.rlike(pattern), F.concat(F.regexp_extract(line, pattern, 1), F.lit("% [Time left: "), F.regexp_extract(line, pattern, 2), F.lit("]"))).otherwise(line)


def date_stamp(ts: Column) -> Column:
    """F7."""
    return F.date_format(ts, "yyyy-MM-dd")


def gamma(v: Column, top: Column, power: float = 0.4) -> Column:
    """F8: (v / top) ** power of clipped values."""
    return F.pow(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(v, top), F.lit(0.0)))), F.lit(power))


def cross(a: list[Column], b: list[Column]) -> list[Column]:
    """F9."""
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def dot(a: list[Column], b: list[Column]) -> Column:
    return sum((x * y for x, y in zip(a, b, strict=True)), F.lit(0.0))


def norm(a: list[Column]) -> Column:
    return F.sqrt(dot(a, a))


def safe_divide(a: Column, b: Column) -> Column:
    """null where b is 0 or either is missing or no number."""
    return F.try_divide(F.nanvl(a, F.lit(None).cast("double")), F.nanvl(b, F.lit(None).cast("double")))


def argmax(a: Column) -> Column:
    """0-based place of the largest element, the first of equals."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def argmin(a: Column) -> Column:
    return (F.array_position(a, F.array_min(a)) - 1).cast("int")


def unravel(index: Column, shape: tuple[int, int, int]) -> list[Column]:
    """coordinates of a linear index."""
    return [F.floor(index / (shape[1] * shape[2])).cast("int"), (F.floor(index / shape[2]) % shape[1]).cast("int"), (index % shape[2]).cast("int")]


def lookup(keys: list, values: list, key: Column) -> Column:
    """a small mapping as a literal map."""
    return F.element_at(F.map_from_arrays(F.array(*map(F.lit, keys)), F.array(*map(F.lit, values))), key)


def as_label(c: Column) -> Column:
    """a number where the text is one, else null."""
    return c.try_cast("long")
