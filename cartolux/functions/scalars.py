"""Column functions of coordinates and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Distances below the first say nothing, from the second on they count whole.
SHORT, LONG = 600, 2200


def line_through(x1: Column, x2: Column, y1: Column, y2: Column) -> tuple[Column, Column]:
    """Slope and intercept of the line through two points; null where both share one x."""
    width = F.nullif(x1 - x2, F.lit(0))
    return (y1 - y2) / width, (x1 * y2 - x2 * y1) / width


def unit_line(x1: Column, x2: Column, y1: Column, y2: Column) -> tuple[Column, Column]:
    """The line of slope one or minus one through the middle of two points."""
    slope = F.when((x1 - x2) * (y1 - y2) >= 0, 1).otherwise(-1)
    return slope, ((y1 + y2) - slope * (x1 + x2)) / 2


def distance_weight(size: Column) -> Column:
    """0 up to SHORT, 1 from LONG on, rising in between."""
    return F.when(size <= SHORT, 0.0).when(size >= LONG, 1.0).otherwise(F.floor((size - 800) / 1600 * 10000 + 0.5) / 10000)


def distance_counts(size: Column) -> Column:
    return F.when(size > SHORT, 1).otherwise(0)


def cost_limit(pairs: Column) -> Column:
    """The cost that an alignment of so many pairs may have."""
    return F.when(pairs <= 6, pairs * 3.0).otherwise(F.floor((pairs * 1.05 - 3.3) * pairs * 100 + 0.5) / 100)


def insertion_index(positions: Column, at: Column, slack: float = 0.1) -> Column:
    """0-based index of the position that ``at`` meets within ``slack``, else where it would be put."""
    return F.size(F.filter(positions, lambda p: p < at - slack))


def turned_positions(positions: Column, length: Column) -> Column:
    return F.reverse(F.transform(positions, lambda p: length - p))


def shared_gap(ends: Column, starts: Column) -> Column:
    """Mean distance from one anchor's ends to the next one's starts over the channels both have."""
    both = F.filter(F.zip_with(ends, starts, lambda a, b: b - a), lambda d: d.isNotNull())
    return F.when(F.size(both) > 0, F.aggregate(both, F.lit(0.0), lambda s, d: s + d.cast("double")) / F.size(both))


def newest_common_version(versions: Column) -> Column:
    """The smallest of the file versions, which all inputs can be read as."""
    return F.array_min(F.transform(versions, lambda v: v.cast("double")))
