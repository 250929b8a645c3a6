"""Ordered computations per key that stay parallel when one key holds much of the data.

A plain ``Window.partitionBy(key).orderBy(time)`` puts a whole key into one task. Here every key
is cut into slices of its order axis (an hour, a value range), and a slice with many rows into as
many parts as its count asks for. Four steps, none of which sees the rows of a whole key:

1. summarise every (key, slice, part) - a map-side combined aggregation;
2. carry the parts' summaries across their slice - a window of at most as many rows as parts;
3. carry the slices' totals across their key - a window of at most as many rows as slices;
4. put one carry row in front of every part and run the window inside the part.

The carry row travels in the same shuffle as the rows it precedes, so step 3 needs no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "__slice"
PART = "__part"
CARRY = "__carry"
# sorts before every position that can occur, and leaves room for a frame offset of one
BEFORE_ALL = -(1 << 62)

COMBINE = {"sum": F.sum, "max": F.max, "min": F.min}

# A slice with more rows than this is cut into four parts for each PART_ROWS rows it has.
PART_ROWS = 100_000


def with_slices(rows: DataFrame, keys: list[str], position: Column, width: int) -> DataFrame:
    """Add the slice of each row, the start of its ``width`` on the order axis, and its part.

    The parts of a slice follow from its count alone, so the plan is one and the same at every size.
    """
    coarse = rows.withColumn(SLICE, (position - F.pmod(position, F.lit(width))).cast("long"))
    busy = (
        coarse.groupBy(*keys, SLICE)
        .agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > PART_ROWS)
        .select(*keys, SLICE, F.greatest(F.lit(1), F.ceil(F.lit(float(width) * PART_ROWS / 4) / F.col("__n"))).cast("long").alias("__step"))
    )
    inside = F.floor(F.pmod(position, F.lit(width)) / F.col("__step")).cast("long")
    # at most one of PART_ROWS rows is a busy slice; without the hint the counts before the filter decide, and all rows are sorted to join
    return coarse.join(F.broadcast(busy), [*keys, SLICE], "left").withColumn(PART, F.coalesce(inside, F.lit(0))).drop("__step")


def _joined(how: str, a: Column, b: Column) -> Column:
    """Two carries as one; a null is no carry."""
    if how == "sum":
        return F.coalesce(a + b, a, b)
    return (F.greatest if how == "max" else F.least)(a, b)


def running_before(
    rows: DataFrame,
    keys: list[str],
    position: str,
    measures: dict[str, tuple[str, str]],
    width: int,
    inclusive: bool = False,
) -> DataFrame:
    """Add running aggregates over the rows of the same key that lie before each row.

    ``measures`` maps an output column to (how, input column), how being sum, max or min.
    "Before" is strict in ``position`` (a bigint): rows at the same position do not see each
    other, unless ``inclusive``. Keys and positions must not be null. Slices are ``width`` wide.
    """
    sliced = with_slices(rows, keys, F.col(position), width)

    summaries = sliced.groupBy(*keys, SLICE, PART).agg(
        *(COMBINE[how](value).alias(name) for name, (how, value) in measures.items())
    )
    totals = summaries.groupBy(*keys, SLICE).agg(*(COMBINE[how](name).alias(name) for name, (how, _) in measures.items()))

    def before(table: DataFrame, by: list[str], order: str, prefix: str) -> DataFrame:
        earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return table.select(
            *by, order, *(COMBINE[how](name).over(earlier).alias(prefix + name) for name, (how, _) in measures.items())
        )

    across = before(summaries, [*keys, SLICE], PART, "__parts_").join(
        before(totals, keys, SLICE, "__slices_"), [*keys, SLICE]
    )
    carries = across.select(
        *keys,
        SLICE,
        PART,
        F.lit(BEFORE_ALL).alias(position),
        *(_joined(how, F.col(f"__parts_{name}"), F.col(f"__slices_{name}")).alias(f"__in_{name}") for name, (how, _) in measures.items()),
        F.lit(True).alias(CARRY),
    ).where(" OR ".join(f"`__in_{name}` IS NOT NULL" for name in measures))

    # rows and carry rows share the measure columns' places
    numbered = sliced.select(
        "*",
        *(F.col(value).alias(f"__in_{name}") for name, (_, value) in measures.items()),
        F.lit(False).alias(CARRY),
    )
    upto = Window.currentRow if inclusive else -1
    inside = (
        Window.partitionBy(*keys, SLICE, PART).orderBy(position).rangeBetween(Window.unboundedPreceding, upto)
    )
    stacked = numbered.unionByName(carries, allowMissingColumns=True)
    return (
        stacked.select(
            *rows.columns,
            CARRY,
            *(COMBINE[how](f"__in_{name}").over(inside).alias(name) for name, (how, _) in measures.items()),
        )
        .where(~F.col(CARRY))
        .drop(CARRY)
    )


def neighbour(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    position: Column,
    width: int,
    values: dict[str, str],
    following: bool = False,
) -> DataFrame:
    """Add values of the previous (or following) row of the same key, in the order of ``order``.

    ``values`` maps an output column to the column read from the neighbour. ``position`` is the
    first order column as a bigint; slices are ``width`` wide on it. Keys must not be null.
    """
    sources = list(dict.fromkeys(values.values()))
    sliced = with_slices(rows, keys, position, width)
    place = F.struct(*order)
    packed = F.struct(*(F.col(c).alias(c) for c in sources))
    pick = F.min_by if following else F.max_by
    summaries = sliced.groupBy(*keys, SLICE, PART).agg(pick(packed, place).alias("__edge"))
    totals = summaries.groupBy(*keys, SLICE).agg(pick("__edge", PART).alias("__edge"))
    step = F.lead if following else F.lag
    parts = summaries.select(
        *keys, SLICE, PART, step("__edge").over(Window.partitionBy(*keys, SLICE).orderBy(PART)).alias("__part_edge")
    )
    slices = totals.select(
        *keys, SLICE, step("__edge").over(Window.partitionBy(*keys).orderBy(SLICE)).alias("__slice_edge")
    )
    carries = (
        parts.join(slices, [*keys, SLICE])
        .select(*keys, SLICE, PART, F.coalesce("__part_edge", "__slice_edge").alias("__edge"))
        .where(F.col("__edge").isNotNull())
        .select(*keys, SLICE, PART, *(F.col(f"__edge.{c}").alias(c) for c in sources if c not in keys), F.lit(True).alias(CARRY))
    )
    # a carry row has the edge's values in the columns they come from, so that no row travels with a second copy of them
    stacked = sliced.withColumn(CARRY, F.lit(False)).unionByName(carries, allowMissingColumns=True)
    edge_first = F.col(CARRY).asc() if following else F.col(CARRY).desc()
    inside = Window.partitionBy(*keys, SLICE, PART).orderBy(edge_first, *order)
    near = [step(source).over(inside).alias(name) for name, source in values.items()]
    return stacked.select(*rows.columns, CARRY, *near).where(~F.col(CARRY)).drop(CARRY)
