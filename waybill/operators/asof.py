"""As-of join: each row with the whole latest row of its key at or before its own moment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.timing import MICROS_PER_DAY, micros
from waybill.operators.ordered import running_before

AT, ROW, LAST, LEFT = "__at", "__row", "__last", "__left"


def as_of(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, columns: list[str],
    width: int = MICROS_PER_DAY, inclusive: bool = True,
) -> DataFrame:
    """``left`` with ``columns`` of the latest row of ``right`` of the same key, nulls where there is none.

    Both sides go onto one time axis, and the latest row so far is a running maximum of (moment, columns): it travels over the parts
    of a key as one carry, so a key with a third of all rows is spread over its parts and no pairs are made. Of right rows at one
    moment the largest columns win. A left row without key or moment finds nothing, a right one is not looked at. With ``inclusive``
    a right row at the left row's own moment counts. Names of ``columns`` that ``left`` has as well are an error.
    """
    if clash := set(columns) & set(left.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    usable = F.col(key).isNotNull() & F.col(left_ts).isNotNull()
    rest = [c for c in left.columns if c != key]
    packed = F.struct(micros(right_ts).alias(AT), *columns)
    kind = right.select(packed.alias(ROW)).schema[ROW].dataType
    asking = left.where(usable).select(*left.columns, micros(left_ts).alias(AT), F.lit(None).cast(kind).alias(ROW), F.lit(True).alias(LEFT))
    known = right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull())
    known = known.select(key, *(F.lit(None).cast(left.schema[c].dataType).alias(c) for c in rest), micros(right_ts).alias(AT), packed.alias(ROW), F.lit(False).alias(LEFT))
    seen = running_before(asking.unionByName(known), [key], AT, {LAST: ("max", ROW)}, width, inclusive).where(LEFT)
    found = seen.select(*left.columns, *(F.col(f"{LAST}.{c}").alias(c) for c in columns))
    none = left.where(~usable).select("*", *(F.lit(None).cast(right.schema[c].dataType).alias(c) for c in columns))
    return found.unionByName(none)
