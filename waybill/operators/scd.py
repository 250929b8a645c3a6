"""Slowly changing dimension, type 2."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.timing import MICROS_PER_DAY, micros
from waybill.operators.asof import as_of
from waybill.operators.ordered import neighbour
from waybill.session import materialize

EFFECTIVE, END, CURRENT = "effective_date", "end_date", "is_current"


def _same(names: list[str], prefix: str):
    same = F.lit(True)
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(prefix + name))
    return same


def build_history(
    changes: DataFrame, key: str, attributes: list[str], change_ts: str, rank: str | None = None
) -> DataFrame:
    """Versions of every key: changes in time order without no-ops, each open until the next.

    At one instant the largest ``rank`` wins, then the largest attribute values. Days cut the time axis, so a key with very
    many changes is spread over its days. Both neighbour steps read their input twice, so it is
    written once instead of being computed again.
    """
    dated = changes.where(F.col(key).isNotNull() & F.col(change_ts).isNotNull()).groupBy(key, change_ts).agg(
        F.max(F.struct(*([rank] if rank else []), *attributes)).alias("__attributes")
    ).select(key, change_ts, *(f"__attributes.{a}" for a in attributes))
    dated = materialize(dated, "scd-changes")
    compared = neighbour(
        dated,
        [key],
        [change_ts],
        micros(change_ts),
        MICROS_PER_DAY,
        {**{f"__prev_{a}": a for a in attributes}, "__prev_ts": change_ts},
    )
    versions = compared.where(F.col("__prev_ts").isNull() | ~_same(attributes, "__prev_")).select(
        key, *attributes, F.col(change_ts).alias(EFFECTIVE)
    )
    versions = materialize(versions, "scd-versions")
    ended = neighbour(
        versions, [key], [EFFECTIVE], micros(EFFECTIVE), MICROS_PER_DAY, {END: EFFECTIVE}, following=True
    )
    return ended.withColumn(CURRENT, F.col(END).isNull())


def upsert(dimension: DataFrame, updates: DataFrame, key: str, attributes: list[str], change_ts: str) -> DataFrame:
    """Rebuild the keys that have updates from their own versions and the updates; all others stay as they are.

    Late changes fall into their place and repeated ones vanish as no-ops, so running an upsert twice changes nothing. An update at
    the instant of a version corrects it.
    """
    changed = updates.where(F.col(key).isNotNull() & F.col(change_ts).isNotNull()).select(F.col(key).alias("__changed")).distinct()
    same = F.col(key) == F.col("__changed")
    known = dimension.join(changed, same, "left_semi").select(key, *attributes, F.col(EFFECTIVE).alias(change_ts), F.lit(0).alias("__rank"))
    corrections = updates.select(key, *attributes, change_ts, F.lit(1).alias("__rank"))
    rebuilt = build_history(known.unionByName(corrections), key, attributes, change_ts, "__rank")
    return dimension.join(changed, same, "left_anti").select(*rebuilt.columns).unionByName(rebuilt)


def valid_at(facts: DataFrame, dimension: DataFrame, key: str, ts: str, attributes: list[str]) -> DataFrame:
    """Facts with the attributes of the version that was valid at their moment, and its ``effective_date``; nulls before the first one.

    Versions follow each other without gaps, so the latest one begun is the valid one.
    """
    return as_of(facts, dimension, key, ts, EFFECTIVE, [*attributes, EFFECTIVE])


def upsert_summary(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Versions inserted, updated (end or state differs) and closed by an upsert."""
    old = before.select(key, EFFECTIVE, F.col(END).alias("__old_end"), F.lit(True).alias("__old"))
    joined = after.join(old, [key, EFFECTIVE], "left")
    existed = F.coalesce(F.col("__old"), F.lit(False))
    changed = existed & ~F.col(END).eqNullSafe(F.col("__old_end"))
    return joined.agg(
        F.count_if(~existed).alias("rows_inserted"),
        F.count_if(changed).alias("rows_updated"),
        F.count_if(changed & F.col("__old_end").isNull()).alias("records_closed"),
    )
