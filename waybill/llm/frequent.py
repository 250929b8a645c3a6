"""The most frequent keys of a table of counts, as a table of bounded size."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def most_frequent(counts: DataFrame, key: str, count: str, most: int, always: Column | None = None) -> pd.DataFrame:
    """(key, count) of at most `most` keys, in falling order of the count: all those above a level of counts (sixteen levels from a
    number to its double). Only the number of keys a level, and then the chosen rows, reach the driver, from however many tasks.
    Keys for which `always` holds are added, and come first."""
    wanted = F.lit(False) if always is None else F.coalesce(always, F.lit(False))
    rows = counts.select(key, count, F.floor(16 * F.log2(F.col(count).cast("double"))).cast("int").alias("level"), wanted.alias("wanted"))
    sizes = sorted(((r.level, r["count"]) for r in rows.groupBy("level").count().collect()), reverse=True)
    cut, held = None, 0
    for level, n in sizes:
        held += n
        if held > most:
            break
        cut = level
    chosen = F.col("wanted") if cut is None else F.col("wanted") | (F.col("level") >= cut)
    top = rows.where(chosen).select(key, count, "wanted").toPandas()
    return top.sort_values(["wanted", count, key], ascending=[False, False, True])[[key, count]].reset_index(drop=True)
