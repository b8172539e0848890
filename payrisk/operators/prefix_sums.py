"""Running totals over a whole table in any order, without gathering it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payrisk.session import current_workspace

PART = "__part"


def running_totals(
    df: DataFrame, values: Sequence[str], order_by: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Add ``<value>_before`` for every value: its sum over the rows that come earlier.

    Rows are range-partitioned by (by, order_by) and stored with their part's number. A part's
    totals are one row; only these are summed across parts, and each part orders its own rows.
    Rows should be unique in (by, order_by): aggregate first, so that a value a third of all
    rows share is a single row.
    """
    keys = [*by, *order_by]
    ranged = df.repartitionByRange(*keys).withColumn(PART, F.spark_partition_id())
    ranged = current_workspace(df.sparkSession).stored(ranged, "ranges")
    totals = ranged.groupBy(*by, PART).agg(*[F.sum(v).alias(v) for v in values])
    earlier = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"__{c}") for c in by],
        F.col(PART).alias("__at"),
        *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"__{v}") for v in values],
    )
    same = F.col(PART) == F.col("__at")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    inside = Window.partitionBy(*by, PART).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(offsets, same).withColumns(
        {f"{v}_before": F.col(f"__{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values}
    )
    return placed.select(*df.columns, *[f"{v}_before" for v in values])
