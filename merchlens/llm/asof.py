"""As-of joins whose hot keys are cut by time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of the order column at most; a key's rows are worked on range by range.
RANGES = 256


def latest_before(rows: DataFrame, keys: list[str], at: str, found: str, ranges: int = RANGES) -> DataFrame:
    """``rows`` with the column ``found`` replaced by the latest earlier one of its key.

    ``found`` is a struct whose first field equals ``at`` (an integer), or null where the
    row offers nothing. Every row gets the greatest struct among rows of equal keys and
    strictly smaller ``at``; rows with a null key or ``at`` get null and offer nothing.

    The order column is cut at approximate quantiles of all rows, so a key with a third
    of them is worked on in many tasks; what a range hands on is one struct per key.
    """
    named = F.lit(True)
    for key in keys:
        named = named & F.col(key).isNotNull()
    rows = rows.withColumn(found, F.when(named & F.col(at).isNotNull(), F.col(found)))
    edges = rows.agg(
        F.percentile_approx(at, [k / ranges for k in range(1, ranges)], 4 * ranges)
    ).first()[0]
    cuts = F.array(*[F.lit(e) for e in sorted(set(edges or ()))]).cast("array<bigint>")
    rows = rows.withColumn("__range", F.size(F.filter(cuts, lambda e: e < F.col(at))))
    offered = rows.where(F.col(found).isNotNull()).groupBy(*keys, "__range").agg(
        F.max(found).alias("__last")
    )
    met = rows.where(named).select(*keys, "__range").distinct()
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    handed = (
        met.join(offered, [*keys, "__range"], "left")
        .withColumn("__handed", F.max("__last").over(earlier))
        .drop("__last")
    )
    inside = Window.partitionBy(*keys, "__range").orderBy(at).rangeBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("__own", F.max(found).over(inside))
    joined = own.join(handed, [*keys, "__range"], "left")
    best = F.when(named & F.col(at).isNotNull(), F.greatest("__own", "__handed"))
    return joined.select(*[best.alias(c) if c == found else F.col(f"`{c}`") for c in rows.columns if c != "__range"])
