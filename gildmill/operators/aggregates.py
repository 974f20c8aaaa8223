"""Per-key aggregates, combined in each map task before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_and_count(
    df: DataFrame, key: str, value: str, mean: str = "avg_rating", count: str = "rating_count"
) -> DataFrame:
    """Mean and count of the non-null values, as double and bigint."""
    v = F.col(value).cast("double")
    return df.groupBy(key).agg(F.avg(v).alias(mean), F.count(v).alias(count))


def left_join_aggregate(
    base: DataFrame,
    aggregate: DataFrame | None,
    key: str,
    mean: str = "avg_rating",
    count: str = "rating_count",
) -> DataFrame:
    """Attach a pre-aggregate: a key without facts has a null mean and a zero count."""
    if aggregate is None:
        return base.withColumns({mean: F.lit(None).cast("double"), count: F.lit(0).cast("bigint")})
    joined = base.join(aggregate.select(key, mean, count), key, "left")
    return joined.withColumn(count, F.coalesce(F.col(count), F.lit(0).cast("bigint")))
