"""Row accounting of a stage and of a load."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

KEPT = "kept"
RANGES = 4096
MISSING, EXTRA, CHANGED = "missing", "extra", "changed"


def stage_metrics(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows in, rows dropped by each rule and rows out, in one pass.

    ``rules`` maps a reason to its keep predicate. A row counts under the first
    rule that it fails; a predicate that is null fails.
    """
    reason = F.lit(None).cast("string")
    for name, keep in reversed(rules.items()):
        reason = F.when(~F.coalesce(keep, F.lit(False)), F.lit(name)).otherwise(reason)
    r = F.coalesce(reason, F.lit(KEPT))
    counted = df.select(r.alias("r")).agg(
        F.count(F.lit(1)).alias("rows_in"),
        *[F.count_if(F.col("r") == n).alias(f"dropped_{n}") for n in rules],
        F.count_if(F.col("r") == KEPT).alias("rows_out"),
    )
    return counted


def reconcile(source: DataFrame, sink: DataFrame, key: str) -> DataFrame:
    """Compare a load with its source by key: counts, missing, extra and repeated keys.

    A tagged union and one grouped count take the place of a full outer join.
    """
    tagged = source.select(key, F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
        sink.select(key, F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    per_key = tagged.groupBy(key).agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    return per_key.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("sink_rows"),
        F.count_if(F.col("t") == 0).alias("missing_keys"),
        F.count_if(F.col("s") == 0).alias("extra_keys"),
        F.count_if((F.col("s") > 0) & (F.col("t") > 0) & (F.col("s") != F.col("t"))).alias(
            "changed_keys"
        ),
    )


class RowCounts:
    """Rows that pass the points of a job, counted while it runs.

    Each point names the rule before it. The counts are there once the job's result has been
    written; nothing is read for them. Only where adaptive execution finds that the result is empty
    does it drop the points from the plan; their rows are then counted on their own.
    """

    def __init__(self) -> None:
        self.points: list[tuple[str, Observation, DataFrame]] = []
        self._passed: list[int] | None = None

    def __call__(self, df: DataFrame, rule: str) -> DataFrame:
        rows = Observation()
        self.points.append((rule, rows, df))
        return df.observe(rows, F.count(F.lit(1)).alias("rows"))

    def passed(self) -> list[int]:
        if self._passed is None:
            self._passed = [_observed(rows, df) for _, rows, df in self.points]
        return self._passed

    def dropped(self) -> dict[str, int]:
        """Rows that each rule after the first point removed."""
        passed = self.passed()
        return {rule: before - after for (rule, *_), before, after in zip(self.points[1:], passed, passed[1:])}


def _observed(rows: Observation, df: DataFrame) -> int:
    try:
        return rows.get["rows"]
    except Py4JJavaError:  # the point's row of metrics has no columns
        return df.count()


def uncounted(df: DataFrame, rule: str) -> DataFrame:
    """In place of ``RowCounts`` where nobody asks."""
    return df


@dataclass(frozen=True)
class RangeReport:
    """``summary`` as of ``reconcile``; the unequal ``ranges`` of keys; ``keys`` (key, difference)."""

    summary: DataFrame
    ranges: list[int]
    keys: DataFrame


def reconcile_ranges(
    source: DataFrame, sink: DataFrame, key: str, columns: list[str] | None = None, ranges: int = RANGES
) -> RangeReport:
    """Compare whole rows of a load with its source, by key only where a checksum differs.

    Keys fall into ``ranges`` by hash. Each side's rows and the sum of their hashes are added up
    per range, whatever their order, in the map tasks first: that is all which is shuffled of equal
    ranges. Rows of unequal ranges alone are compared by key. ``columns`` (default: those of the
    source that the sink has) are compared; a repeated key differs in its sum or count.
    """
    columns = columns or [c for c in source.columns if c in sink.columns]
    rows = _hashed(source, key, columns, ranges, 1, 0).unionByName(_hashed(sink, key, columns, ranges, 0, 1))
    unequal = (F.col("s") != F.col("t")) | (F.col("s_sum") != F.col("t_sum"))
    summed = _sides(rows, "range").withColumn("unequal", unequal).collect()  # ``ranges`` rows
    differing = sorted(r["range"] for r in summed if r["unequal"])
    near = rows.where(F.col("range").isin(differing)) if differing else rows.limit(0)
    kind = (
        F.when(F.col("t") == 0, MISSING).when(F.col("s") == 0, EXTRA).when(unequal, CHANGED).alias("difference")
    )
    keys = _sides(near, key).select(key, kind).where(F.col("difference").isNotNull())
    counted = keys.agg(*[F.count_if(F.col("difference") == d).alias(d) for d in (MISSING, EXTRA, CHANGED)])
    summary = counted.select(
        F.lit(sum(r["s"] for r in summed)).cast("bigint").alias("source_rows"),
        F.lit(sum(r["t"] for r in summed)).cast("bigint").alias("sink_rows"),
        *[F.col(d).alias(f"{d}_keys") for d in (MISSING, EXTRA, CHANGED)],
    )
    return RangeReport(summary, differing, keys)


def _hashed(df: DataFrame, key: str, columns: list[str], ranges: int, s: int, t: int) -> DataFrame:
    return df.select(
        key,
        F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int").alias("range"),
        F.xxhash64(*columns).cast("decimal(20, 0)").alias("h"),
        F.lit(s).alias("s"),
        F.lit(t).alias("t"),
    )


def _sides(rows: DataFrame, by: str) -> DataFrame:
    zero = F.lit(0).cast("decimal(20, 0)")
    return rows.groupBy(by).agg(
        F.sum("s").alias("s"),
        F.sum("t").alias("t"),
        F.sum(F.when(F.col("s") == 1, F.col("h")).otherwise(zero)).alias("s_sum"),
        F.sum(F.when(F.col("t") == 1, F.col("h")).otherwise(zero)).alias("t_sum"),
    )
