"""Key mapping, orphan handling and enrichment joins without fan-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildmill.operators.dedup import first_per_key

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
_FIXED_WIDTH = 16


def measured_bytes(df: DataFrame) -> int:
    """In-memory size estimate from one narrow aggregate over the rows."""
    fixed = _FIXED_WIDTH
    variable: list[Column] = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            variable.append(F.octet_length(f.name))
        elif isinstance(f.dataType, T.BinaryType):
            variable.append(F.length(f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(
            f.dataType.elementType, T.NumericType
        ):
            variable.append(F.greatest(F.size(f.name), F.lit(0)) * 8)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            variable.append(F.octet_length(F.to_json(F.struct(f.name))))
        fixed += _FIXED_WIDTH
    width = sum((F.coalesce(v, F.lit(0)) for v in variable), F.lit(fixed))
    return df.agg(F.sum(width.cast("long")).alias("b")).first()["b"] or 0


def broadcast_if_small(
    df: DataFrame, measured: DataFrame | None = None, limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Mark for broadcast only when measured below ``limit``.

    ``measured`` may be a cheaper table that bounds ``df`` from above. Beyond the
    limit the join shuffles both sides and AQE splits hot keys.
    """
    return F.broadcast(df) if measured_bytes(df if measured is None else measured) <= limit else df


def map_keys(
    facts: DataFrame,
    mapping: DataFrame,
    key: str,
    target: str,
    alias: str,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Add ``alias``, the mapped key; facts without one drop out.

    The mapping is reduced to one row per key first, so no fact repeats.
    """
    raw = mapping.where(F.col(key).isNotNull() & F.col(target).isNotNull())
    one = first_per_key(raw, [key], [F.col(target), *[F.col(c) for c in raw.columns]])
    extra = [c for c in one.columns if c != key and c not in facts.columns]
    one = one.select(key, *extra, F.col(target).alias(alias))
    return facts.join(broadcast_if_small(one, raw, broadcast_limit), key, "inner")


def drop_orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key exists in the parent, each once."""
    return child.join(parent.select(key), key, "left_semi")


MISSING_PARENT = "no_parent"
MISSING_CHILD = "no_child"


def orphan_report(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Keys found on one side only, with the side and the row count.

    One tagged union and one grouped count: a hot key is combined in each map
    task, which two anti joins would not do.
    """
    tagged = child.select(key, F.lit(1).alias("c"), F.lit(0).alias("p")).unionByName(
        parent.select(key, F.lit(0).alias("c"), F.lit(1).alias("p"))
    )
    sides = tagged.where(F.col(key).isNotNull()).groupBy(key)
    counts = sides.agg(F.sum("c").alias("c"), F.sum("p").alias("p"))
    return counts.where("c = 0 or p = 0").select(
        key,
        F.when(F.col("p") == 0, MISSING_PARENT).otherwise(MISSING_CHILD).alias("reason"),
        F.greatest("c", "p").alias("n_rows"),
    )


def left_enrich(
    base: DataFrame,
    side: DataFrame | None,
    key: str,
    columns: dict[str, str],
    order_by: list[str | Column] | None = None,
    side_is_unique: bool = False,
) -> DataFrame:
    """Left join that keeps the base row count.

    ``columns`` maps each wanted side column to its type. The side is pruned and
    reduced to one row per key before the shuffle; an absent side gives typed nulls.
    """
    if side is None:
        return base.withColumns({c: F.lit(None).cast(t) for c, t in columns.items()})
    if not side_is_unique:
        side = first_per_key(side.where(F.col(key).isNotNull()), [key], order_by)
    return base.join(side.select(key, *columns), key, "left")
