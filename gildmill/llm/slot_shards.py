"""Sharding by fixed virtual slots and a stored, versioned slot-to-shard map.

Records hash into a fixed number of slots by id and text. Bytes and rows are counted per slot, and a
map gives each slot a shard so that the shards' bytes are near equal. To rebalance, the map
is edited: a new version moves some slots, all others stay, and no record is hashed anew.

A slot that is much heavier than the others (many rows with one id and one text, or none), or than a
task should hold, is split into sub-slots that the map records and places one by one. Rows of a
split slot are dealt to its sub-slots by their position in the input.

The law is ``bytes``: shards' bytes are near equal whatever the ids and texts are. Equal texts are
not kept together.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gildmill.llm.common import hash52, reduce_tasks

SLOTS = 4096
HEAVY = 4  # times the mean bytes of a slot
SLOT_BYTES = 256 << 20
MAP_SCHEMA = "version int, vslot int, sub int, subs int, shard int, n_rows long, n_bytes long"


def slot_of(doc_id: str, text: str, slots: int = SLOTS):
    digest = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    return F.pmod(hash52(F.lit("slot"), F.col(doc_id), digest), F.lit(slots)).cast("int")


def size_of(text: str):
    """UTF-8 bytes of the text (null: none) plus one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def slot_totals(docs: DataFrame, doc_id="doc_id", text="text", slots: int = SLOTS) -> DataFrame:
    """(vslot, n_rows, n_bytes) of the slots in use."""
    return (
        docs.select(slot_of(doc_id, text, slots).alias("vslot"), size_of(text).alias("size"))
        .groupBy("vslot")
        .agg(F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"))
    )


def split_slots(
    totals: dict[int, tuple[int, int]], slots: int = SLOTS, slot_bytes: int = SLOT_BYTES
) -> dict[tuple[int, int, int], tuple[int, int]]:
    """{(vslot, sub, subs): (rows, bytes)}, the totals of a split slot shared out evenly."""
    most = min(slot_bytes, HEAVY * max(1, sum(size for _, size in totals.values()) // slots))
    out = {}
    for vslot in range(slots):
        rows, size = totals.get(vslot, (0, 0))
        subs = max(1, min(rows, -(-size // most))) if size > most else 1
        for sub in range(subs):
            share = [n * (sub + 1) // subs - n * sub // subs for n in (rows, size)]
            out[vslot, sub, subs] = (share[0], share[1])
    return out


def _rows(version: int, shard_of: dict, totals: dict) -> list[tuple]:
    return [(version, *unit, shard_of[unit], *totals[unit]) for unit in sorted(shard_of)]


def first_map(
    totals: dict[int, tuple[int, int]], shards: int, slots: int = SLOTS, slot_bytes: int = SLOT_BYTES
) -> list[tuple]:
    """Version 1: largest slot first, each to the shard with the fewest bytes so far."""
    units = split_slots(totals, slots, slot_bytes)
    loads = [(0, s) for s in range(shards)]
    shard_of = {}
    for unit in sorted(units, key=lambda u: (-units[u][1], u)):
        load, shard = heapq.heappop(loads)
        shard_of[unit] = shard
        heapq.heappush(loads, (load + units[unit][1], shard))
    return _rows(1, shard_of, units)


def grown_map(rows: list[tuple]) -> list[tuple]:
    """The next version with one more shard: slots move into it only, from the fullest shards."""
    totals = {r[1:4]: (r[5], r[6]) for r in rows}
    shard_of = {r[1:4]: r[4] for r in rows}
    new = max(shard_of.values()) + 1
    loads = dict.fromkeys(range(new), 0)
    held: dict[int, list[tuple]] = {s: [] for s in range(new)}
    for v, s in shard_of.items():
        loads[s] += totals[v][1]
        held[s].append(v)
    for own in held.values():
        own.sort(key=lambda v: (totals[v][1], v))
    goal = sum(loads.values()) / (new + 1)
    taken = 0
    while taken < goal:
        fullest = max(loads, key=lambda s: (loads[s], -s))
        fits = [v for v in held[fullest] if 0 < totals[v][1] <= goal - taken]
        if not fits:
            break
        v = fits[-1]
        held[fullest].remove(v)
        shard_of[v] = new
        loads[fullest] -= totals[v][1]
        taken += totals[v][1]
    return _rows(rows[0][0] + 1, shard_of, totals)


def save_map(spark: SparkSession, rows: list[tuple], path: str) -> DataFrame:
    """Append a version of the map to its table: a row per slot or sub-slot."""
    df = spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1)
    df.write.mode("append").parquet(path)
    return read_map(spark, path, rows[0][0])


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    stored = spark.read.schema(MAP_SCHEMA).parquet(path)
    return stored.filter(F.col("version") == version)


def plan_shards(
    docs: DataFrame, path: str, shards: int = 8, doc_id="doc_id", text="text", slots: int = SLOTS
) -> tuple[DataFrame, DataFrame]:
    """Versions 1 (``shards``) and 2 (one more) of the map, stored at ``path``.

    Only the totals of the slots come to the driver: ``slots`` rows at most. The map grows beyond
    that by one row for each ``SLOT_BYTES`` of a split slot.
    """
    totals = {
        r["vslot"]: (r["n_rows"], r["n_bytes"])
        for r in slot_totals(docs, doc_id, text, slots).collect()
    }
    spark = docs.sparkSession
    rows = first_map(totals, shards, slots)
    return save_map(spark, rows, path), save_map(spark, grown_map(rows), path)


def write_shards(
    docs: DataFrame, slot_map: DataFrame, path: str, doc_id="doc_id", text="text", slots: int = SLOTS
) -> DataFrame:
    """Write whole rows into one folder per shard and read them back.

    Adds ``shard``, ``vslot``, ``sub`` and ``slot``, the row's place in its shard (gapless from 0, by
    virtual slot and id); input columns of these names are replaced. Rows are dealt and sorted
    once, by shard and slot, so a shard's files are contiguous runs of slots; no task holds a
    shard. Places within a slot are written with the rows; the slots' first places are summed up
    from them afterwards, a row per slot, and joined. The map, a row per slot too, is
    broadcast. Null texts stay null and have size 1; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("shard", "vslot", "sub", "slot", "__place", "__deal")]
    split = slot_map.groupBy("vslot").agg(F.max("subs").alias("__subs"))
    placed = (
        docs.select(*kept, slot_of(doc_id, text, slots).alias("vslot"))
        .withColumn("__deal", F.monotonically_increasing_id())
        .join(F.broadcast(split), "vslot")
        .withColumn("sub", F.pmod(F.xxhash64("__deal"), F.col("__subs")).cast("int"))
        .join(F.broadcast(slot_map.select("vslot", "sub", "shard")), ["vslot", "sub"])
        .repartitionByRange(reduce_tasks(spark), "shard", "vslot", "sub")
    )
    unit = ("shard", "vslot", "sub")
    order = Window.partitionBy(*unit).orderBy(doc_id, F.octet_length(text), "__deal")
    out = placed.withColumn("__place", (F.row_number().over(order) - 1).cast("long"))
    out = out.select(*kept, "vslot", "sub", "__place", "shard")
    out.write.mode("overwrite").partitionBy("shard").parquet(path)

    stored = spark.read.schema(out.schema).parquet(path)
    counts = stored.groupBy(*unit).agg(F.count("*").alias("n"))
    upto = Window.partitionBy("shard").orderBy("vslot", "sub").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*unit, F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("__first"))
    found = stored.join(F.broadcast(first), list(unit))  # a row per slot, as the map
    return found.select(*kept, "vslot", "sub", (F.col("__first") + F.col("__place")).alias("slot"), "shard")
