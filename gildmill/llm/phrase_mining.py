"""Phrase collocations by dynamic itemset counting over cyclic shard scans.

Texts are divided into shards that are scanned in turn, round and round. Words are counted from
the first scan. A longer phrase becomes active with the scan after both of its subphrases
(without its last, without its first word) have reached the threshold in what has been counted so
far, and is then counted in every shard once: until it has completed one full cycle. So phrases
of different lengths are counted in the same scans, and phrases that cannot be frequent never
are. The scans end when all active phrases have completed their cycle.

A scan is a job: tasks count the active phrases of blocks of text exactly (words are numbered per
block, so no hash takes part), Spark adds up, and the shard's counts are written by length and
by the scan in which the phrases started. What has been reached is known to the next scan's tasks
by tables of fixed size, one byte per slot: the scan in which the first phrase of that slot reached
the threshold. These tables alone define when a phrase is active, so each phrase's cycle is whole.
Phrases that share a slot with a frequent one may be counted needlessly; every count is exact
whatever the tables' size. Nothing else is broadcast and no vocabulary reaches the driver.

Scores and the last ranks are DataFrame operations; products are decimals of 38 digits, exact
while a phrase occurs fewer than 10^16 times.

Null texts are empty, null languages ``und``. Repeated rows count each; ids and other columns
are not read. Texts without words give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gildmill.llm.common import materialize, mix64, scratch_path, ship_package, slices, whole_text

LEAST = 10
LENGTHS = 3
SHARDS = 2
SLOTS = 1 << 24
KEEP = 2000
COVERED = 50  # percent of a phrase's occurrences that lie in one longer candidate
SCALE = 1_000_000
SALTS = 32
BLOCK = 4 << 20  # bytes of text counted at a time
UNKNOWN = "und"
NEVER = 255
# Fixed patterns of the texts.
BREAKS = r"[.,;:!?\x0A-\x0D]"
BLANKS = r"[\x20\x09]+"
BREAK = "\n"  # stands between pieces, as a word of its own

COUNTS = "k int, start int, lang string, phrase string, c long"

# ---------------------------------------------------------------- inside tasks


def _byte_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit number per string, from its bytes and their places."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    lengths = np.diff(offsets)
    place = (np.arange(len(data)) - np.repeat(offsets[:-1], lengths)).astype(np.uint64)
    mixed = mix64(data.astype(np.uint64) + (place << np.uint64(9)) + np.uint64(1))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    return mix64(sums[offsets[1:]] - sums[offsets[:-1]] + lengths.astype(np.uint64))


def _word_hashes(words: pa.Array, lang: str) -> np.ndarray:
    return mix64(_byte_hashes(words) ^ _byte_hashes(pa.array([lang], pa.string())))


def _longer(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The numbers of phrases with one more word."""
    return mix64(phrase * np.uint64(0x9E3779B97F4A7C15) + word)


def _slot(hashes: np.ndarray, slots: int) -> np.ndarray:
    return (hashes % np.uint64(slots)).astype(np.int64)


def phrase_slots(phrases: pa.Array, langs: pa.Array, k: int, slots: int) -> np.ndarray:
    """The slots of phrases of ``k`` words."""
    words = pc.list_flatten(pc.split_pattern(phrases, " "))
    hashes = mix64(_byte_hashes(words) ^ np.repeat(_byte_hashes(langs), k)).reshape(len(phrases), k)
    return _slot(reduce(_longer, hashes.T), slots)


class ShardScan:
    """Counts the phrases that are active in scan ``step`` of ``shards`` cyclic ones."""

    def __init__(self, step: int, shards: int, lengths: int, reached: list[bytes], slots: int):
        self.step, self.shards, self.lengths, self.slots = step, shards, lengths, slots
        self.reached = [np.frombuffer(r, np.uint8) for r in reached]

    def block(self, texts: pa.Array, lang: str) -> Iterator[pa.RecordBatch]:
        """Normalised texts of one language."""
        flat = pc.list_flatten(pc.split_pattern(texts, " "))
        coded = flat.filter(pc.not_equal(flat, "")).dictionary_encode()
        names, word = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        held = pc.not_equal(names, BREAK).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(held[word])
        if not len(at):
            return
        if self.step < self.shards:
            counts = np.bincount(word[at], minlength=len(names))
            some = np.flatnonzero(counts)
            yield self._rows(1, 0, lang, names.take(pa.array(some)), counts[some])
        hashes = _word_hashes(names, lang)
        since, phrase = self.reached[0][_slot(hashes, self.slots)][word[at]], hashes[word[at]]
        for k in range(2, self.lengths + 1):
            # A phrase of k words is one of k - 1 at its place and another at the next. ``since``
            # is the scan by which the shorter ones were reached.
            first = np.flatnonzero(at[1:] == at[:-1] + 1)
            at, both = at[first], np.maximum(since[first], since[first + 1])
            start = both.astype(np.int64) + 1
            on = np.flatnonzero((both != NEVER) & (start <= self.step) & (self.step < start + self.shards))
            for begun in np.unique(start[on]):
                yield self._phrases(k, int(begun), lang, names, word, at[on[start[on] == begun]])
            if k < self.lengths:
                phrase = _longer(phrase[first], hashes[word[at + k - 1]])
                # Another phrase may have marked the slot before this one could be counted.
                since = np.maximum(self.reached[k - 1][_slot(phrase, self.slots)], both)

    def _phrases(self, k: int, start: int, lang: str, names: pa.Array, word: np.ndarray, at: np.ndarray):
        """Equal phrases once, with their number. Numbers of shorter ones are dense before the next word joins."""
        n = len(names)
        code = word[at]
        for i in range(1, k):
            if i > 1:
                code = np.unique(code, return_inverse=True)[1]
            code = code * n + word[at + i]
        _, first, counts = np.unique(code, return_index=True, return_counts=True)
        parts = [names.take(pa.array(word[at[first] + i])) for i in range(k)]
        return self._rows(k, start, lang, pc.binary_join_element_wise(*parts, " "), counts)

    @staticmethod
    def _rows(k: int, start: int, lang: str, phrase: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        n = len(counts)
        columns = [
            pa.array(np.full(n, k, np.int32)),
            pa.array(np.full(n, start, np.int32)),
            pa.repeat(pa.scalar(lang, pa.string()), n),
            phrase,
            pa.array(counts.astype(np.int64)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["k", "start", "lang", "phrase", "c"])


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, str]]:
    for lang in batch.column("lang").unique().to_pylist():
        yield batch.filter(pc.equal(batch.column("lang"), lang)), lang


# ---------------------------------------------------------------- scans


def normalised(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, text): lower case of A to Z; pieces and words parted by single blanks."""
    lower = F.translate(whole_text(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    broken = F.regexp_replace(F.regexp_replace(lower, BREAKS, f" {BREAK} "), BLANKS, " ")
    ended = F.concat(broken, F.lit(f" {BREAK}"))
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), ended.alias("text"))


def _scan(shard: DataFrame, step: int, shards: int, lengths: int, reached, slots: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = ShardScan(step, shards, lengths, reached.value, slots)
        for batch in batches:
            for rows, lang in _by_language(batch):
                for part in slices(rows, "text", BLOCK):
                    yield from scan.block(part.column("text"), lang)

    return shard.mapInArrow(run, COUNTS)


def _mark(table: np.ndarray, found: DataFrame, k: int, step: int) -> bool:
    """Enter ``step`` for the slots of ``found`` that were not reached before; were there any?

    The slots come as a bit map: len(table) / 64 numbers at most.
    """
    slots = len(table)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = phrase_slots(b.column("phrase"), b.column("lang"), k, slots)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(slot))], names=["slot"])

    bits = F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")
    placed = found.select("phrase", "lang").mapInArrow(place, "slot long")
    rows = placed.groupBy(F.expr("slot >> 6").alias("word")).agg(bits).toArrow()
    words = np.zeros(slots // 64, np.int64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    held = np.unpackbits(words.view(np.uint8), bitorder="little").astype(bool)
    new = held & (table == NEVER)
    table[new] = step
    return bool(new.any())


def frequent_phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    lengths: int = LENGTHS,
    shards: int = SHARDS,
    slots: int = SLOTS,
) -> tuple[DataFrame, DataFrame]:
    """(k, lang, phrase, f) of all phrases that occur ``least`` times, and (lang, n) of all words.

    ``slots`` is a multiple of 64; ``shards * lengths`` is less than 255.
    """
    spark = docs.sparkSession
    ship_package(spark)
    stored = scratch_path(spark, "shards")
    # Any division will do: which shard a text is in does not matter to a count.
    shard = F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")
    divided = normalised(docs, text, lang).withColumn("shard", shard)
    divided.write.partitionBy("shard").parquet(stored)

    tally = scratch_path(spark, "phrase-counts")
    tables = {k: np.full(slots, NEVER, np.uint8) for k in range(1, lengths)}
    starts: dict[int, set[int]] = {1: {0}, **{k: set() for k in range(2, lengths + 1)}}
    complete: dict[int, list[DataFrame]] = {k: [] for k in range(1, lengths + 1)}
    step = 0
    while any(step < start + shards for begun in starts.values() for start in begun):
        reached = spark.sparkContext.broadcast([t.tobytes() for t in tables.values()])
        texts = spark.read.schema("lang string, text string, shard int").parquet(stored)
        part = texts.where(F.col("shard") == step % shards).select("lang", "text")
        counts = _scan(part, step, shards, lengths, reached, slots).groupBy("k", "start", "lang", "phrase")
        counted = counts.agg(F.sum("c").alias("c")).withColumn("step", F.lit(step))
        counted.write.mode("append").partitionBy("step", "k", "start").parquet(tally)
        reached.destroy()
        for k in range(1, lengths):
            for start in [s for s in starts[k] if s <= step < s + shards]:
                found = materialize(_reached(_cycle(spark, tally, k, start), least, step > start), "frequent")
                if step == start + shards - 1:
                    complete[k].append(found)
                if _mark(tables[k], found, k, step):
                    for longer in range(k + 1, lengths + 1):
                        starts[longer].add(step + 1)
        step += 1
    for start in starts[lengths]:
        complete[lengths].append(materialize(_reached(_cycle(spark, tally, lengths, start), least, True), "frequent"))
    tagged = [df.select(F.lit(k).alias("k"), "lang", "phrase", "f") for k in complete for df in complete[k]]
    words = _cycle(spark, tally, 1, 0).groupBy("lang").agg(F.sum("c").alias("n"))
    return reduce(DataFrame.unionByName, tagged), words


def _cycle(spark: SparkSession, tally: str, k: int, start: int) -> DataFrame:
    """What has been counted of the phrases of ``k`` words that started with scan ``start``."""
    rows = spark.read.schema(f"{COUNTS}, step int").parquet(tally)
    return rows.where((F.col("k") == k) & (F.col("start") == start)).select("lang", "phrase", "c")


def _reached(rows: DataFrame, least: int, several: bool) -> DataFrame:
    """Phrases with ``least`` occurrences. The counts of one scan are sums already."""
    sums = rows.groupBy("lang", "phrase").agg(F.sum("c").alias("f")) if several else rows.withColumnRenamed("c", "f")
    return sums.where(F.col("f") >= least)


# ---------------------------------------------------------------- scores


def _part(phrase: str, first: str, count: str) -> str:
    words = f"slice(split({phrase}, ' '), {first}, {count})"
    return f"array_join({words}, ' ')"


def score_cuts(frequent: DataFrame) -> DataFrame:
    """(k, lang, phrase, a, l, r, score) of every phrase of two words or more, by its lowest cut."""
    long = frequent.where(F.col("k") > 1).withColumnRenamed("f", "a")
    cuts = long.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.withColumns(
        {
            "left": F.expr(_part("phrase", "1", "cut")),
            "right": F.expr(_part("phrase", "cut + 1", "k - cut")),
        }
    )
    # Each part of a frequent phrase is frequent, so its count is known.
    f = frequent.select("lang", "phrase", "f")
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr(
        f"(CAST({SCALE} AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(16, 0)) * CAST(a AS DECIMAL(16, 0)))"
        " div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))"
    )
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("least")
    best = cuts.groupBy("k", "lang", "phrase", "a").agg(lowest)
    return best.select("k", "lang", "phrase", "a", "least.l", "least.r", "least.score")


def not_covered(scored: DataFrame, covered: int = COVERED) -> DataFrame:
    """Without phrases of which ``covered`` percent lie in one longer candidate."""
    places = F.expr(
        "explode(flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1),"
        " i -> array_join(slice(split(phrase, ' '), i, m), ' ')))))"
    )
    inner = scored.where(F.col("k") > 2).select("lang", places.alias("phrase"), F.col("a").alias("f"))
    most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    marked = scored.join(most, ["lang", "phrase"], "left")
    inside = F.lit(100) * F.coalesce("most", F.lit(0)) >= F.lit(covered) * F.col("a")
    return marked.where(~inside).drop("most")


def best_phrases(scored: DataFrame, keep: int = KEEP) -> DataFrame:
    """The first ``keep`` per language, ranked; a language is cut down in salted groups first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    near = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    front = salted.withColumn("near", near).where(F.col("near") <= keep)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return front.withColumn("rank", rank.cast("long")).where(F.col("rank") <= keep)


def mine_phrases(docs: DataFrame, **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score); ``options`` are those of ``frequent_phrases``."""
    frequent, words = frequent_phrases(docs, **options)
    ranked = best_phrases(not_covered(materialize(score_cuts(frequent), "scored")))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
