"""What each of several filters removes, in every order, and its fair share by a potential.

The filters play a removal game: the worth v(S) of a coalition S is the number of documents
that fail any filter in S. One pass reduces the documents to counts per part and set of failed
filters; all else follows from the worths of the coalitions:

* the Hart-Mas-Colell potential, P(S) = (v(S) + sum of P(S without i) for i in S) / |S|,
  P of nothing being 0; a filter's Shapley value is P(all) - P(all without it);
* a filter that comes after the set S removes v(S and it) - v(S).

Only DataFrame functions are used. Documents reach the shuffles as ids and SHA-256 digests of
their texts, never as texts, and are combined in the map tasks, so neither a text nor an id
that a third of all rows share meets in one task.

Null texts are empty texts, null parts the part ''. A null ``doc_id`` is never a later copy, nor
does it make one of another document. Repeated rows count each; rows of one id and one text are
copies of a smaller id only. Of several labels of one id any may count. No documents, no rows.
Other columns of the inputs are not read.
"""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gildmill.llm.common import whole_text

FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT = 80  # of 100 words
MOST_CAPITALS = 10  # of 100 code points
# Fixed patterns of the filters.
BLANKS = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = "[#$%&*|]"


def _mask(failures: list[Column]) -> Column:
    """A number with bit i set where the i-th failure holds."""
    bits = [F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(failures)]
    return sum(bits[1:], bits[0])


def text_failures(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, part, digest, mask): which of the first four filters each whole text fails."""
    t = F.col("t")
    whole = docs.select(
        "doc_id", F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("part"), whole_text(text).alias("t")
    )
    words = whole.withColumn("w", F.array_remove(F.split("t", BLANKS), ""))
    sized = words.withColumns({"n": F.size("w"), "distinct": F.size(F.array_distinct("w"))}).drop("w")
    capitals = F.char_length(t) - F.char_length(F.translate(t, CAPITALS, ""))
    failures = [
        F.col("n") < LEAST_WORDS,
        F.lit(100) * F.col("distinct") < F.lit(LEAST_DISTINCT) * F.col("n"),
        F.lit(100) * capitals.cast("long") > F.lit(MOST_CAPITALS) * F.char_length(t),
        t.rlike(SYMBOLS),
    ]
    digest = F.unhex(F.sha2(t.cast("binary"), 256))
    return sized.select("doc_id", "part", digest.alias("digest"), _mask(failures).alias("mask"))


def failure_counts(docs: DataFrame, labels: DataFrame, copy_bit: int = 4) -> DataFrame:
    """(part, mask, good, toxic, n): documents by the filters they fail.

    ``docs`` has (doc_id, part, digest, mask). Bit ``copy_bit`` is added for a document whose
    digest a smaller id also has. Rows of one digest are first combined per id, then to one row
    per part and label with its least id, so the last step sees few rows per digest.
    """
    marked = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    rows = docs.groupBy("digest", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    known = rows.join(marked, "doc_id", "left").na.fill(0, ["good", "toxic"])
    has_id = F.col("doc_id").isNotNull()
    classes = known.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(has_id, F.col("n"))), F.lit(0)).alias("with_id"),
        F.min(F.when(has_id, F.struct("doc_id", "n"))).alias("first"),
    )
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    here = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = classes.withColumn("least", least).withColumn("copies", F.col("with_id") - here)
    both = F.array(
        F.struct(F.col("mask").alias("mask"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct((F.col("mask") + F.lit(1 << copy_bit)).alias("mask"), F.col("copies").alias("n")),
    )
    parted = split.select("part", "good", "toxic", F.inline(both)).where(F.col("n") > 0)
    return parted.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def coalition_worths(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part: ``total``, and by coalition the arrays ``v``, ``good`` and ``toxic``."""
    n, size = F.col("n"), 1 << len(filters)
    hit = F.col("mask").bitwiseAND(F.col("s")) != 0
    games = counts.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(size - 1))))

    def removed(also: Column) -> Column:
        return F.sum(F.when(hit & also, n).otherwise(0))

    worths = games.groupBy("part", "s").agg(
        F.sum(n).alias("total"),
        removed(F.lit(True)).alias("v"),
        removed(F.col("good") == 1).alias("good"),
        removed(F.col("toxic") == 1).alias("toxic"),
    )
    listed = worths.groupBy("part").agg(  # one entry per coalition
        F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("s", "v", "good", "toxic"))).alias("w")
    )
    return listed.select("part", "total", *[F.col("w")[c].alias(c) for c in ("v", "good", "toxic")])


def potential(v: Column, players: int) -> Column:
    """The potentials of all coalitions, times the factorial of ``players``, as whole numbers.

    A potential's denominator divides the least common multiple of 1 to ``players``, which
    divides the factorial. Coalitions come in the order of their numbers, so those without one
    of a coalition's players are known before it.
    """
    scale = F.lit(math.factorial(players)).cast("long")

    def grow(known: Column, s: Column) -> Column:
        without = [
            F.when(s.bitwiseAND(F.lit(1 << i)) != 0, F.get(known, s - F.lit(1 << i))).otherwise(F.lit(0))
            for i in range(players)
        ]
        total = scale * F.get(v, s) + sum(without[1:], without[0])
        return F.concat(known, F.array(F.call_function("div", total, F.bit_count(s))))

    nothing = F.array(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << players) - 1)), nothing, grow)


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row per part, order of the filters and step, from counts by failed filters."""
    everyone = (1 << len(filters)) - 1
    orders = F.lit(",".join("".join(p) for p in permutations(filters)))
    worths = coalition_worths(counts, filters)
    worths = worths.withColumn("p", potential(F.col("v"), len(filters)))
    steps = worths.withColumn("filter_order", F.explode(F.split(orders, ",")))
    steps = steps.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))

    place = {f: F.instr(F.col("filter_order"), f) for f in filters}
    before = sum((F.when(place[f] < F.col("step"), 1 << i).otherwise(0) for i, f in enumerate(filters)), F.lit(0))
    bit = sum((F.when(place[f] == F.col("step"), 1 << i).otherwise(0) for i, f in enumerate(filters)), F.lit(0))
    steps = steps.withColumns({"before": before, "bit": bit}).withColumn("after", F.col("before") + F.col("bit"))

    def gain(column: str) -> Column:
        return F.get(column, F.col("after")) - F.get(column, F.col("before"))

    all_but = F.lit(everyone) - F.col("bit")
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.get("v", F.col("after"))).alias("kept"),
        gain("v").alias("removed"),
        (F.get("v", F.col("bit")) - gain("v")).alias("redundant"),
        (F.get("v", F.lit(everyone)) - F.get("v", all_but)).alias("unique_fails"),
        gain("good").alias("good_lost"),
        gain("toxic").alias("toxic_lost"),
        (F.get("p", F.lit(everyone)) - F.get("p", all_but)).alias("shapley"),
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of all five filters over whole documents, per language."""
    return audit(failure_counts(text_failures(docs), labels))
