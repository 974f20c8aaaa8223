"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source with a share of the bytes below its target share is repeated, one above it is
thinned. With ``rate = target share * all bytes / bytes of the source`` each document
appears a Poisson(rate) number of times, found by inverting the distribution at a number in
[0, 1) hashed from the seed and the document's id. So a document's count does not depend on
partitions, retries or other documents of its source, and mixing needs no coordination.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gildmill.llm.common import hash52, materialize, reduce_tasks, uniform

SEED = 20
COPIES_AT_ONCE = 4096
_EXACT = 20  # below it ln k! comes from a table, above it from Stirling's series


def _ln_factorial(k: Column) -> Column:
    small = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(_EXACT)])
    n = k.cast("double")
    series = n * F.log(n) - n + F.log(n * (2 * math.pi)) / 2
    series = series + 1 / (n * 12) - 1 / (F.pow(n, F.lit(3.0)) * 360)
    series = series + 1 / (F.pow(n, F.lit(5.0)) * 1260)
    return F.when(k < _EXACT, F.element_at(small, (F.least(k, F.lit(_EXACT - 1)) + 1).cast("int"))).otherwise(series)


def source_rates(
    docs: DataFrame,
    weights: dict | None = None,
    default_weight: float = 1.0,
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """(source, n_bytes, rate, first, cdf): mean repetitions of each source's documents.

    Sizes are UTF-8 bytes plus one a document. Weights need not add up to one; sources that
    ``weights`` does not name have ``default_weight``. A null source is a source of its own.
    ``cdf`` holds the distribution from ``first`` on; what lies below or above has a
    probability under 1e-30. One row per source, aggregated before the shuffle.
    """
    bytes_of = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    sizes = materialize(
        docs.select(F.col(source).alias("source"), bytes_of.alias("size"))
        .groupBy("source")
        .agg(F.sum("size").alias("n_bytes")),
        "source-bytes",
    )
    weight = F.lit(float(default_weight))
    for name, value in (weights or {}).items():
        weight = F.when(F.col("source").eqNullSafe(F.lit(name)), float(value)).otherwise(weight)
    weighed = sizes.withColumn("weight", weight.cast("double"))
    total, total_weight = weighed.agg(F.sum("n_bytes"), F.sum("weight")).first()
    share = F.col("weight") / F.lit(float(total_weight or 1.0))
    rate = share * F.lit(float(total or 0)) / F.col("n_bytes")
    spread = F.sqrt("rate") * 12
    lowest = F.when(F.col("rate") <= 200, F.lit(0)).otherwise(F.floor(F.col("rate") - spread))
    steps = (
        weighed.withColumn("rate", rate)
        .withColumn("first", lowest.cast("long"))
        .withColumn("k", F.explode(F.sequence("first", F.floor(F.col("rate") + spread) + 30)))
    )
    term = F.exp(F.col("k") * F.log("rate") - F.col("rate") - _ln_factorial(F.col("k")))
    term = F.when(F.col("k") == 0, F.exp(-F.col("rate"))).otherwise(F.coalesce(term, F.lit(0.0)))
    upto = Window.partitionBy("source").orderBy("k")
    return (
        steps.withColumn("c", F.sum(term).over(upto))
        .groupBy("source", "n_bytes", "rate", "first")
        .agg(F.sort_array(F.collect_list("c")).alias("cdf"))
    )


def exploded(df: DataFrame, count: str, number: str, step: int = COPIES_AT_ONCE) -> DataFrame:
    """Each row ``count`` times, with its ``number`` from 1.

    Three explodes in turn, over blocks of blocks, blocks and numbers: no array has more than
    ``step`` entries up to step ** 3 copies of one row.
    """
    n = F.col(count).cast("long")

    def upto(last: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), last))

    def in_block(block: str, size: int) -> Column:
        rest = F.call_function("div", n - 1 - F.col(block) * F.lit(size * step), F.lit(size))
        return upto(F.least(F.lit(step - 1).cast("long"), rest))

    far = df.withColumn("__b2", upto(F.call_function("div", n - 1, F.lit(step * step))))
    near = far.withColumn("__r1", in_block("__b2", step)).withColumn("__b1", F.col("__b2") * F.lit(step) + F.col("__r1"))
    each = near.withColumn("__r0", in_block("__b1", 1))
    numbered = each.withColumn(number, F.col("__b1") * F.lit(step) + F.col("__r0") + 1)
    return numbered.drop("__b2", "__r1", "__b1", "__r0")


def poisson_mix(
    docs: DataFrame,
    weights: dict | None = None,
    seed: int = SEED,
    default_weight: float = 1.0,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """The documents, each as often as drawn, in a global random order.

    Adds ``copies`` (how often the document appears), ``copy`` (1 to copies), ``mix_rate`` and
    ``mix_key``; input columns of these names are replaced. Rows are dealt to partitions by
    ``mix_key``, a hash, and sorted by it within them: each partition is a random sample in
    random order. Repeated rows with one id are drawn alike; a null id counts as an empty one;
    null and empty texts are mixed like others. An empty table stays empty. However large a rate
    is, a row's copies are made a few thousand at a time.

    The rates are a small written table, so that the planner broadcasts it if its files are
    below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise joins by shuffle, where
    adaptive execution splits a hot source. Size and shuffle follow the mixed corpus, whose
    expected bytes are those of the input.
    """
    added = ("copies", "copy", "mix_rate", "mix_key")
    kept = [c for c in docs.columns if c not in added]
    rates = materialize(source_rates(docs, weights, default_weight, source, text), "rates").select(
        F.col("source").alias("__source"),
        F.col("rate").alias("mix_rate"),
        F.col("first").alias("__first"),
        F.col("cdf").alias("__cdf"),
    )
    drawn = (
        docs.select(*kept, uniform(F.lit(seed), F.col(doc_id)).alias("__u"))
        .join(rates, F.col(source).eqNullSafe(F.col("__source")))
        .withColumn(
            "copies",
            F.col("__first") + F.expr("size(filter(__cdf, c -> c <= __u))").cast("long"),
        )
        .filter(F.col("copies") >= 1)
        .drop("__first", "__cdf", "__u", "__source")
    )
    drawn = exploded(drawn, "copies", "copy").select(
        *kept, "copies", "mix_rate", "copy", hash52(F.lit(seed), F.col(doc_id), F.col("copy")).alias("mix_key")
    )
    return drawn.repartition(reduce_tasks(docs.sparkSession), "mix_key").sortWithinPartitions(
        "mix_key"
    )
