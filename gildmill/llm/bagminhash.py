"""Near-duplicate documents by BagMinHash signatures of their five-word shingles.

A shingle that occurs w times in a document has weight w. Along the weight axis, cut into the
blocks [0,1), [1,2), [2,4), [4,8), ..., every shingle owns one Poisson process a block, with
the block's width as rate and a random signature place for each point. A component of the
signature is the first point that falls on its place below the document's weight; the block
that the weight cuts is thinned by the points' own weight coordinate. Two documents agree in a
component with probability equal to their weighted Jaccard similarity. Points come in order of
time, so a process is left as soon as it is later than all components.

Signatures are banded. Documents that share a band are linked only if the exact overlap of
their shingle multisets reaches the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildmill.llm.common import (
    connected_components,
    materialize,
    mix64,
    ranges_of,
    ship_package,
    slices,
    strings,
    whole_text,
    word_hashes,
)

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 6  # at 0.8 a pair shares no band with probability 6e-5, at 0.85 with 2e-7
PLACES = BANDS * ROWS
STARS = 3  # rounds in which every bucket's documents are compared with one of them
TILE = 256
_PRIME = np.uint64(0xD6E8FEB86659FD93)
_STEP, _BLOCK = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xA0761D6478BD642F)

# ---------------------------------------------------------------- shingles


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of every run of five words, in order.

    Words are lower-cased and split at white space. A text of fewer words is one shingle; a
    text without words has none.
    """
    words, counts = word_hashes(texts)
    owner, place = ranges_of(np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1)))
    starts = np.cumsum(counts) - counts
    at = starts[owner] + place
    out = np.zeros(len(owner), np.uint64)
    for j in range(WORDS):
        there = counts[owner] > j
        word = words[np.minimum(at + j, len(words) - 1)] if len(words) else out
        out = out * _PRIME + np.where(there, word, np.uint64(0))
    return owner, mix64(out)


def multisets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, hash, count), sorted by text and hash."""
    owner, hashes = shingles(texts)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return owner[at], hashes[at], np.diff(np.append(at, len(owner)))


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets (sorted hashes, counts)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    spot = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    common = np.minimum(a[1], b[1][spot])[b[0][spot] == a[0]].sum()
    return float(common / (a[1].sum() + b[1].sum() - common))


def linked(similarity: float, threshold: float) -> bool:
    return similarity >= threshold - 1e-12


# ---------------------------------------------------------------- signatures


def _unit(x: np.ndarray) -> np.ndarray:
    """In (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signatures(texts: list[str], places: int = PLACES) -> np.ndarray:
    """One row of 32-bit components per text; a text without shingles has zeros."""
    n = len(texts)
    owner, hashes, weight = multisets(texts)
    parts = [(owner, hashes, np.ones(len(owner)), np.full(len(owner), np.inf))]
    low = 1
    while (more := weight > low).any():  # block [low, 2 low)
        with np.errstate(over="ignore"):
            seed = mix64(hashes[more] + _BLOCK * np.uint64(low))
        part = np.full(int(more.sum()), float(low))
        parts.append((owner[more], seed, part, (weight[more] - low).astype(float)))
        low *= 2
    owner, seed, rate, covered = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(owner, kind="stable")
    owner, seed, rate, covered = owner[order], seed[order], rate[order], covered[order]
    best = np.full((n, places), np.inf)
    flat = best.reshape(-1)
    time = np.zeros(len(owner))
    step = np.uint64(0)
    while len(owner):
        with np.errstate(over="ignore"):
            step += np.uint64(1)
            draw = mix64(seed + _STEP * step)
            second = mix64(draw ^ _PRIME)
        time = time - np.log(_unit(draw)) / rate
        place = ((second >> np.uint64(40)) * np.uint64(places)) >> np.uint64(24)
        heard = (second & np.uint64(0xFFFFFFFF)).astype(float) / float(1 << 32) * rate < covered
        np.minimum.at(flat, (owner * places + place.astype(np.int64))[heard], time[heard])
        texts_left = np.flatnonzero(np.diff(owner, prepend=-1))
        latest = best[owner[texts_left]].max(axis=1)
        limit = np.repeat(latest, np.diff(np.append(texts_left, len(owner))))
        go = time < limit
        if not go.all():
            owner, seed, rate, covered, time = (
                x[go] for x in (owner, seed, rate, covered, time)
            )
    out = (mix64(best.view(np.uint64)) >> np.uint64(32)).astype(np.uint32)
    out[np.isinf(best[:, 0])] = 0
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """64-bit keys of the bands, of each row of signatures."""
    rows = signature.reshape(len(signature), bands, -1).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, rows.shape[:2])
    with np.errstate(over="ignore"):
        for j in range(rows.shape[2]):
            key = mix64(key * _PRIME + rows[:, :, j])
    return key.view(np.int64)


def _sketch_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", 1 << 21):
            texts = strings(batch.column("text"))
            distinct = list(dict.fromkeys(texts))
            index = {t: i for i, t in enumerate(distinct)}
            rows = signatures(distinct)
            keys = band_keys(rows)
            empty = [not t.strip() for t in distinct]
            bands = [[] if e else k.tolist() for e, k in zip(empty, keys, strict=True)]
            marks = [r.tobytes() for r in rows]
            which = [index[t] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("node"),
                    pa.array([marks[i] for i in which], pa.binary()),
                    pa.array([bands[i] for i in which], pa.list_(pa.int64())),
                ],
                ["doc_id", "node", "signature", "bands"],
            )


# ---------------------------------------------------------------- comparing


def _verify_task(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple] = {}
        for whole in batches:
            for batch in slices(whole, "text_a"):
                rows = batch.to_pylist()
                new = {}
                for r in rows:
                    for side in "ab":
                        if r[side] not in seen:
                            new[r[side]] = r[f"text_{side}"]
                if len(seen) > 20_000:
                    seen = {}
                    new = {r[s]: r[f"text_{s}"] for r in rows for s in "ab"}
                seen |= dict(zip(new, split(list(new.values())), strict=True))
                pairs = [
                    {"a": r["a"], "b": r["b"]}
                    for r in rows
                    if linked(overlap(seen[r["a"]], seen[r["b"]]), threshold)
                ]
                for r in rows:  # only what may come again: the other side is a hub
                    seen.pop(r["a"], None)
                if pairs:
                    yield pa.RecordBatch.from_pylist(pairs, schema=_PAIR)

    return run


_PAIR = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def split(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The multiset of each text."""
    owner, hashes, counts = multisets(texts)
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [(hashes[i:j], counts[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)]


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) whose texts reach the threshold. b may be a hub of very many pairs."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(b, "b").join(a, "a")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(
        _verify_task(threshold), "a binary, b binary"
    )


def _tile_task(threshold: float):
    """Links between documents of different components within a tile, until none is missing."""

    def run(tile: pa.Table) -> pa.Table:
        rows = {r["node"]: r for r in tile.to_pylist()}
        nodes = sorted(rows)
        found = []
        bags = split([rows[n]["text"] for n in nodes])
        marks = np.stack([np.frombuffer(rows[n]["signature"], np.uint32) for n in nodes])
        names = {c: i for i, c in enumerate(sorted({rows[n]["comp"] for n in nodes}))}
        comp = np.array([names[rows[n]["comp"]] for n in nodes])
        main = np.array([rows[n]["main"] for n in nodes])
        for i in range(len(nodes)):
            # two documents of the bucket's largest component are never in need of a link
            other = (comp != comp[i]) & ~(main & main[i])
            other[: i + 1] = False
            at = np.flatnonzero(other)
            if not len(at):
                continue
            share = (marks[at] == marks[i]).mean(axis=1)
            for j, s in sorted(zip(at.tolist(), share.tolist(), strict=True), key=lambda x: -x[1]):
                # an estimate so low has no chance (5 standard deviations)
                if s < threshold - 5 * np.sqrt(threshold * (1 - threshold) / marks.shape[1]):
                    break
                if comp[i] != comp[j] and linked(overlap(bags[i], bags[j]), threshold):
                    found.append({"a": nodes[i], "b": nodes[j]})
                    comp[comp == comp[j]] = comp[i]
        return pa.Table.from_pylist(found, schema=_PAIR)

    return run


def _residual(labelled: DataFrame, sketches: DataFrame, texts: DataFrame, threshold: float):
    """Links that the star rounds missed, in buckets that still hold several components.

    In each such bucket all documents outside its largest component are compared with all
    documents of other components, in tiles of bounded size. Buckets of the same documents
    count once.
    """
    sizes = labelled.groupBy("key", "comp").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("sum")
    )
    buckets = (
        sizes.groupBy("key")
        .agg(
            F.count("*").alias("comps"),
            F.sum("n").alias("total"),
            F.sum("sum").alias("sum"),
            F.max(F.struct("n", "comp")).alias("largest"),
        )
        .filter(F.col("comps") > 1)
        .groupBy("comps", "total", "sum", "largest")
        .agg(F.min("key").alias("key"))
        .select(
            "key",
            F.col("largest.comp").alias("main_comp"),
            F.ceil(F.col("largest.n") / TILE).cast("int").alias("main_tiles"),
            F.ceil((F.col("total") - F.col("largest.n")) / TILE).cast("int").alias("rest_tiles"),
        )
    )
    held = labelled.join(buckets, "key").withColumn("main", F.col("comp") == F.col("main_comp"))
    tiles = F.when(F.col("main"), F.col("main_tiles")).otherwise(F.col("rest_tiles"))
    own = F.pmod(F.xxhash64("node"), tiles).cast("int")
    rest = F.sequence(F.lit(0), F.col("rest_tiles") - 1)
    mains = F.sequence(F.lit(0), F.col("main_tiles") - 1)
    among = F.transform(rest, lambda j: F.struct(F.least(j, F.col("own")).alias("i"), F.greatest(j, F.col("own")).alias("j"), F.lit(False).alias("wide")))
    across = F.transform(mains, lambda j: F.struct(F.col("own").alias("i"), j.alias("j"), F.lit(True).alias("wide")))
    of_main = F.transform(rest, lambda i: F.struct(i.alias("i"), F.col("own").alias("j"), F.lit(True).alias("wide")))
    placed = held.withColumn("own", own).withColumn(
        "tile", F.explode(F.when(F.col("main"), of_main).otherwise(F.concat(among, across)))
    )
    rows = placed.select("key", "tile", "node", "comp", "main").join(
        texts.join(sketches.select("node", "signature"), "node"), "node"
    )
    return rows.groupBy("key", "tile").applyInArrow(_tile_task(threshold), "a binary, b binary")


def near_duplicate_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """(node, class_id, first, low): the class of every distinct text.

    ``node`` is the MD5 of a text (null: empty), ``class_id`` the least id of its class,
    ``first`` marks the one text of the class that stands for it, and ``low`` is the text's
    own least id. Classes are the components of the links.

    Equal texts are one node from the start (combined before the shuffle). Buckets are compared
    in star rounds: one document of a bucket, another each round, against all those of other
    components. That joins even a huge group of near copies with one comparison a document. What
    then lies in several components within a bucket is compared pair by pair in tiles. So no
    pair that shares a band is lost, no task gets a whole bucket, and copies are never expanded.

    Null and empty texts, and others without words, are only equal to themselves. Ids may be
    repeated or null (a class of null ids only has a null class id); other columns are not read.
    An empty table gives no classes.
    """
    ship_package(docs.sparkSession)
    given = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")
    ).withColumn("node", F.unhex(F.md5(F.col("text").cast("binary"))))
    sketches = materialize(
        given.select("doc_id", "node", "text")
        .mapInArrow(
            _sketch_task, "doc_id long, node binary, signature binary, bands array<bigint>"
        )
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("low"),
            F.first("signature").alias("signature"),
            F.first("bands").alias("bands"),
        ),
        "sketches",
    )
    bands = sketches.select("node", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    buckets = materialize(bands.join(shared, "key"), "buckets")
    nodes = buckets.select("node").distinct().join(sketches.select("node", "low"), "node")
    texts = materialize(
        given.alias("d")
        .join(nodes.alias("n"), F.col("d.node") == F.col("n.node"))
        .filter(F.col("d.doc_id").eqNullSafe(F.col("n.low")))
        .select("d.node", "d.text")
        .dropDuplicates(["node"]),
        "bucket-texts",
    )
    labelled, links, parts = buckets.withColumn("comp", F.col("node")), None, None
    for star in range(STARS + 1):
        if star < STARS:
            hub = F.min(F.struct(F.xxhash64(F.lit(star), "node").alias("h"), "node", "comp"))
            hubs = (
                labelled.groupBy("key")
                .agg(hub.alias("hub"), F.min("comp").alias("c"), F.max("comp").alias("d"))
                .filter(F.col("c") != F.col("d"))
                .select("key", "hub")
            )
            pairs = (
                labelled.join(hubs, "key")
                .filter(F.col("comp") != F.col("hub.comp"))
                .groupBy(F.col("node").alias("a"))
                .agg(F.min("hub").alias("hub"))
                .select("a", F.col("hub.node").alias("b"))
            )
            found = materialize(verified(pairs, texts, threshold), "links")
        else:
            found = materialize(_residual(labelled, sketches, texts, threshold), "links")
        if found.isEmpty():
            continue
        links = found if links is None else links.union(found)
        parts = materialize(connected_components(links), "components")
        labelled = materialize(
            buckets.join(parts, "node", "left").select(
                "key", "node", F.coalesce("component", "node").alias("comp")
            ),
            "labelled",
        )
    own = sketches.select("node", "low")
    if parts is not None:
        own = own.join(parts, "node", "left")
    else:
        own = own.withColumn("component", F.lit(None).cast("binary"))
    own = own.select("node", "low", F.coalesce("component", "node").alias("comp"))
    least = own.groupBy("comp").agg(
        F.min(F.struct(F.col("low").isNull().alias("n"), "low", "node")).alias("m")
    )
    return own.join(least, "comp").select(
        "node",
        F.col("m.low").alias("class_id"),
        (F.col("node") == F.col("m.node")).alias("first"),
        "low",
    )


def _with_node(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn("__node", F.unhex(F.md5(whole_text(text).cast("binary"))))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, class_id) of every row of ``docs``."""
    classes = near_duplicate_classes(docs, doc_id, text, threshold).withColumnRenamed(
        "node", "__node"
    )
    rows = _with_node(docs, text).select(F.col(doc_id).alias("doc_id"), "__node")
    return rows.join(classes, "__node").select("doc_id", "class_id")


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs`` that stand for their class: that of the least id.

    Of fully repeated rows one is kept. All columns are kept as they are.
    """
    classes = near_duplicate_classes(docs, doc_id, text, threshold)
    chosen = materialize(
        classes.filter("first").select(F.col("node").alias("__node"), F.col("low").alias("__low")),
        "kept-texts",
    )
    rows = _with_node(docs, text)
    same_id = F.col(doc_id).cast("long").eqNullSafe(F.col("__low"))
    copies = (
        rows.select(F.col(doc_id), F.col("__node"))
        .join(chosen, "__node")
        .filter(same_id)
        .groupBy("__node")
        .agg(F.count("*").alias("__n"))
    )
    kept = rows.join(chosen.join(copies, "__node"), "__node").filter(same_id)
    single = kept.filter("__n = 1").select(*docs.columns)
    repeated = kept.filter("__n > 1").dropDuplicates(["__node"]).select(*docs.columns)
    return single.union(repeated)
