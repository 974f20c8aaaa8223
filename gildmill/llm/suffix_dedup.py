"""Repeated passages: every byte that lies in a 400-byte string which also starts elsewhere.

Each 400-byte window belongs to its smallest 64-byte gram, which depends on the window alone.
So equal windows meet under the same gram, and grams that occur once need no further look. The
windows of one gram occurrence form a stretch of text; equal stretches are counted before they
are moved. What remains under a gram, its different stretches, is put into blocks of bounded
size. A block gets a suffix array by two-stage sorting: only suffixes smaller than their
successors are sorted directly, the others are induced by one scan over the buckets. Only
suffixes that begin a window are asked for, so most of a block's are never sorted. Windows
whose neighbours in that order share 400 bytes with them repeat.

A gram with very many different stretches (a passage that is everywhere, in other surroundings
each time) does not go into one block: its stretches are cut into runs of 16 windows, equal runs
are counted, and runs that still differ are cut into single windows, which are counted.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildmill.llm.common import (
    materialize,
    mix64,
    ranges_of,
    reduce_tasks,
    ship_package,
    slices,
    whole_text,
)

LENGTH = 400
GRAM = 64
RUN = 16
BLOCK = 1 << 19  # bytes of stretches in a block, and at most of one gram in a block
_P = 0x9E3779B97F4A7C15


# ---------------------------------------------------------------- windows and grams


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of every GRAM bytes (a power of two), by doubling."""
    have, step = data.astype(np.uint64) + np.uint64(1), 1
    while step < GRAM:
        have = have[: len(have) - step] * np.uint64(pow(_P, step, 1 << 64)) + have[step:]
        step *= 2
    return mix64(have)


def stretches(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text index, first window, last window, gram place, gram hash) of all stretches.

    A stretch is a run of neighbouring windows that belong to the same gram occurrence, the
    leftmost of the smallest hash. Texts shorter than a window have none.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    none = tuple(np.empty(0, np.int64) for _ in range(4)) + (np.empty(0, np.uint64),)
    if not (sizes >= LENGTH).any():
        return none
    owner, place = ranges_of(sizes)
    with np.errstate(over="ignore"):
        grams = _gram_hashes(data)
    bits = np.uint64(max(1, int(len(data)).bit_length()))
    packed = ((grams >> bits) << bits) | np.arange(len(grams), dtype=np.uint64)
    width, low, step = LENGTH - GRAM + 1, packed, 1
    while step * 2 <= width:
        low = np.minimum(low[: len(low) - step], low[step:])
        step *= 2
    n = len(data) - LENGTH + 1
    low = np.minimum(low[:n], low[width - step : width - step + n])
    at = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    windows = np.flatnonzero(place[:n] + LENGTH <= sizes[owner[:n]])
    at = at[windows]
    first = np.ones(len(at), bool)
    first[1:] = (at[1:] != at[:-1]) | (np.diff(windows) != 1)
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(at)) - 1
    text = owner[windows[starts]]
    shift = (np.cumsum(sizes) - sizes)[text]
    return (
        text,
        windows[starts] - shift,
        windows[ends] - shift,
        at[starts] - shift,
        grams[at[starts]],
    )


def _utf8(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def _gram_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            text, first, last, gram, hashes = stretches(_utf8(batch))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").take(pa.array(text)),
                    pa.array(hashes.view(np.int64)),
                    pa.array(first),
                    pa.array(last),
                    pa.array(gram),
                ],
                ["node", "gram", "first", "last", "place"],
            )


def _digest(data: bytes) -> bytes:
    return hashlib.md5(data).digest()


_MEMBER = "gram long, digest binary, node binary, first long, last long, place long"


def _digest_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            texts = _utf8(batch)
            rows = []
            for node, text, found in zip(
                batch.column("node").to_pylist(), texts, batch.column("found").to_pylist(), strict=True
            ):
                for s in found:
                    data = text[s["first"] : s["last"] + LENGTH]
                    rows.append({**s, "node": node, "digest": _digest(data)})
            if rows:
                out = pa.RecordBatch.from_pylist(rows)
                yield out.select([c.split(" ")[0] for c in _MEMBER.split(", ")])


def _bytes_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            texts = _utf8(batch)
            rows = [
                {
                    "gram": s["gram"],
                    "digest": s["digest"],
                    "n": s["n"],
                    "place": s["place"] - s["first"],
                    "hot": s["hot"],
                    "data": text[s["first"] : s["last"] + LENGTH],
                }
                for text, found in zip(texts, batch.column("found").to_pylist(), strict=True)
                for s in found
            ]
            if rows:
                yield pa.RecordBatch.from_pylist(rows)


# ---------------------------------------------------------------- suffix arrays


def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """For each suffix: is it smaller than the one that starts a byte later?"""
    n = len(data)
    ends = np.append(np.flatnonzero(data[1:] != data[:-1]) + 1, n)  # of runs of one byte
    after = np.repeat(ends, np.diff(ends, prepend=0))
    following = np.append(data, 0)[after].astype(np.int64)
    following[after == n] = -1
    return data < following


def _reached(wanted: np.ndarray, small: np.ndarray) -> np.ndarray:
    """The wanted suffixes and those that place them: on to the next that is sorted directly."""
    n = len(wanted)
    first = np.flatnonzero(wanted & ~np.append(False, wanted[:-1]))
    last = np.flatnonzero(wanted & ~np.append(wanted[1:], False))
    settled = np.append(np.flatnonzero(small), n - 1)  # the whole's last suffix is given
    edges = np.zeros(n + 1, np.int64)
    edges[first] += 1
    np.subtract.at(edges, settled[np.searchsorted(settled, last)] + 1, 1)
    return np.cumsum(edges[:n]) > 0


def suffix_array(data: bytes, depth: int = LENGTH, wanted: np.ndarray | None = None) -> np.ndarray:
    """Suffixes in order of at least their first ``depth`` bytes, by two-stage sorting.

    With ``wanted``, a flag for each suffix, only these are returned.
    """
    text = np.frombuffer(data, np.uint8)
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    small = smaller_than_next(text)
    reached = np.ones(n, bool) if wanted is None else _reached(wanted, small)
    large = reached & ~small
    # stage 1: sort the smaller-than-next suffixes directly
    direct = np.array(
        sorted(np.flatnonzero(reached & small).tolist(), key=lambda i: data[i : i + depth]), dtype=np.int64
    )
    heads = text[direct]
    order = np.argsort(heads, kind="stable")
    direct, heads = direct[order], heads[order]
    edges = np.searchsorted(heads, np.arange(257))
    # stage 2: scan the buckets upwards; each suffix places its predecessor, if that is larger
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if reached[n - 1]:
        waiting[text[n - 1]].append(np.array([n - 1], np.int64))
    out = [np.empty(0, np.int64)]
    for c in range(256):
        mine = direct[edges[c] : edges[c + 1]]
        layer = np.concatenate(waiting[c]) if waiting[c] else np.empty(0, np.int64)
        if not len(mine) and not len(layer):
            continue
        induced = []
        while len(layer):  # runs of one byte place their own predecessors
            induced.append(layer)
            before = layer[layer > 0] - 1
            layer = before[(text[before] == c) & large[before]]
        bucket = np.concatenate([*induced, mine])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[(text[before] > c) & large[before]]
        if len(before):
            targets = text[before]
            order = np.argsort(targets, kind="stable")
            before, targets = before[order], targets[order]
            cuts = np.flatnonzero(np.diff(targets)) + 1
            for part in np.split(before, cuts):
                waiting[text[part[0]]].append(part)
    order = np.concatenate(out)
    return order if wanted is None else order[wanted[order]]


def common_prefixes(data: bytes, order: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``order``, cut at ``depth``."""
    n = len(data)
    raw = np.frombuffer(data + bytes(depth + 8), np.uint8)
    words = np.zeros(n + depth + 1, np.uint64)
    for j in range(8):
        words = (words << np.uint64(8)) | raw[j : j + len(words)].astype(np.uint64)
    out = np.zeros(len(order), np.int64)
    pair = np.arange(1, len(order))
    for offset in range(0, depth, 8):
        a, b = order[pair - 1] + offset, order[pair] + offset
        odd = words[np.minimum(a, n + depth)] ^ words[np.minimum(b, n + depth)]
        same = odd == 0
        if not same.all():
            rest = odd[~same]
            bits = np.frexp(rest.astype(np.float64))[1]
            # rounding up may reach the next power of two: settle the byte exactly
            zero = np.clip((64 - bits) // 8, 0, 7)
            shift = (np.uint64(7) - zero.astype(np.uint64)) * np.uint64(8)
            zero = zero + ((rest >> shift) & np.uint64(255) == 0)
            out[pair[~same]] = offset + zero
        pair = pair[same]
        if not len(pair):
            break
    out[pair] = depth
    room = n - order
    out[1:] = np.minimum(out[1:], np.minimum(room[1:], room[:-1]))
    return np.minimum(out, depth)


def repeated_windows(pieces: list[bytes], counts: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each piece and each of its windows: does it start anywhere else among the pieces?

    A piece that stands for several copies repeats whole.
    """
    data = b"\xff".join(pieces)  # a byte that UTF-8 has not
    windows = np.array([max(0, len(piece) - length + 1) for piece in pieces], np.int64)
    begins = np.cumsum([0, *(len(piece) + 1 for piece in pieces)])[:-1]
    owner, place = ranges_of(windows)
    wanted = np.zeros(len(data), bool)
    wanted[begins[owner] + place] = True
    order = suffix_array(data, length, wanted)
    same = common_prefixes(data, order, length) >= length
    flags = np.zeros(len(data) + 1, bool)
    flags[order[same]] = True
    flags[order[np.flatnonzero(same) - 1]] = True
    parts = zip(begins.tolist(), windows.tolist(), counts, strict=True)
    return [flags[at : at + held] | (n > 1) for at, held, n in parts]


def runs_of(flags: np.ndarray) -> list[dict]:
    """Maximal runs of true flags: first and last."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"a": int(a), "b": int(b) - 1} for a, b in zip(edge[::2], edge[1::2], strict=True)]


_RUNS = "array<struct<a:long,b:long>>"
_RUNS_ARROW = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _block_task(block: pa.Table) -> pa.Table:
    flags = repeated_windows(block.column("data").to_pylist(), block.column("n").to_pylist())
    return pa.table(
        [
            block.column("gram"),
            block.column("digest"),
            pa.array([runs_of(f) for f in flags], _RUNS_ARROW),
        ],
        names=["gram", "digest", "runs"],
    )


# ---------------------------------------------------------------- very common grams


def _cut_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of 16 windows of each stretch, aligned to its gram."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            last = len(r["data"]) - LENGTH
            at = 0
            while at <= last:
                slot = (r["place"] - at) // RUN  # windows of one slot start at most RUN apart
                end = min(last, r["place"] - slot * RUN)
                rows.append(
                    {
                        "gram": r["gram"], "digest": r["digest"], "n": r["n"], "slot": slot,
                        "at": at, "end": end, "part": _digest(r["data"][at : end + LENGTH]),
                    }
                )
                at = end + 1
        if rows:
            yield pa.RecordBatch.from_pylist(rows)


def _window_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            {
                "gram": r["gram"], "digest": r["digest"], "n": r["n"], "at": at, "end": at,
                "part": _digest(r["data"][at : at + LENGTH]),
            }
            for r in batch.to_pylist()
            for cut in r["cuts"]
            for at in range(cut["at"], cut["end"] + 1)
        ]
        if rows:
            yield pa.RecordBatch.from_pylist(rows)


def _common_grams(hot: DataFrame) -> DataFrame:
    """(gram, digest, runs) of the stretches of very common grams, by counting."""
    cuts = materialize(
        hot.select("gram", "digest", "n", "place", "data").mapInArrow(
            _cut_task,
            "gram long, digest binary, n long, slot long, at long, end long, part binary",
        ),
        "cuts",
    )
    parts = cuts.groupBy("gram", "slot", "part").agg(F.sum("n").alias("copies"))
    kinds = parts.groupBy("gram", "slot").agg(F.count("*").alias("kinds"))
    # equal parts repeat; others may still share some of their windows
    open_slots = kinds.filter("kinds > 1").select("gram", "slot")
    repeated = parts.filter("copies > 1").select("gram", "slot", "part")
    whole = cuts.join(repeated, ["gram", "slot", "part"]).select("gram", "digest", "at", "end")
    rest = (
        cuts.join(open_slots, ["gram", "slot"])
        .join(repeated, ["gram", "slot", "part"], "left_anti")
        .groupBy("gram", "digest")
        .agg(F.collect_list(F.struct("at", "end")).alias("cuts"))
    )
    # windows inside repeated parts count as partners too: one stretch stands for each part
    partner = (
        cuts.join(open_slots, ["gram", "slot"])
        .join(repeated, ["gram", "slot", "part"])
        .groupBy("gram", "slot", "part")
        .agg(F.min(F.struct("digest", "at", "end")).alias("m"))
        .select("gram", "m.digest", F.struct("m.at", "m.end").alias("cut"))
        .groupBy("gram", "digest")
        .agg(F.collect_list("cut").alias("cuts"))
    )
    windows = materialize(
        hot.join(rest.union(partner), ["gram", "digest"])
        .select("gram", "digest", "n", "data", "cuts")
        .mapInArrow(
            _window_task, "gram long, digest binary, n long, at long, end long, part binary"
        ),
        "windows",
    )
    shared = windows.groupBy("part").agg(F.sum("n").alias("copies")).filter("copies > 1")
    single = windows.join(shared.select("part"), "part").select("gram", "digest", "at", "end")
    runs = F.collect_set(F.struct(F.col("at").alias("a"), F.col("end").alias("b")))
    found = whole.union(single).groupBy("gram", "digest").agg(F.sort_array(runs).alias("runs"))
    return found.withColumn("runs", _joined("runs"))


def _joined(runs: str):
    """Sorted runs with those that touch made one; a stretch has some hundred windows at most."""
    last = lambda done: F.element_at(done, -1)

    def longer(done, r):
        end = F.greatest(last(done)["b"], r["b"])
        grown = F.array(F.struct(last(done)["a"].alias("a"), end.alias("b")))
        return F.concat(F.slice(done, 1, F.size(done) - 1), grown)

    return F.aggregate(
        runs,
        F.array().cast(_RUNS),
        lambda done, r: F.when(
            (F.size(done) > 0) & (last(done)["b"] + 1 >= r["a"]), longer(done, r)
        ).otherwise(F.concat(done, F.array(r))),
    )


# ---------------------------------------------------------------- whole corpus


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s in sorted(spans, key=lambda s: s["start"]):
        if out and s["start"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["end"]))
        else:
            out.append((s["start"], s["end"]))
    return out


_RESULT = "node binary, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string"


def _cut_out_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for whole in batches:
        for batch in slices(whole, "text"):
            rows = []
            for text, n, found in zip(
                _utf8(batch),
                batch.column("n").to_pylist(),
                batch.column("found").to_pylist(),
                strict=True,
            ):
                spans = _merged(found or [])
                if n > 1 and len(text) >= LENGTH:
                    spans = [(0, len(text))]
                kept, at = hashlib.sha256(), 0
                for start, end in spans:
                    kept.update(text[at:start])
                    at = end
                kept.update(text[at:])
                rows.append((len(text), sum(e - s for s, e in spans), spans, kept.hexdigest()))
            size, removed, spans, digest = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.array(size, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], span),
                    pa.array(digest),
                ],
                ["node", "n_bytes", "n_removed", "spans", "kept_sha256"],
            )


def _bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Write ``df`` to the warehouse in buckets of ``key``: later joins on it do not move it."""
    spark = df.sparkSession
    buckets = reduce_tasks(spark)
    full = f"{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).format("parquet").saveAsTable(full)
    return spark.table(full)


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept_sha256) of every row.

    ``spans`` are the maximal runs (start, end) of bytes covered by a 400-byte string that
    also starts anywhere else in the corpus, the same document included; overlaps count, matches
    never cross documents, and all is judged on the input. ``kept_sha256`` is the digest of the
    bytes outside them.

    Texts are shuffled once, by content: equal texts become one with a count, and the table is
    bucketed, so that later stages join to it without moving it. Memory is bounded by the longest
    text and by blocks of half a megabyte. Null and empty texts have no spans; repeated rows
    remove each other when 400 bytes or longer; ids may be null; other columns are not read; an
    empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), whole_text(text).alias("text")
    ).withColumn("node", F.unhex(F.md5(F.col("text").cast("binary"))))
    texts = _bucketed(
        rows.groupBy("node").agg(F.first("text").alias("text"), F.count("*").alias("n")),
        "node",
        "llm_texts",
    )
    grams = materialize(
        texts.filter(F.octet_length("text") >= LENGTH)
        .select("node", "text")
        .mapInArrow(_gram_task, "node binary, gram long, first long, last long, place long"),
        "grams",
    )
    # counts are written before they are joined: a side that is a plain scan lets Spark split
    # the partition of a hot gram
    again = materialize(
        grams.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"), "again"
    )
    found = (
        grams.join(again, "gram")
        .groupBy("node")
        .agg(F.collect_list(F.struct("gram", "first", "last", "place")).alias("found"))
    )
    members = materialize(
        texts.join(found, "node").select("node", "text", "found").mapInArrow(_digest_task, _MEMBER),
        "stretches",
    )
    distinct = materialize(
        members.groupBy("gram", "digest").agg(
            F.count("*").alias("n"), F.min(F.struct("node", "first", "last", "place")).alias("at")
        ),
        "kinds",
    )
    groups = materialize(
        distinct.groupBy("gram").agg(
            F.count("*").alias("kinds"),
            F.sum(F.col("at.last") - F.col("at.first") + LENGTH).alias("bytes"),
        ),
        "groups",
    )
    # a gram with one kind of stretch: its copies repeat whole
    alike = groups.filter("kinds = 1").select("gram")
    mixed = groups.filter("kinds > 1").select("gram", (F.col("bytes") > BLOCK).alias("hot"))
    wanted = (
        distinct.join(mixed, "gram")
        .groupBy(F.col("at.node").alias("node"))
        .agg(
            F.collect_list(
                F.struct("gram", "digest", "n", "hot", "at.first", "at.last", "at.place")
            ).alias("found")
        )
    )
    pieces = materialize(
        texts.join(wanted, "node")
        .select("node", "text", "found")
        .mapInArrow(
            _bytes_task,
            "gram long, digest binary, n long, place long, hot boolean, data binary",
        ),
        "pieces",
    )
    usual = pieces.filter(~F.col("hot"))
    total = usual.agg(F.sum(F.length("data"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK))
    sorted_runs = (
        usual.select(
            F.pmod(F.xxhash64("gram"), F.lit(blocks)).alias("block"), "gram", "digest", "n", "data"
        )
        .groupBy("block")
        .applyInArrow(_block_task, f"gram long, digest binary, runs {_RUNS}")
    )
    hot = pieces.filter("hot")
    runs = sorted_runs.union(_common_grams(hot)) if not hot.isEmpty() else sorted_runs
    # a stretch's runs stay one row, as bytes from the start of the text
    spans = members.join(runs.filter(F.size("runs") > 0), ["gram", "digest"]).select(
        "node",
        F.transform(
            "runs",
            lambda r: F.struct(
                (F.col("first") + r["a"]).alias("start"),
                (F.col("first") + r["b"] + LENGTH).alias("end"),
            ),
        ).alias("spans"),
    )
    whole = members.join(alike, "gram").select(
        "node",
        F.array(
            F.struct(F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end"))
        ).alias("spans"),
    )
    by_text = (
        spans.union(whole)
        .groupBy("node")
        .agg(F.flatten(F.collect_list("spans")).alias("found"))
    )
    cleaned = (
        texts.join(by_text, "node", "left")
        .select("node", "text", "n", "found")
        .mapInArrow(_cut_out_task, _RESULT)
    )
    return rows.select("doc_id", "node").join(cleaned, "node").drop("node")
