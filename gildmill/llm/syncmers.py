"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the smallest hash among its inner s-mers is
that of the first or the last. That depends on the k-mer alone, so an edit elsewhere never
moves an anchor, and stretches without an anchor are bounded. A fingerprint keeps, for each
of 64 ranges of anchor hashes, the smallest anchor and its position. Two fingerprints are
compared bin by bin: an anchor matches if its hash is equal and its displacement agrees with
that of the other matches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildmill.llm.common import (
    mix64,
    ranges_of,
    reduce_tasks,
    ship_package,
    slices,
    strings,
    whole_text,
)

K, S = 16, 6
BINS = 64
SLACK = 0.05  # of the longer text: how far displacements may differ from their median
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_P = 0x9E3779B97F4A7C15
_LOW = np.uint64(0xFFFFFFFF)


def _gram_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` codes, by doubling: a run is two runs of known hashes."""
    have, out, length, step = codes, None, 0, 1
    while True:
        if size & step:
            if out is None:
                out, length = have, step
            else:
                n = len(codes) - length - step + 1
                factor = np.uint64(pow(_P, step, 1 << 64))
                out = out[:n] * factor + have[length : length + n]
                length += step
        if step * 2 > size:
            return mix64(out)
        have = have[: len(have) - step] * np.uint64(pow(_P, step, 1 << 64)) + have[step:]
        step *= 2


def anchors(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, position, hash) of all closed syncmers, by text and position.

    A text shorter than K is one anchor, the text itself; an empty one has none.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    raw = "".join(texts).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(raw, dtype="<u4").astype(np.uint64) + np.uint64(1)
    owner, place = ranges_of(sizes)
    parts = []
    with np.errstate(over="ignore"):
        if len(codes) >= K:
            inner = _gram_hashes(codes, S)
            n = len(codes) - K + 1
            low, width = inner, 1
            while width * 2 <= K - S + 1:
                low = np.minimum(low[: len(low) - width], low[width:])
                width *= 2
            low = np.minimum(low[:n], low[K - S + 1 - width : K - S + 1 - width + n])
            closed = (inner[:n] == low) | (inner[K - S : K - S + n] == low)
            closed &= place[:n] + K <= sizes[owner[:n]]
            at = np.flatnonzero(closed)
            parts.append((owner[at], place[at], _gram_hashes(codes, K)[at]))
        starts = np.cumsum(sizes) - sizes
        short = np.flatnonzero((sizes > 0) & (sizes < K))
        if len(short):
            whole = [
                _gram_hashes(codes[starts[i] : starts[i] + sizes[i]], int(sizes[i]))[0]
                for i in short
            ]
            parts.append((short, np.zeros(len(short), np.int64), np.array(whole, np.uint64)))
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    own, at, hashes = (np.concatenate(c) for c in zip(*parts, strict=True))
    if len(parts) > 1:
        order = np.lexsort((at, own))
        own, at, hashes = own[order], at[order], hashes[order]
    return own, at, hashes


def sketches(n: int, owner: np.ndarray, place: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """n rows of 64 packed anchors (32 bits of hash, 32 of position); all ones: an empty bin."""
    out = np.full((n, BINS), _NONE)
    top = hashes >> np.uint64(32)
    packed = (top << np.uint64(32)) | place.astype(np.uint64)
    bins = (top >> np.uint64(26)).astype(np.int64)
    np.minimum.at(out.reshape(-1), owner * BINS + bins, packed)
    return out


def fingerprint(sketch: np.ndarray) -> str:
    """Filled bins as hexadecimal text, 16 digits each: hash, then position."""
    return sketch[sketch != _NONE].astype(">u8").tobytes().hex()


def parse(text: str) -> np.ndarray:
    """The sketch that a fingerprint shows."""
    out = np.full(BINS, _NONE)
    packed = np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)
    out[(packed >> np.uint64(58)).astype(np.int64)] = packed
    return out


def likeness(a: np.ndarray, b: np.ndarray, length: int) -> float:
    """Share of filled bins that hold the same anchor at a consistent displacement.

    ``length`` is that of the longer text. Two empty sketches are alike.
    """
    filled = (a != _NONE) | (b != _NONE)
    total = int(filled.sum())
    if not total:
        return 1.0
    same = np.flatnonzero(filled & ((a >> np.uint64(32)) == (b >> np.uint64(32))))
    if not len(same):
        return 0.0
    moved = (a[same] & _LOW).astype(np.int64) - (b[same] & _LOW).astype(np.int64)
    middle = np.sort(moved)[len(moved) // 2]
    return float((np.abs(moved - middle) <= SLACK * length + K).sum() / total)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every whole text, without a shuffle.

    Null and empty texts have an empty fingerprint; equal texts have equal ones; ids may be
    null or repeated; other columns are not read. A task's memory grows with its longest text.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = strings(batch.column("text"))
                rows = sketches(len(texts), *anchors(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([fingerprint(r) for r in rows], pa.string()),
                    ],
                    ["doc_id", "n_chars", "fingerprint"],
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_chars long, fingerprint string"
    )


# ---------------------------------------------------------------- neighbours in id order

EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
_ARROW = pa.schema(
    [
        (n, {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[t])
        for n, t in (p.split(" ") for p in EDITED.split(", "))
    ]
)


class _Edits:
    """Consumes (id, text, is_lookahead) in order; gives one row per text with a successor."""

    def __init__(self):
        self.waiting = None  # the last text, and its anchors

    def feed(self, ids: list, texts: list[str], ahead: list[bool]) -> list[tuple]:
        owner, place, hashes = anchors(texts)
        marks = sketches(len(texts), owner, place, hashes)
        ends = np.searchsorted(owner, np.arange(len(texts) + 1))
        rows = []
        for i, text in enumerate(texts):
            own = slice(ends[i], ends[i + 1])
            here = (ids[i], text, marks[i], place[own], hashes[own], ahead[i])
            if self.waiting is not None and not self.waiting[5]:
                rows.append(self.row(self.waiting, here))
            self.waiting = here
        return rows

    @staticmethod
    def row(a: tuple, b: tuple) -> tuple:
        text, other = a[1], b[1]
        n = len(text)
        cut = n - n // 3
        taken = other[: n // 3]
        edited = text[:cut] + taken
        if len(edited) < K:
            mark = sketches(1, *anchors([edited]))[0]
        else:
            # anchors depend on their k-mer alone: kept ones, donated ones, those across the seam
            keep, fits = a[3] + K <= cut, b[3] + K <= len(taken)
            seam_from = max(0, cut - K + 1)
            seam = edited[seam_from : cut + K - 1]
            _, at, hashes = anchors([seam] if len(seam) >= K else [""])
            places = np.concatenate([a[3][keep], at + seam_from, b[3][fits] + cut])
            grams = np.concatenate([a[4][keep], hashes, b[4][fits]])
            mark = sketches(1, np.zeros(len(places), np.int64), places, grams)[0]
        return (
            a[0],
            n,
            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            fingerprint(a[2]),
            fingerprint(mark),
            likeness(a[2], mark, max(n, len(edited))),
            likeness(a[2], b[2], max(n, len(other))),
        )


def _edit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    edits, part = _Edits(), None
    for whole in batches:
        for batch in slices(whole, "text"):
            parts = batch.column("part").to_pylist()
            ids, ahead = batch.column("doc_id").to_pylist(), batch.column("ahead").to_pylist()
            texts = strings(batch.column("text"))
            rows, start = [], 0
            for i in range(len(parts) + 1):
                if i == len(parts) or parts[i] != part:
                    if i > start:
                        rows += edits.feed(ids[start:i], texts[start:i], ahead[start:i])
                    if i < len(parts):
                        edits, part, start = _Edits(), parts[i], i
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(zip(*rows), _ARROW, strict=True)],
                    schema=_ARROW,
                )


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text.

    In the edited text the last floor(n / 3) code points are replaced by the first as many, or
    all, of the next document's in descending id order; the first follows the last. Ids are cut
    into parts at quantiles (one id per task reaches the driver), and the first document of a
    part is also sent to the part before it. So texts are shuffled once, and each part, sorted,
    is read as a stream. Null ids come last; rows that repeat an id are in one part, ordered by
    text hash. Null texts are empty; an empty table gives no row; one row is its own successor.
    """
    spark = ship_package(docs.sparkSession)
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    ids = given.select("doc_id")
    tasks = reduce_tasks(spark)
    cuts = [i / tasks for i in range(1, tasks)]
    low, high, quantiles = ids.agg(
        F.min("doc_id"),
        F.max("doc_id"),
        F.percentile_approx("doc_id", cuts, 10_000) if cuts else F.lit(None),
    ).first()
    # part p holds the ids from heads[p] down to just above heads[p + 1]; nulls follow the last id
    bounds = sorted({q for q in quantiles or [] if low <= q < high}, reverse=True)
    heads, last = [high, *bounds], len(bounds)
    key = F.col("doc_id")
    head = F.array(*[F.lit(h).cast("long") for h in heads])
    part = F.when(key.isNull(), last).otherwise(
        F.greatest(F.size(F.filter(head, lambda h: h >= key)) - 1, F.lit(0))
    )
    # the head of a part also goes to the part before it; the very first to the last part
    spot = F.array_position(head, key) if high is not None else F.lit(1)
    before = F.when(spot > 0, F.pmod(spot - 2, F.lit(last + 1)).cast("int"))
    placed = given.withColumn("part", part.cast("int")).withColumn("before", before)
    copies = F.array_compact(
        F.array(
            F.struct(F.col("part"), F.lit(False).alias("ahead")),
            F.when(
                F.col("before").isNotNull(),
                F.struct(F.col("before").alias("part"), F.lit(True).alias("ahead")),
            ),
        )
    )
    sent = placed.select("doc_id", "text", F.inline(copies))
    return (
        sent.withColumn("tie", F.xxhash64("text"))
        .repartitionById(last + 1, F.col("part"))
        .sortWithinPartitions("part", "ahead", F.desc_nulls_last("doc_id"), "tie")
        .select("part", "ahead", "doc_id", "text")
        .mapInArrow(_edit_task, EDITED)
    )

