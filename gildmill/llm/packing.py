"""Packing documents into token windows by non-negative least squares over the length histogram.

Documents become pieces: whole windows, and one remainder each. The histogram of remainders
(a bounded number of length bins) is all that reaches the driver. There, the shallow
combinations of lengths that fill a window are enumerated, the repeat count of each is solved
by non-negative least squares against the histogram and rounded down, and what is left is
packed greedily, largest length first, again by whole repeat counts. The outcome is a short
list of patterns. A piece finds its sequence from its rank within its length bin, so no task
sees more than its own rows.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gildmill.llm.common import materialize, ship_package, slices, strings

WINDOW = 4096
END = 2
EXACT = 256  # lengths up to here are bins of their own
STEP = 16  # longer ones are rounded up to a multiple
SALTS = 256
VOCABULARY = "word_bpe_49k.json"

# ---------------------------------------------------------------- token ids

# Fixed value: how the default vocabulary's tokenizer cuts words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = "a-zß-öø-ÿ"
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^0-9{_LETTERS}]+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")  # white space to Python, not to the tokenizer


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, others for letters above."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Recent(dict):
    """A cache of bounded size. When full it becomes the older generation, whose entries come back."""

    limit = 250_000

    def __init__(self):
        self.older: dict[str, bytes] = {}

    def keep(self, key: str, ids: bytes) -> None:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = ids


class _Parts(_Recent):
    """Ids, as bytes, of the parts that the tokenizer cuts words into."""

    def __init__(self, model):
        super().__init__()
        self.tokenize = model.tokenize

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = self.merged(part)
        self.keep(part, ids)
        return ids

    def merged(self, part: str) -> bytes:
        return struct.pack(f"<{len(tokens := self.tokenize(part))}I", *[t.id for t in tokens])


class WordIds(_Recent):
    """Ids, as little-endian bytes, of a white-space separated word.

    The tokenizer drops white space and no token crosses it, so a text's ids are those of its
    words. Words recur. Words of plain Latin letters are cut here by the tokenizer's own pattern,
    all others by the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.parts = _Parts(self.tokenizer.model)
        self.letters = _byte_letters()

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is not None:
            self.keep(word, ids)
            return ids
        if word.isascii() and word.isalpha():  # one part
            lower = word.lower()
            ids = self.parts.merged(word) if word == lower else self[lower]
            if len(word) <= 40:
                self.keep(word, ids)
            return ids
        if "<|" in word:
            return self.encode(word)
        if _PLAIN.fullmatch(word):
            parts = _PARTS.findall(word.lower())
            if not word.isascii():
                parts = [p.encode().decode("latin-1").translate(self.letters) for p in parts]
        else:
            cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
            parts = [p for p, _ in cut(self.tokenizer.normalizer.normalize_str(word))]
        ids = b"".join(map(self.parts.__getitem__, parts))
        if len(word) <= 40:
            self.keep(word, ids)
        return ids

    def text(self, text: str) -> bytes:
        if _ODD_SPACE.search(text):
            return self.encode(text)
        return b"".join(map(self.__getitem__, text.split()))


class TextIds:
    """Ids of whole texts, as little-endian bytes, from a tokenizer of any kind."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def text(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def cuts_words_alike(path: str) -> bool:
    """Does the file's tokenizer normalise and cut texts as ``WordIds`` does?

    That is: compose, collapse white space and lower-case; cut by the pattern above and drop white
    space; merge byte-level letters with a mark at the end of words.
    """
    with open(path, encoding="utf-8") as f:
        kind = json.load(f)
    normal = [n.get("type") for n in (kind.get("normalizer") or {}).get("normalizers", [])]
    steps = (kind.get("pre_tokenizer") or {}).get("pretokenizers", [])
    model = kind.get("model", {})
    return (
        normal == ["NFC", "Replace", "Lowercase"]
        and [p.get("type") for p in steps] == ["Split", "ByteLevel"]
        and steps[0].get("pattern") == {"Regex": SPLIT}
        and model.get("type", "BPE") == "BPE"
        and model.get("end_of_word_suffix") == "</w>"
    )


_encoders: dict[str, WordIds | TextIds] = {}


def encoder(path: str | None = None) -> WordIds | TextIds:
    """One per worker process and vocabulary file; words are cut here only where that is proved."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    if path not in _encoders:
        _encoders[path] = WordIds(path) if cuts_words_alike(path) else TextIds(path)
    return _encoders[path]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    vocabulary: str | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``window`` tokens: cuts only at multiples of the window.

    A document's tokens are its text's ids and the end id, so an empty or null text is one
    token. ``keep_ids`` adds the piece's ``ids``. Repeated rows give repeated pieces; ids may be
    null; other columns are not read.
    """
    ship_package(docs.sparkSession)
    arrow = pa.schema([(f.split(" ")[0], pa.int64()) for f in PIECES.split(", ")])
    if keep_ids:
        arrow = arrow.append(pa.field("ids", pa.list_(pa.int32())))
    step = 4 * window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        end = np.array([END], "<u4").tobytes()
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = []
                for key, value in zip(
                    batch.column("doc_id").to_pylist(), strings(batch.column("text")), strict=True
                ):
                    ids = words.text(value) + end
                    for at in range(0, len(ids), step):
                        piece = ids[at : at + step]
                        row = [key, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4]
                        rows.append([*row, np.frombuffer(piece, "<i4")] if keep_ids else row)
                columns = zip(*rows, strict=True) if rows else [[] for _ in arrow]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)],
                    schema=arrow,
                )

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(run, PIECES + (", ids array<int>" if keep_ids else ""))


# ---------------------------------------------------------------- patterns

Pattern = tuple[int, list[tuple[int, int]]]  # repeats; (bin, pieces of it in a sequence)


def bin_of(length):
    """Upper end of a length's bin: a Column or a number."""
    if isinstance(length, int):
        return length if length <= EXACT else -(-length // STEP) * STEP
    up = (F.ceil(length / STEP) * STEP).cast("long")
    return F.when(length <= EXACT, length).otherwise(up)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """Least ``|ax - b|`` with x >= 0, by active sets (Lawson and Hanson)."""
    n = a.shape[1]
    x, used = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0.0)))
    for _ in range(rounds or 3 * a.shape[0] + 30):
        gain = a.T @ (b - a @ x)
        gain[used] = -np.inf
        best = int(gain.argmax())
        if gain[best] <= tolerance:
            break
        used[best] = True
        while True:
            trial = np.zeros(n)
            trial[used] = np.linalg.lstsq(a[:, used], b, rcond=None)[0]
            if trial[used].min() > 0:
                x = trial
                break
            low = used & (trial <= 0)
            ratio = x[low] / np.maximum(x[low] - trial[low], 1e-300)
            x = x + ratio.min() * (trial - x)
            x[x < 1e-12] = 0
            used &= x > 0
            if not used.any():
                break
    return x


def fillings(units: int, least: int) -> list[tuple[int, ...]]:
    """Combinations of two or three lengths of at least ``least`` units that fill a window."""
    two = [(a, units - a) for a in range(least, units // 2 + 1)]
    three = [
        (a, b, units - a - b)
        for a in range(least, units // 3 + 1)
        for b in range(a, (units - a) // 2 + 1)
    ]
    return two + three


def _take(left: dict[int, int], combo: dict[int, int], repeats: int) -> Pattern | None:
    repeats = min([repeats, *(left.get(size, 0) // n for size, n in combo.items())])
    if repeats < 1:
        return None
    for size, n in combo.items():
        left[size] -= repeats * n
        if not left[size]:
            del left[size]
    return repeats, sorted(combo.items(), reverse=True)


def _counted(sizes) -> dict[int, int]:
    out: dict[int, int] = {}
    for s in sizes:
        out[s] = out.get(s, 0) + 1
    return out


def patterns(histogram: dict[int, int], window: int = WINDOW) -> list[Pattern]:
    """Which lengths share a sequence, and how often; uses up the whole histogram."""
    left = {size: n for size, n in histogram.items() if n}
    out: list[Pattern] = []
    if window in left:
        out.append((left.pop(window), [(window, 1)]))
    present = [s for s in left if s > EXACT and s % STEP == 0]
    if present:
        units = window // STEP
        combos = [
            c for c in fillings(units, EXACT // STEP + 1) if all(u * STEP in left for u in c)
        ]
        if combos:
            row = {s // STEP: i for i, s in enumerate(present)}
            a = np.zeros((len(present), len(combos)))
            for j, combo in enumerate(combos):
                for u in combo:
                    a[row[u], j] += 1
            b = np.array([left[s] for s in present], float)
            x = nnls(a, b / b.max()) * b.max()
            for j in np.argsort(-x, kind="stable"):
                if x[j] >= 1:
                    sizes = _counted(u * STEP for u in combos[j])
                    found = _take(left, sizes, int(x[j] + 1e-6))
                    if found:
                        out.append(found)
    while left:
        combo, room = {}, window
        for size in sorted(left, reverse=True):
            n = min(left[size], room // size)
            if n:
                combo[size] = n
                room -= n * size
        out.append(_take(left, combo, max(left.values())))
    return out


# ---------------------------------------------------------------- placing


def _salted_ranks(pieces: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Adds ``rank``, gapless within each bin, and returns the bins' counts.

    Bins are split by a hash of the piece, so one very common length is ranked by many tasks.
    The counts by bin and part have a bounded number of rows and are broadcast. Pieces that agree in
    id and start are ordered by what else tells them apart, so a task that runs again ranks alike.
    """
    told = [c for c in ("doc_id", "start", "ids_crc32", "doc_tokens") if c in pieces.columns]
    salted = pieces.withColumn("part", F.pmod(F.xxhash64(*told), F.lit(SALTS)))
    counts = salted.groupBy("bin", "part").agg(F.count("*").alias("n")).collect()
    totals: dict[int, int] = {}
    offsets = []
    for r in sorted(counts, key=lambda r: (r["bin"], r["part"])):
        offsets.append((r["bin"], r["part"], totals.get(r["bin"], 0)))
        totals[r["bin"]] = totals.get(r["bin"], 0) + r["n"]
    spark = pieces.sparkSession
    first = spark.createDataFrame(offsets, "bin long, part long, before long")
    order = Window.partitionBy("bin", "part").orderBy(*told)
    ranked = salted.join(F.broadcast(first), ["bin", "part"]).withColumn(
        "rank", F.col("before") + F.row_number().over(order) - 1
    )
    return ranked.drop("part", "before"), totals


_RANKS = 1 << 44


def _segments(found: list[Pattern]):
    """For runs of ranks within a bin: key of the first, sequence and place there, and width."""
    used: dict[int, int] = {}
    sequence, rows = 0, []
    for repeats, sizes in found:
        place = 0
        for size, n in sizes:
            rank = used.get(size, 0)
            rows.append((size * _RANKS + rank, rank, sequence, place, n))
            used[size] = rank + repeats * n
            place += n
        sequence += repeats
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds ``sequence_id`` (gapless from 0) and ``offset`` to pieces of at most ``window`` tokens.

    Columns of these names are replaced. Every piece is placed once; an empty input stays empty.
    """
    binned = pieces.drop("sequence_id", "offset").withColumn(
        "bin", F.least(bin_of(F.col("length")), F.lit(window))
    )
    ranked, totals = _salted_ranks(binned)
    segments = _segments(patterns(totals, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = batch.column("bin").to_numpy(zero_copy_only=False)
            ranks = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(segments[:, 0], bins * _RANKS + ranks, side="right") - 1
            _, first, sequence, place, width = segments[at].T
            step = ranks - first
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sequence + step // width), pa.array(place + step % width)],
                [*names, "sequence_id", "place"],
            )

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema)
    placed = ranked.mapInArrow(run, f"{columns}, sequence_id long, place long")
    before = (
        Window.partitionBy("sequence_id")
        .orderBy("place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return placed.withColumn("offset", F.sum("length").over(before) - F.col("length")).drop(
        "bin", "rank", "place"
    )


def pack_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    vocabulary: str | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their sequence and offset; ``token_pieces`` is written once.

    The end id closes each document. A sequence is padded by its reader up to the window.
    """
    pieces = token_pieces(docs, doc_id, text, window, vocabulary, keep_ids)
    return pack(materialize(pieces, "pieces"), window)
