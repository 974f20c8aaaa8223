"""Token counts by a whole-token shortcut over a byte-fallback piece vocabulary.

Two facts are proved from the vocabulary before any text is read:

* Where a text may be cut. A merge of two neighbours needs a piece that holds the last
  character of one beside the first of the other. Characters that are ever neighbours in a
  piece form classes (the space mark apart); between two classes, around a character that is
  in no longer piece, and before a space mark after another character, no merge can cross.
  So a text's count is the sum of the counts of its runs.
* Which vocabulary strings encode alone as one token. Each goes through the library's merges.

Runs that are such strings count one, directly; only the rest is merged, once per worker while it
stays in a cache of bounded size. Whole texts are read, in chunks that end at a proved cut, so
a task holds some megabytes beside the Arrow batch (a run without any cut is one chunk).

Special strings inside texts are ordinary text, as is the library's default. Null texts are empty
and have no tokens. Other columns and repeated rows pass unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildmill.llm.common import ship_package, whole_text

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
MARK = "▁"  # fixed value: the library's mark for a space
GUARD = "\n"
CHUNK = 1 << 20  # characters
CACHED_LENGTH = 64
LARGE_CLASSES = 3


def character_classes(pieces: list[str]) -> list[set[str]]:
    """Characters other than the mark that may merge: connected by neighbourhood in a piece."""
    parent: dict[str, str] = {}

    def root(c: str) -> str:
        while parent.setdefault(c, c) != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    for piece in pieces:
        letters = piece.replace(MARK, "")
        for a, b in zip(letters, letters[1:]):
            parent[root(a)] = root(b)
        if len(piece) > len(letters):
            for c in letters:
                root(c)
    classes: dict[str, set[str]] = {}
    for c in list(parent):
        classes.setdefault(root(c), set()).add(c)
    return sorted(classes.values(), key=lambda c: (-len(c), min(c)))


class PieceCounts(dict):
    """Tokens per run: the proved strings, and runs merged before, up to ``limit``.

    ``words`` holds the same for what stands between two single spaces: a run or several.
    """

    limit = 100_000

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_proto=model)
        ids = range(self.library.get_piece_size())
        named = [
            i
            for i in ids
            if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i))
        ]
        self.pieces = [self.library.id_to_piece(i) for i in named]
        self.single = {p for p in self.pieces if len(p) == 1}
        classes = character_classes(self.pieces)
        joined = {c for group in classes for c in group}
        self._check(joined)
        # A wider class only means fewer cuts: the small ones go together.
        groups = [*classes[:LARGE_CLASSES], set().union(*classes[LARGE_CLASSES:])]
        sets = ["".join(map(re.escape, sorted(group))) for group in groups if group]
        runs = [f"{MARK}*[{s}]+" for s in sets] + [f"{MARK}+", "."]
        self.runs = re.compile("|".join(runs), re.DOTALL).findall
        lone = f"[^ {MARK}{''.join(map(re.escape, sorted(joined)))}]"
        self.cut = re.compile(f"(?<=[^ {MARK}])[ {MARK}]|{lone}", re.DOTALL)
        self.proved = {p: 1 for p in self.pieces if len(p) > 1 and self.runs(p) == [p] and self.merged(p) == 1}
        self.update(self.proved)
        self.words = WordCounts(self)

    def _check(self, joined: set[str]) -> None:
        """What the proofs rest on; another kind of vocabulary is refused."""
        odd = "  ①éé\t<s>  \n "
        if self.library.normalize(odd) != MARK + odd.replace(" ", MARK):
            raise ValueError("the vocabulary rewrites texts; runs of it can't be counted apart")
        if not any(map(self.library.is_byte, range(self.library.get_piece_size()))):
            raise ValueError("the vocabulary has no byte pieces")
        if GUARD in joined or any(re.search(f"[^{MARK}]{MARK}", p) for p in self.pieces):
            raise ValueError("pieces of the vocabulary cross line ends or spaces")

    def merged(self, run: str) -> int:
        """The library's count of a run, behind the mark it puts first and a line end."""
        return len(self.library.encode(GUARD + run, num_threads=1)) - 2

    def __missing__(self, run: str) -> int:
        if len(run) == 1 and run != MARK:
            count = 1 if run in self.single else len(run.encode("utf-8"))
        else:
            count = self.merged(run)
        if len(run) <= CACHED_LENGTH:
            if len(self) >= self.limit:
                self.clear()
                self.update(self.proved)
            self[run] = count
        return count

    def chunks(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > CHUNK and (found := self.cut.search(text, start + CHUNK)):
            yield text[start : found.start()]
            start = found.start()
        yield text[start:]

    def count(self, text: str) -> int:
        if not text:
            return 0
        if len(text) <= CHUNK and "  " not in text and MARK not in text and not (text[0] == " " or text[-1] == " "):
            return sum(map(self.words.__getitem__, text.split(" ")))
        total, first = 0, MARK
        for chunk in self.chunks(text):
            total += sum(map(self.__getitem__, self.runs(first + chunk.replace(" ", MARK))))
            first = ""
        return total


class WordCounts(dict):
    """Tokens of a word without marks, as it counts behind one mark.

    When full, the words become the older generation; those met again come back from it.
    """

    limit = 300_000

    def __init__(self, runs: PieceCounts):
        self.of, self.older = runs, {}

    def __missing__(self, word: str) -> int:
        count = self.older.get(word)
        if count is None:
            count = sum(map(self.of.__getitem__, self.of.runs(MARK + word)))
        if len(word) <= CACHED_LENGTH:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[word] = count
        return count


_counters: dict[bytes, PieceCounts] = {}


def counter(model: bytes) -> PieceCounts:
    """One per worker process and vocabulary."""
    if model not in _counters:
        _counters.clear()
        _counters[model] = PieceCounts(model)
    return _counters[model]


def read_model(path: str | None = None) -> bytes:
    """The vocabulary file, read on the driver; its half megabyte travels with the tasks."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    return Path(path).read_bytes()


def token_count(text: Column, vocabulary: str | None = None) -> Column:
    model = read_model(vocabulary)
    counter(model)  # refuses an unfit vocabulary here, not in a task

    @F.arrow_udf(T.LongType())
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counts = counter(model)
        for texts in batches:
            yield pa.array([counts.count(t.as_py() or "") for t in texts], pa.int64())

    return count(text)


def count_tokens(
    docs: DataFrame, text: str = "text", limit: int = LIMIT, vocabulary: str | None = None
) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit; equally named columns are replaced."""
    ship_package(docs.sparkSession)
    counted = docs.withColumns(
        {
            "n_bytes": F.octet_length(whole_text(text)).cast("long"),
            "n_tokens": token_count(F.col(text), vocabulary),
        }
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
