"""Secret scan: fixed patterns, and strings that do not compress next to a sensitive word.

Beside three patterns, every long code-like string after a word such as "key" or "auth" is
measured: how many bytes does it add to the zstandard frame of its surroundings, when the
compressor is primed with a dictionary of common identifiers? Words, paths and identifiers
add little; keys and hashes add nearly their entropy and are reported as ``novel``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildmill.llm.common import ship_package, slices, strings, whole_text

KINDS = ("assign", "access", "hex", "novel")
# Fixed patterns of the scan.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
LEAST_ASSIGNED, LEAST_ACCESS = 8, 16

CONTEXT = re.compile(
    r"pass|pwd|secret|token|key|auth|cred|bearer|private|session|signature|salt|jwt|cookie",
    re.IGNORECASE | re.ASCII,
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
BEFORE, AROUND = 48, 160
LEAST_NOVELTY = 0.85  # marginal bytes per character
IDENTIFIERS = (
    "access account admin api application array authorization bearer boolean bucket cache class "
    "client config connection console const context cookie credential database default delete "
    "deploy description document element encoding endpoint environment error event export false "
    "function handler header host import index instance integer interface json key length list "
    "localhost login message method module name null number object option package parameter "
    "password path port private process production project property protected public query "
    "request resource response return root schema secret server service session signature static "
    "status storage string structure table template test timestamp token true type undefined "
    "update upload user value variable version window /usr/share/local/lib/bin/etc/home/var/tmp/opt "
    "dictionary identifier element configuration directory reference information https://www.example.com/index.html "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 xxxxxxxxxxxxxxxx "
    "----------------========________________"
)

Span = tuple[int, int, str]  # start, end, kind


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost and without overlap within a kind."""
    out: list[Span] = []
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_ASSIGNED:
                out.append((*m.span(), "assign"))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= LEAST_ACCESS:
                out.append((*m.span(), "access"))
    out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return out


class Novelty:
    """Marginal compressed size of a string in its surroundings."""

    def __init__(self, identifiers: str = IDENTIFIERS, level: int = 3):
        primed = zstandard.ZstdCompressionDict(
            identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        self.zstd = zstandard.ZstdCompressor(level=level, dict_data=primed, write_checksum=False)

    def __call__(self, text: str, start: int, end: int) -> float:
        before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
        around = (before + after).encode("utf-8", "surrogatepass")
        value = text[start:end].encode()
        alone = len(self.zstd.compress(around))
        return (len(self.zstd.compress(around + value)) - alone) / len(value)


def novel_spans(text: str, taken: list[Span], novelty: Novelty) -> list[Span]:
    out: list[Span] = []
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        value = m[0]
        if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
            continue
        if any(s < end and start < e for s, e, _ in taken):
            continue
        if CONTEXT.search(text, max(0, start - BEFORE), start) is None:
            continue
        if novelty(text, start, end) >= LEAST_NOVELTY:
            out.append((start, end, "novel"))
    return out


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in in_order(spans))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every reported stretch replaced by a mark; touching stretches share one."""
    out, at = [], 0
    for start, end, _ in in_order(spans):
        if end <= at:
            continue
        if start >= at:
            out.append(text[at:start])
            out.append("[REDACTED]")
        at = end
    return "".join(out) + text[at:]


SPAN_TYPE = "array<struct<start:long,end:long,kind:string>>"


def scan(docs: DataFrame, text: str = "text", redact: bool = False) -> DataFrame:
    """Adds ``secret_spans``: start and end (code points) and kind of every finding, in order.

    With ``redact`` the text is replaced by its redacted form. No shuffle: each text is read
    whole by one task. Null and empty texts have no spans, and a null text stays null; repeated
    rows are scanned alike; an input column named ``secret_spans`` is replaced.
    """
    ship_package(docs.sparkSession)
    kept = docs.drop("secret_spans")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    span = pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for whole in batches:
            for batch in slices(whole, text):
                found, changed = [], []
                for value, given in zip(strings(batch.column(text)), batch.column(text), strict=True):
                    spans = base_spans(value)
                    spans = in_order(spans + novel_spans(value, spans, novelty))
                    found.append([{"start": s, "end": e, "kind": k} for s, e, k in spans])
                    if redact:
                        changed.append(redacted(value, spans) if spans else given.as_py())
                columns = [
                    pa.array(changed, pa.string()) if redact and n == text else c
                    for n, c in zip(batch.schema.names, batch.columns, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(found, span)], [*batch.schema.names, "secret_spans"]
                )

    return kept.mapInArrow(run, f"{schema}, secret_spans {SPAN_TYPE}")


def span_digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the fixed kinds, a digest of their spans, and all spans as text."""
    found = scan(docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text")))
    base = F.expr("filter(secret_spans, s -> s.kind != 'novel')")

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind):
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secret_spans")).alias("spans"),
    )


def base_digest(text: str) -> str:
    return hashlib.sha256(spans_text(base_spans(text)).encode()).hexdigest()
