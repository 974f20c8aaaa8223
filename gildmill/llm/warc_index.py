"""WARC archives with payload revisits, and their capture index by external merge.

Pages are written as gzipped WARC records, one archive per task. The archives are read back
one by one; each gives a locally sorted run of captures. Runs are then merged by key range:
a task opens the part of every run that lies in its range and merges them with a loser tree,
so the captures come out ordered by URL key, time and page across all archives while a task
holds one line and one read buffer per run.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gildmill.llm.common import (
    materialize,
    reduce_tasks,
    scratch_path,
    ship_package,
    whole_text,
)

LEAST_REVISIT = 1000  # bytes; shorter payloads are always written whole
BLOCK = 256  # captures between two entries of a run's sparse index
BUFFER = 1 << 15
EPOCH = 1_704_067_200  # capture time of page 0 where the pages carry none
CAPTURE_SECONDS = 190_000_000_000

CAPTURE = (
    "url_key string, captured string, page_id long, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, archive string, record_offset long, record_length long"
)
FIELDS = [part.split(" ")[0] for part in CAPTURE.split(", ")]
_ARROW = pa.schema(
    [(f, pa.string() if t == "string" else pa.int64()) for f, t in (p.split(" ") for p in CAPTURE.split(", "))]
)
_SMALLEST = -(1 << 63)


# ---------------------------------------------------------------- columns


def url_key(url: str) -> Column:
    """Host labels reversed, then the path: all captures of a host are neighbours."""
    lower = F.lower(whole_text(url))
    host = F.regexp_extract(lower, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    host = F.regexp_replace(host, r"^www\d*\.", "")
    rest = F.regexp_replace(lower, r"^[a-z][a-z0-9+.-]*://[^/?#]*", "")
    rest = F.regexp_replace(rest, r"#.*$", "")
    path = F.when(rest == "", F.lit("/")).otherwise(rest)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)


def capture_time(page_id) -> Column:
    """14 digits for any id: seconds since ``EPOCH``, ids beyond some 6,000 years taken modulo that.

    ``pages`` has no time of capture, so the id stands in for it; a null id is the first.
    """
    seconds = F.pmod(F.coalesce(page_id.cast("long"), F.lit(0)), F.lit(CAPTURE_SECONDS)) + F.lit(EPOCH)
    return F.date_format(F.timestamp_seconds(seconds), "yyyyMMddHHmmss")


def mark_revisits(pages: DataFrame, page_id="page_id", url="url", html="html") -> DataFrame:
    """One row per page with its payload, digest, and what kind of record it becomes.

    Of equal payloads of 1000 bytes or more the largest page id is the response, the others
    revisit it. Rows that repeat that id are responses too; a null id never is the response of
    others. Only digests and ids are grouped (combined before the shuffle); the join's other
    side is unique by digest, so a hot payload's rows can be split.
    """
    payload = whole_text(html)
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        whole_text(url).alias("url"),
        url_key(url).alias("url_key"),
        capture_time(F.col(page_id)).alias("captured"),
        payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("digest"),
        F.octet_length(payload).cast("long").alias("size"),
    )
    first = (
        rows.filter(F.col("size") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("response").isNotNull())
        .drop("n")
    )
    refers = F.when(~F.col("response").eqNullSafe(F.col("page_id")), F.col("response"))
    return rows.join(first, "digest", "left").withColumn("refers_to", refers).drop("response")


# ---------------------------------------------------------------- archives


def _file(path: str):
    system, name = pafs.FileSystem.from_uri(path)
    return system, name


def _header(version: str, fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [version, *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _one_line(url: str) -> str:
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in url)


def record_bytes(page_id, url, captured, payload: bytes, digest, size, refers_to) -> bytes:
    """One WARC record; a revisit has the HTTP head and no payload."""
    t = captured
    kind = "response" if refers_to is None else "revisit"
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{page_id}>"),
        ("WARC-Date", f"{t[:4]}-{t[4:6]}-{t[6:8]}T{t[8:10]}:{t[10:12]}:{t[12:14]}Z"),
        ("WARC-Target-URI", _one_line(url)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", size),
    ]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    if refers_to is not None:
        fields.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
        fields.append(
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        )
        return _header("WARC/1.1", fields, head)
    return _header("WARC/1.1", fields, head + payload)


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _write_task(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        path = f"{folder}/{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        out, records = None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if out is None:
                    system, name = _file(path)
                    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
                    out = system.open_output_stream(name, compression=None)
                    info = b"software: gildmill\r\nformat: WARC File Format 1.1\r\n"
                    fields = [("WARC-Type", "warcinfo"), ("Content-Type", "application/warc-fields")]
                    out.write(_gzip(_header("WARC/1.1", fields, info)))
                out.write(
                    _gzip(
                        record_bytes(
                            row["page_id"], row["url"], row["captured"],
                            row["payload"].encode("utf-8", "surrogatepass"),
                            row["digest"], row["size"], row["refers_to"],
                        )
                    )
                )
                records += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"archive": path, "records": records}])

    return run


def write_archives(marked: DataFrame, folder: str) -> DataFrame:
    """(archive, records) of the archives that completed tasks wrote.

    Records of an archive are in index order. A repeated task writes under another name, and
    only names in the returned, written table count.
    """
    ship_package(marked.sparkSession)
    ordered = marked.sortWithinPartitions("url_key", "captured", "page_id")
    written = ordered.mapInArrow(_write_task(folder), "archive string, records long")
    return materialize(written, "archives")


def members(path: str) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of every gzip member of an archive, streamed."""
    system, name = _file(path)
    with system.open_input_stream(name, compression=None) as f:
        at, data = 0, f.read(1 << 20)
        while data:
            z, start, parts = zlib.decompressobj(31), at, []
            while True:
                parts.append(z.decompress(data))
                at += len(data) - len(z.unused_data)
                if z.eof:
                    data = z.unused_data or f.read(1 << 20)
                    break
                data = f.read(1 << 20)
                if not data:
                    raise ValueError(f"{path} is cut off at byte {at}")
            yield start, at - start, b"".join(parts)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('WARC-Record-ID')} has a wrong length")
    return fields, block


def _id_of(urn: str) -> int | None:
    value = urn.strip("<>").rsplit(":", 1)[1]
    return None if value == "None" else int(value)


def captures(path: str, keys: Callable[[str], str]) -> Iterator[dict]:
    """The captures of an archive; a response's payload must have its length and digest."""
    for offset, length, record in members(path):
        fields, block = parse_record(record)
        kind = fields["WARC-Type"]
        if kind == "warcinfo":
            continue
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        size = int(fields["X-Payload-Length"])
        if kind == "response":
            payload = block.partition(b"\r\n\r\n")[2]
            if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
                raise ValueError(f"{fields['WARC-Record-ID']} in {path}: payload has changed")
        yield {
            "url_key": keys(fields["WARC-Target-URI"]),
            "captured": "".join(c for c in fields["WARC-Date"] if c.isdigit()),
            "page_id": _id_of(fields["WARC-Record-ID"]),
            "payload_bytes": size,
            "payload_digest": digest,
            "record_type": kind,
            "refers_to": _id_of(fields["WARC-Refers-To"]) if kind == "revisit" else None,
            "archive": path,
            "record_offset": offset,
            "record_length": length,
        }


def key_of(url: str) -> str:
    """``url_key`` of a URL as it stands in a record."""
    import re

    url = url.lower()
    m = re.match(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url)
    host = re.sub(r"^www\d*\.", "", m[1] if m else "")
    rest = re.sub(r"^[a-z][a-z0-9+.-]*://[^/?#]*", "", url)
    rest = re.sub(r"#.*$", "", rest)
    return ",".join(reversed(host.split("."))) + ")" + (rest or "/")


def order_of(capture: dict) -> tuple[bytes, str, int]:
    page = capture["page_id"]
    return capture["url_key"].encode(), capture["captured"], _SMALLEST if page is None else page


# ---------------------------------------------------------------- runs and their merge


def _run_task(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                rows = sorted(captures(path, key_of), key=order_of)
                target = f"{folder}/{path.rsplit('/', 1)[1]}-{attempt}.run"
                system, name = _file(target)
                system.create_dir(name.rsplit("/", 1)[0], recursive=True)
                blocks, at = [], 0
                with system.open_output_stream(name, compression=None) as out:
                    for i, row in enumerate(rows):
                        if i % BLOCK == 0:
                            blocks.append({"run": target, "key": row["url_key"], "at": at})
                        line = json.dumps([row[f] for f in FIELDS]).encode() + b"\n"
                        out.write(line)
                        at += len(line)
                if blocks:
                    yield pa.RecordBatch.from_pylist(blocks)

    return run


def _lines(path: str, start: int) -> Iterator[dict]:
    system, name = _file(path)
    with system.open_input_file(name) as f:
        f.seek(start)
        rest = b""
        while data := f.read(BUFFER):
            *whole, rest = (rest + data).split(b"\n")
            for line in whole:
                yield dict(zip(FIELDS, json.loads(line), strict=True))


class LoserTree:
    """Merge of sorted iterators: each step replays one leaf's path, comparing with the losers."""

    def __init__(self, sources: Iterable[Iterator[dict]], key: Callable[[dict], tuple] = order_of):
        self.sources = list(sources)
        self.key = key
        self.k = len(self.sources)
        self.heads: list = [self._next(i) for i in range(self.k)]
        self.losers = [-1] * max(1, self.k)
        for i in range(self.k):
            self._replay(i)

    def _next(self, i: int):
        item = next(self.sources[i], None)
        return None if item is None else (self.key(item), i, item)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x[:2] < y[:2])

    def _replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other == -1:  # while building: wait here for the other half
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[dict]:
        while self.k and (head := self.heads[self.losers[0]]) is not None:
            yield head[2]
            leaf = self.losers[0]
            self.heads[leaf] = self._next(leaf)
            self._replay(leaf)


def _within(items: Iterator[dict], low: bytes | None, high: bytes | None) -> Iterator[dict]:
    for item in items:
        key = item["url_key"].encode()
        if high is not None and key >= high:
            return
        if low is None or key >= low:
            yield item


def _slices_task(bounds: list[bytes]):
    """For each run and key range that may overlap: where to begin reading."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                order = sorted(row["blocks"], key=lambda b: b["at"])
                keys, out = [b["key"].encode() for b in order], []
                for i in range(bisect.bisect_right(bounds, keys[0]), len(bounds) + 1):
                    low = bounds[i - 1] if i else None
                    block = bisect.bisect_left(keys, low) - 1 if low is not None else 0
                    out.append({"part": i, "run": row["run"], "at": order[max(0, block)]["at"]})
                if out:
                    yield pa.RecordBatch.from_pylist(out)

    return run


def _merge_task(bounds: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                parts.setdefault(row["part"], []).append((row["run"], row["at"]))
        for part in sorted(parts):
            low = bounds[part - 1] if part else None
            high = bounds[part] if part < len(bounds) else None
            runs = [_within(_lines(path, at), low, high) for path, at in sorted(parts[part])]
            rows = []
            for capture in LoserTree(runs):
                rows.append(capture)
                if len(rows) == 2000:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return run


def capture_index(archives: DataFrame, folder: str) -> DataFrame:
    """Captures of all archives, ordered by (url_key, captured, page_id) across partitions.

    ``archives`` has a column ``archive``. Key ranges come from a bounded sample of the runs'
    sparse index (20 keys a range); it decides how evenly ranges are filled, not what they
    hold. All captures of one URL are in one range. No archives give an empty index.
    """
    spark = ship_package(archives.sparkSession)
    ranges = reduce_tasks(spark)
    count = max(1, archives.count())
    blocks = materialize(
        archives.select("archive")
        .repartition(count)
        .mapInArrow(_run_task(f"{folder}/runs"), "run string, key string, at long"),
        "runs",
    )
    sample = blocks.select("key").orderBy(F.xxhash64("run", "at")).limit(20 * ranges).collect()
    keys = sorted(r["key"].encode() for r in sample)
    bounds = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []
    parts = len(bounds) + 1
    return (
        blocks.groupBy("run")
        .agg(F.collect_list(F.struct("key", "at")).alias("blocks"))
        .mapInArrow(_slices_task(bounds), "part long, run string, at long")
        .repartitionById(parts, F.col("part").cast("int"))
        .mapInArrow(_merge_task(bounds), CAPTURE)
    )


def archive_pages(pages: DataFrame, page_id="page_id", url="url", html="html") -> DataFrame:
    """Write ``pages`` as WARC archives in the shared folder and return their capture index.

    Null ids, URLs and payloads are allowed (null text: empty; a null id's record says None);
    repeated rows give repeated records; other columns are not read. An empty table gives an
    empty index.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    archives = write_archives(mark_revisits(pages, page_id, url, html), folder)
    return capture_index(archives, folder)
