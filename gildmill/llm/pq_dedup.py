"""Near-duplicate embeddings with product quantisation.

Unit vectors go to the nearest of some coarse centroids (inverted lists); their residuals are
coded subspace by subspace. Every vector also is a query: it probes its nearest lists, looks up
its distances to all codes once a subspace, and adds them up for each member. As the exact
error of each member's code is stored, a member is left out only if it cannot be near enough.
All others are compared by cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildmill.llm.common import connected_components, materialize, ship_package

THRESHOLD = 0.9
SAMPLE = 20_000  # vectors at most that centroids and codes are fitted to
LISTS = 1024  # at most; else the square root of the number of vectors
PROBES = 12
CODES = 256
TILE = 2048  # members or queries of a list in one task
_VECTOR = "binary"


@dataclass
class Quantizer:
    centroids: np.ndarray  # lists x dimensions
    books: list[np.ndarray]  # per subspace: codes x its dimensions
    cuts: list[tuple[int, int]]

    def nearest(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n nearest lists of each row, nearest first."""
        d = (self.centroids**2).sum(1) - 2 * (x @ self.centroids.T)
        n = min(n, d.shape[1])
        some = np.argpartition(d, n - 1, axis=1)[:, :n]
        order = np.argsort(np.take_along_axis(d, some, 1), axis=1, kind="stable")
        return np.take_along_axis(some, order, 1)

    def encode(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the distance between each vector and what they stand for."""
        residual = x - self.centroids[home]
        codes = np.empty((len(x), len(self.books)), np.uint8)
        error = np.zeros(len(x))
        for s, (book, (i, j)) in enumerate(zip(self.books, self.cuts, strict=True)):
            part = residual[:, i:j]
            best = ((book**2).sum(1) - 2 * part @ book.T).argmin(1)
            codes[:, s] = best
            error += ((part - book[best]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def distances(self, x: np.ndarray, home: int, codes: np.ndarray) -> np.ndarray:
        """Distance of every query to every member of a list, by table look-up."""
        residual = x - self.centroids[home]
        out = np.zeros((len(x), len(codes)))
        for s, (book, (i, j)) in enumerate(zip(self.books, self.cuts, strict=True)):
            part = residual[:, i:j]
            lookup = (part**2).sum(1)[:, None] + (book**2).sum(1)[None] - 2 * part @ book.T
            out += lookup[:, codes[:, s]]
        return np.sqrt(np.maximum(out, 0))


def _kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    random = np.random.default_rng(seed)
    centres = x[np.sort(random.choice(len(x), min(k, len(x)), replace=False))].copy()
    for _ in range(rounds):
        owner = ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)
        counts = np.bincount(owner, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, owner, x)
        full = counts > 0
        centres[full] = total[full] / counts[full, None]
    return centres


def fit(sample: np.ndarray, lists: int) -> Quantizer:
    """Centroids and codebooks of unit vectors."""
    centroids = _kmeans(sample, lists, 8, 1)
    d = sample.shape[1]
    spaces = max(1, min(16, d // 4))
    edges = [d * s // spaces for s in range(spaces + 1)]
    cuts = list(zip(edges[:-1], edges[1:], strict=True))
    home = ((centroids**2).sum(1) - 2 * sample @ centroids.T).argmin(1)
    residual = sample - centroids[home]
    books = [_kmeans(residual[:, i:j], CODES, 5, 2 + i) for i, j in cuts]
    return Quantizer(centroids, books, cuts)


def _units(vectors: pa.Array) -> np.ndarray:
    """Rows scaled to length one; scaling by the largest component first avoids overflow."""
    x = np.stack(vectors.to_numpy(zero_copy_only=False)).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x**2).sum(1))[:, None]


def usable(vector: str):
    """Neither null nor empty nor zero, all components finite."""
    v = F.col(vector)
    big = F.lit(float("inf"))
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == big))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda e: e != 0)


def _encode_task(model, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quantizer = model.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                x = _units(batch.column("vector"))
                near = quantizer.nearest(x, probes)
                codes, error = quantizer.encode(x, near[:, 0])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node"),
                        batch.column("n"),
                        pa.array([v.tobytes() for v in x], pa.binary()),
                        pa.array(near[:, 0].astype(np.int32)),
                        pa.array(near.astype(np.int32).tolist(), pa.list_(pa.int32())),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(error),
                    ],
                    ["node", "n", "unit", "home", "probes", "codes", "error"],
                )

    return run


_FOUND = pa.schema([("node", pa.binary()), ("root", pa.binary()), ("links", pa.int64())])


def _tile_task(model, threshold: float):
    """Links between a tile's queries and members: counts, and a tree edge per vector.

    A pair that both vectors' probes can meet is counted for the query only, as the other
    vector meets it as a query elsewhere; else it is counted for both.
    """
    reach = np.sqrt(2 - 2 * threshold) + 1e-9

    def run(tile: pa.Table) -> pa.Table:
        quantizer = model.value
        query = np.array(tile.column("query").to_pylist())
        rows = [tile.filter(pa.array(query)), tile.filter(pa.array(~query))]
        if not rows[0].num_rows or not rows[1].num_rows:
            return _FOUND.empty_table()
        (q, m), dim = rows, quantizer.centroids.shape[1]
        x, y = (
            np.frombuffer(b"".join(r.column("unit").to_pylist())).reshape(-1, dim) for r in rows
        )
        names = [r.column("node").to_pylist() for r in rows]
        weight = [np.array(r.column("n").to_pylist()) for r in rows]
        codes = np.frombuffer(b"".join(m.column("codes").to_pylist()), np.uint8)
        codes = codes.reshape(len(y), -1)
        error = np.array(m.column("error").to_pylist())
        home = np.array(q.column("home").to_pylist())
        list_id = tile.column("list")[0].as_py()
        index = {node: i for i, node in enumerate(names[1])}
        probed = [set(p) for p in m.column("probes").to_pylist()]
        left, right = [], []
        for start in range(0, len(x), 256):
            part = x[start : start + 256]
            near = quantizer.distances(part, list_id, codes) <= reach + error[None]
            i, j = np.nonzero(near)
            if len(i):
                exact = np.empty(len(i))
                for s in range(0, len(i), 20_000):
                    a, b = i[s : s + 20_000], j[s : s + 20_000]
                    exact[s : s + 20_000] = (part[a] * y[b]).sum(1)
                ok = exact >= threshold
                left.append(i[ok] + start)
                right.append(j[ok])
        if not left:
            return _FOUND.empty_table()
        i, j = np.concatenate(left), np.concatenate(right)
        twin = np.array([index.get(node, -1) for node in names[0]])
        ok = twin[i] != j  # not a vector with itself
        i, j = i[ok], j[ok]
        if not len(i):
            return _FOUND.empty_table()
        # rows of the tile as one numbering: members first, queries that are no members after
        number = np.where(twin >= 0, twin, np.arange(len(x)) + len(y))
        links = np.zeros(len(y) + len(x), np.int64)
        np.add.at(links, number[i], weight[1][j])
        both = np.array([h in p for h, p in ((int(home[a]), probed[b]) for a, b in zip(i, j))])
        once = ~both & (home[i] != list_id)
        np.add.at(links, j[once], weight[0][i[once]])
        root = np.arange(len(y) + len(x))
        a, b = number[i], j
        while True:
            before = root.copy()
            low = np.minimum(root[a], root[b])
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            root = root[root]
            if (root == before).all():
                break
        used = np.unique(np.concatenate([a, b]))
        label = dict(enumerate(names[1])) | {
            len(y) + k: node for k, node in enumerate(names[0])
        }
        return pa.Table.from_pydict(
            {
                "node": [label[u] for u in used],
                "root": [label[root[u]] for u in used],
                "links": links[used],
            },
            schema=_FOUND,
        )

    return run


def _of_length(nodes: DataFrame, count: int, threshold: float, probes: int) -> DataFrame:
    """(node, root, links) found among vectors of one length."""
    spark = nodes.sparkSession
    share = min(1.0, 1.5 * SAMPLE / count + 50.0 / count)
    key = F.abs(F.xxhash64("node", F.lit(1)) % 1_000_000)
    sample = (
        nodes.filter(key < int(share * 1_000_000) + 1)
        .orderBy(F.xxhash64("node", F.lit(1)))
        .limit(SAMPLE)
        .select("vector")
        .toArrow()
    )
    units = _units(sample.column("vector").combine_chunks())
    model = fit(units, max(1, min(LISTS, int(np.sqrt(count)))))
    shared = spark.sparkContext.broadcast(model)
    coded = materialize(
        nodes.select("node", "n", "vector").mapInArrow(
            _encode_task(shared, probes),
            "node binary, n long, unit binary, home int, probes array<int>, codes binary, "
            "error double",
        ),
        "codes",
    )
    # tiles of each list: rows by list, a bounded number
    members = coded.groupBy(F.col("home").alias("list")).agg(F.count("*").alias("m"))
    queries = (
        coded.select(F.explode("probes").alias("list")).groupBy("list").agg(F.count("*").alias("q"))
    )
    sizes = members.join(queries, "list").select(
        "list",
        F.ceil(F.col("m") / TILE).cast("int").alias("mt"),
        F.ceil(F.col("q") / TILE).cast("int").alias("qt"),
    )
    sizes = F.broadcast(materialize(sizes, "list-sizes"))
    place = F.xxhash64("node", F.lit(2))
    asks = (
        coded.select("*", F.explode("probes").alias("list"))
        .join(sizes, "list")
        .select(
            "list",
            F.explode(F.sequence(F.lit(0), F.col("mt") - 1)).alias("mc"),
            F.pmod(place, "qt").cast("int").alias("qc"),
            F.lit(True).alias("query"),
            "node", "n", "unit", "home",
            F.lit(None).cast("array<int>").alias("probes"),
            F.lit(None).cast("binary").alias("codes"),
            F.lit(None).cast("double").alias("error"),
        )
    )
    held = (
        coded.withColumn("list", F.col("home"))
        .join(sizes, "list")
        .select(
            "list",
            F.pmod(place, "mt").cast("int").alias("mc"),
            F.explode(F.sequence(F.lit(0), F.col("qt") - 1)).alias("qc"),
            F.lit(False).alias("query"),
            "node", "n", "unit", "home", "probes", "codes", "error",
        )
    )
    return (
        asks.unionByName(held)
        .groupBy("list", "mc", "qc")
        .applyInArrow(_tile_task(shared, threshold), "node binary, root binary, links long")
    )


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = THRESHOLD,
    probes: int = PROBES,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Links are pairs with cosine >= ``threshold``; each list is searched exactly, so a link can
    only be missed if neither vector's list is among the other's nearest ``probes``. Equal
    vectors are one node whose copies all link with each other. Lists, queries included, are cut
    into tiles of at most about 2048 rows a side, so a hot list is many tasks; tiles return
    counts and tree edges, never pairs.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing;
    vectors of different length link with each other never (lengths are searched one after the
    other). Ids may be repeated; a null id never is a component's id unless all are null. Other
    columns are not read. An empty table gives no rows.
    """
    spark = ship_package(vectors.sparkSession)
    text = F.concat_ws(",", F.col("vector").cast("array<string>"))
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("vector")
    ).withColumn("node", F.when(usable("vector"), F.unhex(F.md5(text))))
    nodes = materialize(
        rows.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.min("vec_id").alias("low"),
            F.count("*").alias("n"),
            F.first("vector").alias("vector"),
        ),
        "vectors",
    )
    lengths = nodes.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).collect()
    found = None
    for r in sorted(lengths):
        part = _of_length(nodes.filter(F.size("vector") == r["d"]), r["n"], threshold, probes)
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], "node binary, root binary, links long")
    found = materialize(found, "vector-links")
    parts = materialize(
        connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))),
        "components",
    )
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    own = (
        nodes.select("node", "low", "n")
        .join(counts, "node", "left")
        .join(parts, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    least = own.groupBy("component").agg(F.min("low").alias("component_id"))
    result = own.join(least, "component").select(
        "node",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
        "component_id",
    )
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (
        rows.select("vec_id", "node")
        .join(result, "node", "left")
        .select(
            "vec_id",
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.col("vec_id").eqNullSafe(component).alias("kept"),
        )
    )
