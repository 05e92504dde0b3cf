"""Approximate nearest neighbours by a forest of random-projection trees.

The forest is fitted on a bounded sample and indexes every row. A query walks all trees
with one shared priority queue: the branch it misses by least, over all trees, is opened
next, until it has opened its share of the leaves. The rows of opened leaves are scored
exactly in double precision. How many leaves that takes depends on the data; the share is
tuned on the sample, against brute force there, so easy data are searched in few leaves
and data without structure in many.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.llm.bitmaps import groups
from tallyhawk.llm.common import cut_lineage, ship_package, spread, uniform

TREES = 8
#: Leaves of a tree at most.
MAX_DEPTH = 8
#: Sampled vectors to a leaf at least.
LEAF_SAMPLE = 24
#: Vectors that the forest is fitted on, at most about.
SAMPLE = 16_384
TARGET_RECALL = 0.97
_SHARES = (0.01, 0.02, 0.04, 0.06, 0.08, 0.1, 0.13, 0.17, 0.22, 0.3, 0.4, 0.6, 1.0)
#: Indexed rows of a leaf that are scored together.
CHUNK = 8192


class Forest(NamedTuple):
    """Hyperplanes by tree and node, the children of node i being 2 i + 1 and 2 i + 2."""

    planes: np.ndarray
    cuts: np.ndarray
    visits: int

    @property
    def inner(self) -> int:
        return self.cuts.shape[1]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row of ``x`` in every tree."""
        out = np.empty((len(x), len(self.planes)), dtype=np.int32)
        depth = (self.inner + 1).bit_length() - 1
        for t in range(len(self.planes)):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                side = np.einsum("ij,ij->i", x, self.planes[t][node]) > self.cuts[t][node]
                node = 2 * node + 1 + side
            out[:, t] = node - self.inner
        return out

    def search(self, x: np.ndarray, visits: int | None = None) -> list[tuple[int, int]]:
        """(tree, leaf) of the leaves that ``x`` opens, nearest margins first."""
        margin = np.einsum("tij,j->ti", self.planes, x) - self.cuts
        cost = (margin * margin).tolist()
        right = (margin > 0).tolist()
        visits = self.visits if visits is None else visits
        heap = [(0.0, t, 0) for t in range(len(self.planes))]
        out: list[tuple[int, int]] = []
        while heap and len(out) < visits:
            missed, t, node = heapq.heappop(heap)
            while node < self.inner:
                near, far = (2 * node + 2, 2 * node + 1) if right[t][node] else (2 * node + 1, 2 * node + 2)
                heapq.heappush(heap, (missed + cost[t][node], t, far))
                node = near
            out.append((t, node - self.inner))
        return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square is out of range."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def grow(sample: np.ndarray, trees: int = TREES, k: int = 5, target: float = TARGET_RECALL) -> Forest:
    """A forest over the unit rows of ``sample``, with the number of leaves to open."""
    rng = np.random.default_rng(5)
    n, dims = sample.shape
    depth = min(MAX_DEPTH, max(0, int(np.log2(max(1, n / LEAF_SAMPLE)))))
    planes = np.zeros((trees, 2**depth - 1, dims))
    cuts = np.zeros((trees, 2**depth - 1))
    for t in range(trees):
        rows = {0: np.arange(n)}
        for node in range(2**depth - 1):
            own = rows.pop(node)
            plane = rng.standard_normal(dims)
            if len(own) > 1:
                a, b = rng.choice(len(own), 2, replace=False)
                apart = sample[own[a]] - sample[own[b]]
                plane = apart if np.abs(apart).max() > 1e-12 else plane
            plane /= np.sqrt(plane @ plane)
            side = sample[own] @ plane
            cut = float(np.median(side)) if len(own) else 0.0
            planes[t, node], cuts[t, node] = plane, cut
            rows[2 * node + 1], rows[2 * node + 2] = own[side <= cut], own[side > cut]
    forest = Forest(planes, cuts, trees * 2**depth)
    tried = rng.choice(n, min(n, 200), replace=False)
    scores = sample[tried] @ sample.T
    scores[np.arange(len(tried)), tried] = -np.inf
    truth = np.argsort(-scores, axis=1)[:, : min(k, n - 1)]
    leaf = forest.leaves(sample)
    for share in _SHARES:
        visits = max(trees, round(share * trees * 2**depth))
        found = 0
        for q, row in zip(tried, truth, strict=True):
            opened = np.zeros((trees, 2**depth), dtype=bool)
            for t, j in forest.search(sample[q], visits):
                opened[t, j] = True
            found += opened[np.arange(trees), leaf[row]].any(axis=1).sum()
        if found >= target * truth.size:
            break
    return forest._replace(visits=visits)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, trees: int = TREES, sample: int = SAMPLE,
    target: float = TARGET_RECALL,
) -> DataFrame:
    """The ``k`` nearest found of each query: query_id, rank, vec_id and score.

    Both tables hold vec_id and embedding. Candidates of a query are the rows of
    ``vectors`` with another vec_id; nearest is the largest cosine, ties to the smaller
    vec_id. Vectors that are null, of no component other than zero, that hold a null or a
    number that is not finite, or that are not of the most frequent length take no part;
    nor do rows without vec_id. Repeated rows count once. Rows of equal vectors are
    indexed once, with their ``k + 1`` smallest ids; no further one can be among the
    nearest. Fewer candidates than ``k`` give fewer rows, an empty table none.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    kind = "<f4" if "float" in vectors.schema["embedding"].dataType.simpleString() else "<f8"

    def sound(df: DataFrame) -> DataFrame:
        x = F.col("embedding")
        finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        return df.select(F.col("vec_id").cast("long"), "embedding").where(
            F.col("vec_id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0)
        )

    rows = sound(vectors)
    sizes = rows.groupBy(F.size("embedding").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    dims = sizes.orderBy(F.desc("n"), "dims").first()
    if dims is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = dims["dims"]
    rows = rows.where(F.size("embedding") == dims).distinct()
    smallest = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    indexed = cut_lineage(
        rows.withColumn("place", smallest).where(F.col("place") <= k + 1)
        .groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    asked = cut_lineage(sound(queries).where(F.size("embedding") == dims).distinct())
    n = indexed.count()
    drawn = (
        indexed.where(uniform(F.col("ids")[0], F.lit(17)) < sample / n).orderBy(F.col("ids")[0])
        .select("embedding").collect()
    )
    points = np.array([r["embedding"] for r in drawn], dtype=kind).reshape(-1, dims)
    if not len(points):
        points = np.array([indexed.select("embedding").first()["embedding"]], dtype=kind)
    # At most 8 trees of 255 planes, whatever the number of rows.
    forest = spark.sparkContext.broadcast(grow(unit(points), trees, k, target))
    chunks = -(-n // (CHUNK * 2**MAX_DEPTH))

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy().astype(kind).reshape(-1, dims)

    def blobs(x: np.ndarray, rows: np.ndarray) -> pa.Array:
        return pa.array([x[i].tobytes() for i in rows], pa.binary())

    names = ["tree", "leaf", "chunk", "query", "key", "ids", "x"]
    schema = "tree int, leaf int, chunk int, query boolean, key long, ids array<long>, x binary"

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(0))
            if not len(x):
                continue
            leaf = forest.value.leaves(unit(x))
            own = np.repeat(np.arange(len(x)), leaf.shape[1])
            ids = batch.column(1)
            first = np.array([i[0] for i in ids.to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(np.arange(leaf.shape[1], dtype=np.int32), len(x))),
                    pa.array(leaf.ravel()), pa.array((first % chunks)[own].astype(np.int32)),
                    pa.array(np.zeros(len(own), bool)), pa.array(first[own]),
                    ids.take(pa.array(own)), blobs(x, own),
                ],
                names,
            )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(0))
            for i, q in enumerate(unit(x) if len(x) else ()):
                opened = np.array(forest.value.search(q), dtype=np.int32)
                opened = np.repeat(opened, chunks, axis=0)
                m = len(opened)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(opened[:, 0]), pa.array(opened[:, 1]),
                        pa.array(np.tile(np.arange(chunks, dtype=np.int32), m // chunks)),
                        pa.array(np.ones(m, bool)),
                        pa.array(np.full(m, batch.column(1)[i].as_py(), dtype=np.int64)),
                        pa.nulls(m, pa.list_(pa.int64())), blobs(x, np.full(m, i)),
                    ],
                    names,
                )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["tree", "leaf", "chunk"]):
            query = table.column("query").to_numpy()
            if query.all() or not query.any():
                continue
            x = np.frombuffer(b"".join(table.column("x").to_pylist()), kind).reshape(-1, dims)
            keys = table.column("key").to_numpy()
            a, b = unit(x[query]), unit(x[~query])
            at, ids = np.flatnonzero(~query), table.column("ids")
            for s in range(0, len(a), 1024):
                near = a[s : s + 1024] @ b.T
                keep = min(k + 1, len(b))
                top = np.argpartition(-near, keep - 1, axis=1)[:, :keep]
                # What ties with the last one may be it by its id.
                least = np.take_along_axis(near, top, axis=1).min(axis=1)
                q, v = np.nonzero(near >= least[:, None] - 1e-12)
                exact = (a[s + q] * b[v]).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[query][s + q]), pa.array(keys[~query][v]), pa.array(exact),
                     ids.take(pa.array(at[v])).combine_chunks()],
                    ["q", "v", "score", "ids"],
                )

    wanted = asked.groupBy("embedding").agg(F.min("vec_id").alias("key"))
    wanted = cut_lineage(wanted.repartition(spread(asked)))
    found = (
        indexed.mapInArrow(index, schema).unionByName(wanted.mapInArrow(ask, schema))
        .repartition(2 * spread(vectors), "tree", "leaf", "chunk").sortWithinPartitions("tree", "leaf", "chunk")
        .mapInArrow(score, "q long, v long, score double, ids array<long>")
        # The same vector from several trees has the same score.
        .groupBy("q", "v").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    )
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    listed = (
        found.select("q", "score", F.explode("ids").alias("vec_id"))
        .withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    )
    own = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    keyed = asked.join(wanted, "embedding").select(F.col("vec_id").alias("query_id"), F.col("key").alias("q"))
    return (
        keyed.join(listed, "q").where("query_id <> vec_id")
        .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def neighbours_digest(vectors: DataFrame) -> DataFrame:
    """The 5 nearest found of every vector whose id is divisible by 50."""
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)
