"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence.

The product is taken in two steps, so that it costs what the result needs.

* *Prefix columns.* Columns are ordered by how common they are. Two sets of sizes x and
  y that link share at least ``need(x, y)`` n-grams, so at least ``need - max(x - p,
  y - q)`` of those lie in both prefixes, p and q being the prefix lengths. Overlap
  counts accumulate over the columns that few documents have; pairs below that bound
  are discarded. Most documents have enough n-grams of their own to fill their prefix
  and never meet another.
* *Blocks.* What is left, and columns that many documents have in their prefix, joins
  documents to clusters. Each cluster is a product of blocks of rows, multiplied and
  counted over blocks of columns inside a task. Of each block product only a spanning
  forest of its links leaves the task, so a large group of copies makes no list of its
  pairs and loses no component.

How common a column is comes from counts over all documents, kept as two bitmaps of
fixed size. Two columns may share a bit; the order is then coarser and the result the
same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.llm.bitmaps import common_bitmaps, groups, marked
from tallyhawk.llm.common import cut_lineage, ship_package, spread
from tallyhawk.llm.graph import components
from tallyhawk.llm.shingles import shingle_sets

#: Columns of at most so many documents are multiplied pair by pair.
FEW = 32
#: Rows of a block, and columns multiplied at a time.
BLOCK = 512
COLUMNS = 4096
NO_ID = 1 << 62
#: Numbers of rows that their doc_id does not tell apart begin here.
OWN_ID = 1 << 61


def _profile(docs: DataFrame, size: int, num: int, den: int, maps) -> DataFrame:
    """Per row: doc_id, th (hash of the text), n, key of its set, and its shared prefix."""
    bits = docs.sparkSession.sparkContext.broadcast(maps)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, common = (np.frombuffer(m, dtype=np.uint8) for m in bits.value)
        for batch in batches:
            n, keys, prefixes = [], [], []
            for hashes in shingle_sets(batch.column(2), size):
                n.append(len(hashes))
                keys.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                level = marked(shared, hashes).astype(np.int8) + marked(common, hashes)
                p = len(hashes) - -(-num * len(hashes) // den) + 1 if len(hashes) else 0
                # Columns of one document fill the prefix first and meet nobody.
                p -= int((level == 0).sum())
                picked = hashes[:0]
                if p > 0:
                    light = hashes[level == 1]
                    picked = light[:p] if len(light) >= p else np.concatenate(
                        [light, hashes[level == 2][: p - len(light)]]
                    )
                prefixes.append(picked.view(np.int64))
            lengths = np.cumsum([0, *map(len, prefixes)])
            flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.int64)
            prefix = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int32()),
                 pa.array(keys, pa.binary()), prefix],
                ["doc_id", "th", "n", "key", "prefix"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text")
    return rows.mapInArrow(scan, "doc_id long, th long, n int, key binary, prefix array<long>")


def _pairs(postings: DataFrame, num: int, den: int, parts: int) -> DataFrame:
    """(a, b, x, y, c, big): shared prefix columns of pairs; a star where many share one."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush():
            if held:
                rows = np.concatenate(held)
                held.clear()
                found, counts = np.unique(rows, axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(found[:, k]) for k in range(4)), pa.array(counts),
                     pa.array(found[:, 4] == 1)],
                    ["a", "b", "x", "y", "c", "big"],
                )

        def pair(m: np.ndarray, i: np.ndarray, j: np.ndarray, big: int) -> np.ndarray:
            swap = m[i, 0] < m[j, 0]
            a, b = np.where(swap, j, i), np.where(swap, i, j)
            rows = np.column_stack([m[a, 0], m[b, 0], m[a, 1], m[b, 1], np.full(len(a), big)])
            rows = rows[rows[:, 0] != rows[:, 1]]
            if big:
                return rows
            x, y = rows[:, 2], rows[:, 3]
            return rows[np.minimum(x, y) * den >= np.maximum(x, y) * num]

        def group(m: np.ndarray) -> None:
            if 2 <= len(m) <= FEW:
                i, j = np.triu_indices(len(m), 1)
                held.append(pair(m, i, j, 0))
            elif len(m) > FEW:
                rest = np.arange(1, len(m))
                held.append(pair(m, np.zeros_like(rest), rest, 1))

        rest = None  # rows of a column that may go on in the next batch
        for batch in batches:
            t = batch.column(0).to_numpy()
            m = np.column_stack([batch.column(1).to_numpy(), batch.column(2).to_numpy()])
            if rest is not None:
                t, m = np.concatenate([rest[0], t]), np.concatenate([rest[1], m])
            cuts = np.concatenate([[0], np.flatnonzero(t[1:] != t[:-1]) + 1, [len(t)]])
            for s, e in zip(cuts[:-2], cuts[1:-1], strict=True):
                group(m[s:e])
            s = cuts[-2] if len(cuts) > 1 else 0
            tail_t, tail_m = t[s:], m[s:]
            if len(tail_m) > 4 * FEW:
                # A column that goes on: keep its leader and enough rows to stay big.
                group(tail_m)
                tail_t, tail_m = tail_t[: FEW + 1], tail_m[: FEW + 1]
            rest = (tail_t, tail_m)
            if sum(map(len, held)) > 500_000:
                yield from flush()
        if rest is not None and len(rest[0]):
            group(rest[1])
        yield from flush()

    found = (
        postings.repartition(parts, "t").sortWithinPartitions("t")
        .mapInArrow(scan, "a long, b long, x long, y long, c long, big boolean")
        .groupBy("a", "b").agg(
            F.first("x").alias("x"), F.first("y").alias("y"), F.sum("c").alias("c"),
            F.max("big").alias("big"),
        )
    )
    x, y = F.col("x"), F.col("y")
    rest = lambda n: F.ceil(n * num / F.lit(float(den)) - 1e-9) - 1  # noqa: E731  outside a prefix
    need = F.ceil((x + y) * num / F.lit(float(num + den)) - 1e-9)
    return found.where(F.col("big") | (F.col("c") >= need - F.greatest(rest(x), rest(y))))


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of two blocks of sets, summed over blocks of columns."""
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    columns = np.intersect1d(flat_a, flat_b)
    rows_a = np.repeat(np.arange(len(a)), [len(s) for s in a])
    rows_b = np.repeat(np.arange(len(b)), [len(s) for s in b])

    def place(flat, rows):
        at = np.searchsorted(columns, flat)
        at[at == len(columns)] = 0
        hit = columns[at] == flat if len(columns) else np.zeros(len(flat), bool)
        at, rows = at[hit], rows[hit]
        order = np.argsort(at, kind="stable")
        return at[order], rows[order]

    at_a, row_a = place(flat_a, rows_a)
    at_b, row_b = place(flat_b, rows_b)
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    for c in range(0, len(columns), COLUMNS):
        width = min(COLUMNS, len(columns) - c)
        one, two = np.zeros((len(a), width), np.float32), np.zeros((len(b), width), np.float32)
        s, e = np.searchsorted(at_a, [c, c + width])
        one[row_a[s:e], at_a[s:e] - c] = 1
        s, e = np.searchsorted(at_b, [c, c + width])
        two[row_b[s:e], at_b[s:e] - c] = 1
        out += one @ two.T
    return out.astype(np.int64)


def _forest(i: np.ndarray, j: np.ndarray) -> list[int]:
    """Positions of links that join something new."""
    root: dict[int, int] = {}

    def find(v: int) -> int:
        while root.setdefault(v, v) != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    kept = []
    for k, (u, v) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        u, v = find(u), find(v)
        if u != v:
            root[u] = v
            kept.append(k)
    return kept


def _multiply(members: DataFrame, num: int, den: int, parts: int) -> DataFrame:
    """Links (a, b) of ``members(cluster, i, j, block, node, hashes)``, a forest per block."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["cluster", "i", "j"]):
            nodes = table.column("node").to_numpy()
            block = table.column("block").to_numpy()
            _, once = np.unique(nodes, return_index=True)
            sets = [np.frombuffer(h, np.uint64) for h in table.column("hashes").to_pylist()]
            i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
            left = [k for k in once if block[k] == i]
            right = left if i == j else [k for k in once if block[k] == j]
            if not left or not right:
                continue
            x = np.array([len(sets[k]) for k in left])[:, None]
            y = np.array([len(sets[k]) for k in right])[None, :]
            if x.max() * den < y.min() * num or y.max() * den < x.min() * num:
                continue
            both = _overlaps([sets[k] for k in left], [sets[k] for k in right])
            u, v = np.nonzero(both * den >= num * (x + y - both))
            u, v = nodes[np.array(left)][u], nodes[np.array(right)][v]
            u, v = u[u != v], v[u != v]
            kept = _forest(u, v)
            yield pa.RecordBatch.from_arrays([pa.array(u[kept]), pa.array(v[kept])], ["a", "b"])

    return (
        members.repartition(parts, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
        .mapInArrow(scan, "a long, b long")
    )


def jaccard_components(
    docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, block: int = BLOCK
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id.

    Rows link when den * |common| >= num * |either| for their sets of ``size``-word
    shingles. component_id is the smallest doc_id reachable by links, its own included.
    Null and empty texts, and texts without words, have no shingles and link with
    nothing. Rows of equal sets link, repeated rows included. Rows that share a doc_id
    are one document. Rows without doc_id link others; where no row of a component has
    one, component_id is null. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select("doc_id", "text")
    maps = common_bitmaps(
        docs.select("text"), lambda batch: shingle_sets(batch.column(0), size), (1, FEW)
    )
    rows = cut_lineage(_profile(docs, size, num, den, maps))
    classes = cut_lineage(
        rows.where("n > 0").groupBy("key").agg(
            F.min(F.struct("doc_id", "th")).alias("from"), F.min("doc_id").alias("first"),
            F.first("n").alias("n"), F.first("prefix").alias("prefix"),
        ).withColumn(
            "node",
            F.coalesce("first", F.xxhash64("key").bitwiseAND(F.lit(NO_ID - 1)).bitwiseOR(F.lit(NO_ID))),
        )
    )
    postings = classes.select(F.explode("prefix").alias("t"), "node", F.col("n").cast("long"))
    parts = spread(docs)
    pairs = cut_lineage(_pairs(postings, num, den, parts))
    clusters = cut_lineage(components(pairs.select("a", "b")).withColumnRenamed("root", "cluster"))
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    wanted = (
        classes.select("node", "from").join(clusters, "node").join(sizes, "cluster")
    )
    # One row of each class; a text that several rows of one doc_id repeat comes several times.
    row = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"))
    texts = docs.select(row.alias("from"), "text").join(wanted.select("from"), "from", "left_semi")

    def hash_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [h.tobytes() for h in shingle_sets(batch.column(1), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(blobs, pa.binary())], ["from", "hashes"]
            )

    sets = texts.mapInArrow(hash_again, "from struct<doc_id:long,th:long>, hashes binary")
    own = F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int")
    members = (
        wanted.join(sets, "from").withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                "block", "node", "hashes")
    )
    links = _multiply(members, num, den, parts)
    # Rows of one doc_id and different sets are one document.
    same = rows.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(
        F.min("key").alias("k1"), F.max("key").alias("k2")
    ).where("k1 <> k2").select("doc_id")
    again = rows.where("n > 0").join(same, "doc_id", "left_semi").select("doc_id", "key").join(
        classes.select("key", "node"), "key"
    ).select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    roots = components(links.unionByName(again))
    named = classes.select("key", "node").join(roots, "node", "left").select(
        F.col("key").alias("k"), F.coalesce("root", "node").alias("root")
    )
    component = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("root") < NO_ID, F.col("root"))
    return rows.select("doc_id", "n", "key").join(named, F.col("key") == F.col("k"), "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id")
    )


def keep_one(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component of texts, the one of the smallest doc_id.

    All columns stay as they are. Rows are compared by their texts alone: rows of one doc_id
    and unrelated texts all stay. Of a component the row of least (doc_id, missing last,
    hash of the text) stays, of equal rows of these the one of the least hash of its other
    columns, so reruns agree. Rows without shingles stay, equal ones once. doc_ids are below
    2 ** 61. An empty table gives an empty table.
    """
    columns = docs.columns
    th = F.xxhash64("text")
    keys = docs.select("doc_id", th.alias("th"))
    known = keys.where("doc_id is not null")
    twice = known.groupBy("doc_id").agg(F.min("th").alias("low"), F.max("th").alias("high")).where("low <> high")
    # Rows that their doc_id does not tell apart: numbers of their own, behind all doc_ids.
    odd = cut_lineage(
        known.join(twice.select("doc_id"), "doc_id", "left_semi").unionByName(keys.where("doc_id is null")).distinct()
        .withColumn("own", F.monotonically_increasing_id() + F.lit(OWN_ID))
    )
    if odd.isEmpty():
        named = docs.withColumn("own", F.col("doc_id").cast("long"))
    else:
        match = F.col("doc_id").eqNullSafe(F.col("odd_id")) & (th == F.col("th"))
        named = docs.join(odd.withColumnRenamed("doc_id", "odd_id"), match, "left").select(
            *columns, F.coalesce("own", F.col("doc_id").cast("long")).alias("own")
        )
    found = jaccard_components(named.select(F.col("own").alias("doc_id"), "text"), size, num, den).distinct()
    of = found.select(F.col("doc_id").alias("own"), "component_id").join(odd, "own", "left")
    first = F.struct(
        (F.col("own") >= OWN_ID) & F.col("doc_id").isNull(), F.when(F.col("own") < OWN_ID, F.col("own")).otherwise(F.col("doc_id")), "th", "own"
    )
    stays = of.groupBy("component_id").agg(F.min_by("own", first).alias("own")).select("own")
    others = [c for c in columns if c != "text"]
    order = Window.partitionBy("own").orderBy(F.xxhash64(*others))
    return (
        named.join(stays, "own", "left_semi").withColumn("_place", F.row_number().over(order))
        .where("_place = 1").select(*columns)
    )


def jaccard_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id over 3-word shingles at 0.9 or more."""
    return jaccard_components(docs, size=3, num=90, den=100)
