"""Lines that many documents share, found with levelled sorted runs of line hashes.

Documents come in batches by descending doc_id. What is known of the lines so far is a set
of runs: tables of (key, docs, top), bucketed by key and sorted inside a bucket, where docs
counts the documents that hold the line and top is the largest doc_id among them. A new
batch is counted by key, merge-anti-joined with the runs for the keys that are settled
there (found in enough documents), and what is left becomes a run of level 0. As soon as a
level has two runs they are compacted into one run of the next level by a merge join. As
runs and batches share their buckets, neither step shuffles a run. Since batches descend,
a settled key has its largest doc_id, so nothing that the anti-join leaves out can change
the result.

At the end all runs are compacted into one. Each line of each document then looks its key
up. Keys of very many documents are held by every task, the others are joined by key, so
no key's lines go to one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm.common import new_folder

#: Batches that a table is dealt into by doc_id.
BATCHES = 4
#: A key counts as busy from so many lines of a batch on; more where more than
#: BUSY_KEYS keys could have as many.
BUSY_LINES = 5_000
BUSY_KEYS = 10_000
_STRIP = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z as a-z."""
    return F.translate(F.btrim(line, F.lit(_STRIP)), _UPPER, _UPPER.lower())


def key_hash(key: Column) -> Column:
    """Half a SHA-256, so that no two lines of any corpus share it."""
    return F.substring(F.unhex(F.sha2(key, 256)), 1, 16)


class LineRuns:
    """Levelled sorted runs of line hashes in a folder of their own.

    Runs are bucketed tables of the session's catalog; ``drop`` takes them out of it again.
    """

    def __init__(self, spark: SparkSession, min_docs: int, keep_from: int) -> None:
        self.spark, self.min_docs, self.keep_from = spark, min_docs, keep_from
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = new_folder(spark, "runs")
        self.levels: list[str | None] = []
        self.names: list[str] = []

    def _write(self, run: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            run.write.bucketBy(self.buckets, "key").sortBy("key")
            .option("path", f"{self.folder}/{name}").saveAsTable(name)
        )
        self.names.append(name)
        return name

    def merged(self, one: str, two: str) -> DataFrame:
        """Two runs as one; both are bucketed by key, so the join shuffles neither."""
        other = self.spark.table(two).toDF("key2", "docs2", "top2")
        return self.spark.table(one).join(other, F.col("key") == F.col("key2"), "full").select(
            F.coalesce("key", "key2").alias("key"),
            (F.coalesce("docs", F.lit(0)) + F.coalesce("docs2", F.lit(0))).alias("docs"),
            F.greatest("top", "top2").alias("top"),
        )

    def runs(self) -> list[str]:
        return [run for run in self.levels if run is not None]

    def add(self, batch: DataFrame) -> None:
        """Add ``batch(doc_id, key)``, whose doc_ids are below those of all earlier batches.

        Keys of ``keep_from`` documents or more are counted on when settled, so that busy
        keys are known as such.
        """
        found = batch.dropDuplicates(["doc_id", "key"]).groupBy("key").agg(
            F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("top")
        )
        for name in self.runs():
            settled = self.spark.table(name).where(F.col("docs") >= self.min_docs).select(F.col("key").alias("known"))
            found = found.join(
                settled, (F.col("key") == F.col("known")) & (F.col("docs") < self.keep_from), "left_anti"
            )
        run, level = self._write(found), 0
        while level < len(self.levels) and self.levels[level] is not None:
            run = self._write(self.merged(self.levels[level], run))
            self.levels[level] = None
            level += 1
        self.levels[level : level + 1] = [run]

    def compact(self) -> DataFrame:
        """All runs as one: key, docs and top, one row a key."""
        while len(runs := self.runs()) > 1:  # the smallest first
            self.levels = [self._write(self.merged(runs[0], runs[1])), *runs[2:]]
        return self.spark.table(runs[0])

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"drop table if exists {name}")
        self.names = []


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.transform(F.array(value), body)[0]


def _row_key(docs: DataFrame) -> list[Column]:
    # Joins on equal values: a missing doc_id is 0 and marked.
    return [
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), F.xxhash64("text").alias("th"),
    ]


def drop_common_lines(
    docs: DataFrame, min_docs: int = 3, min_chars: int = 20, batches: int = BATCHES, busy_lines: int = BUSY_LINES
) -> DataFrame:
    """``docs(doc_id, text)`` without the lines that at least ``min_docs`` documents share.

    Lines end at line feeds; two lines are the same if their keys are (``line_key``). A key
    of at least ``min_chars`` code points that ``min_docs`` documents hold keeps its lines in
    the largest doc_id holding it alone. Returns doc_id, text (what is left, joined by line
    feeds), n_lines and n_dropped, one row for each row.

    A null or empty text is one empty line. Rows of one doc_id are one document: their lines
    stay or go together. All rows without doc_id are one document below all others. Repeated
    rows give equal rows, an empty table an empty one; other columns play no part. Texts of
    any length are read whole.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [k / batches for k in range(1, batches)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] if shares else []
    batch = F.lit(0)
    for bound in bounds or []:
        batch = batch + F.when(F.col("doc_id") > bound, 1).otherwise(0)
    listed = docs.select("doc_id", *_row_key(docs), batch.alias("batch"), F.posexplode(F.split("text", "\n")).alias("line", "words"))
    keyed = listed.select("doc_id", "id", "no_id", "th", "batch", "line", line_key(F.col("words")).alias("words"))
    lines = keyed.where(F.length("words") >= min_chars).select(
        "doc_id", "id", "no_id", "th", "line", key_hash(F.col("words")).alias("key"), "batch"
    )
    folder = new_folder(spark, "lines")
    lines.write.partitionBy("batch").parquet(folder)
    lines = spark.read.schema(lines.schema).parquet(folder)
    # No more than BUSY_KEYS keys can have as many lines, whatever the table's size.
    busy_from = max(busy_lines, -(-lines.count() // BUSY_KEYS))
    runs = LineRuns(spark, min_docs, busy_from)
    for number in reversed(range(batches)):
        runs.add(lines.where(F.col("batch") == number).select("doc_id", "key"))
    common = runs.compact().where(F.col("docs") >= min_docs)
    busy = common.where(F.col("docs") >= busy_from).select(F.col("key").alias("busy"), F.col("top").alias("busy_top"))
    marked = lines.drop("batch").join(F.broadcast(busy), F.col("key") == F.col("busy"), "left")
    rest = common.where(F.col("docs") < busy_from).select(F.col("key").alias("known"), "top")
    place = [F.col(c) for c in ("id", "no_id", "th", "line")]
    goes = lambda top: ~F.col("doc_id").eqNullSafe(F.col(top))
    gone = (
        marked.where(F.col("busy").isNotNull() & goes("busy_top")).select(*place)
        .unionByName(
            marked.where(F.col("busy").isNull()).join(rest, F.col("key") == F.col("known")).where(goes("top")).select(*place)
        )
        .groupBy("id", "no_id", "th").agg(F.collect_set("line").alias("gone"))
    )
    rows = docs.select("doc_id", "text", *_row_key(docs)).join(gone, ["id", "no_id", "th"], "left").select(
        "doc_id", F.split("text", "\n").alias("all"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone")
    )
    kept = _let(
        F.struct("all", "gone"),
        lambda x: F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(x["all"]) - 1), x["gone"]), lambda i: F.get(x["all"], i)
        ),
    )
    result = rows.select(
        "doc_id", F.array_join(kept, "\n").alias("text"), F.size("all").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
    )
    runs.drop()  # the catalog's entries; the files stay for the result
    return result


def lines_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the hash of what is left of every text."""
    return drop_common_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


LINES_SQL = r"""
with lines as (
    select doc_id, unnest(l) as line, generate_subscripts(l, 1) as i
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents) d
),
keys as (
    select doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
    from lines
),
common as (
    select k, max(doc_id) as top from keys where length(k) >= 20 group by k having count(distinct doc_id) >= 3
),
marked as (
    select keys.*, common.k is not null and keys.doc_id <> common.top as gone from keys left join common on keys.k = common.k
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""
