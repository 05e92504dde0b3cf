"""Document fingerprints by consistent weighted sampling, in DataFrame expressions only.

The terms of a text are its pairs of neighbouring words, weighted by how often they come.
For each of K samples, every term draws r and c from Gamma(2, 1) and b from U(0, 1), all
from its hash; with weight S, t = floor(ln S / r + b), y = exp(r (t - b)) and
a = c / (y exp(r)). The sample is the (term, t) of the least a. Two texts agree in a sample
with a probability equal to their generalised Jaccard similarity, the sum of the smaller
weights over the sum of the larger ones.

A term needs no row of a shuffle: texts are counted inside their row, and the samples of a
text are K running minima, so what moves is K numbers a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut_lineage

SAMPLES = 16
#: Neighbouring documents that are put in order together, about.
RUN_ROWS = 2_000
#: doc_ids are counted in equal cells of each of so many bands, which hold about as many
#: rows each.
BANDS = 256
CELLS = 256
_BITS = 25


def term_counts(text: Column) -> Column:
    """The terms of a text as an array of (term hash, weight); empty for a null text.

    A term is a word with the one after it, the last word a term of its own.
    """
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def pairs(words: Column) -> Column:
        return F.sort_array(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1))))

    def ends(hashes: Column) -> Column:
        last = F.transform(
            hashes, lambda h, i: F.when(F.get(hashes, i + 1).eqNullSafe(h), F.lit(None)).otherwise(i)
        )
        return F.struct(hashes.alias("h"), F.filter(last, lambda i: i.isNotNull()).alias("e"))

    def weigh(x: Column) -> Column:
        return F.transform(
            x["e"],
            lambda e, j: F.struct(
                F.get(x["h"], e).alias("term"),
                (e - F.coalesce(F.get(x["e"], j - 1), F.lit(-1))).alias("weight"),
            ),
        )

    def let(value: Column, body) -> Column:
        return F.transform(F.array(value), body)[0]

    return let(words, lambda w: let(pairs(w), lambda h: let(ends(h), weigh)))


def _unit(hashed: Column, shift: int, bits: int = _BITS) -> Column:
    part = F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit((1 << bits) - 1))
    return (part.cast("double") + 0.5) / float(1 << bits)


def _sample(one: Column, two: Column, ln_weight: Column) -> Column:
    """A long whose minimum over the terms is the sample: ln a, and a tag of (term, t).

    The tag is made of bits that are drawn already. Null where there is no weight.
    """
    r = -F.log(_unit(one, 0) * _unit(one, _BITS))
    c = -F.log(_unit(two, 0) * _unit(two, _BITS))
    spare = 64 - 2 * _BITS
    b = (_unit(one, 2 * _BITS, spare) + F.floor(_unit(two, 2 * _BITS, spare) * (1 << spare))) / float(1 << spare)
    t = F.floor(ln_weight / r + b)
    ln_a = F.log(c) - r * (t - b) - r
    place = F.shiftleft(F.floor((ln_a + 256.0) * float(1 << 28)).cast("long"), 24)
    return place + one.bitwiseXOR(t).bitwiseAND(F.lit((1 << 24) - 1))


def fingerprints(texts: DataFrame, keys: list[str], text: Column, samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``samples`` (array of longs) of each row of ``texts``.

    ``keys`` must name one row; if ``texts`` is partitioned by some of them, nothing is
    shuffled. A text without words, or a null one, has samples of 0. Equal texts have equal
    samples. The text is read whole.
    """
    terms = texts.select(*keys, F.explode_outer(term_counts(text)).alias("t")).select(
        *keys, F.col("t.term").alias("term"), F.log(F.col("t.weight").cast("double")).alias("ln_weight")
    )
    drawn = terms.withColumns(
        {f"a{k}": F.xxhash64("term", F.lit(2 * k)) for k in range(samples)}
        | {f"b{k}": F.xxhash64("term", F.lit(2 * k + 1)) for k in range(samples)}
    )
    least = drawn.groupBy(*keys).agg(*[
        F.min(_sample(F.col(f"a{k}"), F.col(f"b{k}"), F.col("ln_weight"))).alias(f"m{k}") for k in range(samples)
    ])
    return least.select(
        *keys, F.array(*[F.coalesce(f"m{k}", F.lit(0)).cast("long") for k in range(samples)]).alias("samples")
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples."""
    same = F.filter(F.arrays_zip(a.alias("x"), b.alias("y")), lambda p: p["x"] == p["y"])
    return F.size(same).cast("double") / F.size(a)


def printed(samples: Column) -> Column:
    """The fingerprint as text: eight hexadecimal digits a sample."""
    word = lambda x: F.lpad(F.hex(F.xxhash64(x).bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")
    return F.lower(F.array_join(F.transform(samples, word), ""))


def in_runs(docs: DataFrame, run_rows: int = RUN_ROWS) -> tuple[DataFrame, DataFrame]:
    """``docs(doc_id, text)`` with the run each row belongs to, and the runs' successors.

    Runs are ranges of doc_id of about ``run_rows`` rows. They come from counts in CELLS
    equal cells of each band between two quantiles of doc_id, null ids before all others; so
    ids far from all others widen the cells of one band only. The second table has (run,
    next_run), the last one followed by the first.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    shares = [k / BANDS for k in range(1, BANDS)]
    low, high, inner = ids.agg(F.min("doc_id"), F.max("doc_id"), F.percentile_approx("doc_id", shares)).first()
    cell = F.lit(-1).cast("long")
    if low is not None:
        edges = sorted({low, *inner, high + 1})
        band = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in edges[:-1]]), lambda e: e <= F.col("doc_id")))
        start, width = (
            F.element_at(F.array(*[F.lit(float(x)) for x in xs]), band)
            for xs in (edges[:-1], [max(1, -(-(b - a) // CELLS)) for a, b in zip(edges, edges[1:], strict=False)])
        )
        place = F.floor((F.col("doc_id").cast("double") - start) / width)
        cell = F.when(F.col("doc_id").isNull(), -1).otherwise(band * (CELLS + 2) + place).cast("long")
    counts = ids.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cut_lineage(
        counts.select("cell", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / run_rows).alias("run"))
    )
    # BANDS * (CELLS + 2) rows of 16 bytes at most.
    dealt = docs.select(F.col("doc_id").cast("long"), "text").withColumn("cell", cell).join(
        F.broadcast(cells), "cell"
    ).drop("cell")
    runs = cells.select("run").distinct()
    following = F.lead("run").over(Window.orderBy("run"))
    first = F.min("run").over(Window.partitionBy())
    return dealt, runs.select("run", F.coalesce(following, first).alias("next_run"))


def with_next(docs: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """(run, place, doc_id, text, next_text, next_run, next_place) by ascending doc_id.

    Each row is followed by the next one in the order of doc_id (null first) and hash of
    the text, the last one by the first. The order takes one shuffle of the texts: the
    first row of the next run stands at the end of each run as a guest.
    """
    dealt, runs = in_runs(docs, run_rows)
    dealt = dealt.withColumn("th", F.xxhash64("text"))
    firsts = dealt.groupBy("run").agg(
        F.min_by(F.struct("text"), F.struct(F.col("doc_id").isNotNull(), "doc_id", "th")).alias("first")
    )
    guests = runs.join(firsts.withColumnRenamed("run", "next_run"), "next_run").select(
        "run", F.lit(True).alias("guest"), F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("long").alias("th"), F.col("first.text").alias("text"), "next_run",
    )
    rows = dealt.select(
        "run", F.lit(False).alias("guest"), "doc_id", "th", "text", F.lit(None).cast("long").alias("next_run")
    )
    order = Window.partitionBy("run").orderBy("guest", F.col("doc_id").asc_nulls_first(), "th")
    placed = rows.unionByName(guests).withColumns({
        "place": F.row_number().over(order),
        "next_text": F.lead("text").over(order),
        "next_guest": F.lead("guest").over(order),
        "then": F.lead("next_run").over(order),
    })
    return placed.where("not guest").select(
        "run", "place", "doc_id", "text", "next_text",
        F.when(F.col("next_guest"), F.col("then")).otherwise(F.col("run")).alias("next_run"),
        F.when(F.col("next_guest"), F.lit(1)).otherwise(F.col("place") + 1).alias("next_place"),
    )


def fingerprint_neighbours(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next. The edited text is the text with its last half, rounded down, replaced by as
    many code points from the beginning of the next document, or all it has. A null text is
    empty. Rows of one doc_id follow each other by hash of the text; repeated rows each
    give a row. An only row is its own next. An empty table gives an empty table.
    """
    placed = with_next(docs)
    text = F.coalesce("text", F.lit(""))
    size = F.length(text)
    half = F.floor(size / 2).cast("int")
    edited = F.concat(
        F.substring(text, F.lit(1), size - half),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half),
    )
    pairs = placed.select(
        "run", "place", "doc_id", "next_run", "next_place", size.cast("long").alias("n_chars"),
        F.explode(F.array(
            F.struct(F.lit(False).alias("edited"), text.alias("text"), F.lit(None).cast("binary").alias("sha")),
            F.struct(F.lit(True).alias("edited"), edited.alias("text"), F.unhex(F.sha2(edited, 256)).alias("sha")),
        )).alias("v"),
    ).select("*", "v.*").drop("v")
    keys = ["run", "place", "edited", "doc_id", "next_run", "next_place", "n_chars", "sha"]
    printed_rows = cut_lineage(fingerprints(pairs, keys, F.col("text"), samples))
    own = printed_rows.where("not edited").drop("sha", "edited")
    other = printed_rows.where("edited").select(
        "run", "place", F.lower(F.hex("sha")).alias("edited_sha256"), F.col("samples").alias("edited_samples")
    )
    following = own.select(
        F.col("run").alias("next_run"), F.col("place").alias("next_place"), F.col("samples").alias("next_samples")
    )
    return own.join(other, ["run", "place"]).join(following, ["next_run", "next_place"]).select(
        "doc_id", "n_chars", "edited_sha256", printed(F.col("samples")).alias("fingerprint"),
        printed(F.col("edited_samples")).alias("edited_fingerprint"),
        likeness(F.col("samples"), F.col("edited_samples")).alias("near_edited"),
        likeness(F.col("samples"), F.col("next_samples")).alias("near_next"),
    )
