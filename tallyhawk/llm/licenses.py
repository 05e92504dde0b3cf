"""Licence notices in documents: a trained paragraph classifier, confirmed by templates.

A paragraph is a line, or lines that a notice is wrapped over: those around a line with a cue
word, up to the end of a sentence or to a blank line. Its word n-grams, one to three words with a cue word among them, are
the sparse inputs of a multinomial logistic regression over licence families and a class
for other uses of the words. Scores are scaled on held-out variants of the notices, and a
prediction under the calibrated bound, or one that no notice of its family resembles, is
unknown. A paragraph without a cue word has no input, so it is not scored.

The model is fitted by Spark ML on rows made from the notices alone, and applied as a join
with its table of weights; every distinct paragraph is scored once, however often it comes.
"""

from __future__ import annotations

import json
import re
from typing import NamedTuple

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut_lineage
from tallyhawk.llm.license_texts import CUES, OTHER, TEMPLATES

NONE = "none"
UNKNOWN = "unknown"
#: Share of a notice's words that a paragraph must have to confirm it.
CONFIRM = 0.8
#: Share of held-out notices that the calibrated bound lets through.
COVER = 0.99
#: Words, as runs of letters and digits, looked at before and after a line with a cue word:
#: twice the longest notice.
AROUND = 2 * max(len(re.findall("[A-Za-z0-9]+", n)) for texts in TEMPLATES.values() for n in texts)
_WORD = r"[a-z0-9][a-z0-9+\-]*(?:\.[a-z0-9]+)*"
_PREFIXES = ["", "copyright 2021 example authors ", "this project is ", "note: ", "© the authors. "]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _cues() -> Column:
    return F.array(*[F.lit(w) for w in CUES])


def ngrams(tokens: Column) -> Column:
    """Distinct n-grams of one to three words that hold a cue word."""

    def around(tokens: Column) -> Column:
        def grams(n: int) -> Column:
            return F.filter(
                F.transform(tokens, lambda t, i: F.slice(tokens, i + 1, n)),
                lambda g: (F.size(g) == n) & F.arrays_overlap(g, _cues()),
            )

        parts = [F.transform(grams(n), lambda g: F.array_join(g, " ")) for n in (1, 2, 3)]
        return F.array_distinct(F.concat(*parts))

    return F.transform(F.array(tokens), around)[0]


def variants(notice: str) -> list[str]:
    """The notice after other words, and with one word in six left out, six ways."""
    tokens = notice.split()
    out = [prefix + notice for prefix in _PREFIXES]
    if len(tokens) > 4:
        out += [" ".join(t for i, t in enumerate(tokens) if i % 6 != k) for k in range(6)]
    return out


class Model(NamedTuple):
    families: list[str]
    vocabulary: list[str]
    weights: np.ndarray  # vocabulary x families
    bias: np.ndarray
    scale: float
    bound: float


def fit_licenses(spark: SparkSession) -> Model:
    """Fit and calibrate the model on variants of the notices: two of three, the third held out."""
    families = [NONE, *TEMPLATES]
    rows = [(0, text, k % 5 == 4) for k, text in enumerate(OTHER)]
    for label, family in enumerate(TEMPLATES, start=1):
        for notice in TEMPLATES[family]:
            rows += [(label, text, k % 3 == 2) for k, text in enumerate(variants(notice))]
    table = spark.range(1).select(
        F.explode(F.array(*[
            F.struct(F.lit(float(a)).alias("label"), F.lit(b).alias("text"), F.lit(c).alias("held"))
            for a, b, c in rows
        ])).alias("r")
    ).select("r.*").withColumn("grams", ngrams(words(F.col("text"))))
    vectors = CountVectorizer(inputCol="grams", outputCol="features", binary=True).fit(
        table.where("not held")
    )
    data = vectors.transform(table).coalesce(1).persist()
    found = LogisticRegression(maxIter=60, regParam=1e-3, family="multinomial").fit(data.where("not held"))
    weights, bias = found.coefficientMatrix.toArray().T, np.array(found.interceptVector.toArray())
    held = data.where("held").select("label", "features").collect()
    data.unpersist()
    x = np.array([r["features"].toArray() for r in held])
    y = np.array([int(r["label"]) for r in held])
    logits = x @ weights + bias

    def chances(scale: float) -> np.ndarray:
        z = np.exp((logits - logits.max(axis=1, keepdims=True)) * scale)
        return z / z.sum(axis=1, keepdims=True)

    scale = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0),
                key=lambda s: -np.log(chances(s)[np.arange(len(y)), y] + 1e-12).mean())
    right = chances(scale)[np.arange(len(y)), y][y > 0]
    bound = float(min(max(np.quantile(right, 1 - COVER), 0.3), 0.9))
    return Model(families, vectors.vocabulary, weights, bias, scale, bound)


def classify(paragraphs: DataFrame, model: Model) -> DataFrame:
    """``paragraphs(text)`` with family, chance and likeness.

    family is a licence family, ``unknown`` or ``none``; chance is the calibrated
    probability of the likeliest class, ``none`` where the model knows no n-gram; likeness is the largest share of a notice's words,
    over the notices of that family, that the paragraph has.
    """
    spark = paragraphs.sparkSession
    # One row for each n-gram of the notices: the model's size does not grow with the data.
    listed = json.dumps([
        {"gram": gram, "w": [float(w) for w in row]}
        for gram, row in zip(model.vocabulary, model.weights, strict=True)
    ])
    weights = spark.range(1).select(
        F.explode(F.from_json(F.lit(listed), "array<struct<gram:string,w:array<double>>>")).alias("r")
    ).select("r.*")
    tokens = paragraphs.select("text", words(F.col("text")).alias("tokens"))
    grams = tokens.select("text", F.explode_outer(ngrams(F.col("tokens"))).alias("gram"))
    k = len(model.families)
    summed = grams.join(F.broadcast(weights), "gram", "left").groupBy("text").agg(
        F.count("w").alias("n"),
        *[F.coalesce(F.sum(F.get("w", F.lit(i))), F.lit(0.0)).alias(f"z{i}") for i in range(k)],
    )
    logits = [(F.col(f"z{i}") + float(model.bias[i])) * model.scale for i in range(k)]
    top = F.greatest(*logits)
    likeliest = F.element_at(
        F.array(*[F.lit(f) for f in model.families]), F.array_position("z", F.col("top")).cast("int")
    )
    scored = summed.select("text", "n", F.array(*logits).alias("z"), top.alias("top")).select(
        "text",
        F.when(F.col("n") == 0, F.lit(NONE)).otherwise(likeliest).alias("guess"),
        (1.0 / F.aggregate("z", F.lit(0.0), lambda a, z: a + F.exp(z - F.col("top")))).alias("chance"),
    )
    notices = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(family).alias("guess"), F.lit(notice).alias("notice"))
        for family, texts in TEMPLATES.items() for notice in texts
    ])).alias("r")).select("r.guess", F.array_distinct(words(F.col("r.notice"))).alias("notice"))
    families = notices.groupBy("guess").agg(F.collect_list("notice").alias("notices"))
    own = words(F.col("text"))
    share = F.transform(
        "notices", lambda n: F.size(F.array_intersect(n, own)).cast("double") / F.size(n)
    )
    compared = scored.join(F.broadcast(families), "guess", "left").withColumn(
        "likeness", F.coalesce(F.array_max(share), F.lit(0.0))
    )
    sure = (F.col("chance") >= model.bound) & (F.col("likeness") >= CONFIRM)
    family = F.when(F.col("guess") == NONE, F.lit(NONE)).when(sure, F.col("guess")).otherwise(F.lit(UNKNOWN))
    return compared.select("text", family.alias("family"), "chance", "likeness")


def _nearest(lines: Column) -> Column:
    """``lines`` up to the first one without a letter or digit."""
    blank = F.array_position(F.transform(lines, lambda t: t.rlike("[A-Za-z0-9]")), False).cast("int")
    return F.when(blank > 0, F.slice(lines, 1, F.greatest(blank - 1, F.lit(0)))).otherwise(lines)


def _clip(text: Column) -> Column:
    return F.regexp_extract(text, rf"(?s)^(?:[^A-Za-z0-9]*+[A-Za-z0-9]++){{0,{AROUND}}}[^A-Za-z0-9\n]*+", 0)


def _cue_lines(text: Column) -> Column:
    """The lines of ``text`` with a cue word: paragraph, line, and the text before and after it.

    The text around a line ends at a blank line and has AROUND words. The text before is
    reversed, character by character.
    """
    cue = r"(?i)(?<![a-z0-9])(?:" + "|".join(c.replace(".", r"\.") for c in CUES) + r")(?![a-z0-9])"

    def numbered(lines: Column) -> Column:
        found = F.filter(
            F.transform(lines, lambda t, i: F.struct(i.alias("paragraph"), t.alias("line"))),
            lambda p: p["line"].rlike(cue),
        )

        def with_context(p: Column) -> Column:
            i = p["paragraph"]
            first = F.greatest(i - AROUND, F.lit(0))
            before = _nearest(F.transform(F.reverse(F.slice(lines, first + 1, i - first)), F.reverse))
            after = _nearest(F.slice(lines, i + 2, AROUND))
            return F.struct(
                i.alias("paragraph"), p["line"].alias("line"),
                F.when(F.size(before) > 0, _clip(F.array_join(before, "\n"))).alias("before"),
                F.when(F.size(after) > 0, _clip(F.array_join(after, "\n"))).alias("after"),
            )

        return F.transform(found, with_context)

    return F.transform(F.array(F.split(text, "\n")), numbered)[0]


def _pieces(lines: DataFrame) -> DataFrame:
    """(doc_id, th, paragraph, level, from, to, text): joined lines around unconfirmed ones.

    Level 1 ends where a line ends a sentence, level 2 at blank lines only. A line that is a
    notice by itself belongs to no piece.
    """
    near = Window.partitionBy("doc_id", "th").orderBy("paragraph")
    sure = F.when(F.col("known"), F.col("paragraph"))
    rows = lines.withColumn("low", F.max(sure).over(near.rowsBetween(Window.unboundedPreceding, -1))).withColumn(
        "high", F.min(sure).over(near.rowsBetween(1, Window.unboundedFollowing))
    ).where("not known and (before is not null or after is not null)")
    none = F.array().cast("array<string>")
    at = F.col("paragraph")

    def sentence_end(line: Column) -> Column:
        return line.rlike(r"[.!?][\"')\]]*\s*(?:\*/|-->)?\s*$")

    def first_end(found: Column) -> Column:
        return F.array_position(F.transform(found, sentence_end), True).cast("int")

    before = F.coalesce(F.transform(F.split("before", "\n"), F.reverse), none)
    after = F.coalesce(F.split("after", "\n"), none)
    rows = rows.withColumn("b2", F.slice(before, 1, F.coalesce(at - F.col("low") - 1, F.size(before)))).withColumn(
        "a2", F.slice(after, 1, F.coalesce(F.col("high") - at - 1, F.size(after)))
    )
    end_b, end_a = first_end(F.col("b2")), first_end(F.col("a2"))
    rows = rows.withColumn(
        "b1", F.when(end_b > 0, F.slice("b2", 1, F.greatest(end_b - 1, F.lit(0)))).otherwise(F.col("b2"))
    ).withColumn(
        "a1", F.when(sentence_end(F.col("line")), none).when(end_a > 0, F.slice("a2", 1, F.greatest(end_a, F.lit(0)))).otherwise(F.col("a2"))
    )

    def piece(level: int) -> Column:
        b, a = F.col(f"b{level}"), F.col(f"a{level}")
        text = F.array_join(F.concat(F.reverse(b), F.array("line"), a), "\n")
        # A word with a hyphen may be cut behind it.
        text = F.regexp_replace(F.regexp_replace(text, r"(?<=[A-Za-z])-\s*\n[^A-Za-z0-9]*", "-"), r"\s*\n\s*", " ")
        return F.struct(
            F.lit(level).alias("level"), (at - F.size(b)).alias("from"), (at + F.size(a)).alias("to"), text.alias("text")
        )

    both = F.array(piece(1), piece(2))
    wanted = F.filter(both, lambda p: (p["to"] > p["from"]) & (
        (p["level"] == 1) | (p["from"] < both[0]["from"]) | (p["to"] > both[0]["to"])
    ))
    return rows.select("doc_id", "th", "paragraph", F.explode(wanted).alias("p")).select("doc_id", "th", "paragraph", "p.*")


def license_paragraphs(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Every licence notice of ``docs(doc_id, text)``.

    doc_id, th (hash of the whole text), paragraph (number from 0 of its first line), text,
    family, chance and likeness, for lines that are a licence or unknown, and for notices
    wrapped over lines of which none is one by itself; the text of those is joined, and
    their lines are not listed as unknown. Null and empty texts have no line with a notice.
    Repeated rows are listed once.
    """
    model = model or fit_licenses(docs.sparkSession)
    candidates = cut_lineage(
        docs.select("doc_id", F.xxhash64("text").alias("th"), F.explode(_cue_lines(F.col("text"))).alias("p"))
        .select("doc_id", "th", "p.*").distinct()
    )
    found = classify(candidates.select(F.col("line").alias("text")).distinct(), model)
    notices = cut_lineage(found.where(F.col("family") != NONE))
    lines = cut_lineage(
        candidates.join(notices, F.col("line") == F.col("text"), "left")
        .withColumn("known", F.coalesce(F.col("family") != UNKNOWN, F.lit(False)))
    )
    pieces = cut_lineage(_pieces(lines))
    joined = classify(pieces.select("text").distinct(), model).where(~F.col("family").isin(NONE, UNKNOWN))
    same = Window.partitionBy("doc_id", "th", "family").orderBy("from", "to")
    sentence = F.col("level") == 1
    # What a sentence shows counts once, and not again for the paragraph around it.
    wrapped = cut_lineage(
        pieces.join(cut_lineage(joined), "text")
        .withColumn("seen", F.max(F.when(sentence, F.col("to"))).over(same.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("next", F.min(F.when(sentence, F.col("from"))).over(same.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .where(sentence | ~(F.coalesce(F.col("seen") >= F.col("from"), F.lit(False)) | F.coalesce(F.col("next") <= F.col("to"), F.lit(False))))
    )
    columns = ["doc_id", "th", "paragraph", "text", "family", "chance", "likeness"]
    first = wrapped.withColumn(
        "done", F.max("to").over(same.rowsBetween(Window.unboundedPreceding, -1))
    ).where("done is null or from > done").drop("paragraph").withColumnRenamed("from", "paragraph")
    explained = wrapped.select(
        F.col("doc_id").alias("d"), F.col("th").alias("h"), F.col("paragraph").alias("at")
    ).distinct()
    own = (F.col("th") == F.col("h")) & (F.col("paragraph") == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("d"))
    listed = lines.where("family is not null").select(*columns)
    return listed.where(F.col("family") != UNKNOWN).unionByName(
        listed.where(F.col("family") == UNKNOWN).join(explained, own, "left_anti")
    ).unionByName(first.select(*columns))


def license_digest(docs: DataFrame) -> DataFrame:
    """Per document: its lines, how many are notices or unknown, and its licence families.

    families is the sorted, comma-separated list of confirmed ones, empty if there is none.
    """
    docs = docs.select("doc_id", "text").withColumn("th", F.xxhash64("text"))
    known = F.col("family") != UNKNOWN
    found = license_paragraphs(docs.select("doc_id", "text")).groupBy(
        F.col("doc_id").alias("d"), F.col("th").alias("h")
    ).agg(
        F.count_if(known).alias("n_notices"), F.count_if(~known).alias("n_unknown"),
        F.array_join(F.array_sort(F.collect_set(F.when(known, F.col("family")))), ",").alias("families"),
    )
    lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    rows = docs.select("doc_id", "th", F.when(F.col("text").isNull(), 0).otherwise(lines).cast("long").alias("n_paragraphs"))
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h")), "left").select(
        "doc_id", "n_paragraphs", F.coalesce("n_notices", F.lit(0)).alias("n_notices"),
        F.coalesce("n_unknown", F.lit(0)).alias("n_unknown"), F.coalesce("families", F.lit("")).alias("families"),
    )
