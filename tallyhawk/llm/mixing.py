"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source asks for the same number of copies, the source's target
divided by its size. The whole part is granted; the fraction is a probability. Pairs of
fractions then trade words: mass moves from one to the other, in a random direction
that keeps both expectations, until one of them is 0 or 1. A trade never changes the
words of the pair, so a source ends within one document of its target.

Trades run as a reduction tree: the fractions of a source are dealt into groups of
about ``fan_in``, a group is folded inside one row, and what each group leaves over,
one fraction at most, meets the others' on the next level. A source with a third of all
rows is many groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.llm.common import cut_lineage, null_safe, uniform, word_count

FAN_IN = 512
#: Equal rows numbered together.
CELL_ROWS = 20_000
#: Fractions closer than this to 0 or 1 are settled.
TINY = 1e-9


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """One row per source of ``sizes(source, size)``: source_size and target.

    Sources by code point, null last, take ``weights`` in turn and share ``share`` times
    all words. No target is above ``most`` times its source's size; what is cut off goes
    to the others by weight until none is above. That is one water level: each target is
    the smaller of its cap and level times weight. The windows see one row per source.
    """
    per_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_units")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place % len(weights) + 1)
    ranked = per_source.select("*", weight.alias("weight")).select(
        "*", (F.col("source_size") * most).alias("cap")
    ).select("*", (F.col("cap") / F.col("weight")).alias("ratio"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (
        F.sum("source_size").over(whole) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("weight").over(after)
    found = F.when(F.col("level") <= F.col("ratio"), F.col("level"))
    return (
        ranked.select("*", level.alias("level"))
        .select("*", F.max(found).over(whole).alias("water"))
        .select(
            "source",
            F.col("source_size").cast("long").alias("source_size"),
            "n_units",
            F.coalesce(F.least("cap", F.col("water") * F.col("weight")), F.col("cap")).alias("target"),
        )
    )


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _trade(carry: Column, new: Column) -> Column:
    """The two fractions after one trade; one of them at least is 0 or 1."""

    def move(x: Column) -> Column:
        up, down = F.least(x["c_room"], x["n_mass"]), F.least(x["c_mass"], x["n_room"])
        rises = new["u"] * (up + down) < down
        c = F.when(
            rises,
            F.when(x["c_room"] <= x["n_mass"], 1.0).otherwise(carry["p"] + up / carry["mass"]),
        ).otherwise(
            F.when(x["c_mass"] <= x["n_room"], 0.0).otherwise(carry["p"] - down / carry["mass"])
        )
        n = F.when(
            rises,
            F.when(x["n_mass"] <= x["c_room"], 0.0).otherwise(new["p"] - up / new["mass"]),
        ).otherwise(
            F.when(x["n_room"] <= x["c_mass"], 1.0).otherwise(new["p"] + down / new["mass"])
        )
        return F.struct(_snap(c).alias("c"), _snap(n).alias("n"))

    return _let(
        F.struct(
            ((1 - carry["p"]) * carry["mass"]).alias("c_room"),
            (carry["p"] * carry["mass"]).alias("c_mass"),
            ((1 - new["p"]) * new["mass"]).alias("n_room"),
            (new["p"] * new["mass"]).alias("n_mass"),
        ),
        move,
    )


def _snap(p: Column) -> Column:
    return F.when(p < TINY, 0.0).when(p > 1 - TINY, 1.0).otherwise(p)


def _fold(units: Column, unit_type: str) -> Column:
    """Trade through an array of units, largest first: settled ones and what is left."""
    start = F.struct(
        F.array().cast(f"array<{unit_type}>").alias("done"),
        F.lit(None).cast(unit_type).alias("carry"),
    )

    def step(state: Column, new: Column) -> Column:
        carry = state["carry"]

        def settle(p: Column) -> Column:
            old, now = carry.withField("p", p["c"]), new.withField("p", p["n"])
            whole_old, whole_now = p["c"].isin(0.0, 1.0), p["n"].isin(0.0, 1.0)
            done = F.when(whole_old & whole_now, F.array(old, now)).otherwise(
                F.when(whole_old, F.array(old)).otherwise(F.array(now))
            )
            left = F.when(~whole_old, old).when(~whole_now, now)
            return F.struct(F.concat(state["done"], done).alias("done"), left.alias("carry"))

        return F.when(
            carry.isNull(), F.struct(state["done"].alias("done"), new.alias("carry"))
        ).otherwise(_let(_trade(carry, new), settle))

    return F.aggregate(units, start, step)


def settle_fractions(units: DataFrame, fan_in: int = FAN_IN, seed: int = 7) -> DataFrame:
    """Round ``units(key, source, mass, p, n_units)`` to ``(key, up)`` with up 0 or 1.

    ``p`` lies strictly between 0 and 1, ``mass`` is above 0, and ``n_units`` is the
    number of units of the source, or more. Each level is stored, so a lost executor
    costs one level.
    """
    units = cut_lineage(units)
    most = units.agg(F.max("n_units")).first()[0] or 0
    key_type = units.schema["key"].dataType.simpleString()
    unit_type = f"struct<mass:double,key:{key_type},source:{units.schema['source'].dataType.simpleString()},p:double,u:double>"
    settled, level = [], 0
    while True:
        groups = F.ceil(F.col("n_units") / fan_in)
        bucket = F.pmod(F.xxhash64("key", F.lit(seed + level)), groups)
        unit = F.struct(
            "mass", "key", "source", "p", uniform(F.col("key"), F.lit(seed + 1000 + level)).alias("u")
        ).cast(unit_type)
        folded = cut_lineage(
            units.groupBy("source", bucket.alias("bucket"), groups.alias("groups"))
            .agg(F.sort_array(F.collect_list(unit), asc=False).alias("units"))
            .select("groups", _fold(F.col("units"), unit_type).alias("fold"))
        )
        settled.append(
            folded.select(F.explode("fold.done").alias("unit")).select(
                "unit.key", F.col("unit.p").cast("int").alias("up")
            )
        )
        units = folded.where("fold.carry is not null").select(
            "fold.carry.key", "fold.carry.source", "fold.carry.mass", "fold.carry.p",
            F.col("groups").alias("n_units"),
        )
        most, level = -(-most // fan_in), level + 1
        if most <= 1:
            break
    # One fraction per source is left; the nearer whole number is closer to the target.
    settled.append(units.select("key", F.round("p").cast("int").alias("up")))
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    fan_in: int = FAN_IN,
    seed: int = 7,
) -> DataFrame:
    """``docs`` with mix_size, mix_source_size, mix_target and mix_copies.

    The size of a document is its number of words. Columns of these four names are
    replaced; all others stay. Null and empty texts have size 0 and cost nothing; their
    copies are drawn one by one. A null source is a source of its own, the last one.
    Of rows equal in doc_id, source and text, a null doc_id included, as many get one copy
    more as their rate asks for, in whole rows, and only the row left over trades; which
    of them does not matter to the mix and may differ between runs where their other
    columns differ. An empty table gives an empty table. Reruns give the same copies.
    """
    own = ["mix_size", "mix_source_size", "mix_target", "mix_copies"]
    sized = docs.drop(*own).withColumn("mix_size", word_count(F.col("text")))
    keys = sized.select(
        "doc_id", "source", F.xxhash64("text").alias("th"), F.col("mix_size").alias("size")
    )
    key = ["doc_id", "source", "th", "size"]
    units = cut_lineage(keys.groupBy(*key).agg(F.count(F.lit(1)).alias("m")))
    targets = cut_lineage(
        source_targets(
            units.select("source", (F.col("size") * F.col("m")).alias("size")), weights, share, most
        )
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = (
        units.alias("u")
        .join(targets.alias("t"), F.col("u.source").eqNullSafe(F.col("t.source")))
        .select("u.*", "n_units", "source_size", "target", rate.alias("rate"))
        .withColumn("base", F.floor("rate").cast("int"))
        .withColumn("p", _snap(F.col("rate") - F.col("base")))
        .withColumn("want", F.col("p") * F.col("m"))
        .withColumn("sure", F.floor("want"))
        .withColumn("rest", _snap(F.col("want") - F.col("sure")))
    )
    loose = rated.where((F.col("rest") > 0) & (F.col("rest") < 1) & (F.col("size") > 0)).select(
        F.struct(*key).alias("key"), "source", F.col("size").cast("double").alias("mass"),
        F.col("rest").alias("p"), "n_units",
    )
    ups = settle_fractions(loose, fan_in, seed).select("key.*", "up")
    lucky = (uniform(F.col("u.doc_id"), F.col("u.source"), F.lit(seed)) < F.col("p")).cast("int")
    up = F.when(F.col("size") == 0, lucky * F.col("m")).otherwise(
        F.col("sure") + F.when(F.col("rest") == 1, 1).otherwise(F.coalesce("up", F.lit(0)))
    )
    granted = (
        rated.alias("u")
        .join(
            ups.toDF("up_doc", "up_source", "up_th", "up_size", "up"),
            F.col("u.doc_id").eqNullSafe(F.col("up_doc"))
            & F.col("u.source").eqNullSafe(F.col("up_source"))
            & (F.col("u.th") == F.col("up_th")) & (F.col("u.size") == F.col("up_size")),
            "left",
        )
        .select(*[F.col(f"u.{c}") for c in key], "m", "source_size", "target", "base", up.alias("ups"))
    )
    # Structs keep the columns of the documents apart from those of the mix.
    rows = sized.alias("d").join(
        granted.alias("g"),
        F.col("d.doc_id").eqNullSafe(F.col("g.doc_id"))
        & F.col("d.source").eqNullSafe(F.col("g.source"))
        & (F.xxhash64(F.col("d.text")) == F.col("g.th")) & (F.col("d.mix_size") == F.col("g.size")),
    ).select(F.struct("d.*").alias("d"), F.struct("g.*").alias("g"))

    def finished(part: DataFrame, more: Column) -> DataFrame:
        return part.select(
            "d.*", F.col("g.source_size").alias("mix_source_size"),
            F.col("g.target").alias("mix_target"),
            (F.col("g.base") + more).cast("int").alias("mix_copies"),
        )

    if units.where("m > 1").isEmpty():
        return finished(rows, F.col("g.ups"))
    numbered = _numbered(cut_lineage(rows.where("g.m > 1").withColumn("r", F.rand(seed))))
    return finished(rows.where("g.m = 1"), F.col("g.ups")).unionByName(
        finished(numbered, (F.col("place") <= F.col("g.ups")).cast("int"))
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows(d, g, r)`` with their place from 1 among the rows of one ``g``.

    Rows are numbered in cells of about ``CELL_ROWS``, cut by the stored number ``r``, and
    one small row a cell carries the numbers of the cells before it.
    """
    cells = F.ceil(F.col("g.m") / CELL_ROWS)
    rows = rows.withColumn("cell", F.floor(F.col("r") * cells))
    before = Window.partitionBy("g").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    firsts = cut_lineage(
        rows.groupBy("g", "cell").agg(F.count(F.lit(1)).alias("n")).select(
            F.col("g").alias("of"), F.col("cell").alias("at"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        )
    )
    place = F.row_number().over(Window.partitionBy("g", "cell").orderBy("r"))
    return rows.withColumn("place", place).join(
        firsts, F.col("g").eqNullSafe(F.col("of")) & (F.col("cell") == F.col("at"))
    ).withColumn("place", F.col("place") + F.col("first"))


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it, with its own columns only."""
    columns = [c for c in mixed.columns if not c.startswith("mix_")]
    return mixed.where("mix_copies > 0").select(
        *columns, F.explode(F.sequence(F.lit(1), F.col("mix_copies"))).alias("mix_copy")
    ).drop("mix_copy")


def mix_digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document."""
    return mix_sources(docs.select("doc_id", "source", "text")).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), "source",
        F.col("mix_copies").alias("copies"),
        (F.col("mix_copies") * F.col("mix_size")).cast("long").alias("taken"),
    )
