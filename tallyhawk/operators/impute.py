"""Fill missing merchant zip codes from the nearest known place.

The nearest of billions of places is found with nested grids. Cells of one level
split into cells of the next, and each non-empty cell keeps how many places it
has and one of them. The place kept by a row's own cell, at the finest level that
has one, gives a first bound; only cells that reach into the circle of that bound
can hold the answer. Crowded cells among them are replaced by their parts until
few places are left to compare, so no cell is ever compared in full and the
result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhawk.operators.skew import lookup_join
from tallyhawk.session import cut_lineage
from tallyhawk.settings import DEFAULT_SKEW, SkewPolicy

# Cell sides in degrees, powers of two so that cells nest without rounding. The
# first level is one cell for the whole globe, the last is five centimetres wide.
SIDES = [512.0, 32.0, 4.0, 2.0**-1, 2.0**-4, 2.0**-7, 2.0**-10, 2.0**-13, 2.0**-17, 2.0**-21]
FINEST = len(SIDES) - 1
CROWDED = 128

_PLACE = ["merch_lat", "merch_long"]
_CELL = ["level", "cx", "cy"]
_ROW = ["lat", "long"]


def flag_missing_zip(df: DataFrame) -> DataFrame:
    return df.withColumn("merch_zipcode_missing", F.col("merch_zipcode").isNull())


def split_by_zip(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with and without a merchant zip code."""
    missing = F.col("merch_zipcode").isNull()
    return df.filter(~missing), df.filter(missing)


def _cell() -> Column:
    return F.struct(*_CELL)


def _with_cells(df: DataFrame, cells: DataFrame, policy: SkewPolicy | None) -> DataFrame:
    """Join rows with what is in their cell; rows of an empty cell are dropped.

    Very many rows may look into one cell, so busy cells are spread.
    """
    lookup = cells.select(_cell().alias("cell"),
                          *[c for c in cells.columns if c not in _CELL])
    joined = lookup_join(df.withColumn("cell", _cell()), lookup, "cell", F.struct(*_ROW), policy)
    return joined.filter(F.col(lookup.columns[1]).isNotNull()).drop("cell")


def _sides() -> Column:
    return F.array(*[F.lit(s) for s in SIDES])


def _number(offset: Column, side: Column) -> Column:
    """Cell number along one axis; what lies off the grid belongs to its border cells."""
    last = F.floor(SIDES[0] / side) - 1
    return F.least(F.greatest(F.floor(offset / side), F.lit(0)), last)


def _cell_x(lat: Column, side: Column) -> Column:
    return _number(lat + 90.0, side)


def _cell_y(long: Column, side: Column) -> Column:
    return _number(long + 180.0, side)


def _has_place() -> Column:
    """Both coordinates are finite numbers."""
    finite = [F.abs(c) < float("inf") for c in _PLACE]  # also false for not-a-number
    return F.coalesce(finite[0] & finite[1], F.lit(False))


def _square(lat1: Column, long1: Column, lat2: Column, long2: Column) -> Column:
    return (lat1 - lat2) * (lat1 - lat2) + (long1 - long2) * (long1 - long2)


def _cells_of(points: DataFrame, lat: str, long: str, depth: int = FINEST) -> DataFrame:
    """Every point once per level down to ``depth``, with the cell it lies in."""
    sides = F.slice(_sides(), 1, depth + 1)
    return points.select("*", F.posexplode(sides).alias("level", "side")).select(
        *points.columns, "level",
        _cell_x(F.col(lat), F.col("side")).alias("cx"),
        _cell_y(F.col(long), F.col("side")).alias("cy"),
    )


def _outside(number: Column, offset: Column, side: Column) -> Column:
    """Distance from a value to a cell; border cells reach outwards without end."""
    low = number * side
    below = F.when(number > 0, low - offset).otherwise(F.lit(0.0))
    above = F.when(low + side < SIDES[0], offset - low - side).otherwise(F.lit(0.0))
    return F.greatest(below, above, F.lit(0.0))


def _reach(side: Column) -> Column:
    """Squared distance from the row's place to the nearest edge of the cell."""
    x = _outside(F.col("cx"), F.col("lat") + 90.0, side)
    y = _outside(F.col("cy"), F.col("long") + 180.0, side)
    return x * x + y * y


# The slack in both covers rounding in the distances; it only keeps more cells.
def _radius() -> Column:
    return F.sqrt("bound") * (1 + 1e-9) + 1e-9


def _within_bound() -> Column:
    side = F.element_at(_sides(), F.col("level") + 1)
    return _reach(side) <= F.col("bound") * (1 + 1e-9) + 1e-18


def nearest_zips(
    known: DataFrame, wanted: DataFrame, policy: SkewPolicy | None = DEFAULT_SKEW
) -> DataFrame:
    """``merch_lat, merch_long, nearest_zip`` for each distinct wanted place.

    Places are compared by straight distance in degrees; among equally near ones
    the smallest zip code wins.
    """
    places = (
        known.filter(_has_place())
        .groupBy(*_PLACE)
        .agg(F.min("merch_zipcode").alias("zip"))
    )
    rows = (
        wanted.select(*_PLACE).distinct()
        .filter(_has_place())
        .select(F.col("merch_lat").alias("lat"), F.col("merch_long").alias("long"))
    )
    cells = cut_lineage(
        _cells_of(places, *_PLACE).groupBy(*_CELL).agg(
            F.count(F.lit(1)).alias("places"),
            # The southernmost place: plain doubles keep this a hash aggregate.
            F.min("merch_lat").alias("kept_lat"),
            F.min_by("merch_long", "merch_lat").alias("kept_long"),
        )
    )
    depth = _useful_depth(cells)
    cells = cells.filter(F.col("level") <= depth)
    is_crowded = (F.col("places") > CROWDED) & (F.col("level") < depth)
    near = cut_lineage(_first_cells(rows, cells, depth, policy))
    settled = near.filter(~is_crowded)
    while True:
        crowded = near.filter(is_crowded)
        if crowded.isEmpty():
            break
        near = cut_lineage(_split_cells(crowded, cells, policy))
        settled = settled.unionByName(near.filter(~is_crowded))

    distance = _square(F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long"))
    # Ten levels at most. Coarse cells, which hold very many places, are seldom among them.
    levels = [r["level"] for r in settled.select("level").distinct().collect()]
    looked_at = _cells_of(places, *_PLACE, depth).filter(F.col("level").isin(levels))
    return (
        _with_cells(settled.select(*_ROW, *_CELL), looked_at, policy)
        .groupBy(*_ROW)
        .agg(F.min(F.struct(distance.alias("d"), "zip")).alias("best"))
        .select(F.col("lat").alias("merch_lat"), F.col("long").alias("merch_long"),
                F.col("best.zip").alias("nearest_zip"))
    )


def _useful_depth(cells: DataFrame) -> int:
    """The first level without a crowded cell; finer ones would not help."""
    fullest = cells.groupBy("level").agg(F.max("places").alias("places")).collect()
    return min((r["level"] for r in fullest if r["places"] <= CROWDED), default=FINEST)


def _kept_distance() -> Column:
    return _square(F.col("lat"), F.col("long"), F.col("kept_lat"), F.col("kept_long"))


def _first_cells(
    rows: DataFrame, cells: DataFrame, depth: int, policy: SkewPolicy | None
) -> DataFrame:
    """Cells that reach into the circle around each row given by its own cells."""
    bounds = (
        _with_cells(_cells_of(rows, *_ROW, depth), cells, policy)
        .groupBy(*_ROW)
        .agg(F.min(_kept_distance()).alias("bound"))
    )
    # The finest level whose cells are no smaller than the circle's radius: at
    # most three cells each way cover the circle.
    radius = _radius()
    level = F.lit(0)
    for number, side in enumerate(SIDES[: depth + 1]):
        level = F.when(radius <= side, number).otherwise(level)
    side = F.element_at(_sides(), F.col("level") + 1)
    covered = (
        bounds.withColumns({"radius": radius, "level": level})
        .withColumn("cx", F.explode(F.sequence(_cell_x(F.col("lat") - F.col("radius"), side),
                                               _cell_x(F.col("lat") + F.col("radius"), side))))
        .withColumn("cy", F.explode(F.sequence(_cell_y(F.col("long") - F.col("radius"), side),
                                               _cell_y(F.col("long") + F.col("radius"), side))))
        .drop("radius")
    )
    return _with_cells(covered.filter(_within_bound()), cells, policy).select(
        *_ROW, "bound", *_CELL, "places"
    )


def _split_cells(crowded: DataFrame, cells: DataFrame, policy: SkewPolicy | None) -> DataFrame:
    """Replace crowded cells by their non-empty parts and tighten the bound."""
    sides = _sides()
    outer, inner = (F.element_at(sides, F.col("level") + n) for n in (1, 2))
    parts = (outer / inner).cast("bigint")
    radius = _radius()

    def within(cell: str, value: str, of) -> Column:
        """Parts of a cell along one axis that the circle reaches."""
        first = F.greatest(F.col(cell) * parts, of(F.col(value) - radius, inner))
        last = F.least(F.col(cell) * parts + parts - 1, of(F.col(value) + radius, inner))
        # A sequence that runs backwards would list cells outside.
        return F.when(first <= last, F.sequence(first, last))

    children = (
        crowded.drop("places")
        .withColumns({"xs": within("cx", "lat", _cell_x), "ys": within("cy", "long", _cell_y)})
        .select(*_ROW, "bound", (F.col("level") + 1).alias("level"),
                F.explode("xs").alias("cx"), "ys")
        .withColumn("cy", F.explode("ys"))
        .drop("ys")
        .filter(_within_bound())
    )
    children = _with_cells(children, cells, policy)
    tighter = children.groupBy("lat", "long").agg(F.min(_kept_distance()).alias("kept_bound"))
    return (
        children.join(tighter, ["lat", "long"])
        .withColumn("bound", F.least("bound", "kept_bound"))
        .filter(_within_bound())
        .select("lat", "long", "bound", *_CELL, "places")
    )


def fill_merchant_zip(df: DataFrame, policy: SkewPolicy | None = DEFAULT_SKEW) -> DataFrame:
    """Flag missing merchant zip codes and fill them from the nearest known place.

    A row without finite coordinates, or a table without any known zip, stays unfilled.
    """
    flagged = flag_missing_zip(df)
    known, missing = split_by_zip(flagged)
    place = F.struct(*_PLACE)
    found = nearest_zips(known, missing, policy).select(place.alias("_place"), "nearest_zip")
    # Rows that have a zip code stay out of the join and its shuffle.
    filled = lookup_join(
        missing.withColumn("_place", place), found, "_place", F.struct("trans_num"), policy
    )
    return known.unionByName(
        filled.withColumn("merch_zipcode", F.col("nearest_zip")).select(*flagged.columns)
    )
