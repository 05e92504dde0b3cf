"""Categorical encoding and alignment to a fixed feature list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tallyhawk.functions.numbers import gender_code
from tallyhawk.schema import ENCODED_COLUMNS, MODEL_FEATURES

MAX_LEVELS = 10_000


def fit_levels(
    df: DataFrame, columns: Sequence[str] = tuple(ENCODED_COLUMNS), max_levels: int = MAX_LEVELS
) -> dict[str, list[str]]:
    """Sorted levels per column, found in one pass.

    Levels become columns, so a column with too many of them is refused.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("level"))
        for c in columns
    ]))
    found = (
        df.select(pairs.alias("_p")).select("_p.*").filter(F.col("level").isNotNull())
        .distinct().limit(max_levels * len(columns) + 1).collect()
    )
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for row in found:
        levels[row["column"]].append(row["level"])
    for column, values in levels.items():
        if len(values) > max_levels:
            raise ValueError(f"{column} has more than {max_levels} levels")
    return {c: sorted(v) for c, v in levels.items()}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace columns by 0/1 columns ``column_level``; the first level has none.

    A null or unknown level is 0 everywhere.
    """
    kept = [f"`{c}`" for c in df.columns if c not in levels]
    dummies = [
        f"cast(cast(`{column}` as string) <=> {_quoted(level)} as int) as `{column}_{level}`"
        for column, values in levels.items() for level in values[1:]
    ]
    return df.selectExpr(*kept, *dummies)


def encode_gender(df: DataFrame) -> DataFrame:
    return df.withColumn("gender", gender_code(F.col("gender")))


def level_codes(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Add ``column_encoded``: the place of the level among the sorted levels, from 0."""
    codes = {}
    for column, values in levels.items():
        if values:
            pairs = [F.lit(x) for i, level in enumerate(values) for x in (level, i)]
            codes[f"{column}_encoded"] = F.try_element_at(
                F.create_map(*pairs), F.col(f"`{column}`").cast("string")
            )
        else:
            codes[f"{column}_encoded"] = F.lit(None).cast("int")
    return df.withColumns(codes)


def align(df: DataFrame, features: Sequence[str] = tuple(MODEL_FEATURES),
          keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the given features in the given order.

    A feature the table lacks, or lacks a value of, is 0; other columns go.
    """
    have = set(df.columns)
    columns = [
        f"coalesce(`{c}`, 0) as `{c}`" if c in have else f"0 as `{c}`" for c in features
    ]
    return df.selectExpr(*[f"`{c}`" for c in keep], *columns)


def vector_input(df: DataFrame, features: Sequence[str] = tuple(MODEL_FEATURES),
                 output: str = "features") -> DataFrame:
    """Assemble the features into one vector column.

    Feature names may hold blanks or dots, hence the positional names inside.
    """
    from pyspark.ml.feature import VectorAssembler

    names = [f"_f{i}" for i in range(len(features))]
    staged = df.selectExpr(
        "*", *[f"cast(`{c}` as double) as {n}" for c, n in zip(features, names)]
    )
    return VectorAssembler(inputCols=names, outputCol=output).transform(staged).drop(*names)

