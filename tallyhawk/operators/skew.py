"""Finding busy keys and joining on them without one overfull task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhawk.settings import DEFAULT_SKEW, SkewPolicy

_ROWS = "_rows"


def hot_keys(df: DataFrame, *keys: str, policy: SkewPolicy = DEFAULT_SKEW) -> DataFrame | None:
    """Keys above ``policy.hot_rows`` rows with their ``_rows``; None if there is none.

    Reads the key columns only and combines counts before the shuffle. The job runs at
    once, so that a table without busy keys gets a plan without the steps for them. A
    short list comes back as a small table to broadcast, a long one as a plan.
    """
    hot = (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(_ROWS))
        .filter(F.col(_ROWS) > policy.hot_rows)
    )
    listed = hot.limit(policy.broadcast_keys + 1).collect()
    if not listed:
        return None
    if len(listed) > policy.broadcast_keys:
        return hot
    return F.broadcast(df.sparkSession.createDataFrame(listed, hot.schema))


def mark_hot(df: DataFrame, hot: DataFrame, name: str) -> DataFrame:
    """Add a boolean column that says whether the keys are in the hot list."""
    keys = [c for c in hot.columns if c != _ROWS]
    return (
        df.join(hot, keys, "left")
        .select(*[F.col(f"`{c}`") for c in df.columns], F.col(_ROWS).isNotNull().alias(name))
    )


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    spread: Column,
    policy: SkewPolicy | None = DEFAULT_SKEW,
) -> DataFrame:
    """Left join with a lookup table.

    Rows of a hot key are spread by the hash of ``spread`` over salts that follow from
    the key's number of rows, and its lookup row is repeated as often.
    """
    if policy is None:
        return df.join(lookup, key, "left")
    own = [F.col(f"`{c}`") for c in df.columns]
    # Null keys match nothing; spreading them keeps them out of one task.
    apart = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread), F.lit(1024)).cast("int"))
    hot = hot_keys(df, key, policy=policy)
    if hot is None:
        left = df.withColumn("_salt", apart.otherwise(0))
        right = lookup.withColumn("_salt", F.lit(0))
    else:
        salts = F.greatest(F.ceil(F.col(_ROWS) / max(policy.hot_rows, 1)), F.lit(policy.salts))
        salts = F.coalesce(salts, F.lit(1)).cast("int")
        left = df.join(hot, key, "left").select(
            *own, apart.otherwise(F.pmod(F.xxhash64(spread), salts).cast("int")).alias("_salt")
        )
        right = lookup.join(hot, key, "left").select(
            *lookup.columns, F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt")
        )
    return left.join(right, [key, "_salt"], "left").select(
        *df.columns, *[c for c in lookup.columns if c != key]
    )
