"""Change detection by content: order-independent fingerprints of the rows of a key."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKS = ["_rows", "_sum", "_folded"]


def fingerprints(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the number of its rows, the sum and the exclusive or of their hashes. Neither the order of rows nor
    their files matter; repeated rows do. Tasks add up their own rows, so only a row a key is shuffled."""
    row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    rows = df.select(*keys, row.alias("_h"))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(F.col("_h").cast("decimal(20,0)")).cast("string").alias("_sum"), F.bit_xor("_h").alias("_folded")
    )


def differing(new: DataFrame, old: DataFrame | None, keys: list[str]) -> DataFrame:
    """(keys, gone): the keys whose fingerprint in ``new`` isn't that in ``old``; ``gone`` are those that only ``old``
    has. Null keys equal each other."""
    if old is None:
        return new.select(*keys, F.lit(False).alias("gone"))
    a = new.select(*keys, F.struct(*MARKS).alias("_a"))
    b = old.select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct(*MARKS).alias("_b"))
    on = functools.reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    both = a.join(b, on, "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b")))
    gone = F.col("_a").isNull()
    return both.select(*[F.when(gone, F.col(f"_{k}")).otherwise(F.col(k)).alias(k) for k in keys], gone.alias("gone"))
