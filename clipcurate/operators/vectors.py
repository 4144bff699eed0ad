"""Mean vectors and growth of a vector table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements are summed as decimals of this type, so that the mean does not depend on order: sums add ten digits, which
# is room for 10^10 rows of up to 10^9. Larger elements are summed in the units of the wide type instead.
FINE, WIDE = "decimal(28,18)", "decimal(28,0)"
_FINE_LIMIT = 1e9


def element_sums(vectors: DataFrame, *group: str, vec: str = "vec") -> DataFrame:
    """Per group and position: `fine_sum`, `wide_sum` and `n`. Map tasks send one partial sum per position.

    An element counts in one of the two sums, by its size; from 10^9 on, what lies behind the point is left to the fine one.
    """
    elements = vectors.select(*group, F.posexplode(vec).alias("pos", "x"))
    x = F.col("x").cast("double")
    whole = F.when(F.abs(x) >= _FINE_LIMIT, F.when(x < 0, F.ceil(x)).otherwise(F.floor(x))).otherwise(F.lit(0))
    return elements.groupBy(*group, "pos").agg(
        F.sum((x - whole.cast("double")).cast(FINE)).alias("fine_sum"),
        F.sum(whole.cast(WIDE)).alias("wide_sum"),
        F.count(F.lit(1)).alias("n"),
    )


def mean_elements(vectors: DataFrame, *group: str, vec: str = "vec") -> DataFrame:
    sums = element_sums(vectors, *group, vec=vec)
    mean = (F.col("fine_sum").cast("double") + F.col("wide_sum").cast("double")) / F.col("n")
    return sums.select(*group, "pos", mean.alias("mean"))


def mean_vector(vectors: DataFrame, *group: str, vec: str = "vec") -> DataFrame:
    """One mean vector per group, or of the whole table; an array has one entry per position."""
    entries = F.sort_array(F.collect_list(F.struct("pos", "mean")))
    means = mean_elements(vectors, *group, vec=vec).groupBy(*group).agg(
        entries.alias("_entries")
    )
    return means.select(*group, F.transform("_entries", lambda e: e["mean"]).alias("mean_vec"))


def extend_vectors(vectors: DataFrame, new_ids: DataFrame, vec: str = "vec") -> DataFrame:
    """Known rows stay; every new token starts at the mean of all known rows."""
    start = mean_vector(vectors, vec=vec)
    known = vectors.select(
        "token_id", F.col(vec).cast("array<double>").alias("vec"), F.lit(False).alias("added")
    )
    added = new_ids.select(
        "token_id", start.scalar().alias("vec"), F.lit(True).alias("added")
    )
    return known.unionByName(added)
