"""Left joins of a large frame to a lookup, broadcast only when measured small."""

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 48
COPIES_A_TASK = 16  # of lookup rows of frequent keys; more of them spread rows more evenly
ROW = "__row"


def lookup_bytes(lookup: DataFrame) -> int:
    """In-memory size of a lookup, from one distributed aggregate over it."""
    row = F.lit(ROW_OVERHEAD_BYTES + 8 * len(lookup.columns))
    for field in lookup.schema.fields:
        if isinstance(field.dataType, StringType):
            row = row + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
    return lookup.agg(F.sum(row.cast("bigint"))).first()[0] or 0


def fits_broadcast(lookup: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    return lookup_bytes(lookup) <= limit


def frequent_keys(frame: DataFrame, key: Column, tasks: int) -> DataFrame:
    """Keys that more rows hold than half a task's fair share, and how many copies of such a
    key's lookup row spread its rows evenly: at most 2 ``tasks`` keys.

    One aggregate of bounded size a task tells them: counts of the most frequent items, which
    may be too high, so that a key may be spread for nothing, but never too low."""
    counted = frame.select(key.alias("__key")).agg(
        F.count("*").alias("__rows"),
        F.expr(f"approx_top_k(__key, {2 * tasks}, {min(1_000_000, 64 * tasks)})").alias("__top"),
    )
    items = counted.select("__rows", F.inline("__top"))
    share = F.col("count") / F.col("__rows")
    return items.where(2 * tasks * share > 1).select(
        F.col("item").alias("__frequent"),
        F.ceil(COPIES_A_TASK * tasks * share).cast("int").alias("__copies"),
    )


def numbered(frame: DataFrame, small: bool) -> DataFrame:
    """Rows with a number to spread copies of one key by, where the join will need it.

    To be taken where rows come from a scan, whose order a lost task repeats."""
    return frame if small else frame.withColumn(ROW, F.monotonically_increasing_id())


def lookup_join(
    frame: DataFrame, lookup: DataFrame, keys: Mapping[str, str], small: bool
) -> DataFrame:
    """Left join that keeps every row of ``frame``; ``keys`` pairs its columns with the
    lookup's, which the result lacks.

    ``small`` is the outcome of ``fits_broadcast``.  When it is false both sides are
    shuffled by key, and rows of a frequent key by a share of their number too: its lookup
    row is copied once for each share, so no task gets much more than another, however
    many rows hold one key or are copies of one row.  NULL keys are spread in the same way."""
    match = [F.col(own) == F.col(f"__{other}") for own, other in keys.items()]
    lookup = lookup.select(
        *[
            F.col(other).cast(frame.schema[own].dataType).alias(f"__{other}")
            for own, other in keys.items()
        ],
        *[c for c in lookup.columns if c not in keys.values()],
    )
    found = [f"__{other}" for other in keys.values()]
    if small:
        return frame.join(F.broadcast(lookup), reduce(and_, match), "left").drop(*found)
    tasks = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frequent = frequent_keys(frame, F.xxhash64(*keys), tasks)

    def beside(rows: DataFrame, *columns: str) -> DataFrame:
        same = F.xxhash64(*columns) == F.col("__frequent")
        return rows.join(F.broadcast(frequent), same, "left")  # at most 2 rows a task

    share = F.coalesce(F.pmod(F.col(ROW), F.col("__copies")), F.lit(0))
    rows = frame if ROW in frame.columns else numbered(frame, False)
    rows = beside(rows, *keys).withColumn("__share", share.cast("int"))
    copies = F.sequence(F.lit(0), F.coalesce(F.col("__copies") - 1, F.lit(0)))
    copied = beside(lookup, *found).select(*lookup.columns, F.explode(copies).alias("__copy"))
    match.append(F.col("__share") == F.col("__copy"))
    helpers = ["__frequent", "__copies", "__share", "__copy", *found]
    if ROW not in frame.columns:
        helpers.append(ROW)
    joined = rows.join(copied, reduce(and_, match), "left")
    return joined.drop(*helpers)
