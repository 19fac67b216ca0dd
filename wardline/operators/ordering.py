"""Running totals, exact quantiles and stratified ranks over whole tables.

A window without partitions would pull a table into one task. Here the order key
is cut into buckets of near-equal size first: totals run inside each bucket, and
the bucket totals (one small row per bucket) are accumulated and joined back.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.operators.store import materialize

BUCKETS = 128
BUCKET_ERROR = 0.001
QUANTILE_ERROR = 0.0005
RANK_HASH_DIGITS = 3  # 16**3 buckets of hash prefixes per stratum


def _bucket_of(key: str, bounds: Sequence[float]) -> Column:
    """Number of bounds below the key: a balanced tree of comparisons, depth log2(n)."""

    def split(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        test = f"`{key}` <= CAST('{float(bounds[middle])!r}' AS DOUBLE)"
        return f"CASE WHEN {test} THEN {split(low, middle)} ELSE {split(middle + 1, high)} END"

    return F.expr(split(0, len(bounds)))


def running_totals(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    ascending: bool = True,
    buckets: int = BUCKETS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Inclusive running totals of ``columns`` in the order of numeric ``key``, per ``by``.

    Adds ``run_<column>``. ``df`` must already have one row per key (and ``by``), so a
    value shared by very many source rows is a single row here. The bucket bounds only
    balance the work; the totals are exact whatever they are.
    """
    steps = [i / buckets for i in range(1, buckets)]
    bounds = sorted(set(df.approxQuantile(key, steps, BUCKET_ERROR))) if steps else []
    cut = df.withColumn("_bucket", _bucket_of(key, bounds))
    group = [*by, "_bucket"]

    order = F.col(key).asc() if ascending else F.col(key).desc()
    inside = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({f"run_{c}": F.sum(c).over(inside) for c in columns})

    # One row per bucket (at most `buckets` per `by` group): this window is bounded.
    step = F.col("_bucket").asc() if ascending else F.col("_bucket").desc()
    before = Window.partitionBy(*by).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*group)
        .agg(*[F.sum(c).alias(f"sum_{c}") for c in columns])
        .select(*group, *[F.coalesce(F.sum(f"sum_{c}").over(before), F.lit(0)).alias(f"off_{c}") for c in columns])
    )
    totals = {f"run_{c}": F.col(f"run_{c}") + F.col(f"off_{c}") for c in columns}
    return local.join(F.broadcast(offsets), group).withColumns(totals).drop("_bucket", *[f"off_{c}" for c in columns])


def quantile_table(df: DataFrame, column: str, fraction: float) -> DataFrame:
    """Exact linear-interpolated quantile as one row (``value``, null when empty).

    A sketch brackets the quantile, and the ranks at the bracket's edges are counted. Until
    both neighbours of the quantile provably lie inside, the bracket is doubled; up to the
    whole range, so the result is exact at every size. Values inside (a fraction of a
    per cent of large tables) are grouped, written and ranked.
    """
    values = df.select(F.col(column).cast("double").alias("value")).where(F.col("value").isNotNull())
    width = 2 * QUANTILE_ERROR
    while True:
        probes = [max(fraction - width, 0.0), min(fraction + width, 1.0)]
        error = 0.0 if probes == [0.0, 1.0] else QUANTILE_ERROR
        bracket = values.approxQuantile("value", probes, error)
        if not bracket:
            return values.agg(F.max("value").alias("value"))
        low, high = bracket
        side = F.when(F.col("value") < low, -1).when(F.col("value") > high, 1).otherwise(0)
        inside = F.when(F.col("value").between(low, high), F.col("value"))
        counts = materialize(
            values.groupBy(side.alias("side"), inside.alias("value")).agg(F.count("*").alias("n_value")), "quantile"
        )
        of_side = [F.coalesce(F.sum(F.when(F.col("side") == s, F.col("n_value"))), F.lit(0)) for s in (-1, 0)]
        total, below, held = counts.agg(F.sum("n_value"), *of_side).first()
        position = fraction * (total - 1)
        if below <= math.floor(position) and math.ceil(position) < below + held or probes == [0.0, 1.0]:
            break
        width *= 8
    ranked = running_totals(counts.where("side = 0"), "value", ["n_value"])
    # `last` is the zero-based rank of the last copy of a value.
    last = F.lit(below) + F.col("run_n_value") - 1
    ends = ranked.agg(
        F.min(F.when(last >= math.floor(position), F.col("value"))).alias("lower"),
        F.min(F.when(last >= math.ceil(position), F.col("value"))).alias("upper"),
    )
    share = F.lit(position - math.floor(position))
    return ends.select((F.col("lower") + (F.col("upper") - F.col("lower")) * share).alias("value"))


def grouped_quantile(df: DataFrame, keys: Sequence[str], column: str, fraction: float) -> DataFrame:
    """Exact linear-interpolated quantile of each group: the keys and ``value``.

    Two passes over the rows for all groups together. Sketches bracket each group's quantile
    further apart than their error; then the rows below are counted, and the values inside
    (some of a per mille of a large group) are grouped and ranked. A group without values has
    a null.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(column).cast("double").alias("value"))
    accuracy = round(1 / QUANTILE_ERROR)
    probes = [max(fraction - 2 * QUANTILE_ERROR, 0.0), min(fraction + 2 * QUANTILE_ERROR, 1.0)]
    sketched = F.percentile_approx("value", probes, accuracy)
    brackets = rows.groupBy(*keys).agg(F.count("value").alias("n"), sketched.alias("probed"))
    position = F.lit(fraction) * (F.col("n") - 1)
    # A bracket is open at the ends of the order, and where so few rows lie between its
    # probes that rounding of ranks could matter.
    many = F.col("n") >= 10 * accuracy
    low = F.when(many & (F.lit(probes[0]) > 0), F.get("probed", 0)).otherwise(F.lit(float("-inf")))
    high = F.when(many & (F.lit(probes[1]) < 1), F.get("probed", 1)).otherwise(F.lit(float("inf")))
    brackets = brackets.select(*[F.col(k).alias(f"k_{k}") for k in keys], "n", position.alias("at"), low.alias("low"), high.alias("high"))
    brackets = materialize(brackets, "quantile-brackets")
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"k_{k}")) for k in keys])
    placed = rows.where("value IS NOT NULL").join(brackets, same).where("value <= high")
    inside = F.when(F.col("value") >= F.col("low"), F.col("value"))
    counted = placed.groupBy(*[f"k_{k}" for k in keys], "at", inside.alias("value")).agg(F.count("*").alias("copies"))
    # Nulls are the rows below the bracket: they come first.
    order = Window.partitionBy(*[f"k_{k}" for k in keys]).orderBy(F.col("value").asc_nulls_first())
    ranked = counted.withColumn("last", F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    ends = ranked.groupBy(*[f"k_{k}" for k in keys], "at").agg(
        F.min(F.when(F.col("last") >= F.floor("at"), F.col("value"))).alias("lower"),
        F.min(F.when(F.col("last") >= F.ceil("at"), F.col("value"))).alias("upper"),
    )
    value = F.col("lower") + (F.col("upper") - F.col("lower")) * (F.col("at") - F.floor("at"))
    found = ends.select(*[F.col(f"k_{k}").alias(f"e_{k}") for k in keys], value.alias("value"))
    again = reduce(lambda x, y: x & y, [F.col(f"k_{k}").eqNullSafe(F.col(f"e_{k}")) for k in keys])
    return brackets.join(found, again, "left").select(*[F.col(f"k_{k}").alias(k) for k in keys], "value")


def exact_quantile(df: DataFrame, column: str, fraction: float) -> float | None:
    """The quantile as a number: a fitted constant (one row leaves the executors)."""
    return quantile_table(df, column, fraction).first()[0]


def seeded_hash(key: str, seed: int) -> Column:
    """Repeatable pseudo-random text per key, evenly spread over hex digits."""
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def stratified_rank(df: DataFrame, stratum: str, key: str, seed: int) -> DataFrame:
    """Add ``stratum_rank`` (1-based, in hash order) and ``stratum_size``.

    Ranks run inside (stratum, hash prefix) groups, which are even because keys are
    unique; a stratum with most of the rows is spread over 4096 groups. The group
    offsets join on the same two columns, so the rows are shuffled once.
    """
    hashed = df.withColumns(
        {"_hash": seeded_hash(key, seed), "_stratum": F.coalesce(F.col(stratum).cast("string"), F.lit(""))}
    ).withColumn("_prefix", F.substring("_hash", 1, RANK_HASH_DIGITS))
    # At most 4096 rows per stratum, so this window is bounded.
    before = Window.partitionBy("_stratum").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        hashed.groupBy("_stratum", "_prefix")
        .agg(F.count("*").alias("_n"))
        .select(
            "_stratum",
            "_prefix",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
            F.sum("_n").over(Window.partitionBy("_stratum")).alias("stratum_size"),
        )
    )
    inside = Window.partitionBy("_stratum", "_prefix").orderBy("_hash", key)
    ranked = hashed.withColumn("_local", F.row_number().over(inside))
    return (
        ranked.join(sizes, ["_stratum", "_prefix"])
        .withColumn("stratum_rank", F.col("_offset") + F.col("_local"))
        .drop("_hash", "_prefix", "_local", "_offset", "_stratum")
    )
