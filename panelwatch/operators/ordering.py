"""Ordered computations that stay parallel: running totals, ranks, quantiles, top-k.

A window without a partition key sorts everything in one task. The functions here
split the order first. Cut points come from ``percentile_approx`` (a sketch
merged on the map side, so no row is shuffled for it); they only balance the work,
the results are exact whatever they are. Each bucket keeps its own running total,
and the at most ``2**bits`` bucket totals per key are added as offsets. Buckets and
salts follow the session's shuffle parallelism.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwatch.session import cut_lineage

MIN_BITS, MAX_BITS = 6, 10
MAX_SALTS, MAX_JOIN_SALTS = 256, 64


def shuffle_partitions(df: DataFrame) -> int:
    """The session's reduce-side parallelism, by which work is split here."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bucket_bits(df: DataFrame) -> int:
    """Twice as many buckets as shuffle partitions, between 64 and 1024."""
    return max(MIN_BITS, min(MAX_BITS, (2 * shuffle_partitions(df) - 1).bit_length()))


def _cut_points(value: str, bits: int) -> Column:
    # One parsed expression: hundreds of literals made one by one would slow planning.
    fractions = ", ".join(f"{i / 2**bits!r}D" for i in range(1, 2**bits))
    return F.expr(
        f"percentile_approx(cast(`{value}` as double), array({fractions}), {10 * 2**bits})"
    )


def _bucket(value: Column, cuts: Column, bits: int) -> Column:
    """Number of cut points below the value, by binary search over the sorted array.

    Declared as never null (it isn't): joins on it would otherwise filter on it below the sums,
    and the input would be evaluated once more for that branch.
    """
    steps = F.array(*[F.lit(2**i) for i in reversed(range(bits))])
    number = value.cast("double")
    found = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(cuts, at + step - F.lit(1)) < number, at + step).otherwise(
            at
        ),
    )
    return F.coalesce(found, F.lit(0))


def with_bucket(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    bits: int | None = None,
    name: str = "_bucket",
    sample: DataFrame | None = None,
) -> DataFrame:
    """Adds a bucket number that grows with ``value``, about equally filled within each key.

    The cuts are those of ``sample`` if given, else of ``df``: one row for each key, joined
    as Spark sees fit, since keys may be many.
    """
    bits = bits or bucket_bits(df)
    source = df if sample is None else sample
    if keys:
        cuts = source.groupBy(*keys).agg(_cut_points(value, bits).alias("_cuts"))
        df = df.join(cuts, list(keys), "left")
    else:
        df = df.withColumn("_cuts", source.agg(_cut_points(value, bits)).scalar())
    return df.withColumn(name, _bucket(F.col(value), F.col("_cuts"), bits)).drop("_cuts")


def cumulative_by_value(
    df: DataFrame,
    value: str,
    sums: Sequence[str],
    keys: Sequence[str] = (),
    bits: int | None = None,
) -> DataFrame:
    """One row per distinct ``(keys, value)``: sums, running sums upwards, and totals.

    For each column ``c`` of ``sums`` the result has ``c`` (at this value),
    ``c_cum`` (up to and including it) and ``c_total`` (of the key). Equal values are
    merged with map-side partial sums, so ties of any size cost nothing.
    """
    keys = list(keys)
    merged = df.groupBy(*keys, value).agg(*[F.sum(c).alias(c) for c in sums])
    # Looking at every sum keeps this branch on the very exchange the others read,
    # so that the input is evaluated once.
    same = merged.where(F.coalesce(*[F.col(c).cast("double") for c in sums]).isNotNull())
    bucketed = with_bucket(merged, value, keys, bits, sample=same)
    per_bucket = bucketed.groupBy(*keys, "_bucket").agg(*[F.sum(c).alias(c) for c in sums])
    # The frames below hold at most 2**bits rows per key.
    earlier = (
        Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*keys)
    offsets = per_bucket.select(
        *keys,
        "_bucket",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}_before") for c in sums],
        *[F.sum(c).over(whole).alias(f"{c}_total") for c in sums],
    )
    upto = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Without keys the offsets are 2**bits rows, a proven bound; keys may be many.
    offsets = offsets if keys else F.broadcast(offsets)
    return bucketed.join(offsets, [*keys, "_bucket"]).select(
        *keys,
        value,
        *sums,
        *[(F.col(f"_{c}_before") + F.sum(c).over(upto)).alias(f"{c}_cum") for c in sums],
        *[f"{c}_total" for c in sums],
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: dict[str, float],
    keys: Sequence[str] = (),
    bits: int | None = None,
) -> DataFrame:
    """Exact linearly interpolated quantiles (nulls skipped), one row per key.

    Unlike ``percentile`` no reducer holds all distinct values of a group.
    """
    keys = list(keys)
    ones = df.where(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("_v"), F.lit(1).alias("_n")
    )
    runs = cumulative_by_value(ones, "_v", ["_n"], keys, bits)
    first, last = F.col("_n_cum") - F.col("_n"), F.col("_n_cum") - 1
    aggregates = []
    for name, q in quantiles.items():
        place = F.lit(float(q)) * (F.col("_n_total") - 1)
        low, high = F.floor(place), F.ceil(place)
        aggregates += [
            F.max(F.when(low.between(first, last), F.col("_v"))).alias(f"_lo_{name}"),
            F.max(F.when(high.between(first, last), F.col("_v"))).alias(f"_hi_{name}"),
            F.max(place - low).alias(f"_w_{name}"),
        ]
    rows = runs.groupBy(*keys).agg(*aggregates) if keys else runs.agg(*aggregates)
    return rows.select(
        *keys,
        *[
            (
                F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")
            ).alias(n)
            for n in quantiles
        ],
    )


def average_ranks(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct ``(keys, value)`` with its count and average rank (ties share one rank)."""
    ones = df.where(F.col(value).isNotNull()).select(*keys, value, F.lit(1).alias("n_rows"))
    runs = cumulative_by_value(ones, value, ["n_rows"], keys)
    rank = F.col("n_rows_cum") - (F.col("n_rows") - 1) / F.lit(2.0)
    return runs.select(*keys, value, "n_rows", rank.alias("avg_rank"))


def with_global_rank(
    df: DataFrame, value: str, tie: str, descending: bool = True, name: str = "rank"
) -> DataFrame:
    """Position 1..n of every row by ``value`` and then ``tie`` upwards, without one big sort.

    Rows with one value are split further by buckets of the tie-break, so a value
    shared by a third of all rows is numbered by many tasks. The rows are needed
    three times (cuts, counts, numbering) and are therefore stored first.
    """
    rows = with_bucket(cut_lineage(df), tie, name="_part")
    counts = rows.groupBy(value, "_part").agg(F.count(F.lit(1)).alias("_n"))
    runs = cumulative_by_value(counts, value, ["_n"])
    before = (
        F.col("_n_total") - F.col("_n_cum") if descending else F.col("_n_cum") - F.col("_n")
    )
    within = (
        Window.partitionBy(value).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.join(runs.select(value, before.alias("_before")), value).select(
        value,
        "_part",
        (F.col("_before") + F.coalesce(F.sum("_n").over(within), F.lit(0))).alias("_offset"),
    )
    local = Window.partitionBy(value, "_part").orderBy(tie)
    return (
        rows.withColumn("_local", F.row_number().over(local))
        .join(offsets, [value, "_part"])
        .withColumn(name, (F.col("_offset") + F.col("_local")).cast("bigint"))
        .drop("_part", "_local", "_offset")
    )


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int | Column,
    salt_on: Sequence[str],
    salts: int | None = None,
    name: str = "rank",
) -> DataFrame:
    """First ``k`` rows of each group in a total order, with their position.

    A hot group is first cut to ``k`` rows within each of ``salts`` slices; only
    those ``k * salts`` rows meet in one task.
    """
    salts = salts or min(MAX_SALTS, shuffle_partitions(df))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)))
    slices = Window.partitionBy(*group, "_salt").orderBy(*order)
    groups = Window.partitionBy(*group).orderBy(*order)
    return (
        salted.withColumn(name, F.row_number().over(slices))
        .where(F.col(name) <= k)
        .drop("_salt")
        .withColumn(name, F.row_number().over(groups))
        .where(F.col(name) <= k)
    )


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    salt_on: Sequence[str],
    how: str = "inner",
    salts: int | None = None,
) -> DataFrame:
    """Equi-join of many rows to a smaller lookup where one key may hold most rows.

    No side is forced to broadcast: Spark does so when the measured size allows it.
    Otherwise the rows of a hot key are spread over ``salts`` tasks, to each of which
    the lookup row is copied.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins keep one copy of each left row")
    salts = salts or min(MAX_JOIN_SALTS, shuffle_partitions(rows))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = rows.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int"))
    return spread.join(copies, [*on, "_salt"], how).drop("_salt")
