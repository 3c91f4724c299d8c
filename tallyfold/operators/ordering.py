"""Exact order statistics and numbering without a single sorting task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.hashing import stable_bucket


def running_totals(counted: DataFrame, groups: list[str], value: str, measures: list[str],
                   levels: list[Column]) -> DataFrame:
    """Adds ``before_<measure>``: the group's sum over all smaller values.

    ``counted`` has one row per (group, value). ``levels`` are expressions that
    never decrease with the value, coarse to fine; each level is summed up and
    accumulated on its own, so no window sees more rows than there are distinct
    entries of one level below one entry of the level above.
    """
    names = [f"_l{i}" for i in range(len(levels))]
    base = counted.withColumns(dict(zip(names, levels)))
    df = base
    back = Window.unboundedPreceding, -1
    for depth in range(len(names) + 1):
        above = groups + names[:depth]
        here = names[depth] if depth < len(names) else value
        by = Window.partitionBy(*above).orderBy(here).rowsBetween(*back)
        if depth == len(names):
            df = df.withColumns({
                f"_b{depth}_{m}": F.coalesce(F.sum(m).over(by), F.lit(0)) for m in measures})
            continue
        sums = base.groupBy(*above, here).agg(*[F.sum(m).alias(m) for m in measures])
        offsets = sums.select(*above, here, *[
            F.coalesce(F.sum(m).over(by), F.lit(0)).alias(f"_b{depth}_{m}") for m in measures])
        df = df.join(offsets, above + [here])
    total = {f"before_{m}": sum((F.col(f"_b{d}_{m}") for d in range(1, len(names) + 1)),
                                F.col(f"_b0_{m}")) for m in measures}
    return df.withColumns(total).select(*counted.columns, *total)


def count_levels(value: str) -> list[Column]:
    """Levels for whole numbers: blocks of 2^20, so a window stays below 2^20 rows
    for values up to 2^40."""
    return [F.shiftright(F.col(value).cast("bigint"), 20)]


def unit_levels(value: str) -> list[Column]:
    """Levels for numbers in [0, 1]: steps of 2^-16 and 2^-32."""
    return [F.floor(F.col(value) * 65536.0), F.floor(F.col(value) * 4294967296.0)]


def upper_quartile(df: DataFrame, group: str, value: str, alias: str = "p75") -> DataFrame:
    """Per group the exclusive 75th percentile of a whole-number column.

    With n values and m = 3(n + 1) the cut lies between the j-th and the next
    value, j = floor(m / 4) kept within 1..n-1, weighted by the remainder; with
    fewer than four values it is the largest. Values are counted first, so ties
    travel once and no group is gathered. Null values are not counted, so a group of nulls
    only has no cut.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_totals(counted, [group], value, ["_n"], count_levels(value))
    sizes = counted.groupBy(group).agg(F.sum("_n").alias("_size"), F.max(value).alias("_top"))
    n = F.col("_size")
    j = F.greatest(F.lit(1), F.least(F.floor((n + 1) * 3 / F.lit(4)), n - 1))
    first, last = F.col("before__n") + 1, F.col("before__n") + F.col("_n")
    cut = placed.join(sizes, group).withColumn("_j", j)

    def at(rank):
        return F.max(F.when(rank.between(first, last), F.col(value)))

    picked = cut.groupBy(group).agg(
        F.max("_size").alias("_size"), F.max("_top").alias("_top"), F.max("_j").alias("_j"),
        at(F.col("_j")).alias("_low"), at(F.col("_j") + 1).alias("_high"))
    delta = (F.col("_size") + 1) * 3 - F.col("_j") * 4
    between = (F.col("_low") * (4 - delta) + F.col("_high") * delta).cast("double") / 4
    return picked.select(group, F.when(n < 4, F.col("_top").cast("double"))
                         .otherwise(between).alias(alias))


def approx_upper_quartile(df: DataFrame, group: str, value: str, alias: str = "p75",
                          accuracy: int = 10000) -> DataFrame:
    """Sketch-based 75th percentile per group, one shuffle of sketches."""
    return df.groupBy(group).agg(
        F.percentile_approx(value, 0.75, accuracy).cast("double").alias(alias))


def percent_ranks(df: DataFrame, group: str, value: str, copies: str | None = None) -> DataFrame:
    """Percent rank of every distinct whole-number value within its group.

    Equal to ``percent_rank()`` over the rows, but only counts are ordered. ``copies`` names a
    column that says how many rows a row stands for.
    """
    number = F.count(F.lit(1)) if copies is None else F.sum(copies)
    counted = df.groupBy(group, value).agg(number.alias("_n"))
    placed = running_totals(counted, [group], value, ["_n"], count_levels(value))
    sizes = counted.groupBy(group).agg(F.sum("_n").alias("_size"))
    rank = F.try_divide(F.col("before__n").cast("double"), (F.col("_size") - 1).cast("double"))
    return placed.join(sizes, group).select(
        group, value, F.coalesce(rank, F.lit(0.0)).alias("percent_rank"))


def top_within(df: DataFrame, groups: list[str], order: list, k: int,
               rank: str = "rank") -> DataFrame:
    """First ``k`` rows of every group, pre-limited before the shuffle."""
    by = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(by)).filter(F.col(rank) <= k)


def number_rows(df: DataFrame, key: list[str], alias: str = "n", start: int = 1,
                buckets: int = 4096) -> DataFrame:
    """Gapless numbers for rows with a unique key.

    Rows are ordered by (hash bucket of the key, key). Buckets spread evenly
    because keys are unique; only their counts pass through one small window.
    """
    hashed = df.withColumn("_bucket", stable_bucket(buckets, *[F.col(k) for k in key]))
    by_bucket = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # At most `buckets` rows reach the unpartitioned window and the broadcast.
    offsets = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size")).select(
        "_bucket", F.coalesce(F.sum("_size").over(by_bucket), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(*key))
    return (hashed.withColumn("_within", within)
            .join(F.broadcast(offsets), "_bucket")
            .withColumn(alias, F.col("_offset") + F.col("_within") + F.lit(start - 1))
            .drop("_bucket", "_within", "_offset"))


def number_in_order(df: DataFrame, order: list[str], alias: str, path: str, start: int = 0) -> tuple[DataFrame, int]:
    """Rows with gapless numbers along ``order`` (nulls first), and how many there are.

    Rows are sorted by ranges and written to ``path``; each range's count is one row of the only window, and
    a row's number is its place in its range and the counts before. Equal rows may change places.
    """
    spark = df.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in order]
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns(
        {"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path)
    # One row per task of the write reaches the driver, the window and the broadcast.
    counts = rows.groupBy("_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_size")).orderBy("_range").collect()
    offsets, total = [], start
    for r in counts:
        offsets.append((r["_range"], total - r["_first"]))
        total += r["_size"]
    shifts = F.broadcast(spark.createDataFrame(offsets, "_range int, _shift long"))
    numbered = rows.join(shifts, "_range").withColumn(alias, F.col("_at") + F.col("_shift"))
    return numbered.select(*df.columns, alias), total - start


def equal_chunks(df: DataFrame, entity: list[str], at: str, size: int, alias: str = "chunk") -> DataFrame:
    """Rows with a chunk number that grows along the timestamp ``at``, about ``size`` rows to a chunk, per entity.

    A histogram of two levels, days and minutes, over counts per moment tells how many of the entity's rows come before each
    one, and the chunk is that number over ``size``. Only counts are ordered, a minute of one entity at most in a window, so an
    entity with a third of all rows on one day is cut like any other. Rows of the same moment stay together; null moments
    are in the first chunk.
    """
    micros = F.coalesce(F.unix_micros(F.col(at).cast("timestamp")), F.lit(-(1 << 62)))
    keyed = df.withColumn("_at", micros)
    counted = keyed.groupBy(*entity, "_at").agg(F.count(F.lit(1)).alias("_rows"))
    day, minute = 86_400_000_000, 60_000_000
    placed = running_totals(counted, entity, "_at", ["_rows"], [
        F.floor(F.col("_at") / day).cast("long"), F.floor(F.col("_at") / minute).cast("long")])
    names = [f"_e{i}" for i in range(len(entity))]
    placed = placed.select(*[F.col(c).alias(n) for c, n in zip(entity, names)], F.col("_at").alias("_moment"),
                           F.floor(F.col("before__rows") / size).cast("long").alias(alias))
    same = F.col("_at") == F.col("_moment")
    for c, n in zip(entity, names):
        same = same & F.col(c).eqNullSafe(F.col(n))
    return keyed.join(placed, same).drop("_at", "_moment", *names)


def trailing_rows(df: DataFrame, entity: list[str], order: list[str], chunk: Column, size: int,
                  aggregates: dict[str, tuple[str, str]]) -> DataFrame:
    """Aggregates over each row and the ``size - 1`` rows before it, per entity.

    A busy entity is split by ``chunk``, an expression that never decreases
    along ``order``. Every chunk is given the rows its first windows reach back
    to: the tails of earlier chunks, of which ``size - 1`` always suffice.
    ``aggregates`` maps an output name to (function name, column).
    """
    reach = size - 1
    base = df.withColumn("_chunk", chunk)
    needed = [c for c in dict.fromkeys(order + [c for _, c in aggregates.values()])
              if c not in entity]
    latest = Window.partitionBy(*entity, "_chunk").orderBy(*[F.col(c).desc() for c in order])
    row = F.struct(*needed)
    # One array of at most `reach` rows per (entity, chunk).
    tails = (base.select(*entity, "_chunk", *needed)
             .withColumn("_back", F.row_number().over(latest)).filter(F.col("_back") <= reach)
             .groupBy(*entity, "_chunk").agg(F.sort_array(F.collect_list(row)).alias("_tail")))
    earlier = Window.partitionBy(*entity).orderBy("_chunk").rowsBetween(-reach, -1)
    carried = (tails.select(*entity, "_chunk", F.flatten(
                   F.collect_list("_tail").over(earlier)).alias("_rows"))
               .select(*entity, "_chunk", F.explode(F.slice(
                   "_rows", F.greatest(F.lit(1), F.size("_rows") - reach + 1), reach)).alias("_r"))
               .select(*entity, "_chunk", "_r.*"))
    stacked = base.withColumn("_own", F.lit(True)).unionByName(
        carried.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    window = (Window.partitionBy(*entity, "_chunk").orderBy(*order).rowsBetween(-reach, 0))
    out = stacked.withColumns({
        name: getattr(F, fn)(F.col(c)).over(window) for name, (fn, c) in aggregates.items()})
    return out.filter("_own").drop("_own", "_chunk")
