"""Percentiles, cumulative shares, ranks and picks.

Running totals don't use a window over all rows of a table or of a key, which
would put them into one task: rows are dealt into ranges of the whole order
(key, value, tie), so that equal values and large keys are cut too; ranges are
totalled, and windows run inside a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.lineage import cut


def running_sum(df: DataFrame, amount: str, order: list[Column], partition: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """Adds `cum` (total of amount over the rows down to this one), `place`, and the partition's `total` and `rows`.

    The order should be total, or equal rows get any of their places.
    """
    keys = partition or []
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cut(cut(df).repartitionByRange(n, *map(F.col, keys), *order).withColumn("_range", F.spark_partition_id()))
    sums = rows.groupBy(*keys, "_range").agg(F.sum(amount).alias("_sum"), F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    whole = Window.partitionBy(*keys)
    sums = sums.select(
        *(F.col(k).alias(f"_key_{k}") for k in keys), F.col("_range").alias("_r"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_place"), F.sum("_sum").over(whole).alias("total"), F.sum("_n").over(whole).alias("rows"),
    )
    same = F.col("_range") == F.col("_r")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    rows = rows.join(F.broadcast(sums) if not keys else sums, same)  # without keys: a row a range
    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    rows = rows.withColumns({"cum": F.col("_before") + F.sum(amount).over(inside.rowsBetween(Window.unboundedPreceding, 0)), "place": F.col("_place") + F.row_number().over(inside)})
    return rows.drop("_range", "_r", "_before", "_place", *(f"_key_{k}" for k in keys))


def running_total(df: DataFrame, value: str, tie: str, partition: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """running_sum() of value, largest first, ties by name."""
    return running_sum(df, value, [F.desc(value), F.col(tie)], partition, ranges)


def tied(rows: DataFrame, value: str, partition: list[str] | None = None) -> DataFrame:
    """Adds `cum_tied` to running_total()'s rows: equal values share the total after the last of them."""
    keys = [*(partition or []), value]
    last = rows.groupBy(*(F.col(k).alias(f"_t_{k}") for k in keys)).agg(F.max("cum").alias("cum_tied"))
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_t_{k}"))
    return rows.join(last, same, "left").drop(*(f"_t_{k}" for k in keys))


def percentiles(df: DataFrame, specs: dict[str, tuple[str, str]], floor: float = 0.0, anchor: float = 50.0) -> DataFrame:
    """Adds a column for each of specs (name to (value column, rule)).

    `high` and `low`: 100 times the share of rows that are no worse, higher or
    lower values being worse; NULL values and constant columns have none.
    `floor`: anchor up to the floor; above it, spread to 100 by rank among the
    values above. df is computed once; all columns are counted by distinct value
    and ranked together.
    """
    rows = cut(df)
    x = {}
    for name, (value, rule) in specs.items():
        v = F.col(value).cast("double")
        x[name] = {"high": v, "low": -v, "floor": F.when(v > floor, v)}[rule]
    long = rows.select(F.explode(F.array(*(F.struct(F.lit(name).alias("_metric"), c.alias("_x")) for name, c in x.items()))).alias("_e")).select("_e.*")
    counts = long.where(F.col("_x").isNotNull()).groupBy("_metric", "_x").agg(F.count("*").alias("_n"))
    ranked = running_sum(counts, "_n", [F.col("_x")], ["_metric"])
    ranked = cut(ranked.select("_metric", "_x", "rows", (F.col("cum") / F.col("total")).alias("_share")))
    for name, (value, rule) in specs.items():
        mine = ranked.where(F.col("_metric") == name).select(F.col("_x").alias("_v"), (100.0 * F.col("_share")).alias("_p"), F.col("rows").alias("_kinds"))
        rows = rows.join(mine, x[name] == F.col("_v"), "left")
        spread = F.when(F.col(value) <= floor, anchor).otherwise(anchor + (100.0 - anchor) / 100.0 * F.col("_p")) if rule == "floor" else F.when(F.col("_kinds") > 1, F.col("_p"))
        rows = rows.withColumn(name, spread).drop("_v", "_p", "_kinds")
    return rows


def risk_percentile(df: DataFrame, value: str, out: str, higher_is_worse: bool = True) -> DataFrame:
    """percentiles() of one column."""
    return percentiles(df, {out: (value, "high" if higher_is_worse else "low")})


def floor_anchored(df: DataFrame, value: str, out: str, floor: float = 0.0, anchor: float = 50.0) -> DataFrame:
    """percentiles() of one column by the rule `floor`."""
    return percentiles(df, {out: (value, "floor")}, floor, anchor)


def top_share_tied(df: DataFrame, value: str, tie: str, share: float) -> DataFrame:
    """Rows whose value is at least that of the row where the running total first reaches the share."""
    rows = running_total(df, value, tie)
    cutoff = rows.where(F.col("cum") >= share * F.col("total")).agg(F.coalesce(F.max(value), F.lit(0)).alias("_cut"))
    return rows.crossJoin(F.broadcast(cutoff)).where(F.col(value) >= F.col("_cut")).drop("_cut", "cum", "place", "total", "rows")


def top_share_index(df: DataFrame, value: str, tie: str, share: float) -> DataFrame:
    """Rows before and at the place where the running total reaches the share; ties are cut by name."""
    rows = running_total(df, value, tie)
    return rows.where(F.col("cum") - F.col(value) < share * F.col("total")).drop("cum", "place", "total", "rows")


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row a key: the first by order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def bus_factor_rows(df: DataFrame, group: str, member: str, commits: str) -> DataFrame:
    """Adds `before` (commits of larger members), `total` and `share` within the group."""
    w = Window.partitionBy(group).orderBy(F.desc(commits), F.col(member)).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum(commits).over(Window.partitionBy(group))
    return df.withColumns({"before": F.coalesce(F.sum(commits).over(w), F.lit(0)), "total": total, "share": F.col(commits) / total})
