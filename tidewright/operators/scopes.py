"""Work lists, yearly measures of services, and composite scores by a function of the caller's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions import numbers as N
from tidewright.operators import windows as W


def _blank(name: str) -> Column:
    return F.trim(F.coalesce(F.col(name).cast("string"), F.lit(""))) == ""


def candidates(packages: DataFrame, classes: list[str] | None = None, without: tuple[str, ...] = (), exclude: Column | None = None) -> DataFrame:
    """Rows with a package name, of these classes if given, whose columns `without` are all blank, and not excluded (such as pseudo-packages)."""
    rows = packages.where(~_blank("package"))
    if classes is not None:
        rows = rows.where(F.trim("value_class").isin(*classes))
    for name in without:
        rows = rows.where(_blank(name))
    return rows if exclude is None else rows.where(~F.coalesce(exclude, F.lit(False)))


def scoped_repos(value: DataFrame, registries: dict[str, str], order: Column, classes: list[str] | None = None, overrides: dict[str, str] | None = None) -> DataFrame:
    """(url, class, ecosystem, registry, package) of value (repo, platform, git_url, class, top_eco, top_eco_pkg).

    The address is git_url, else the repository on GitHub, without .git and closing slashes;
    rows without one, without a package or of an unknown registry go. Of addresses that
    differ in case only, the first by `order` stays. overrides: address to package.
    """
    known = F.create_map(*(F.lit(x) for kv in registries.items() for x in kv))
    git, slug = F.trim(F.coalesce("git_url", F.lit(""))), F.trim(F.coalesce("repo", F.lit("")))
    fallback = F.when((F.lower(F.trim("platform")) == "github") & (slug != ""), F.concat(F.lit("https://github.com/"), slug))
    url = F.regexp_replace(F.regexp_replace(F.coalesce(F.nullif(git, F.lit("")), fallback), r"\.git$", ""), "/+$", "")
    rows = value if classes is None else value.where(F.trim("class").isin(*classes))
    rows = rows.where(~_blank("top_eco_pkg")).select(url.alias("url"), "class", F.trim("top_eco").alias("ecosystem"), F.try_element_at(known, F.trim("top_eco")).alias("registry"), F.trim("top_eco_pkg").alias("package"), order.alias("_order"))
    rows = rows.where("url <> '' AND registry IS NOT NULL")
    kept = ["url", "class", "ecosystem", "registry", "package"]
    best = rows.groupBy(F.lower("url").alias("_key")).agg(F.min(F.struct("_order", *kept)).alias("_b")).select("_b.*").drop("_order")
    if not overrides:
        return best
    renamed = F.create_map(*(F.lit(x) for kv in overrides.items() for x in kv))
    return best.withColumn("package", F.coalesce(F.try_element_at(renamed, F.col("url")), F.col("package")))


def issue_years(targets: DataFrame, issues: DataFrame, key: str, years: list[int]) -> DataFrame:
    """(key, year, opened, closed): issues (key, created, closed) by the year of each date.

    Every year of every target (key, complete) is there, 0 if nothing happened; a
    target whose listing was cut short (complete is not true) has no rows.
    """
    dates = F.array(F.struct(F.lit("opened").alias("what"), F.year("created").alias("year")), F.struct(F.lit("closed").alias("what"), F.year("closed").alias("year")))
    found = issues.select(F.col(key).alias("_k"), F.explode(dates).alias("d")).where(F.col("d.year").isin(*years))
    found = found.groupBy("_k", F.col("d.year").alias("_y")).agg(*(F.sum((F.col("d.what") == w).cast("long")).alias(w) for w in ("opened", "closed")))
    grid = targets.where("complete").select(key).distinct().withColumn("year", F.explode(F.array(*map(F.lit, years))))
    rows = grid.join(found, (F.col(key) == F.col("_k")) & (F.col("year") == F.col("_y")), "left")
    return rows.select(key, "year", *(F.coalesce(w, F.lit(0)).alias(w) for w in ("opened", "closed")))


def yearly_budgets(accounts: DataFrame, key: str, years: list[int]) -> DataFrame:
    """(key, status, raised_<year>..., currency) of accounts (key, json): cents to units without needless decimals; the last year's currency wins.

    No payload is `not_found` with '' everywhere.
    """
    at = lambda path: F.get_json_object("json", path)
    missing = F.col("json").isNull() | (F.trim("json") == "null")

    def money(year: int) -> Column:
        cents = at(f"$.stats.y{year}.valueInCents").cast("long")
        whole = (cents / 100).cast("long").cast("string")
        return F.coalesce(F.when(cents % 100 == 0, whole).otherwise(F.when(cents.isNotNull(), F.format_string("%.2f", cents / 100))), F.lit("")).alias(f"raised_{year}")

    currency = F.coalesce(*(F.nullif(at(f"$.stats.y{y}.currency"), F.lit("")) for y in reversed(years)), at("$.currency"), F.lit(""))
    return accounts.select(key, F.when(missing, "not_found").otherwise("ok").alias("status"), *map(money, years), currency.alias("currency"))


def composite_score(df: DataFrame, specs: dict[str, str], out: str, composite: Callable[..., Column] = N.geometric_mean, neutral: dict[str, float] | None = None) -> DataFrame:
    """Adds `<metric>_p` for each metric (rule `high` or `low`, two decimals) and `out`: composite of these columns, 1 at least.

    composite takes the percentile columns and gives a column (geometric_mean, worst_of or the caller's own).
    neutral: metrics whose missing percentile counts as this value where all others are there.
    """
    names = {m: f"{m}_p" for m in specs}
    rows = W.percentiles(df, {names[m]: (m, rule) for m, rule in specs.items()})
    rows = rows.withColumns({p: F.round(p, 2) for p in names.values()})
    for metric, fill in (neutral or {}).items():
        others = F.lit(True)
        for m, p in names.items():
            others &= F.lit(True) if m == metric else F.col(p).isNotNull()
        rows = rows.withColumn(names[metric], F.when(F.col(names[metric]).isNull() & others, F.lit(float(fill))).otherwise(F.col(names[metric])))
    complete = F.lit(True)
    for p in names.values():
        complete &= F.col(p).isNotNull()
    return rows.withColumn(out, F.when(complete, F.round(F.greatest(F.lit(1.0), composite(*map(F.col, names.values()))), 2)))
