"""Verdicts on packages and snapshots: end of life, yanks, freshness, completeness, budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.windows import running_sum


def formula_eol(mapping: DataFrame, formulas: DataFrame) -> DataFrame:
    """(project, is_eol, method, reason): over iff every known formula is disabled or deprecated.

    mapping: (project, formula); formulas: (formula, disabled, deprecated, disable_reason, deprecation_reason).
    disabled wins the method; a project without known formulas is alive.
    """
    status = F.when(F.col("disabled"), "disabled").when(F.col("deprecated"), "deprecated").otherwise("alive")
    why = F.when(F.col("disabled"), F.coalesce(F.nullif("disable_reason", F.lit("")), F.lit("disabled"))).otherwise(F.coalesce(F.nullif("deprecation_reason", F.lit("")), F.lit("deprecated")))
    known = mapping.join(formulas, "formula").select("project", "formula", status.alias("status"), F.concat_ws(": ", "formula", why).alias("why"))
    found = known.groupBy("project").agg(
        F.every(F.col("status") != "alive").alias("over"), F.bool_or(F.col("status") == "disabled").alias("hard"), F.array_sort(F.collect_set("why")).alias("why"),
    )
    rows = mapping.select("project").distinct().join(found, "project", "left")
    over = F.coalesce("over", F.lit(False))
    method = F.when(~over, "").when(F.col("hard"), "homebrew_disabled").otherwise("homebrew_deprecated")
    return rows.select("project", over.alias("is_eol"), method.alias("method"), F.when(over, F.substring(F.array_join("why", "; "), 1, 500)).otherwise("").alias("reason"))


def cycles_eol(cycles: DataFrame, today: Column) -> DataFrame:
    """(product, is_eol, reason) of cycles (product, eol as text): the last day of all cycles lies before today.

    A cycle that says `false` keeps the product alive; other values that are no date are left out.
    """
    day = F.when(F.col("eol").rlike(r"^\d{4}-\d\d-\d\d$"), F.col("eol").try_cast("date"))
    found = cycles.groupBy("product").agg(F.bool_or(F.coalesce(F.lower("eol") == "false", F.lit(False))).alias("open"), F.max(day).alias("last"))
    over = ~F.col("open") & F.coalesce(F.col("last") < today, F.lit(False))
    text = F.date_format("last", "yyyy-MM-dd")
    reason = F.when(F.col("open"), "at least one cycle has eol=false").when(F.col("last").isNull(), "no parseable eol dates").otherwise(F.concat(F.lit("max eol="), text, F.when(over, " < today").otherwise("")))
    return found.select("product", over.alias("is_eol"), reason.alias("reason"))


def yank_verdicts(packages: DataFrame, names: DataFrame, defaults: DataFrame, versions: DataFrame) -> DataFrame:
    """(package, is_eol, reason, source) of packages: is the default version yanked?

    names (id, name), defaults (id, version), versions (version, yanked). A default
    version that versions lacks is not yanked; a package without one is not found.
    Only default versions are looked up, and names meet in any case.
    """
    state = defaults.join(versions, "version", "left").select("id", F.coalesce("yanked", F.lit(False)).alias("yanked"))
    index = names.join(state, "id").groupBy(F.lower("name").alias("_name")).agg(F.max_by("yanked", "id").alias("yanked"))
    rows = packages.join(index, F.lower("package") == F.col("_name"), "left")
    known = F.col("yanked").isNotNull()
    reason = F.when(~known, "not in db dump").when(F.col("yanked"), "default version yanked").otherwise("")
    return rows.select("package", F.coalesce("yanked", F.lit(False)).alias("is_eol"), reason.alias("reason"), F.when(known, "db-dump").otherwise("not_found").alias("source"))


def mean_budget(df: DataFrame, prefix: str, out: str) -> DataFrame:
    """Adds the mean of the non-blank columns of that prefix; 0 if there are none. Cents are a matter of formatting."""
    values = F.array_compact(F.array(*(F.trim(F.col(c).cast("string")).try_cast("double") for c in df.columns if c.startswith(prefix))))
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return df.withColumn(out, F.when(F.size(values) > 0, total / F.size(values)).otherwise(0.0))


def money(df: DataFrame, cents: dict[str, str]) -> DataFrame:
    """Adds columns in units for columns in cents (new name to old), two places."""
    return df.withColumns({new: F.round(F.col(old) / 100, 2) for new, old in cents.items()})


def snapshot_done(metrics: DataFrame, keys: list[str], needed: tuple[str, ...], positive: str) -> DataFrame:
    """(keys, done): all needed metrics of (keys, metric, value) are there and the positive one is above 0."""
    there = F.count_distinct(F.when(F.col("metric").isin(*needed) & F.col("value").isNotNull(), F.col("metric"))) == len(needed)
    return metrics.groupBy(*keys).agg((there & F.coalesce(F.bool_or((F.col("metric") == positive) & (F.col("value") > 0)), F.lit(False))).alias("done"))


def freshness(wanted: DataFrame, have: DataFrame, key: str, at: str, cutoff: Column) -> DataFrame:
    """(state, n): how many distinct wanted keys are fresh, stale (older or undated) or missing; a key has its newest row."""
    newest = have.groupBy(F.col(key).alias("_k")).agg(F.max(at).alias("_at"), F.lit(True).alias("_there"))
    rows = wanted.select(key).distinct().join(newest, F.col(key) == F.col("_k"), "left")
    state = F.when(F.col("_there").isNull(), "missing").when(F.col("_at") >= cutoff, "fresh").otherwise("stale")
    return rows.groupBy(state.alias("state")).agg(F.count("*").alias("n"))


def split_done(cache: DataFrame, key: str, status: str, at: str, done: tuple[str, ...], cutoff: Column) -> DataFrame:
    """(key, reuse): a key is reused if one of its rows has a done status and is recent or undated (undated rows never expire)."""
    good = F.col(status).isin(*done) & (F.col(at).isNull() | (F.col(at) >= cutoff))
    return cache.groupBy(key).agg(F.bool_or(F.coalesce(good, F.lit(False))).alias("reuse"))


def bounded_ranges(df: DataFrame, at: str, most: int) -> DataFrame:
    """(lo, hi, n): ranges [lo, hi) of an integer column, together all its values, with at most `most` rows each; a single value may hold more.

    Values are counted, and the running total of the counts is cut every half of
    `most`: what begins within one step makes a range, unless a value alone holds
    over half of `most`, which is a range of its own. Two passes, whatever the
    values are; hi is one above the range's last value.
    """
    step = max(1, most // 2)
    points = df.where(F.col(at).isNotNull()).groupBy(F.col(at).cast("long").alias("x")).agg(F.count("*").alias("n"))
    points = points.withColumn("heavy", (F.col("n") > step).cast("long"))
    placed = running_sum(points, "n", [F.col("x")]).select("x", "n", "heavy", F.col("cum").alias("upto"))
    placed = running_sum(placed, "heavy", [F.col("x")])
    # the count of heavy values up to here parts the light ones before a heavy value from those after it
    part = F.when(F.col("heavy") == 1, F.struct(F.col("cum").alias("a"), F.lit(-1).cast("long").alias("b"))).otherwise(F.struct(F.col("cum").alias("a"), F.floor((F.col("upto") - F.col("n")) / step).alias("b")))
    return placed.groupBy(part.alias("part")).agg(F.min("x").alias("lo"), (F.max("x") + 1).alias("hi"), F.sum("n").alias("n")).select("lo", "hi", "n")


def section_links(pages: DataFrame, key: str, html: str, section: str) -> DataFrame:
    """(key, at, link): distinct links of the sections `<section>...</section>` in order of appearance; one row with a NULL link if there are none.

    Links whose host has no top-level domain are left out; links within a site (no scheme) stay.
    """
    inside = F.array_join(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(rf"(?is)<{section}[ >].*?</{section}>"), F.lit(0)), " ")
    links = F.array_distinct(F.regexp_extract_all(inside, F.lit(r'(?i)<a [^>]*href="([^"]*)"'), F.lit(1)))
    links = F.filter(links, lambda u: ~u.rlike(r"^[a-z]+://") | u.rlike(r"^[a-z]+://[^/]*\.[a-z]"))
    return pages.select(key, F.posexplode_outer(links).alias("at", "link"))
