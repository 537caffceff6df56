"""Packages collapsed to repositories: one row with its measures, classes and identity; overrides of the identity afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.funding import github_repo
from tidewright.functions.numbers import value_class
from tidewright.functions.urls import group_key, platform_and_slug
from tidewright.lineage import cut
from tidewright.operators.stats import ln_minmax, pnorm_score
from tidewright.operators.windows import running_sum

ECOSYSTEMS = ("npm", "pypi", "crates", "cpp")


def _text(c: str) -> Column:
    return F.coalesce(F.trim(c), F.lit(""))


def first_known(value: Column, *order: Column) -> Column:
    """Aggregate: the first value by order that is neither NULL nor blank; NULL if there is none."""
    text = F.nullif(F.trim(value), F.lit(""))
    return F.min_by(text, F.when(text.isNotNull(), F.struct(*order)))


def last_known(value: Column, *order: Column) -> Column:
    """Aggregate: the last value by order that is neither NULL nor blank."""
    text = F.nullif(F.trim(value), F.lit(""))
    return F.max_by(text, F.when(text.isNotNull(), F.struct(*order)))


def keyed(packages: DataFrame, ecosystems: tuple[str, ...] = ECOSYSTEMS) -> DataFrame:
    """packages (package, ecosystem, repo_id, git_url, ...) with `group_key` and `ordinal`: by ecosystem, then name."""
    number = F.array_position(F.array(*map(F.lit, ecosystems)), F.col("ecosystem"))
    key = group_key(F.col("repo_id"), F.col("git_url"), F.col("ecosystem"), F.col("package"))
    return packages.withColumns({"group_key": key, "ordinal": F.struct(number.alias("ecosystem"), F.col("package"))})


def sum_of_alias_maxima(rows: DataFrame, keys: list[str], alias_of: str, value: str, out: str) -> DataFrame:
    """(keys, out): names of one thing (alias_of) count once, with the largest of their values; things are added up."""
    return rows.groupBy(*keys, alias_of).agg(F.max(value).alias("_most")).groupBy(*keys).agg(F.sum("_most").alias(out))


def repo_rows(packages: DataFrame, ecosystems: tuple[str, ...] = ECOSYSTEMS) -> DataFrame:
    """One row a repository, or a package without one.

    packages: package, ecosystem, repo_id, git_url, canonical_url, github_repo,
    pagerank. Grouped by repo_id, else git_url, else the package itself.
    Columns: group_key, repo, platform, repo_id, git_url, canonical_url,
    git_valid (NULL, filled later), ecosystems (comma-separated), packages,
    top_eco, top_eco_pkg, top_eco_pct, pr_score, class, class_<ecosystem> ('' where
    absent), openssf_crit, eco_crit, value_score (NULL, filled later).

    Per ecosystem: PageRank sums, cumulative share (ties by key) to class and
    percentile, ln-scaled mass to pr_score. The ecosystem of the greatest
    percentile is the top one, earlier ones first among equals; class is the
    strongest. gh/ ids take the members' slug, gl/ ids the path of the address, other
    groups the slug of a GitHub address, else the members' commonest slug.
    """
    rows = cut(keyed(packages, ecosystems))
    mass = F.coalesce(F.col("pagerank").cast("double"), F.lit(0.0))
    own = rows.groupBy("group_key").agg(
        *(first_known(F.col(c), F.col("ordinal")).alias(c) for c in ("repo_id", "git_url", "canonical_url", "github_repo")), F.count("*").alias("packages"),
    )
    slugs = rows.select("group_key", F.nullif(F.trim("github_repo"), F.lit("")).alias("slug")).where("slug is not null").groupBy("group_key", "slug").agg(F.count("*").alias("n"))
    common = slugs.groupBy("group_key").agg(F.min_by("slug", F.struct((-F.col("n")).alias("n"), "slug")).alias("common"))
    by_eco = cut(rows.where(F.col("ordinal.ecosystem") > 0).groupBy("group_key", "ecosystem").agg(
        F.sum(mass).alias("mass"), F.min_by("package", F.struct((-mass).alias("m"), "package")).alias("top"), F.min("ordinal.ecosystem").alias("number"),
    ))
    ranked = running_sum(by_eco, "mass", [F.desc("mass"), F.col("group_key")], ["ecosystem"])
    share = F.when(F.col("total") > 0, F.col("cum") / F.col("total")).otherwise(0.0)
    ranked = ranked.withColumn("share", share)
    best = F.min_by(F.struct("ecosystem", "top", "share"), F.struct("share", "number"))
    classes = [F.coalesce(F.max(F.when(F.col("ecosystem") == e, value_class(F.col("share")))), F.lit("")).alias(f"class_{e}") for e in ecosystems]
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "ecosystem"))), lambda s: s["ecosystem"]), ",")  # an entry for each ecosystem
    tops = ranked.groupBy("group_key").agg(best.alias("_best"), F.min(value_class(F.col("share"))).alias("class"), listed.alias("ecosystems"), *classes)
    scores = pnorm_score(ln_minmax(by_eco, ["ecosystem"], "mass", "normal"), "group_key", "normal", "pr_score")
    out = own.join(common, "group_key", "left").join(tops, "group_key", "left").join(scores, "group_key", "left")
    url, rid = F.coalesce("git_url", F.lit("")), F.coalesce("repo_id", F.lit(""))
    on_github, on_gitlab = rid.startswith("gh/"), rid.startswith("gl/")
    parsed = platform_and_slug(url)
    slug = F.when(on_github, F.coalesce("github_repo", F.lit(""))).when(~on_gitlab, F.coalesce(F.nullif(github_repo(url), F.lit("")), "common", F.lit(""))).otherwise("")
    named = slug != ""
    repo = F.when(on_github | named, slug).when(url != "", parsed["slug"]).otherwise("")
    platform = F.when(on_github | named, "github").when(on_gitlab, "gitlab").when(url != "", parsed["platform"]).otherwise("")
    git = F.when(on_github & named, F.concat(F.lit("https://github.com/"), slug, F.lit(".git"))).otherwise(url)
    empty = F.lit(None).cast("string")
    return out.select(
        "group_key", repo.alias("repo"), platform.alias("platform"), rid.alias("repo_id"), git.alias("git_url"), F.when(on_gitlab, "").otherwise(F.coalesce("canonical_url", F.lit(""))).alias("canonical_url"),
        empty.alias("git_valid"), "ecosystems", "packages", F.col("_best.ecosystem").alias("top_eco"), F.col("_best.top").alias("top_eco_pkg"), F.round(100.0 - 100.0 * F.col("_best.share"), 4).alias("top_eco_pct"),
        F.round("pr_score", 2).alias("pr_score"), "class", *(f"class_{e}" for e in ecosystems), empty.alias("openssf_crit"), empty.alias("eco_crit"), empty.alias("value_score"),
    )


def valid_overrides(overrides: DataFrame) -> DataFrame:
    """Overrides (package, ecosystem, repo, git_url, canonical_url, valid, reason) that are explained and set something; of a repeated key the last by all columns."""
    text = {c: _text(c) for c in ("package", "ecosystem", "repo", "git_url", "canonical_url", "valid", "reason")}
    rows = overrides.select(*((F.lower(v) if c in ("repo", "git_url") else v).alias(c) for c, v in text.items()))
    rows = rows.where("package <> '' and ecosystem <> '' and reason <> '' and (repo <> '' or git_url <> '' or canonical_url <> '' or valid <> '')")
    whole = F.struct("repo", "git_url", "canonical_url", "valid")
    return rows.groupBy("package", "ecosystem").agg(F.max(whole).alias("o")).select("package", "ecosystem", "o.*")


def _plain(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.coalesce(url, F.lit("")))), "/+$", ""), r"\.git$", "")


def override_identity(repos: DataFrame, packages: DataFrame, overrides: DataFrame, ecosystems: tuple[str, ...] = ECOSYSTEMS) -> DataFrame:
    """repo_rows() with the identity that overrides give to a group with one of their packages (of several, the last in order).

    A slug puts the group on GitHub; another address beside it stays as
    canonical_url, and an id of another platform goes. An address alone becomes
    the group's, platform and name follow from it, and the id survives only if
    a member that has this id came from the same address. What only names a page
    or a verdict changes nothing here.
    """
    members = cut(keyed(packages, ecosystems))
    hit = members.join(valid_overrides(overrides), ["package", "ecosystem"], "left_semi").select("group_key", "package", "ecosystem", "ordinal")
    given = valid_overrides(overrides).select("package", "ecosystem", F.struct("repo", "git_url").alias("o"))
    given = hit.join(given, ["package", "ecosystem"]).groupBy("group_key").agg(F.max_by("o", "ordinal").alias("_o"))
    ids = members.where((_text("repo_id") != "") & (_plain(F.col("git_url")) != "")).groupBy("group_key", _plain(F.col("git_url")).alias("_url")).agg(F.max_by("repo_id", "ordinal").alias("_member_id"))
    rows = repos.join(given, "group_key", "left").withColumn("_url", _plain(F.col("_o.git_url"))).join(ids, ["group_key", "_url"], "left")
    slug, url = F.coalesce("_o.repo", F.lit("")), F.coalesce("_o.git_url", F.lit(""))
    to_slug, to_url = slug != "", (slug == "") & (url != "")
    parsed = platform_and_slug(url)
    changed = {
        "platform": F.when(to_slug, "github").when(to_url, parsed["platform"]).otherwise(F.col("platform")),
        "repo": F.when(to_slug, slug).when(to_url, parsed["slug"]).otherwise(F.col("repo")),
        "git_url": F.when(to_slug, F.concat(F.lit("https://github.com/"), slug, F.lit(".git"))).when(to_url, url).otherwise(F.col("git_url")),
        "canonical_url": F.when(to_slug & (url != "") & ~url.startswith("https://github.com/"), url).otherwise(F.col("canonical_url")),
        "repo_id": F.when(to_slug & ~F.col("repo_id").startswith("gh/"), "").when(to_url, F.coalesce("_member_id", F.lit(""))).otherwise(F.col("repo_id")),
    }
    return rows.withColumns(changed).select(*repos.columns)


def marginals(df: DataFrame, dims: list[str], measures: dict[str, Column]) -> DataFrame:
    """Every combination of the dimensions and all their totals in one pass: `level` says which are summed up (bit set: total), whose columns are NULL."""
    given = df.select("*", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_dim_{c}") for c in dims))
    cube = given.cube(*(f"_dim_{c}" for c in dims)).agg(F.grouping_id().alias("level"), *(m.alias(n) for n, m in measures.items()))
    return cube.select("level", *(F.col(f"_dim_{c}").alias(c) for c in dims), *measures)


def address_bucket(git_url: Column) -> Column:
    """github, gitlab, other or none: where an address lies."""
    url = F.lower(F.trim(F.coalesce(git_url, F.lit(""))))
    return F.when(url == "", "none").when(url.rlike("^https?://(www\\.)?github\\.com/"), "github").when(url.rlike("^https?://[^/]*gitlab[^/]*/"), "gitlab").otherwise("other")
