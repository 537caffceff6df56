"""Which repository a row belongs to: validity, authority, and stamping of stable ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.funding import github_repo
from tidewright.functions.urls import HOST_PRIORITY, classify_url, host_of, path_parts

#: Sources of addresses, strongest first.
SOURCES = ("eco_strong", "prior", "eco_weak")


def mark_invalid(df: DataFrame, url: str, bad_urls: DataFrame, bad_slugs: DataFrame, out: str = "invalid") -> DataFrame:
    """Adds whether an address is known to be invalid: itself (bad_urls.url) or its GitHub slug (bad_slugs.slug, any case)."""
    urls = bad_urls.select(F.trim("url").alias("_bad")).where("_bad != ''").distinct().withColumn("_u", F.lit(True))
    slugs = bad_slugs.select(F.lower(F.trim("slug")).alias("_bad_slug")).where("_bad_slug != ''").distinct().withColumn("_s", F.lit(True))
    rows = df.join(urls, F.col(url) == F.col("_bad"), "left").join(slugs, github_repo(F.col(url)) == F.col("_bad_slug"), "left")
    return rows.withColumn(out, F.coalesce("_u", "_s", F.lit(False))).drop("_bad", "_bad_slug", "_u", "_s")


def resolve_authority(rows: DataFrame, key: str, bad_urls: DataFrame, bad_slugs: DataFrame) -> DataFrame:
    """(key, git, github, via) of rows (key, strong and weak: arrays of addresses, prior_git, prior_slug, and what
    people have fixed: fixed_slug, fixed_git, fixed_page).

    Each platform takes its first valid address by source (its first, if all are
    invalid); the platform of highest priority gives `git`. A fixed slug replaces
    the GitHub address; a fixed address replaces all; a fixed page without git
    leaves none. github is the slug of git if it is on GitHub, '' after a fixed
    address or page, else the prior slug.
    """
    text = lambda c: F.coalesce(F.trim(c), F.lit(""))
    slug, address, page = (text(F.col(c)) for c in ("fixed_slug", "fixed_git", "fixed_page"))
    clear = (slug == "") & ((address != "") | (page != ""))
    prior = F.coalesce(F.nullif(text(F.col("prior_git")), F.lit("")), F.when(text(F.col("prior_slug")) != "", F.concat(F.lit("https://github.com/"), "prior_slug", F.lit(".git"))))
    given = {"eco_strong": F.col("strong"), "prior": F.array(prior), "eco_weak": F.col("weak")}

    def of_source(rank: int, source: str) -> Column:
        return F.transform(F.coalesce(given[source], F.array().cast("array<string>")), lambda u: F.struct(F.lit(rank).alias("rank"), F.lit(source).alias("source"), u.alias("url")))

    listed = F.concat(*(of_source(n, s) for n, s in enumerate(SOURCES)))
    found = rows.select(F.col(key).alias("_key"), F.posexplode(listed).alias("at", "c")).where(F.col("c.url").isNotNull())
    found = found.select("_key", "at", "c.rank", "c.source", "c.url").withColumn("k", classify_url(F.col("url"))).select("_key", "at", "rank", "source", "k.platform", F.col("k.canonical").alias("url")).where("platform != ''")
    found = mark_invalid(found, "url", bad_urls, bad_slugs)
    best = found.groupBy("_key", "platform").agg(F.min_by(F.struct("url", "source"), F.struct("invalid", "rank", "at")).alias("pick"))
    best = best.groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("platform", "pick"))).alias("picks"))
    chosen_by_hand = F.when(slug != "", F.concat(F.lit("https://github.com/"), slug)).when(address != "", address)
    rows = rows.withColumn("_by_hand", chosen_by_hand).withColumn("_fixed", classify_url(F.col("_by_hand")))  # classified once, used for each platform
    rows = rows.join(best, F.col(key) == F.col("_key"), "left")
    none = F.lit(None).cast("struct<url:string,source:string>")

    def pick(platform: str) -> Column:
        own = F.when(F.col("_fixed.platform") == platform, F.struct(F.col("_fixed.canonical").alias("url"), F.lit("override").alias("source")))
        return F.coalesce(own, F.when(~clear, F.try_element_at(F.col("picks"), F.lit(platform))), none)

    chosen = rows.withColumn("_pick", F.coalesce(*map(pick, HOST_PRIORITY)))
    git = F.coalesce("_pick.url", F.lit(""))
    on_github = host_of(git) == "github.com"
    github = F.when(on_github, github_repo(git)).when(clear, "").otherwise(text(F.col("prior_slug")))
    return chosen.select(key, git.alias("git"), github.alias("github"), F.coalesce("_pick.source", F.lit("")).alias("via"))


def _renamed(renames: DataFrame) -> DataFrame:
    """(_old, _new) of renames (old, new), lower-case; of several new names the smallest."""
    return renames.where("old is not null").groupBy(F.lower("old").alias("_old")).agg(F.min(F.lower("new")).alias("_new"))


def stamp_github(rows: DataFrame, renames: DataFrame, repos: DataFrame) -> DataFrame:
    """rows (git, slug and more) with repo_id, slug, git and upstream from repos (full_name, number, valid, upstream).

    Ids of earlier runs are cleared first. The slug is the address's, else the
    row's own; renames (old, new) lead to today's name. A slug without a valid
    entry keeps its clone address and has no id; of several entries of one name the least number counts.
    """
    own = F.coalesce(F.nullif(github_repo(F.col("git")), F.lit("")), F.lower(F.trim(F.coalesce("slug", F.lit("")))))
    moved = _renamed(renames)
    entry = F.struct(F.col("full_name").alias("_full"), F.concat(F.lit("gh/"), F.col("number").cast("string")).alias("_id"), F.col("upstream").alias("_up"))
    known = repos.where("valid AND number IS NOT NULL").groupBy(F.lower("full_name").alias("_name")).agg(F.min_by(entry, F.struct("number", "full_name", "upstream")).alias("_e")).select("_name", "_e.*")
    joined = rows.drop("repo_id", "upstream").withColumn("_own", F.nullif(own, F.lit(""))).join(moved, F.col("_own") == F.col("_old"), "left").join(known, F.coalesce("_new", "_own") == F.col("_name"), "left")
    address = lambda s: F.concat(F.lit("https://github.com/"), s, F.lit(".git"))
    git = F.when(F.col("_id").isNotNull(), address(F.col("_full"))).when(F.col("_own").isNotNull(), address(F.col("_own"))).otherwise(F.col("git"))
    out = joined.withColumns({"git": git, "slug": F.coalesce("_full", "slug"), "repo_id": F.coalesce("_id", F.lit("")), "upstream": F.coalesce("_up", F.lit(""))})
    return out.drop("_own", "_old", "_new", "_name", "_full", "_id", "_up")


def stamp_gitlab(rows: DataFrame, projects: DataFrame) -> DataFrame:
    """rows with repo_id of GitLab addresses where it is still ''.

    projects: project (host/path as asked for), host, path (where it lives now),
    aliases (separated by |), valid and repo_id; every name leads to the id.
    """
    names = F.array(F.col("project"), F.concat_ws("/", "host", "path"))
    names = F.concat(names, F.split(F.coalesce("aliases", F.lit("")), r"\|"))
    ids = projects.where(F.col("valid") & F.col("repo_id").startswith("gl/")).select(F.explode(names).alias("_project"), F.col("repo_id").alias("_id"))
    ids = ids.select(F.lower(F.trim("_project")).alias("_project"), "_id").where("_project != ''").groupBy("_project").agg(F.max("_id").alias("_id"))
    git = F.lower(F.coalesce("git", F.lit("")))
    target = F.when((F.col("repo_id") == "") & (git != ""), F.concat_ws("/", host_of(git), F.array_join(path_parts(git), "/")))
    return rows.withColumn("_target", target).join(ids, F.col("_target") == F.col("_project"), "left").withColumn("repo_id", F.coalesce("_id", "repo_id")).drop("_target", "_project", "_id")


def backfill_ids(rows: DataFrame, slug: str, renames: DataFrame, layers: list[DataFrame]) -> DataFrame:
    """rows with repo_id by slug, over renames: the first of layers (slug, repo_id) that knows it; '' if none does."""
    moved = _renamed(renames)
    ids = reduce(DataFrame.unionByName, [x.select(F.lower("slug").alias("_slug"), F.col("repo_id").alias("_id"), F.lit(n).alias("_n")) for n, x in enumerate(layers)])
    ids = ids.where("_id != ''").groupBy("_slug").agg(F.min_by("_id", F.struct("_n", "_id")).alias("_id"))
    joined = rows.join(moved, F.lower(slug) == F.col("_old"), "left").join(ids, F.coalesce("_new", F.lower(slug)) == F.col("_slug"), "left")
    return joined.withColumn("repo_id", F.coalesce("_id", F.lit(""))).drop("_old", "_new", "_slug", "_id")
