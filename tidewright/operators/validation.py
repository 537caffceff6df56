"""Whether a repository's upstream is there, and what is known about the repositories in scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.urls import clone_url, host_of, path_parts

#: Sites by their hosts, for comparing addresses.
SITES = {"github.com": "github", "gitlab.com": "gitlab", "bitbucket.org": "bitbucket", "codeberg.org": "codeberg", "git.sr.ht": "sourcehut"}


def _text(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c).cast("string")), F.lit(""))


def target(platform: Column, repo: Column, git_url: Column) -> Column:
    """struct(target, type) to check: the slug of a GitHub row (github_repo), else its clone address (git_url); NULL for a row without either."""
    slug, url = F.lower(F.trim(F.coalesce(repo, F.lit("")))), F.trim(F.coalesce(git_url, F.lit("")))
    on_github = (F.lower(F.trim(F.coalesce(platform, F.lit("")))) == "github") & slug.contains("/")
    address = F.struct(F.coalesce(F.nullif(clone_url(url), F.lit("")), url).alias("target"), F.lit("git_url").alias("type"))
    return F.when(on_github, F.struct(slug.alias("target"), F.lit("github_repo").alias("type"))).when(url != "", address)


def verdicts(github: DataFrame, addresses: DataFrame, pins: DataFrame) -> DataFrame:
    """(target, type, valid, checked_at) of all that was checked.

    github: repo, full_name, valid, fetched_at, known by both names; addresses:
    url, valid, checked_at; pins: repo, git_url, valid, checked by hand, which win
    (the slug first; without slug or address a pin says nothing). Of several verdicts on a
    target the latest counts, the valid one at equal times.
    """
    yes = lambda c: F.lower(_text(c)) == "true"
    names = F.explode(F.array_distinct(F.array(F.lower(_text("repo")), F.lower(_text("full_name")))))
    a = github.select(names.alias("target"), F.lit("github_repo").alias("type"), yes("valid").alias("valid"), _text("fetched_at").alias("checked_at"), F.lit(0).alias("rank"))
    b = addresses.select(_text("url").alias("target"), F.lit("git_url").alias("type"), yes("valid").alias("valid"), _text("checked_at").alias("checked_at"), F.lit(0).alias("rank"))
    slug, url = F.lower(_text("repo")), F.lower(_text("git_url"))
    by_hand = pins.where(_text("valid") != "").select(F.when(slug != "", slug).otherwise(url).alias("target"), F.when(slug != "", "github_repo").otherwise("git_url").alias("type"), yes("valid").alias("valid"), F.lit("override").alias("checked_at"), F.lit(1).alias("rank"))
    known = a.unionByName(b).unionByName(by_hand).where("target <> ''")
    return known.groupBy("target", "type").agg(F.max_by(F.struct("valid", "checked_at"), F.struct("rank", "checked_at", "valid")).alias("v")).select("target", "type", "v.*")


def unchecked(rows: DataFrame, checked: DataFrame) -> DataFrame:
    """(target, type) of rows that no verdict speaks of."""
    wanted = rows.select(target(F.col("platform"), F.col("repo"), F.col("git_url")).alias("t")).where("t is not null").select("t.*").distinct()
    return wanted.join(checked, ["target", "type"], "left_anti")


def validate(rows: DataFrame, checked: DataFrame) -> DataFrame:
    """rows with git_valid; a ValueError that names a few targets if any of them has no verdict.

    A gl/ id is valid by itself, since only an existing project gets one; a row
    without a target is not.
    """
    lost = unchecked(rows, checked)
    if some := [f"{r['target']} [{r['type']}]" for r in lost.orderBy("type", "target").limit(5).collect()]:
        raise ValueError(f"{lost.count()} targets have no verdict, among them {', '.join(some)}")
    aimed = rows.drop("git_valid").withColumn("_t", target(F.col("platform"), F.col("repo"), F.col("git_url")))
    known = checked.select(F.struct("target", "type").alias("_k"), F.col("valid").alias("_valid"))
    valid = F.when(_text("repo_id").startswith("gl/"), True).otherwise(F.coalesce("_valid", F.lit(False)))
    return aimed.join(known, F.col("_t") == F.col("_k"), "left").withColumn("git_valid", valid).drop("_t", "_k", "_valid")


def targets(rows: DataFrame, checked: DataFrame) -> DataFrame:
    """(target, type, sources, checked_at, valid): each target once, with all ecosystems that lead to it."""
    aimed = rows.select(target(F.col("platform"), F.col("repo"), F.col("git_url")).alias("t"), _text("ecosystems").alias("all")).where("t is not null")
    aimed = aimed.select("t", F.explode_outer(F.split("all", r"\s*,\s*")).alias("eco"))
    sources = aimed.groupBy("t.target", "t.type").agg(F.array_join(F.array_sort(F.collect_set(F.when(F.col("eco") != "", F.col("eco")))), ",").alias("sources"))
    return sources.join(checked, ["target", "type"]).select("target", "type", "sources", "checked_at", "valid")


def place_of(site: Column, slug: Column, url: Column) -> Column:
    """struct(host, repo) of a named site and slug, else of an address: known hosts by their site, others by their domain; both '' if there is none."""
    named, address = F.lower(F.trim(F.coalesce(slug, F.lit("")))), F.lower(F.trim(F.coalesce(url, F.lit(""))))
    host = F.regexp_replace(host_of(address), r"^www\.", "")
    known = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in SITES.items() for x in pair)), host), host)
    parts = path_parts(address)
    path = F.array_join(F.when(known.isin(*SITES.values()) & (F.size(parts) >= 2), F.slice(parts, 1, 2)).otherwise(parts), "/")
    given = F.lower(F.trim(F.coalesce(site, F.lit(""))))
    given = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in SITES.items() for x in pair)), given), given)
    return F.when(named != "", F.struct(given.alias("host"), named.alias("repo"))).otherwise(F.struct(known.alias("host"), path.alias("repo")))


def audit_verdict(ours: Column, theirs: Column) -> Column:
    """both_empty, eco_only, ours_only, match, host_differs (theirs is not on GitHub) or mismatch."""
    none, nothing = ours["repo"] == "", theirs["repo"] == ""
    return (
        F.when(none & nothing, "both_empty").when(none, "eco_only").when(nothing, "ours_only").when((ours["host"] == theirs["host"]) & (ours["repo"] == theirs["repo"]), "match")
        .when(theirs["host"] != "github", "host_differs").otherwise("mismatch")
    )


def audit(theirs: DataFrame, ours: DataFrame, keys: list[str], in_scope: DataFrame) -> DataFrame:
    """(keys, verdict, our_host, our_repo, eco_host, eco_repo, in_scope) for each package of theirs.

    ours: keys, github_repo, git; theirs: keys, repo_host, repo_full_name,
    repository_url; in_scope: repo. Only our GitHub slugs can be in scope.
    """
    joined = theirs.join(ours, keys, "left")
    both = joined.withColumns({"_o": place_of(F.lit("github"), F.col("github_repo"), F.col("git")), "_e": place_of(F.col("repo_host"), F.col("repo_full_name"), F.col("repository_url"))})
    scope = in_scope.select(F.lower(F.trim("repo")).alias("_s")).where("_s <> ''").distinct()
    slug = F.when(F.col("_o.host") == "github", F.nullif(F.col("_o.repo"), F.lit("")))
    both = both.withColumn("_slug", slug).join(scope, F.col("_slug") == F.col("_s"), "left")
    return both.select(*keys, audit_verdict(F.col("_o"), F.col("_e")).alias("verdict"), F.col("_o.host").alias("our_host"), F.col("_o.repo").alias("our_repo"), F.col("_e.host").alias("eco_host"), F.col("_e.repo").alias("eco_repo"), F.col("_s").isNotNull().alias("in_scope"))


def top_repos(value: DataFrame, github: DataFrame, gitlab: DataFrame, classes: tuple[str, ...] = ("A",), platforms: tuple[str, ...] = ("github", "gitlab"), skip_archived: bool = False, skip_invalid: bool = True) -> DataFrame:
    """The valid repositories of these classes, once each, with what their host says of them.

    value: repo, platform, class, git_valid (boolean), repo_id, git_url,
    canonical_url. github: repo, full_name, repo_id, archived, stars; gitlab:
    repo_id, archived, stars. A GitHub slug becomes today's full name; one row a
    slug there and an id on GitLab (its path without one), of the strongest
    class, then the smallest row. The id is the host's, else the value row's; its
    address the value row's, else GitHub's clone address. A value row's canonical_url is kept.
    """
    slug = F.lower(_text("repo"))
    platform = F.lower(_text("platform"))
    rows = value.where(F.col("class").isin(*classes) & platform.isin(*platforms) & (slug != ""))
    rows = rows.where("git_valid") if skip_invalid else rows
    names = F.explode(F.array_distinct(F.array(F.lower(_text("repo")), F.lower(_text("full_name")))))
    today = github.where(_text("full_name") != "").select(names.alias("_raw"), F.lower(_text("full_name")).alias("_full"), F.struct("repo_id", "archived", "stars").alias("_m"), (F.lower(_text("repo")) != F.lower(_text("full_name"))).alias("_alias"))
    canon = today.groupBy(F.col("_raw").alias("_old")).agg(F.min("_full").alias("_now"))
    meta = today.groupBy(F.col("_full").alias("_key")).agg(F.min_by("_m", F.struct("_alias", F.col("_m.repo_id").cast("string"), "_raw")).alias("_gh"))
    labs = gitlab.groupBy(F.col("repo_id").alias("_lab")).agg(F.min(F.struct("repo_id", "archived", "stars")).alias("_gl"))
    rows = rows.select(slug.alias("_raw"), platform.alias("platform"), "class", _text("repo_id").alias("_rid"), _text("git_url").alias("git_url"), _text("canonical_url").alias("canonical_url"))
    rows = rows.withColumn("_rid", F.when(F.col("_rid").rlike(r"^\d+$"), F.concat(F.lit("gh/"), "_rid")).otherwise(F.col("_rid")))
    on_github = F.col("platform") == "github"
    rows = rows.join(canon, F.when(on_github, F.col("_raw")) == F.col("_old"), "left").withColumn("repo", F.coalesce("_now", "_raw"))
    key = F.when(on_github, F.col("repo")).otherwise(F.coalesce(F.nullif("_rid", F.lit("")), F.concat_ws(":", "platform", "_raw")))
    one = rows.groupBy(key.alias("_key_of"), "platform").agg(F.min(F.struct("class", "repo", "_rid", "git_url", "canonical_url")).alias("r")).select("platform", "r.*")
    one = one.join(meta, F.when(on_github, F.col("repo")) == F.col("_key"), "left").join(labs, F.when(~on_github, F.nullif("_rid", F.lit(""))) == F.col("_lab"), "left")
    found = F.coalesce("_gh", "_gl")
    out = one.withColumn("_m", found).select(
        "repo", "platform", "class", F.coalesce(F.nullif(F.col("_m.repo_id").cast("string"), F.lit("")), F.col("_rid")).alias("repo_id"),
        F.when(F.col("git_url") != "", F.col("git_url")).when(on_github, F.concat(F.lit("https://github.com/"), "repo", F.lit(".git"))).otherwise("").alias("git_url"), "canonical_url",
        F.coalesce("_m.archived", F.lit(False)).alias("archived"), F.col("_m.stars").alias("stars"), F.col("_m").isNotNull().alias("enriched"),
    )
    return out.where("not archived") if skip_archived else out


def activity(repos: DataFrame, overrides: DataFrame) -> DataFrame:
    """repos (repo, repo_id, archived) with `eol` and `active`: an override (repo_id, repo, eol) by id, else by slug of one without an id; active is neither."""
    given = overrides.where(_text("eol") != "").select(_text("repo_id").alias("_i"), F.lower(_text("repo")).alias("_s"), (_text("eol") == "True").alias("_e"))
    by_id = given.where("_i <> ''").groupBy("_i").agg(F.max("_e").alias("_by_id"))
    by_slug = given.where("_i = '' and _s <> ''").groupBy("_s").agg(F.max("_e").alias("_by_slug"))
    rows = repos.join(by_id, _text("repo_id") == F.col("_i"), "left").join(by_slug, F.lower(_text("repo")) == F.col("_s"), "left")
    eol = F.coalesce("_by_id", "_by_slug", F.lit(False))
    return rows.withColumns({"eol": eol, "active": ~eol & ~F.coalesce("archived", F.lit(False))}).drop("_i", "_by_id", "_s", "_by_slug")


def upsert_found(old: DataFrame, found: DataFrame, key: str, order: str) -> tuple[DataFrame, DataFrame]:
    """(table, counts): found rows replace those of the same key (of several, the greatest by order, then by all columns); counts: total, added, updated."""
    rest = [c for c in found.columns if c not in (key, order)]
    new = found.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(order, *rest)).alias("_r")).select(key, "_r.*").select(*found.columns)
    table = old.select(*found.columns).join(new, key, "left_anti").unionByName(new)
    seen = new.join(old.select(key).distinct().withColumn("_had", F.lit(True)), key, "left")
    counts = seen.agg(F.count(F.when(F.col("_had").isNull(), 1)).alias("added"), F.count("_had").alias("updated"))
    return table, counts.crossJoin(F.broadcast(table.agg(F.count("*").alias("total")))).select("total", "added", "updated")


def slugs_of_classes(sources: list[tuple[DataFrame, str | None]], classes: tuple[str, ...] = ("A", "B")) -> DataFrame:
    """(repo): the distinct GitHub slugs of several tables (github_repo), of these classes where a table has a class column."""
    parts = [(df if c is None else df.where(F.col(c).isin(*classes))).select(F.lower(_text("github_repo")).alias("repo")) for df, c in sources]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("repo <> ''").distinct()


def worklist(scope: DataFrame, have: DataFrame, keys: list[str], at: str, cutoff: Column, states: list[str], years: list[int]) -> DataFrame:
    """(keys, year, state, why): what scope lacks of every state and year (`missing`), and what it has from before the cutoff (`stale`)."""
    grid = scope.select(*keys).distinct().withColumn("year", F.explode(F.array(*map(F.lit, years)))).withColumn("state", F.explode(F.array(*map(F.lit, states))))
    on = [*keys, "year", "state"]
    newest = have.groupBy(*on).agg(F.max(at).alias("_at"), F.lit(True).alias("_has"))
    why = F.when(F.col("_has").isNull(), "missing").when(F.col("_at").isNull() | (F.col("_at") < cutoff), "stale")
    return grid.join(newest, on, "left").select(*on, why.alias("why")).where("why is not null")

