"""Who wrote a repository: identities merged to persons, and how far the work rests on few of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.packages import canonical_email, full_name, is_bot_identity, login_of
from tidewright.lineage import cut
from tidewright.operators.graph import components
from tidewright.operators.windows import running_sum


def persons(rows: DataFrame, repo: str = "repo", name: str = "name", email: str = "email") -> DataFrame:
    """(repo, name, email, person): person is the smallest (name, email) of those that are one person within a repository.

    Identities are trimmed. Two are one if they share a canonical address (a
    numbered and a plain no-reply address are the same) or a full name; handles
    without a space merge nothing. Each address and name is a star around its
    smallest holder, so no pairs are made.
    """
    text = lambda c: F.coalesce(F.trim(c), F.lit(""))
    own = cut(rows.select(F.col(repo).alias("repo"), text(name).alias("name"), text(email).alias("email")).where("repo is not null").distinct())
    identity = F.struct("repo", "name", "email")
    tags = F.array(F.concat(F.lit("e"), F.nullif(canonical_email(F.col("email")), F.lit(""))), F.concat(F.lit("n"), full_name(F.col("name"))))
    tagged = own.select("repo", identity.alias("node"), F.explode(F.array_compact(tags)).alias("tag"))
    hubs = tagged.groupBy("repo", "tag").agg(F.min("node").alias("hub"))
    stars = tagged.join(hubs, ["repo", "tag"]).where("node <> hub").select(F.col("node").alias("src"), F.col("hub").alias("dst"))
    found = components(stars, own.select(identity.alias("node")))
    return found.select("node.repo", "node.name", "node.email", F.struct("label.name", "label.email").alias("person"))


def authors(commits: DataFrame, n: str = "commits") -> DataFrame:
    """One row a person of each repo: name and login of the identity with most commits (ties: smallest), commits, identities, is_bot.

    commits: repo, name, email and a number of commits. One bot identity makes the person a bot.
    """
    text = lambda c: F.coalesce(F.trim(c), F.lit(""))
    own = commits.select("repo", text("name").alias("name"), text("email").alias("email"), F.col(n).cast("long").alias("n")).groupBy("repo", "name", "email").agg(F.sum("n").alias("n"))
    merged = own.join(persons(own), ["repo", "name", "email"])
    lead = F.min_by(F.struct("name", "email"), F.struct((-F.col("n")).alias("n"), "name", "email"))
    out = merged.groupBy("repo", "person").agg(lead.alias("_lead"), F.sum("n").alias("commits"), F.count("*").alias("identities"), F.bool_or(is_bot_identity(F.col("name"), F.col("email"))).alias("is_bot"))
    return out.select("repo", F.col("_lead.name").alias("name"), login_of(F.col("_lead.name"), F.col("_lead.email")).alias("login"), "commits", "identities", "is_bot")


def _held_by_few(people: DataFrame, n: str, share: float = 0.5) -> DataFrame:
    """(repo, bus factor, hhi, persons) over persons with commits; ranks come from ranges of the whole order, so that a large repository is not one task."""
    ranked = running_sum(people.where(F.col(n) > 0).select("repo", "person", n), n, [F.desc(n), F.col("person")], ["repo"])
    before = F.col("cum") - F.col(n)
    return ranked.groupBy("repo").agg(
        F.sum((before < share * F.col("total")).cast("long")).alias("bus_factor"),
        F.round(F.sum(F.pow(100.0 * F.col(n) / F.col("total"), 2))).cast("long").alias("hhi"),
        F.count("*").alias("people"),
    )


def concentration(commits: DataFrame, window: tuple[int, int], last_year: int) -> DataFrame:
    """How concentrated a repository's work is, over its history and over a window of years.

    commits: repo, name, email, year, commits. Years after last_year count in
    neither. Identities are merged first; bots hold no share, but their commits
    are in the totals. A repository without a human in the window gets the worst
    of it, bus factor 1 and hhi 10000, and a comment that says why: no commits up
    to last_year at all, none in the window, or none by a human.
    """
    text = lambda c: F.coalesce(F.trim(c), F.lit(""))
    n, year = F.coalesce(F.col("commits").cast("long"), F.lit(0)), F.col("year")
    full, win = F.sum(F.when(year <= last_year, n).otherwise(0)), F.sum(F.when(year.between(*window), n).otherwise(0))
    own = commits.where("repo is not null").groupBy("repo", text("name").alias("name"), text("email").alias("email")).agg(full.alias("full"), win.alias("win"))
    own = cut(own)
    merged = own.join(persons(own), ["repo", "name", "email"])
    bot = F.bool_or(is_bot_identity(F.col("name"), F.col("email")))
    people = cut(merged.groupBy("repo", "person").agg(F.sum("full").alias("full"), F.sum("win").alias("win"), bot.alias("bot")))
    humans = people.where("not bot")
    whole, lately = (_held_by_few(humans, c).select("repo", *(F.col(k).alias(f"{k}_{c}") for k in ("bus_factor", "hhi", "people"))) for c in ("full", "win"))
    totals = people.groupBy("repo").agg(F.sum("full").alias("commits_full"), F.sum("win").alias("commits_win"))
    out = totals.join(whole, "repo", "left").join(lately, "repo", "left")
    none = F.col("people_win").isNull()
    why = F.when(F.col("commits_win") > 0, "no human commits in window").when(F.col("commits_full") > 0, "no commits in window").otherwise("no commits through last complete year")
    return out.select(
        "repo", "commits_full", F.coalesce("people_full", F.lit(0)).alias("people_full"), "bus_factor_full", "hhi_full", "commits_win", F.coalesce("people_win", F.lit(0)).alias("people_win"),
        F.when(none, 1).otherwise(F.col("bus_factor_win")).cast("long").alias("bus_factor_win"), F.when(none, 10000).otherwise(F.col("hhi_win")).cast("long").alias("hhi_win"), F.when(none, why).alias("comment"),
    )


def logins_in_scope(members: DataFrame, scope: DataFrame) -> DataFrame:
    """Distinct logins of bus-factor members (repo_id, login) whose repository is in scope (repo_id); blanks are nobody."""
    login = F.lower(F.trim("login"))
    return members.join(scope.select("repo_id").distinct(), "repo_id", "left_semi").where(F.coalesce(login, F.lit("")) != "").select(login.alias("login")).distinct()


def per_active(amount: Column, people: Column) -> Column:
    """An amount per active contributor, 4 places; without any it rests on one; NULL where either is unknown."""
    return F.round(amount / F.when(people == 0, 1).when(people > 0, people), 4)


def workload(rows: DataFrame, amounts: dict[str, str], people: str = "people_win") -> DataFrame:
    """Adds `dormant` (no active contributor; NULL if unknown) and each of amounts (new name to column) per active contributor."""
    count = F.col(people).cast("double")
    return rows.withColumns({"dormant": F.when(count >= 0, (count == 0).cast("int")), **{out: per_active(F.col(c), count) for out, c in amounts.items()}})
