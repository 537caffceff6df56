"""Dependency declarations and contributor identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_REPLY = r"^(?:\d+\+)?([^@]+)@users\.noreply\.github\.com$"


def python_requirements(specs: Column) -> Column:
    """Distinct normal names of an array of requirement strings, in order; optional extras are left out."""
    needed = F.filter(specs, lambda s: ~s.rlike(r";\s?extra\s?=="))
    names = F.transform(needed, lambda s: F.regexp_replace(F.lower(F.regexp_extract(F.trim(s), r"^([A-Za-z0-9](?:[A-Za-z0-9._-]*[A-Za-z0-9])?)", 1)), "[-_.]+", "-"))
    return F.array_distinct(F.filter(names, lambda n: n != ""))


def debian_relations(field: Column) -> Column:
    """Array of struct(name, version) of a comma-separated field: first alternatives, without architecture."""
    groups = F.transform(F.split(F.coalesce(field, F.lit("")), ","), lambda g: F.trim(F.element_at(F.split(g, r"\|"), 1)))
    rows = F.transform(groups, lambda g: F.struct(F.trim(F.element_at(F.split(F.trim(F.regexp_replace(g, r"\([^)]+\)", "")), ":"), 1)).alias("name"), F.trim(F.regexp_extract(g, r"\(([^)]+)\)", 1)).alias("version")))
    return F.filter(rows, lambda r: r["name"] != "")


def t64_alias(package: Column, replaces: Column, provides: Column) -> Column:
    """The name a 64-bit-time package had before, if it says that it replaces or provides it."""
    old = F.regexp_extract(package, "^(.*)t64$", 1)
    said = F.concat(F.transform(debian_relations(replaces), lambda r: r["name"]), F.transform(debian_relations(provides), lambda r: r["name"]))
    return F.when((old != "") & F.array_contains(said, old), old)


def canonical_email(email: Column) -> Column:
    e = F.lower(F.trim(email))
    login = F.regexp_extract(e, NO_REPLY, 1)
    return F.when(login != "", F.concat(login, F.lit("@noreply"))).otherwise(e)


def login_of(name: Column, email: Column) -> Column:
    e = F.lower(F.trim(email))
    login = F.regexp_extract(e, NO_REPLY, 1)
    return F.coalesce(F.nullif(login, F.lit("")), F.nullif(F.substring_index(e, "@", 1), F.lit("")), F.lower(F.trim(name)))


#: Accounts and addresses of programs.
BOTS = (
    "dependabot[bot]", "renovate[bot]", "github-actions[bot]", "cloudflare-workers-and-pages", "web-flow", "greenkeeper[bot]", "snyk-bot",
    "codecov-commenter", "semantic-release-bot", "allcontributors[bot]", "imgbot[bot]", "pyup-bot", "mend-bolt-for-github[bot]", "copilot",
    "claude", "pre-commit-ci[bot]", "netlify[bot]", "vercel[bot]", "mergify[bot]", "renovate-bot", "depfu[bot]",
)
BOT_EMAILS = ("noreply@github.com", "actions@github.com")


def is_bot_name(name: Column) -> Column:
    n = F.lower(F.trim(name))
    return n.endswith("[bot]") | n.isin(*BOTS)


def is_bot_identity(name: Column, email: Column) -> Column:
    """Whether the name, the address or the login of a no-reply address is a program's."""
    e = F.lower(F.trim(email))
    login = F.regexp_extract(e, NO_REPLY, 1)
    return F.coalesce(is_bot_name(name), F.lit(False)) | F.coalesce(e.isin(*BOT_EMAILS), F.lit(False)) | F.coalesce(login.endswith("[bot]") | login.isin(*BOTS), F.lit(False))


def full_name(name: Column) -> Column:
    """A name of several words in lower case, which identifies a person; NULL for a handle."""
    n = F.lower(F.trim(name))
    return F.when(n.contains(" "), n)
