"""Funding links, hosts behind repository ids, published dates and free-form licences, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewright.functions.urls import GITLAB_HOSTS

# Parts of an address and the platform they stand for; the first that occurs wins.
PLATFORM_HOSTS = (
    ("github.com/sponsors", "github"), ("patreon.com", "patreon"), ("opencollective.com", "open_collective"), ("ko-fi.com", "ko_fi"),
    ("tidelift.com", "tidelift"), ("liberapay.com", "liberapay"), ("issuehunt.io", "issuehunt"), ("polar.sh", "polar"),
    ("buymeacoffee.com", "buy_me_a_coffee"), ("buymeacoff.ee", "buy_me_a_coffee"), ("thanks.dev", "thanks_dev"), ("otechie.com", "otechie"),
)
#: Names in the path of github.com that are no owners.
RESERVED_OWNERS = ("sponsors", "orgs", "topics", "collections", "marketplace")
#: What a free-form licence field must be, as a whole, to name a licence.
PLAIN_LICENSE = r"(?i)^\s*(mit|apache-?2\.?0|bsd-?[23]?-?clause|isc|gpl-?[23](?:\.0)?(?:-or-later)?|lgpl-?[23](?:\.[01])?(?:-or-later)?|agpl-?3(?:\.0)?(?:-or-later)?|mpl-?2\.0|epl-?[12]\.0|cc0-?1\.0|unlicense|wtfpl|psf|blueoak-?1\.0\.0)\s*$"


def first_segment(text: Column) -> Column:
    """What stands before the first /, ? or # once leading slashes are gone."""
    return F.regexp_extract(text, r"^/*([^/?#]*)", 1)


def platform_handle(url: Column) -> Column:
    """struct(platform, handle): of an unknown host no platform and the address itself; of a blank one no platform and ''."""
    u = F.trim(F.coalesce(url, F.lit("")))
    low = F.lower(u)
    platform, rest = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, name in reversed(PLATFORM_HOSTS):
        here = low.contains(host)
        platform = F.when(here, name).otherwise(platform)
        rest = F.when(here, first_segment(F.element_at(F.split(low, host.replace(".", r"\."), 2), 2))).otherwise(rest)
    return F.struct(platform.alias("platform"), F.coalesce(F.nullif(rest, F.lit("")), u).alias("handle"))


def collective_slug(value: Column) -> Column:
    """The bare lower-case name from a handle or an address of opencollective.com."""
    v = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    site = "opencollective.com"
    rest = F.when(v.contains(site), F.regexp_replace(F.element_at(F.split(v, r"opencollective\.com", 2), 2), "^/+", "")).otherwise(v)
    return F.regexp_extract(rest, r"^([^/?#]*)", 1)


def github_repo(url: Column) -> Column:
    """owner/name of a github.com address, lower-case; '' for others and for pages under reserved names."""
    slug = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^(?:git\+)?(?:https?|git|ssh)://(?:git@)?(?:www\.)?github\.com/([^/?#]+/[^/?#]+?)(?:\.git)?(?:[/?#].*)?$", 1)
    return F.when(F.substring_index(slug, "/", 1).isin(*RESERVED_OWNERS), "").otherwise(slug)


def instance_host(repo_id: Column) -> Column:
    """The GitLab host of a repository id; '' for other ids and unknown nicknames."""
    rest = F.regexp_extract(F.trim(F.coalesce(repo_id, F.lit(""))), "^gl/(.+)$", 1)
    by_nick = F.create_map(*(F.lit(x) for host, nick in GITLAB_HOSTS.items() for x in (nick, host)))
    nick = F.regexp_extract(rest, "^(.*)-[^-]*$", 1)
    return F.when(rest.rlike(r"^\d+$"), "gitlab.com").otherwise(F.coalesce(F.try_element_at(by_nick, nick), F.lit("")))


def id_link(repo_id: Column, slug: Column) -> Column:
    """A web address for an id: by slug on GitHub, by number on the id's GitLab instance; '' if neither is known."""
    host = instance_host(repo_id)
    number = F.regexp_extract(repo_id, r"(\d+)$", 1)
    return F.when(repo_id.startswith("gh/") & (F.coalesce(slug, F.lit("")) != ""), F.concat(F.lit("https://github.com/"), slug)).when(host != "", F.concat(F.lit("https://"), host, F.lit("/projects/"), number)).otherwise("")


def handles_by_platform(links: Column) -> Column:
    """array of struct(platform, handles): distinct handles in the order they are first seen; unknown hosts count as custom."""
    found = F.transform(F.filter(F.coalesce(links, F.array().cast("array<string>")), lambda u: F.trim(F.coalesce(u, F.lit(""))) != ""), platform_handle)
    found = F.transform(found, lambda s: F.struct(F.coalesce(s["platform"], F.lit("custom")).alias("platform"), s["handle"].alias("handle")))
    names = F.array_distinct(F.transform(found, lambda s: s["platform"]))
    return F.transform(names, lambda n: F.struct(n.alias("platform"), F.array_distinct(F.transform(F.filter(found, lambda s: s["platform"] == n), lambda s: s["handle"])).alias("handles")))


def first_match(texts: list[Column], patterns: list[str]) -> Column:
    """The first non-empty group 1 over texts, then patterns."""
    return F.coalesce(*(F.nullif(F.regexp_extract(F.coalesce(t, F.lit("")), p, 1), F.lit("")) for t in texts for p in patterns), F.lit(""))


def published(raw: Column) -> Column:
    """struct(year, day): an ISO time in UTC, else its first ten characters as a date, else its first four digits as a year only."""
    text = F.trim(F.coalesce(raw, F.lit("")))
    day = F.coalesce(F.when(text.rlike(r"^\d{4}-\d\d-\d\d[T ]"), F.try_to_timestamp(text)).cast("date"), F.when(text.rlike(r"^\d{4}-\d\d-\d\d"), F.substring(text, 1, 10).try_cast("date")))
    year = F.coalesce(F.year(day), F.when(text.rlike(r"^\d{4}"), F.substring(text, 1, 4).cast("int")))
    return F.struct(year.alias("year"), F.date_format(day, "yyyy-MM-dd").alias("day"))


def plain_license(text: Column) -> Column:
    """A licence named by the first line of a free-form field as a whole, lower-case without spaces; '' otherwise."""
    line = F.substring(F.regexp_extract(F.trim(F.coalesce(text, F.lit(""))), r"^([^\r\n]*)", 1), 1, 80)
    return F.regexp_replace(F.lower(F.regexp_extract(line, PLAIN_LICENSE, 1)), " ", "")


def resolve_license(expression: Column, classifiers: Column, names: dict[str, str], text: Column) -> Column:
    """The expression, else the first known classifier `License :: ... :: <name>`, else plain_license(); lower-case."""
    known = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    parts = lambda c: F.transform(F.split(c, "::"), lambda p: F.lower(F.trim(p)))
    labels = F.transform(F.filter(F.coalesce(classifiers, F.array().cast("array<string>")), lambda c: (F.size(parts(c)) >= 2) & (F.element_at(parts(c), 1) == "license")), lambda c: F.try_element_at(known, F.element_at(parts(c), -1)))
    first = F.try_element_at(F.array_compact(labels), F.lit(1))
    return F.coalesce(F.nullif(F.lower(F.trim(expression)), F.lit("")), first, plain_license(text))


def guess_language(build: Column, runtime: Column, hints: list[tuple[str, str]], scripting: tuple[str, ...], markers: tuple[str, ...], default: str) -> Column:
    """The first hint (name, pattern) that a build dependency matches, unless it names a scripting language and a
    marker of another build system is there too; then the first that a runtime dependency matches, scripting languages left out."""
    empty = F.array().cast("array<string>")
    build, runtime = F.coalesce(build, empty), F.coalesce(runtime, empty)
    marked = F.arrays_overlap(build, F.array(*map(F.lit, markers)))
    matches = lambda names, pattern: F.exists(names, lambda n: n.rlike(pattern))
    out = F.lit(default)
    for name, pattern in reversed([h for h in hints if h[0] not in scripting]):
        out = F.when(matches(runtime, pattern), name).otherwise(out)
    for name, pattern in reversed(hints):
        fits = matches(build, pattern)
        out = F.when(fits & ~marked if name in scripting else fits, name).otherwise(out)
    return out
