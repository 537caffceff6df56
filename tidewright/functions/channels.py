"""Declared links, funding channels and funding files, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewright.functions.funding import platform_handle
from tidewright.functions.urls import GITLAB_HOSTS

# The platforms of a funding file, words of a link's name that speak of funding, and paths that are no owners or groups.
PLATFORMS = (
    "github", "patreon", "open_collective", "ko_fi", "tidelift", "community_bridge", "liberapay", "issuehunt", "lfx_crowdfunding",
    "polar", "buy_me_a_coffee", "thanks_dev", "otechie", "custom",
)
FUNDING_WORDS = ("fund", "sponsor", "donate", "tidelift", "patreon", "give")
NO_OWNERS = ("sponsors", "orgs", "apps", "marketplace", "about", "topics", "collections")
NO_GROUPS = ("users", "groups", "explore", "help", "dashboard", "projects", "admin", "search", "public", "-")
NO_PAGES = ("sponsors", "orgs", "topics", "collections", "marketplace", "about", "login", "apps", "settings", "features", "pricing", "explore", "search")
#: Values of a funding file's key that declare nothing.
EMPTY_VALUES = ("[]", "~", "null")


def _text(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit("")))


def host_path(url: Column) -> Column:
    """host/path in lower case, without scheme, .git and closing slashes: the key that joins addresses of any host."""
    u = F.regexp_replace(F.lower(_text(url)), "/+$", "")
    return F.regexp_replace(F.regexp_replace(u, "^(https?|git)://", ""), r"\.git$", "")


def github_owner_repo(url: Column) -> Column:
    """struct(owner, repo): repo is '' for an owner's page; both are for other hosts, reserved names and search results."""
    u = _text(url)
    search = F.lower(u).rlike(r"github\.com/") & F.lower(u).rlike("[?&]q=")
    parts = lambda i: F.lower(F.regexp_extract(u, r"(?i)github\.com/([a-z0-9_.-]+)(?:/([a-z0-9_.-]+))?", i))
    none = search | parts(1).isin(*NO_OWNERS)
    return F.struct(F.when(none, "").otherwise(parts(1)).alias("owner"), F.when(none, "").otherwise(F.regexp_replace(parts(2), r"\.git$", "")).alias("repo"))


def owner_page(url: Column) -> Column:
    """The owner that a page of github.com stands for as a whole; '' for repositories, reserved names and other hosts."""
    u = F.regexp_replace(F.regexp_replace(F.lower(_text(url)), "[?#].*$", ""), r"/+$", "")
    owner = F.regexp_extract(F.regexp_replace(u, r"\.git$", ""), r"github\.com/([^/]+)$", 1)
    return F.when(owner.isin(*NO_PAGES), "").otherwise(owner)


def gitlab_project(url: Column) -> Column:
    """host/group/.../project of a known GitLab instance; '' if the path names no project."""
    u = _text(url)
    full = F.when(u.contains("://"), u).otherwise(F.concat(F.lit("https://"), u))
    host = F.regexp_replace(F.lower(F.regexp_extract(full, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", "")
    path = F.regexp_extract(full, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    parts = F.filter(F.split(F.element_at(F.split(path, "/-/", 2), 1), "/"), lambda p: p != "")
    known = host.startswith("gitlab.") | host.isin(*GITLAB_HOSTS)
    fits = known & (F.size(parts) >= 2) & ~F.lower(F.element_at(parts, 1)).isin(*NO_GROUPS)
    return F.when(fits, host_path(F.concat_ws("/", host, F.array_join(parts, "/")))).otherwise("")


def declared_links(repository: Column, socials: Column, website: Column) -> Column:
    """Distinct non-blank addresses in the order of declaration. socials: array of struct(type, url)."""
    links = F.concat(F.array(repository), F.transform(F.coalesce(socials, F.array().cast("array<struct<type:string,url:string>>")), lambda s: s["url"]), F.array(website))
    return F.array_distinct(F.filter(F.transform(links, _text), lambda u: u != ""))


def best_github(repository: Column, socials: Column, website: Column) -> Column:
    """struct(owner, repo, url) of the first link to github.com: repository, links of type GITHUB, other links, website; all '' if none is."""
    some = F.coalesce(socials, F.array().cast("array<struct<type:string,url:string>>"))
    typed = lambda wanted: F.transform(F.filter(some, lambda s: F.coalesce(s["type"] == "GITHUB", F.lit(False)) == wanted), lambda s: s["url"])
    links = F.concat(F.array(repository), typed(True), typed(False), F.array(website))
    found = F.transform(F.transform(links, _text), lambda u: F.struct(github_owner_repo(u).alias("r"), u.alias("url")))
    first = F.try_element_at(F.filter(found, lambda f: f["r"]["owner"] != ""), F.lit(1))
    pick = lambda c: F.coalesce(c, F.lit(""))
    return F.struct(pick(first["r"]["owner"]).alias("owner"), pick(first["r"]["repo"]).alias("repo"), pick(first["url"]).alias("url"))


def best_gitlab(links: Column) -> Column:
    """The first GitLab project among links in order; '' if none is."""
    return F.coalesce(F.try_element_at(F.filter(F.transform(links, gitlab_project), lambda p: p != ""), F.lit(1)), F.lit(""))


def channel_platforms(channels: Column) -> Column:
    """struct(platforms, handles) of channels (array of struct(type, address)).

    platforms: distinct names in order; a channel without an address counts under
    its type. handles: every address as struct(platform, handle), unknown hosts as custom.
    """
    some = F.filter(F.coalesce(channels, F.array().cast("array<struct<type:string,address:string>>")), lambda c: c.isNotNull())
    known = lambda c: platform_handle(c["address"])
    name = lambda c: F.when(_text(c["address"]) == "", _text(c["type"])).otherwise(F.coalesce(known(c)["platform"], F.lit("custom")))
    handles = F.transform(F.filter(some, lambda c: _text(c["address"]) != ""), lambda c: F.struct(name(c).alias("platform"), known(c)["handle"].alias("handle")))
    return F.struct(F.array_distinct(F.filter(F.transform(some, name), lambda n: n != "")).alias("platforms"), handles.alias("handles"))


def funding_links(links: Column) -> Column:
    """struct(platforms, first) of a map from names to addresses: those of a known host, or whose name speaks of funding (custom)."""
    entries = F.map_entries(F.coalesce(links, F.create_map().cast("map<string,string>")))
    speaks = lambda e: F.lower(e["key"]).rlike("|".join(FUNDING_WORDS))
    kept = F.filter(entries, lambda e: platform_handle(e["value"])["platform"].isNotNull() | speaks(e))
    platforms = F.array_sort(F.array_distinct(F.transform(kept, lambda e: F.coalesce(platform_handle(e["value"])["platform"], F.lit("custom")))))
    first = F.try_element_at(F.filter(F.transform(kept, lambda e: _text(e["value"])), lambda u: u != ""), F.lit(1))
    return F.struct(platforms.alias("platforms"), F.coalesce(first, F.lit("")).alias("first"))


def funding_field(json: Column) -> Column:
    """The address in a field that is a string, an object with url, or a list whose first entry is either; '' otherwise."""
    j = _text(json)
    bare = lambda path: F.get_json_object(F.concat(F.lit('{"v": '), j, F.lit("}")), path)
    of_list = F.coalesce(bare("$.v[0].url"), F.when(~F.coalesce(bare("$.v[0]"), F.lit("")).startswith("{"), bare("$.v[0]")))
    return F.coalesce(F.when(j.startswith('"'), bare("$.v")).when(j.startswith("{"), F.trim(bare("$.v.url"))).when(j.startswith("["), of_list), F.lit(""))


def funding_file_platforms(text: Column) -> Column:
    """Platforms that a funding file declares, sorted: `name: value` at the start of a line, or `name:` with a list item below it.

    What follows # is a comment; values that are empty declare nothing.
    """
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|[\r\n]"), lambda r: F.rtrim(F.regexp_replace(F.element_at(F.split(r, "#", 2), 1), r"\s+$", "")))
    kind = "struct<found:array<string>,open:string>"
    start = F.struct(F.array().cast("array<string>").alias("found"), F.lit(None).cast("string").alias("open"))

    def step(state: Column, line: Column) -> Column:
        key, value = F.regexp_extract(line, r"^([a-z_]+)\s*:\s*(\S.*)$", 1), F.regexp_extract(line, r"^([a-z_]+)\s*:\s*(\S.*)$", 2)
        bare = F.trim(F.regexp_replace(line, ":+$", ""))
        item = state["open"].isNotNull() & line.rlike(r"^\s*-")
        with_open = F.struct(F.array_append(state["found"], state["open"]).alias("found"), F.lit(None).cast("string").alias("open"))
        with_key = F.struct(F.array_append(state["found"], key).alias("found"), F.lit(None).cast("string").alias("open"))
        closed = F.struct(state["found"].alias("found"), F.lit(None).cast("string").alias("open"))
        opened = F.struct(state["found"].alias("found"), bare.alias("open"))
        return (
            F.when(F.trim(line) == "", state).when(line.rlike(r"^[ \t-]"), F.when(item, with_open).otherwise(state))
            .when(key != "", F.when(key.isin(*PLATFORMS) & ~F.trim(value).isin(*EMPTY_VALUES), with_key).otherwise(closed))
            .when(line.endswith(":") & bare.isin(*PLATFORMS), opened).otherwise(closed)
        ).cast(kind)

    return F.array_sort(F.array_distinct(F.aggregate(lines, start.cast(kind), step)["found"]))
