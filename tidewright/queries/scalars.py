"""URL, licence, package and date expressions over literal cases and text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions import funding, licenses, numbers, packages, urls
from tidewright.queries.registry import query, table

URLS = (
    "git+https://GitHub.com/Owner/Repo.git", "git@gitlab.com:group/sub/proj.git", "ssh://git@codeberg.org/a/b", "git://git.savannah.gnu.org/gettext.git",
    "https://gitlab.freedesktop.org/xorg/lib/libx11/-/issues", "https://git.sr.ht/~user/tool", "https://bitbucket.org/x/y/src", "https://example.com/about", "",
    "https://git.kernel.org/cgit/linux/kernel", "http://sourceware.org/elfutils/", "https://github.com/only", "https://salsa.debian.org/pkg/thing.git/",
)


def _values(rows) -> str:
    quote = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return "(VALUES " + ", ".join("(" + ", ".join(quote(v) for v in r) + ")" for r in rows) + ")"


_U = [(i, u) for i, u in enumerate(URLS)]
_SPLIT = r"""
n AS (SELECT i, lower(CASE WHEN starts_with(v, 'git://') THEN 'https://' || substr(v, 7) WHEN starts_with(v, 'ssh://git@') THEN 'https://' || substr(v, 11) WHEN starts_with(v, 'git@') THEN regexp_replace(v, '^git@([^:]*):', 'https://\1/') ELSE v END) AS u FROM (SELECT i, regexp_replace(trim(u), '^git\+', '') AS v FROM urls)),
h AS (SELECT i, u, regexp_extract(u, '^[a-z]+://([^/:?#]*)', 1) AS host, list_filter(string_split(regexp_replace(regexp_extract(u, '^[a-z]+://[^/?#]*([^?#]*)', 1), '(\.git)?/*$', ''), '/'), lambda x: x <> '') AS p FROM n),
q AS (SELECT *, CASE WHEN list_position(p, '-') > 0 THEN p[1:list_position(p, '-') - 1] ELSE p END AS proj FROM h),
c AS (SELECT *, CASE WHEN host = '' THEN '' WHEN host = 'github.com' AND len(p) >= 2 THEN 'github' WHEN (starts_with(host, 'gitlab.') OR host IN ('salsa.debian.org', 'invent.kde.org', 'code.videolan.org')) AND len(proj) >= 2 THEN 'gitlab'
  WHEN host = 'bitbucket.org' AND len(p) >= 2 THEN 'bitbucket' WHEN host = 'git.sr.ht' AND len(p) >= 2 THEN 'sourcehut' WHEN host = 'codeberg.org' AND len(p) >= 2 THEN 'codeberg'
  WHEN host IN ('git.savannah.gnu.org', 'sourceware.org', 'git.kernel.org') OR u LIKE '%.git' OR u LIKE '%git.%' OR u LIKE '%/git/%' OR u LIKE '%/cgit%' OR u LIKE '%/scm/%' OR u LIKE '%/gitweb%' THEN 'custom' ELSE '' END AS platform FROM q)
"""


def url_table(spark: SparkSession, d: str) -> DataFrame:
    """The literal cases and all page addresses, numbered from 1000."""
    cases = spark.createDataFrame(_U, "i long, u string")
    return cases.unionByName(table(spark, d, "pages").select((F.col("page_id") + 1000).alias("i"), F.col("url").alias("u")))


_URLS_SQL = f"urls AS (SELECT i::BIGINT AS i, u FROM {_values(_U)} t(i, u) UNION ALL SELECT page_id + 1000, url FROM pages)"


@query(f"WITH {_URLS_SQL}, {_SPLIT} SELECT i, platform, CASE WHEN platform IN ('github','bitbucket','codeberg') THEN 'https://' || host || '/' || array_to_string(p[1:2], '/') || '.git' WHEN platform = 'gitlab' THEN 'https://' || host || '/' || array_to_string(proj, '/') || '.git' WHEN platform = 'sourcehut' THEN 'https://git.sr.ht/' || array_to_string(p[1:2], '/') WHEN platform = 'custom' THEN u ELSE '' END AS canonical FROM c")
def url_classify(spark: SparkSession, d: str) -> DataFrame:
    return url_table(spark, d).select("i", urls.classify_url(F.col("u")).alias("c")).select("i", "c.platform", "c.canonical")


@query(f"WITH {_URLS_SQL}, {_SPLIT} SELECT i, platform, CASE WHEN platform = '' THEN '' WHEN platform IN ('github','bitbucket','codeberg') THEN array_to_string(p[1:2], '/') WHEN platform = 'gitlab' THEN array_to_string(proj, '/') WHEN platform = 'sourcehut' THEN array_to_string(p[1:2], '/') ELSE array_to_string(p, '/') END AS slug FROM c")
def platform_slug(spark: SparkSession, d: str) -> DataFrame:
    return url_table(spark, d).select("i", urls.platform_and_slug(F.col("u")).alias("c")).select("i", "c.platform", "c.slug")


@query("""
WITH n AS (SELECT *, replace(p_name, ' ', '-') AS n FROM part)
SELECT p_partkey, CASE p_type WHEN 'STANDARD' THEN 'git://git.savannah.gnu.org/' || n || '.git' WHEN 'MEDIUM' THEN 'git://git.kernel.org/pub/scm/utils/' || n || '.git' WHEN 'PROMO' THEN 'https://gitlab.gnome.org/GNOME/' || n || '.git'
  WHEN 'LARGE' THEN CASE WHEN p_size < 25 THEN '' ELSE 'https://code.videolan.org/videolan/' || n || '.git' END WHEN 'ECONOMY' THEN CASE WHEN p_size < 25 THEN 'git://git.code.sf.net/p/' || n || '/code' ELSE 'https://gitlab.xiph.org/xiph/' || n || '.git' END
  ELSE CASE WHEN p_size < 40 THEN 'git://example.org/' || n || '.git' ELSE '' END END AS clone FROM n
""")
def url_canonicalize(spark: SparkSession, d: str) -> DataFrame:
    """Page addresses of hosts that clone elsewhere, over scheme or not at all."""
    name = F.replace("p_name", F.lit(" "), F.lit("-"))
    of = lambda before, after="": F.concat(F.lit(before), name, F.lit(after))
    kind, small = F.col("p_type"), F.col("p_size") < 25
    url = F.when(kind == "STANDARD", of("https://git.savannah.gnu.org/cgit/", ".git")).when(kind == "MEDIUM", of("https://git.kernel.org/cgit/utils/")).when(kind == "PROMO", of("git://gitlab.gnome.org/GNOME/", ".git"))
    url = url.when((kind == "LARGE") & small, of("https://github.com/a/")).when(kind == "LARGE", of("https://git.videolan.org/?p=", ".git;a=summary"))
    url = url.when((kind == "ECONOMY") & small, of("http://", ".git.sourceforge.net/")).when(kind == "ECONOMY", of("https://git.xiph.org/", ".git")).when(F.col("p_size") < 40, of("http://example.org/", ".git")).otherwise(of("https://hg.example.org/"))
    return table(spark, d, "part").select("p_partkey", urls.clone_url(url).alias("clone"))


@query("SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN 'gh/' || c_custkey WHEN 1 THEN 'gl/' || c_custkey WHEN 2 THEN 'gl/salsa-' || c_custkey END AS rid, coalesce(c_nationkey % 4 < 3, false) AS valid FROM customer")
def repo_ids(spark: SparkSession, d: str) -> DataFrame:
    hosts = F.array(*[F.lit(h) for h in ("github.com", "gitlab.com", "salsa.debian.org", "example.org")])
    rid = urls.repo_id(hosts[F.col("c_nationkey") % 4], F.col("c_custkey"))
    return table(spark, d, "customer").select("c_custkey", rid.alias("rid"), F.coalesce(urls.is_repo_id(rid), F.lit(False)).alias("valid"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'gh/' || p_partkey WHEN p_partkey % 3 = 1 THEN 'https://x/' || p_name ELSE '__orphan__:' || p_brand || ':' || p_name END AS grp FROM part")
def repo_group_key(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    rid = F.when(k == 0, F.concat(F.lit("gh/"), "p_partkey")).otherwise("")
    url = F.when(k == 1, F.concat(F.lit("https://x/"), "p_name"))
    return table(spark, d, "part").select("p_partkey", urls.group_key(rid, url, F.col("p_brand"), F.col("p_name")).alias("grp"))


@query("""
WITH ok AS (SELECT DISTINCT lower(p_brand) AS b FROM part WHERE p_size = 50)
SELECT p_partkey, CASE WHEN p_type = 'LARGE' THEN NULL WHEN p_type = 'SMALL' THEN false ELSE lower(p_brand) IN (SELECT b FROM ok) END AS oss FROM part
""")
def license_expr_classify(spark: SparkSession, d: str) -> DataFrame:
    """Single names, choices, brackets, suffixes, unknown and near misses; approved are the brands of one size."""
    p = table(spark, d, "part")
    approved = p.where("p_size = 50").agg(F.coalesce(F.collect_set(F.lower("p_brand")), F.array().cast("array<string>")).alias("approved"))  # a brand once
    kind, b = F.col("p_type"), F.col("p_brand")
    text = F.when(kind == "STANDARD", b).when(kind == "MEDIUM", F.concat(F.lit("Custom OR "), b)).when(kind == "PROMO", F.concat(F.lit("("), b, F.lit("-or-later AND Own)"))).when(kind == "LARGE", "NOASSERTION")
    text = text.when(kind == "ECONOMY", F.concat(F.upper(b), F.lit("+ with classpath-exception"))).otherwise(F.concat(F.lit("not-"), b))
    return p.crossJoin(F.broadcast(approved)).select("p_partkey", licenses.is_open(text, F.col("approved")).alias("oss"))


_SQL_TEXT = r"""SELECT doc_id, CASE
WHEN regexp_matches(h, '(?i)apache\s+license[, ]+\s*version\s+2\.0|licensed under the apache license,\s*version\s+2\.0') THEN 'Apache-2.0'
WHEN regexp_matches(h, '(?is)permission is hereby granted,\s+free of charge,?\s+to any person\s+obtaining a copy') THEN 'MIT'
WHEN regexp_matches(h, '(?i)mozilla public license,\s*v\.?\s*2\.0|mpl-?2\.0') THEN 'MPL-2.0'
WHEN regexp_matches(h, '(?i)gnu general public license\s+version 3') THEN 'GPL-3.0'
WHEN regexp_matches(h, '(?i)creative commons attribution\s*4\.0') THEN 'CC-BY-4.0' ELSE '' END AS license
FROM (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'Apache License, Version 2.0 ' WHEN 1 THEN 'SPDX-License-Identifier: mit ' WHEN 2 THEN 'GNU General Public License version 3 ' ELSE '' END || coalesce(text, '') AS whole, substr(whole, 1, 50000) AS h FROM documents)"""


@query(f"SELECT doc_id, CASE WHEN doc_id % 7 = 1 THEN 'MIT' ELSE license END AS license FROM ({_SQL_TEXT})")
def license_text_classify(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id") % 7
    head = F.when(k == 0, "Apache License, Version 2.0 ").when(k == 1, "SPDX-License-Identifier: mit ").when(k == 2, "GNU General Public License version 3 ").otherwise("")
    text = F.concat(head, F.coalesce("text", F.lit("")))
    return table(spark, d, "documents").select("doc_id", licenses.license_of_text(text).alias("license"))


@query("""
SELECT p_partkey, replace(p_name, ' ', '-') || ',' || lower(p_type) || '-' || p_size AS py, 'lib' || p_size || '=>= ' || p_size || ';' || lower(p_type) || '=' || CASE WHEN p_size > 25 THEN ';python3== 3.1' ELSE '' END AS deb FROM part
""")
def dep_spec_parse(spark: SparkSession, d: str) -> DataFrame:
    """Requirements in several spellings of one name, extras, versions; relations with alternatives, architectures and blanks."""
    text = lambda *parts: F.concat(*(F.lit(x) if x[:1] != "$" else F.col(x[1:]).cast("string") for x in parts))
    under, dots = (F.replace("p_name", F.lit(" "), F.lit(c)) for c in "_.")
    specs = F.array(F.concat(F.upper(under), F.lit(" (>=2)")), F.concat(dots, F.lit(">=4,<5")), text("$p_type", "; extra == 'x'"), text("$p_type", "_", "$p_size", " ; python_version<'3'"))
    field = F.concat(text("lib", "$p_size", " (>= ", "$p_size", "), "), F.lower("p_type"), F.lit(":any | bar, , "), F.when(F.col("p_size") > 25, "python3 (= 3.1)").otherwise(""))
    deb = F.array_join(F.transform(packages.debian_relations(field), lambda r: F.concat(r["name"], F.lit("="), r["version"])), ";")
    return table(spark, d, "part").select("p_partkey", F.array_join(packages.python_requirements(specs), ",").alias("py"), deb.alias("deb"))


@query("SELECT p_partkey, 'is_' || lower(p_type) || '_' || replace(p_name, ' ', '_') || '_' || p_size AS name FROM part")
def snake_case(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("Is"), F.initcap(F.lower("p_type")), F.lit(" "), F.initcap("p_name"), F.lit("-"), F.col("p_size").cast("string"), F.lit("!"))
    return table(spark, d, "part").select("p_partkey", numbers.snake_case(raw).alias("name"))


@query(r"""
SELECT page_id, coalesce(nullif(regexp_extract(url, '/(\d{4,})(?:\?|$)', 1), ''), nullif(regexp_extract(url, '^https?://m\.([a-z]+)\.', 1), ''), nullif(regexp_extract(html, '<title>([^ <]+)', 1), ''), '') AS found FROM pages
""")
def first_match_over_texts(spark: SparkSession, d: str) -> DataFrame:
    """The address first, by each pattern in turn, then the page."""
    by_address = funding.first_match([F.col("url")], [r"/(\d{4,})(?:\?|$)", r"^https?://m\.([a-z]+)\."])
    by_page = funding.first_match([F.col("html")], [r"<title>([^ <]+)"])
    return table(spark, d, "pages").select("page_id", F.coalesce(F.nullif(by_address, F.lit("")), by_page).alias("found"))
