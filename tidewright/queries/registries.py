"""Names, pages and addresses of registries, over parts and suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.operators import health, registries
from tidewright.queries.registry import query, table


@query("SELECT p_partkey, CASE p_type WHEN 'STANDARD' THEN p_size WHEN 'MEDIUM' THEN p_partkey WHEN 'PROMO' THEN NULL WHEN 'LARGE' THEN NULL ELSE 7 END::INTEGER AS pages FROM part")
def last_pages(spark: SparkSession, d: str) -> DataFrame:
    """Link headers: several relations in either order, none of the last page, no header, other numbers in the query."""
    link = """CASE p_type WHEN 'STANDARD' THEN concat('<https://api.example.org/x?page=2>; rel="next", <https://api.example.org/x?per_page=1&page=', p_size, '>; rel="last"')
      WHEN 'MEDIUM' THEN concat('<https://api.example.org/x?page=', p_partkey, '&per_page=100>; rel="last", <https://api.example.org/x?page=1>; rel="first"')
      WHEN 'PROMO' THEN concat('<https://api.example.org/x?page=', p_size, '>; rel="next"') WHEN 'LARGE' THEN NULL ELSE '<https://api.example.org/x?page=7#top>; rel="last"' END"""
    return table(spark, d, "part").select("p_partkey", registries.last_page(F.expr(link)).alias("pages"))


@query("""
SELECT s_suppkey, CASE WHEN s_acctbal > 6000 THEN 'https://github.com/s/' || s_suppkey WHEN s_nationkey > 12 THEN 'https://bitbucket.org/s/' || s_suppkey WHEN s_acctbal > 0 THEN 'https://codeberg.org/s/' || s_suppkey ELSE '' END AS git FROM supplier
""")
def injected_addresses(spark: SparkSession, d: str) -> DataFrame:
    """One address beside each result: Bitbucket before Codeberg here, unlike the choice of a repository's host."""
    s = table(spark, d, "supplier")
    wide = s.where("s_acctbal > 0 OR s_nationkey > 12").selectExpr("s_suppkey", "if(s_acctbal > 6000, concat('https://github.com/s/', s_suppkey), '') AS github", "'' AS gitlab", "if(s_nationkey > 12, concat('https://bitbucket.org/s/', s_suppkey), NULL) AS bitbucket", "' ' AS sourcehut",
        "if(s_acctbal > 0, concat('https://codeberg.org/s/', s_suppkey), '') AS codeberg", "'' AS custom")
    return registries.inject(s.select("s_suppkey"), wide, "s_suppkey")


BINARIES = """
m AS (SELECT CASE WHEN p_size < 20 THEN 'lib' || p_size || 't64' WHEN p_size < 30 THEN 'lib' || p_size || 't64-' || lower(p_type) WHEN p_size < 40 THEN 'lib' || (p_size - 29) ELSE 'tool' || p_size END AS package, CASE WHEN p_size = 45 THEN '' ELSE 'src-' || p_brand END AS source FROM part),
al AS (SELECT 'old' || p_size || 't64' AS old, CASE WHEN p_size < 30 THEN 'tool' || (p_size + 20) ELSE 'unknown' END AS current FROM part WHERE p_size > 25 UNION ALL SELECT 'tool41', 'tool42')
"""


@query(f"""
WITH {BINARIES}, s AS (SELECT package AS name, min(source) AS source, 0 AS kind FROM m WHERE source <> '' GROUP BY 1), b AS (SELECT * FROM s UNION ALL SELECT old, s.source, 1 FROM al JOIN s ON s.name = current),
t AS (SELECT * FROM b UNION ALL SELECT regexp_extract(name, '^(lib[a-z0-9.+-]*?[0-9]+)t64(-.*)?$', 1) || regexp_extract(name, '^(lib[a-z0-9.+-]*?[0-9]+)t64(-.*)?$', 2), source, 2 FROM (SELECT * FROM b UNION ALL SELECT package, source, 0 FROM m WHERE source <> '') WHERE regexp_matches(name, '^(lib[a-z0-9.+-]*?[0-9]+)t64(-.*)?$'))
SELECT name, arg_min(source, (kind, source)) AS source FROM t GROUP BY 1
""")
def binary_sources(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    metadata = p.selectExpr("CASE WHEN p_size < 20 THEN concat('lib', p_size, 't64') WHEN p_size < 30 THEN concat('lib', p_size, 't64-', lower(p_type)) WHEN p_size < 40 THEN concat('lib', p_size - 29) ELSE concat('tool', p_size) END AS package", "if(p_size = 45, '', concat('src-', p_brand)) AS source")
    aliases = p.where("p_size > 25").selectExpr("concat('old', p_size, 't64') AS old", "if(p_size < 30, concat('tool', p_size + 20), 'unknown') AS current")
    return registries.sources_of_binaries(metadata, aliases.unionByName(spark.createDataFrame([("tool41", "tool42")], "old string, current string")))


@query("""
WITH de AS (SELECT p_name AS project, 'd' || p_partkey AS package, p_size AS n, CASE WHEN p_size > 30 THEN 'deb/' || p_brand ELSE '' END AS slug, p_type = 'LARGE' AS cpp FROM part WHERE p_type <> 'PROMO'),
ho AS (SELECT p_name || CASE WHEN p_size > 40 THEN '-x' ELSE '' END AS project, 'h' || p_size AS package, p_size * 2 AS n, 'brew/' || p_brand AS slug, NULL::BOOLEAN AS cpp FROM part WHERE p_size > 20),
a AS (SELECT project, max(n) AS n, bool_or(coalesce(cpp, false)) AS cpp, arg_min(slug, package) FILTER (WHERE slug <> '') AS slug, string_agg(DISTINCT package, '|' ORDER BY package) AS pk FROM de GROUP BY 1),
b AS (SELECT project, max(n) AS n, bool_or(coalesce(cpp, false)) AS cpp, min(slug) FILTER (WHERE package = least_package) AS slug, string_agg(DISTINCT package, '|' ORDER BY package) AS pk FROM (SELECT *, min(package) OVER (PARTITION BY project) AS least_package FROM ho) GROUP BY 1)
SELECT coalesce(a.project, b.project) AS project, coalesce(a.n, 0) AS debian, coalesce(b.n, 0) AS homebrew, round(1.39 * coalesce(a.n, 0) + coalesce(b.n, 0), 4)::DOUBLE AS score, coalesce(a.cpp, false) OR coalesce(b.cpp, false) AS cpp, coalesce(a.pk, '') AS debian_packages, coalesce(b.pk, '') AS homebrew_packages,
  CASE WHEN a.slug IS NOT NULL THEN a.slug WHEN b.slug IS NOT NULL THEN 'brew' ELSE '' END AS slug FROM a FULL JOIN b ON a.project = b.project
""")
def combined_projects(spark: SparkSession, d: str) -> DataFrame:
    """Two registries put together by project: the largest of aliases, weights, the first slug, any package in C++."""
    p = table(spark, d, "part")
    debian = p.where("p_type <> 'PROMO'").selectExpr("p_name AS project", "concat('d', p_partkey) AS package", "p_size AS downloads", "if(p_size > 30, concat('deb/', p_brand), '') AS github_repo", "p_type = 'LARGE' AS cpp")
    homebrew = p.where("p_size > 20").selectExpr("concat(p_name, if(p_size > 40, '-x', '')) AS project", "concat('h', p_size) AS package", "p_size * 2 AS downloads", "concat('brew/', p_brand) AS github_repo", "CAST(NULL AS BOOLEAN) AS cpp")
    out = registries.combine_projects(debian, homebrew)
    slug = F.when(F.col("github_repo").startswith("brew/"), "brew").otherwise(F.col("github_repo"))
    return out.select("project", "debian", "homebrew", F.round("score", 4).alias("score"), "cpp", "debian_packages", "homebrew_packages", slug.alias("slug"))


@query("SELECT 'filled: openssf_crit' AS \"check\", count(*) FILTER (WHERE s_acctbal < 500) = 0 AS ok, count(*) FILTER (WHERE s_acctbal < 500) || ' of ' || count(*) || ' rows blank' AS detail FROM supplier WHERE s_nationkey < 12 AND s_acctbal > -500")
def criticality_gate(spark: SparkSession, d: str) -> DataFrame:
    """Every valid repository of the strongest class has a criticality score."""
    rows = table(spark, d, "supplier").selectExpr("if(s_nationkey < 12, 'github', 'gitlab') AS platform", "s_acctbal > -500 AS git_valid", "if(s_acctbal < 500, ' ', string(s_acctbal)) AS openssf_crit")
    return health.filled(rows, (F.col("platform") == "github") & F.col("git_valid"), "openssf_crit", "openssf_crit")
