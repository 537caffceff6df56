"""What registries say: names of one package, pages of a listing, addresses by platform."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.windows import first_by

#: Order in which a package's address is put beside its results; another one than that of choosing a repository's host.
INJECTED = ("github", "gitlab", "bitbucket", "sourcehut", "codeberg", "custom")
#: Fixed value: a library of the 64-bit time transition, its numbered name before it and what follows the mark.
T64 = r"^(lib[a-z0-9.+-]*?\d+)t64(\b.*)$"


def last_page(link: Column) -> Column:
    """The number of the last page in a Link header; NULL if it names none."""
    parts = F.transform(F.split(F.coalesce(link, F.lit("")), ","), lambda p: F.trim(p))
    last = F.try_element_at(F.filter(parts, lambda p: p.contains('rel="last"')), F.lit(1))
    return F.nullif(F.regexp_extract(F.substring_index(last, ";", 1), r"[?&]page=(\d+)(?:[&#>]|$)", 1), F.lit("")).try_cast("int")


def injected_address(order: tuple[str, ...] = INJECTED) -> Column:
    """The first address that is not blank over one column a platform; '' if there is none."""
    return F.coalesce(*(F.nullif(F.trim(p), F.lit("")) for p in order), F.lit(""))


def inject(results: DataFrame, addresses: DataFrame, key: str = "package", order: tuple[str, ...] = INJECTED) -> DataFrame:
    """results with `git` from addresses (key and a column a platform); '' where they know none. A repeated key takes its smallest row's."""
    one = addresses.select(F.col(key).alias("_k"), injected_address(order).alias("_git")).where("_git <> ''").groupBy("_k").agg(F.min("_git").alias("_git"))
    return results.drop("git").join(one, F.col(key) == F.col("_k"), "left").withColumn("git", F.coalesce("_git", F.lit(""))).drop("_k", "_git")


def sources_of_binaries(metadata: DataFrame, aliases: DataFrame) -> DataFrame:
    """(name, source) of binary packages: as the metadata (package, source) says, then old names (old, current) of known ones, then the names that libraries had before their t64 form.

    An earlier kind wins over a later one; of several sources of one name the smallest counts.
    """
    said = metadata.where(F.coalesce("source", F.lit("")) != "").select(F.col("package").alias("name"), "source", F.lit(0).alias("kind"))
    known = said.groupBy("name").agg(F.min("source").alias("source"))
    older = aliases.select(F.col("old").alias("name"), F.col("current").alias("_current")).join(known.withColumnRenamed("name", "_current"), "_current").select("name", "source", F.lit(1).alias("kind"))
    both = said.unionByName(older)
    before = both.where(F.col("name").rlike(T64)).select(F.concat(F.regexp_extract("name", T64, 1), F.regexp_extract("name", T64, 2)).alias("name"), "source", F.lit(2).alias("kind"))
    return first_by(both.unionByName(before), ["name"], F.col("kind"), F.col("source")).select("name", "source")


def combine_projects(debian: DataFrame, homebrew: DataFrame, weights: tuple[float, float] = (1.39, 1.0)) -> DataFrame:
    """One row a project from two registries (project, package, downloads, github_repo, cpp): weighted score, packages, first GitHub slug, whether it is C++.

    Names of one project in one registry are aliases: the largest downloads
    count. The slug is Debian's first (by name), else Homebrew's. A project is C++
    if any of its packages says so.
    """
    slug = F.nullif(F.trim("github_repo"), F.lit(""))

    def one(df: DataFrame, name: str) -> DataFrame:
        first = F.min_by(slug, F.when(slug.isNotNull(), F.col("package")))
        return df.groupBy(F.col("project").alias(f"{name}_p")).agg(F.max("downloads").alias(f"{name}_n"), F.bool_or(F.coalesce("cpp", F.lit(False))).alias(f"{name}_cpp"), first.alias(f"{name}_slug"), F.array_join(F.array_sort(F.collect_set("package")), "|").alias(f"{name}_packages"))

    joined = one(debian, "d").join(one(homebrew, "h"), F.col("d_p") == F.col("h_p"), "full_outer")
    score = weights[0] * F.coalesce("d_n", F.lit(0)) + weights[1] * F.coalesce("h_n", F.lit(0))
    return joined.select(F.coalesce("d_p", "h_p").alias("project"), F.coalesce("d_n", F.lit(0)).alias("debian"), F.coalesce("h_n", F.lit(0)).alias("homebrew"), score.alias("score"), (F.coalesce("d_cpp", F.lit(False)) | F.coalesce("h_cpp", F.lit(False))).alias("cpp"), F.coalesce("d_slug", "h_slug", F.lit("")).alias("github_repo"), F.coalesce("d_packages", F.lit("")).alias("debian_packages"), F.coalesce("h_packages", F.lit("")).alias("homebrew_packages"))
