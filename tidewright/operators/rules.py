"""Data-quality rules as rows: any number of them in one pass over the cells of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.urls import GITLAB_HOSTS

#: metric: a column's name, or *end for all columns with this end; low, high: its bounds; max_age_days: for times; found: what breaks the rule is called so.
RULES = "metric string, low double, high double, max_age_days int, found string, severity string"
FINDINGS = ("category", "severity", "key", "metric", "value")


def rules_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, RULES)


def _cells(df: DataFrame, key: str, only: list[str] | None = None) -> DataFrame:
    """(key, metric, value) of the cells that are not blank."""
    names = [c for c in df.columns if c != key and (only is None or c in only)]
    cells = F.array(*(F.struct(F.lit(c).alias("metric"), F.trim(F.col(c).cast("string")).alias("value")) for c in names))
    return df.select(F.col(key).cast("string").alias("key"), F.explode(F.filter(cells, lambda c: c["value"] != "")).alias("c")).select("key", "c.*")


def anomalies(df: DataFrame, key: str, rules: DataFrame, now) -> DataFrame:
    """(category, severity, key, metric, value) of every cell that breaks a rule.

    A bounded metric that is no number is `type` (err). One below 0 whose low
    bound is 0 or more is `negative` (err) where the rule calls it an outlier. Outside the bounds it is what the
    rule calls it. A time older than max_age_days before now breaks its rule too;
    one that is no time is `type`. The cells are put into rows once and meet the
    rules in one join on the metric, however many there are.
    """
    columns = df.sparkSession.createDataFrame([(c,) for c in df.columns if c != key], "column string")
    wide = F.col("metric").startswith("*")
    named = columns.join(rules, F.when(wide, F.col("column").endswith(F.expr("substring(metric, 2)"))).otherwise(F.col("column") == F.col("metric")))
    named = named.select(F.col("column").alias("metric"), "low", "high", "max_age_days", "found", "severity")
    x, at = F.col("value").try_cast("double"), F.try_to_timestamp(F.col("value"))
    bounded = F.col("max_age_days").isNull()
    number = F.when(x.isNull() | F.isnan(x), F.struct(F.lit("type").alias("category"), F.lit("err").alias("severity")))
    number = number.when((x < 0) & (F.col("low") >= 0) & (F.col("found") == "outlier"), F.struct(F.lit("negative").alias("category"), F.lit("err").alias("severity")))
    outside = F.coalesce(x < F.col("low"), F.lit(False)) | F.coalesce(x > F.col("high"), F.lit(False))
    own = F.struct(F.col("found").alias("category"), F.col("severity").alias("severity"))
    number = number.when(outside, own)
    age = F.when(at.isNull(), F.struct(F.lit("type").alias("category"), F.lit("err").alias("severity"))).when(at < now - F.make_dt_interval(F.col("max_age_days")), own)
    found = _cells(df, key).join(F.broadcast(named), "metric").withColumn("f", F.when(bounded, number).otherwise(age)).where("f is not null")  # named: a row for each column and rule
    return found.select("f.category", "f.severity", "key", "metric", "value")


def many_zeros(df: DataFrame, key: str, columns: list[str], most: int) -> DataFrame:
    """Rows of which at least `most` of these columns are filled and as many are 0: more likely a failed measurement."""
    text = [F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) for c in columns]
    zeros = sum((F.when(t.try_cast("double") == 0, 1).otherwise(0) for t in text), F.lit(0))
    filled = sum((F.when(t != "", 1).otherwise(0) for t in text), F.lit(0))
    rows = df.select(F.col(key).cast("string").alias("key"), zeros.alias("z"), filled.alias("n")).where((F.col("n") >= most) & (F.col("z") >= most))
    return rows.select(F.lit("many-zeros").alias("category"), F.lit("info").alias("severity"), "key", F.lit(None).cast("string").alias("metric"), F.concat_ws("/", F.col("z").cast("string"), F.col("n").cast("string")).alias("value"))


def missing_keys(scope: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Keys in scope that the table lacks: it is out of date."""
    lost = scope.select(F.col(key).cast("string").alias("key")).distinct().join(df.select(F.col(key).cast("string").alias("key")), "key", "left_anti")
    null = F.lit(None).cast("string")
    return lost.select(F.lit("coverage").alias("category"), F.lit("warn").alias("severity"), "key", null.alias("metric"), null.alias("value"))


def id_findings(df: DataFrame, slug: str, repo_id: str, scope: DataFrame | None = None) -> DataFrame:
    """(problem, slug, repo_id) of ids that are no ids: blank for a slug in scope (slug), of another shape, or of an instance without a nickname.

    The instance of gl/<nick>-<n> must be one whose nickname is known; gl/<n> is
    gitlab.com and gh/<n> GitHub.
    """
    rows = df.select(F.lower(F.trim(F.col(slug).cast("string"))).alias("slug"), F.coalesce(F.trim(F.col(repo_id).cast("string")), F.lit("")).alias("repo_id"))
    if scope is not None:
        inside = scope.select(F.lower(F.trim("slug")).alias("slug"), F.lit(True).alias("_in")).distinct()
        rows = rows.join(inside, "slug", "left")
    else:
        rows = rows.withColumn("_in", F.lit(True))
    nick = F.regexp_extract("repo_id", r"^gl/(.+)-\d+$", 1)
    problem = F.when(F.col("repo_id") == "", F.when(F.col("_in"), "blank")).when(F.col("repo_id").rlike(r"^\d+$"), "bare number").when(~F.col("repo_id").rlike(r"^(gh/\d+|gl/(.+-)?\d+)$"), "shape")
    problem = problem.when((nick != "") & ~nick.isin(*GITLAB_HOSTS.values()), "unknown instance")
    return rows.select(problem.alias("problem"), "slug", "repo_id").where("problem is not null")


def severity_counts(findings: DataFrame) -> DataFrame:
    """(severity, category, n) with an example, the smallest key and value."""
    return findings.groupBy("severity", "category").agg(F.count("*").alias("n"), F.min(F.struct("key", "metric", "value")).alias("_e")).select("severity", "category", "n", F.col("_e.key").alias("example"))
