"""Ids that have drifted: tables stamped again with today's repository ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.lineage import cut


def final_names(renames: DataFrame) -> DataFrame:
    """(old, new) of renames followed to their end, any case.

    An old name with several new ones takes the smallest. Names on a circle of
    renames lead nowhere and are left out. Pointers double each round, so a
    chain of n renames takes log n rounds.
    """
    pairs = renames.select(F.lower(F.trim("old")).alias("old"), F.lower(F.trim("new")).alias("new")).where("old <> '' and new <> '' and old <> new")
    links = cut(pairs.groupBy("old").agg(F.min("new").alias("new")))
    rounds, most = 0, links.count()
    while True:
        onward = links.select(F.col("old").alias("new"), F.col("new").alias("_next"))
        moved = cut(links.join(onward, "new", "left").select("old", F.coalesce("_next", "new").alias("new"), F.col("_next").isNotNull().alias("going")))
        links, rounds = moved.select("old", "new"), rounds + 1
        if moved.where("going").isEmpty():
            return links
        if 2 ** (rounds - 1) > most:  # longer than any chain: what still moves goes in circles
            return moved.where("not going").select("old", "new")


def _stamped(table: DataFrame, current: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One pass over a table: its rows with today's names and ids, and what was done: (slug, action, rows)."""
    moved = names.select(F.col("old").alias("_slug"), F.col("new").alias("_moved"))
    today = current.select(F.col("slug").alias("_today"), F.col("repo_id").alias("_id"))
    by_id = current.where("repo_id <> ''").groupBy("repo_id").agg(F.min("slug").alias("_by_id")).withColumnRenamed("repo_id", "_known")
    raw = F.coalesce(F.trim("repo_id"), F.lit(""))
    rows = table.withColumns({"_slug": F.nullif(F.lower(F.trim("slug")), F.lit("")), "_was": raw, "_now": F.when(raw.rlike(r"^\d+$"), F.concat(F.lit("gh/"), raw)).otherwise(raw)})
    rows = rows.join(moved, "_slug", "left").withColumn("_name", F.coalesce("_moved", "_slug"))
    # a name that nobody has today, under an id that somebody has: renamed without a notice
    rows = rows.join(today, F.col("_name") == F.col("_today"), "left").join(by_id, F.nullif(F.col("_now"), F.lit("")) == F.col("_known"), "left")
    lost = F.col("_today").isNull()
    rows = rows.withColumn("_name", F.when(lost, F.coalesce("_by_id", "_name")).otherwise(F.col("_name"))).withColumn("_lost", lost & F.col("_by_id").isNull())
    rows = cut(rows.withColumn("_id", F.when(lost & F.col("_by_id").isNotNull(), F.col("_now")).otherwise(F.col("_id"))))
    state = rows.where(F.col("_id").isNotNull() & (F.col("_now") != "")).groupBy(F.col("_name").alias("_n")).agg((~F.bool_or(F.col("_now") == F.col("_id"))).alias("_drifted"))
    out = rows.join(state, F.col("_name") == F.col("_n"), "left")
    restamp = F.coalesce("_drifted", F.lit(False)) & (F.col("_now") != F.col("_id"))
    action = F.when(restamp, "restamped").when(F.col("_now") != F.col("_was"), "prefixed").when(F.col("_name") != F.col("_slug"), "renamed").when(F.col("_lost") & (F.col("_now") != ""), "vanished")
    out = cut(out.withColumns({"repo_id": F.when(restamp, F.col("_id")).otherwise(F.col("_now")), "slug": F.coalesce(F.col("_name"), F.col("slug")), "_action": action}))
    done = out.where("_action is not null").groupBy(F.col("_name").alias("slug"), F.col("_action").alias("action")).agg(F.count("*").alias("rows"))
    return out.select(*table.columns), done


def heal_ids(tables: dict[str, DataFrame], current: DataFrame, renames: DataFrame, rounds: int = 8) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables (slug, repo_id and more) stamped with today's ids, and a report (table, round, slug, action, rows).

    current: slug, repo_id, one row a slug; renames: old, new. A bare number is a
    GitHub id. Names follow renames to their end; a name nobody has today is that
    of its id's owner. If none of a name's rows has its current id, all of them
    get it (a stale id beside the current one is left: it joins nothing). Names
    and ids that nobody has are reported as vanished and left. Passes are
    repeated until one changes nothing.
    """
    spark = current.sparkSession
    today = current.select(F.lower(F.trim("slug")).alias("slug"), F.trim("repo_id").alias("repo_id")).where("slug <> '' and repo_id <> ''")
    today = cut(today.groupBy("slug").agg(F.min("repo_id").alias("repo_id")))
    names = cut(final_names(renames).join(today.select(F.col("slug").alias("old")), "old", "left_anti"))  # a name that is in use again is not followed
    healed, report = {}, []
    for name, table in tables.items():
        for n in range(1, rounds + 1):
            table, done = _stamped(table, today, names)
            changed = not done.where("action <> 'vanished'").isEmpty()
            report.append(done.where("action <> 'vanished'" if changed else "true").select(F.lit(name).alias("table"), F.lit(n).alias("round"), "slug", "action", "rows"))
            if not changed:
                break
        healed[name] = table
    empty = spark.createDataFrame([], "table string, round int, slug string, action string, rows long")
    return healed, reduce(DataFrame.unionByName, report, empty)


def drifted_names(table: DataFrame, current: DataFrame) -> DataFrame:
    """(slug, ids) of names of which no row has the current id, with the ids they have."""
    rows = table.select(F.lower(F.trim("slug")).alias("slug"), F.trim("repo_id").alias("_had")).where("_had <> ''").distinct()
    joined = rows.join(current.select(F.lower(F.trim("slug")).alias("slug"), F.trim("repo_id").alias("_id")), "slug")
    return joined.groupBy("slug").agg(F.bool_or(F.col("_had") == F.col("_id")).alias("_ok"), F.array_sort(F.collect_set("_had")).alias("ids")).where("not _ok").select("slug", "ids")
