"""Funding intent from eleven signals, and its spread over an owner's repositories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns that speak for a way to be funded.
SIGNAL_FLAGS = ("gh_sponsors_enabled", "has_funding_links", "has_funding_yml", "has_funding_json", "has_npm_funding", "has_pypi_funding", "bf_maintainer_fundable")
SIGNAL_NAMES = ("paypal", "oc_slug", "host", "owner")
#: Of these, the ones that an owner declares.
DECLARED_FLAGS = SIGNAL_FLAGS[:6]


def _any(flags: tuple[str, ...], names: tuple[str, ...]) -> Column:
    given = [F.coalesce(F.col(c), F.lit(False)) for c in flags] + [F.trim(F.coalesce(F.col(c), F.lit(""))) != "" for c in names]
    return reduce(lambda a, b: a | b, given)


def intent() -> Column:
    """Any flag is true or any name is not blank; unknown ones do not count."""
    return _any(SIGNAL_FLAGS, SIGNAL_NAMES)


def declares_channel() -> Column:
    return _any(DECLARED_FLAGS, ("oc_slug",))


def owner_intent(df: DataFrame, owner: str) -> DataFrame:
    """Adds intent, and owner_intent: also true if any row of the same owner declares a channel."""
    owners = df.where(declares_channel()).select(F.col(owner).alias("_owner")).distinct().withColumn("_spread", F.lit(True))
    rows = df.withColumn("intent", intent()).join(owners, F.col(owner) == F.col("_owner"), "left")
    return rows.withColumn("owner_intent", F.col("intent") | F.coalesce("_spread", F.lit(False))).drop("_owner", "_spread")
