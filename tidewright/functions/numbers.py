"""Lenient cell parsing. Missing is NULL, never 0, unless a caller asks for 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def num_or_null(c: Column) -> Column:
    return blank_to_null(c).try_cast("double")


def num_or_zero(c: Column) -> Column:
    return F.coalesce(num_or_null(c), F.lit(0.0))


def flag(c: Column) -> Column:
    """`True`/`False` cells to Boolean; anything else is unknown."""
    s = blank_to_null(c)
    return F.when(s == "True", True).when(s == "False", False)


def value_class(share: Column, a: float = 0.75, b: float = 0.95) -> Column:
    """A, B or C by cumulative share; upper bounds are inclusive."""
    return F.when(share <= a, "A").when(share <= b, "B").when(share.isNotNull(), "C")


def count_nonzero(*cols: Column) -> Column:
    return sum((F.when(c.isNotNull() & (c != 0), 1).otherwise(0) for c in cols), F.lit(0))


def pro_rata(parts: list[tuple[float, Column]], least: int) -> Column:
    """Weighted mean over the present components; NULL when fewer than `least` are present."""
    total = sum((F.when(c.isNotNull(), w * c).otherwise(0.0) for w, c in parts), F.lit(0.0))
    weight = sum((F.when(c.isNotNull(), w).otherwise(0.0) for w, c in parts), F.lit(0.0))
    present = sum((c.isNotNull().cast("int") for _, c in parts), F.lit(0))
    return F.when((present >= least) & (weight > 0), total / weight)


def geometric_mean(*cols: Column) -> Column:
    """NULL as soon as one component is."""
    product = cols[0]
    for c in cols[1:]:
        product = product * c
    return F.pow(product, F.lit(1.0 / len(cols)))


def rounded(c: Column, places: int) -> Column:
    """Half away from zero after scaling in doubles, as SQL engines and the C library do: 0.575 scales to 57.49999999999999 and gives 0.57.

    Spark's round works on the shortest decimal spelling instead, so the two part where a value is half a unit up to its last bit.
    """
    scale = float(10**places)
    return F.round(c.cast("double") * scale) / scale


def worst_of(*cols: Column) -> Column:
    """The greatest component; NULL as soon as one is missing."""
    complete = cols[0].isNotNull()
    for c in cols[1:]:
        complete = complete & c.isNotNull()
    return F.when(complete, F.greatest(*cols))


def worst_present(*cols: Column) -> Column:
    return F.greatest(*cols)


def concentration_score(hhi: Column, bus_factor: Column) -> Column:
    return F.greatest(F.lit(1.0), F.sqrt(hhi / bus_factor))


def age_years(created: Column, at: str) -> Column:
    """Years of 365.25 days until a date; negative ages are 0."""
    days = F.datediff(F.to_date(F.lit(at)), F.to_date(created))
    return F.round(F.greatest(days, F.lit(0)) / 365.25, 1)


def backing_score(kind: Column) -> Column:
    """How little a backer of this kind pays for: company 0, nonprofit a half, none 1."""
    return F.when(kind == "company", 0.0).when(kind == "nonprofit", 0.5).when(kind == "none", 1.0)


def snake_case(c: Column) -> Column:
    words = F.regexp_replace(c, r"([a-z0-9])([A-Z])", "$1_$2")
    return F.trim(F.lower(F.regexp_replace(words, r"[^A-Za-z0-9]+", "_")), F.lit("_"))


def place_in(value: Column, order: tuple[str, ...]) -> Column:
    """The value's place in a fixed order; values outside it come after all of it."""
    out = F.lit(len(order))
    for n, name in reversed(list(enumerate(order))):
        out = F.when(value == name, n).otherwise(out)
    return out
