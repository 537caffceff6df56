"""Licence names, expressions and texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = ("", "noassertion", "other", "none")

# Patterns of licence texts, most specific first.
TEXT_PATTERNS = (
    ("Apache-2.0", r"(?i)apache\s+license[, ]+\s*version\s+2\.0|licensed under the apache license,\s*version\s+2\.0"),
    ("MIT", r"(?is)permission is hereby granted,\s+free of charge,?\s+to any person\s+obtaining a copy"),
    ("ISC", r"(?is)permission to use,\s+copy,\s+modify,?\s+and(?:/or)?\s+distribute this software"),
    ("BSD-3-Clause", r"(?is)neither the names? of (?:the [^\n]*?|its contributors)[^\n]*may be used to endorse or promote"),
    ("BSD-2-Clause", r"(?is)redistributions in binary form must reproduce the above copyright\s+notice"),
    ("0BSD", r"(?i)\bbsd zero[- ]clause license\b|\b0bsd license\b"),
    ("MPL-2.0", r"(?i)mozilla public license,\s*v\.?\s*2\.0|mpl-?2\.0"),
    ("AGPL-3.0", r"(?i)gnu affero general public license\s+version 3"),
    ("LGPL-3.0", r"(?i)gnu lesser general public license\s+version 3"),
    ("LGPL-2.1", r"(?i)gnu lesser general public license\s+version 2\.1"),
    ("GPL-3.0", r"(?i)gnu general public license\s+version 3"),
    ("GPL-2.0", r"(?i)gnu general public license[\s,]+version 2"),
    ("EPL-2.0", r"(?i)eclipse public license\s*-?\s*v(?:ersion)?\s*2"),
    ("EPL-1.0", r"(?i)eclipse public license\s*-?\s*v(?:ersion)?\s*1"),
    ("BSL-1.0", r"(?i)boost software license\s*-?\s*version\s*1"),
    ("Zlib", r"(?i)\bzlib license\b"),
    ("Unlicense", r"(?i)\bthis is free and unencumbered software\b"),
    ("CC0-1.0", r"(?i)creative commons (?:cc0|zero)\s*1\.0"),
    ("PostgreSQL", r"(?i)postgresql.*?(?:license|licence)"),
    ("NCSA", r"(?i)university of illinois/ncsa open source license"),
    ("BlueOak-1.0.0", r"(?i)blue oak model license"),
    ("OFL-1.1", r"(?i)sil open font license,\s*version\s*1\.1"),
    ("CC-BY-4.0", r"(?i)creative commons attribution\s*4\.0"),
)
TEXT_LIMIT = 50_000  # characters of a licence file that are looked at: part of the definition


def is_meaningful(c: Column) -> Column:
    return c.isNotNull() & ~F.lower(F.trim(c)).isin(*UNKNOWN)


def is_open(expression: Column, approved: Column) -> Column:
    """Whether a licence or any part of an expression is approved; NULL when nothing is declared. approved: array of lower-case ids."""
    s = F.lower(F.trim(F.coalesce(expression, F.lit(""))))
    parts = F.split(s, r"\s+or\s+|\s+and\s+|/|,|\(|\)|\bwith\s+[a-z0-9.-]+-exception\b")
    plain = F.transform(parts, lambda p: F.regexp_replace(F.trim(p), r"(-or-later)?(-only)?(\+)?$", ""))
    return F.when(s.isin(*UNKNOWN), None).otherwise(F.array_contains(approved, s) | F.arrays_overlap(plain, approved))


def license_of_text(text: Column) -> Column:
    """The id that a licence text names in its header or shows by its wording; empty if none."""
    head = F.substring(F.coalesce(text, F.lit("")), 1, TEXT_LIMIT)
    tag = F.lower(F.regexp_extract(head, r"(?i)SPDX-License-Identifier:\s*([\w.+-]+)", 1))
    known = F.create_map(*[F.lit(x) for name, _ in TEXT_PATTERNS for x in (name.lower(), name)])
    wording = F.lit("")
    for name, pattern in reversed(TEXT_PATTERNS):
        wording = F.when(head.rlike(pattern), name).otherwise(wording)
    return F.coalesce(known[tag], wording)


def pick_license(sources: list[tuple[str, Column]]) -> Column:
    """struct(license, source): the first meaningful value, else the first that is not blank."""
    present = [(n, F.nullif(F.trim(c), F.lit(""))) for n, c in sources]
    tell = [F.when(is_meaningful(c), F.struct(c.alias("license"), F.lit(n).alias("source"))) for n, c in present]
    junk = [F.when(c.isNotNull(), F.struct(c.alias("license"), F.lit(n).alias("source"))) for n, c in present]
    return F.coalesce(*tell, *junk)
