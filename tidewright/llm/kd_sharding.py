"""K-d tree partitioning into shards of nearly equal bytes, in DataFrame operations only.

The tree's units are groups of equal texts, so that copies share a shard; a
group with more than a 16th of a shard's bytes or rows is cut into pieces. A node is
split along the dimension that is widest in it (relative to the whole table's
width) at the weighted median, until leaves hold the target bytes. Medians are
found by counting bytes in bins of the interval that still holds the median,
all nodes of a level at once; only bins reach the driver. Equal coordinates are
ordered by a hash, so that a median inside a tie is found too.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import materialize

PIECES_PER_SHARD, BINS = 16, 2048
_HASH_SPAN = float(1 << 40)


@dataclass
class _Search:
    """Where a node's median lies: first by coordinate, then by hash among equal coordinates."""

    dim: str
    half: float
    lo: float
    hi: float
    below: float = 0.0  # bytes before the interval
    value: float | None = None  # the coordinate, once known
    t_lo: float = 0.0
    t_hi: float = _HASH_SPAN
    done: bool = field(default=False)

    def take(self, bins: list[tuple]) -> None:
        """bins: (bin, bytes, least, greatest coordinate or hash), in order."""
        on_value = self.value is None
        total = self.below
        for _, weight, least, most in bins:
            if total + weight >= self.half:
                self.below = total
                if on_value:
                    self.lo, self.hi = least, most
                    if least == most:
                        self.value = least
                elif least == most or weight <= 0:
                    left_out = self.half - total < total + weight - self.half
                    self.t_hi = least - 1 if left_out else least
                    self.done = True
                else:
                    self.t_lo, self.t_hi = least, most
                return
            total += weight
        self.done = True  # rounding: everything goes left
        self.value = self.hi if self.value is None else self.value


def _pick(node: Column, of: dict[int, Column | float], default: Column) -> Column:
    out = default
    for k, v in of.items():
        out = F.when(node == k, v if isinstance(v, Column) else F.lit(v)).otherwise(out)
    return out


def _split_level(units: DataFrame, dims: list[str], spans: dict[str, float]) -> dict[int, _Search]:
    """For each node of units (node, weight, tie and dims) its split."""
    stats = units.groupBy("node").agg(F.sum("weight").alias("w"), *(f(d).alias(f"{d}_{n}") for d in dims for n, f in (("lo", F.min), ("hi", F.max)))).collect()
    search = {}
    for r in stats:
        widths = [((r[f"{d}_hi"] - r[f"{d}_lo"]) / spans[d] if spans[d] else 0.0) for d in dims]
        d = dims[max(range(len(dims)), key=lambda i: (widths[i], -i))]
        s = search[r["node"]] = _Search(d, r["w"] / 2, r[f"{d}_lo"], r[f"{d}_hi"])
        if s.lo == s.hi:
            s.value = s.lo
    while going := {k: s for k, s in search.items() if not s.done}:
        node = F.col("node")
        coordinate = _pick(node, {k: F.col(s.dim) for k, s in going.items()}, F.lit(0.0))
        by_tie = {k: s for k, s in going.items() if s.value is not None}
        x = F.when(node.isin(*by_tie), F.col("tie")).otherwise(coordinate) if by_tie else coordinate
        lo = _pick(node, {k: float(s.t_lo if k in by_tie else s.lo) for k, s in going.items()}, F.lit(0.0))
        hi = _pick(node, {k: float(s.t_hi if k in by_tie else s.hi) for k, s in going.items()}, F.lit(0.0))
        inside = node.isin(*going) & (F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi"))
        if by_tie:
            inside &= ~node.isin(*by_tie) | (coordinate == _pick(node, {k: s.value for k, s in by_tie.items()}, F.lit(0.0)))
        rows = units.withColumns({"x": x, "lo": lo, "hi": hi}).where(inside)
        place = F.least(F.floor((F.col("x") - F.col("lo")) / F.greatest(F.col("hi") - F.col("lo"), F.lit(1e-300)) * BINS), F.lit(BINS - 1))
        bins = rows.groupBy("node", place.alias("bin")).agg(F.sum("weight").alias("w"), F.min("x").alias("least"), F.max("x").alias("most")).collect()
        of: dict[int, list] = {k: [] for k in going}
        for r in bins:
            of[r["node"]].append((r["bin"], r["w"], r["least"], r["most"]))
        for k, s in going.items():
            s.take(sorted(of[k]))
    return search


def kd_shards(docs: DataFrame, dims: dict[str, Column], target_bytes: int | None = None, n_shards: int | None = None) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1), text_crc32, shard and slot (gapless from 0 in each shard) for every row.

    dims: numeric columns over docs, besides the size, along which nodes may be
    split; a null counts as 0. The number of shards is n_shards, or what
    target_bytes needs, rounded up to a power of two. A null text counts as
    empty. Slots follow a hash bucket, then doc_id. Repeated rows get slots of
    their own. An empty table gives no rows; docs' other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = F.octet_length(text).cast("long") + 1
    named = {f"dim_{i}": F.coalesce(c.cast("double"), F.lit(0.0)) for i, c in enumerate(dims.values())}
    rows = materialize(docs.select("doc_id", size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("hash"), *(c.alias(n) for n, c in named.items())), "rows")
    total, n = rows.agg(F.sum("size"), F.count("*")).first()
    wanted = n_shards or max(1, math.ceil((total or 0) / target_bytes))
    depth = max(0, math.ceil(math.log2(wanted)))
    key = ["hash", "text_crc32", "size"]
    most = PIECES_PER_SHARD << depth
    heavy = rows.groupBy(*key).agg(F.sum("size").alias("w"), F.count("*").alias("n"))
    heavy = heavy.where((F.col("w") > (total or 0) / most) | (F.col("n") > n / most)).select(*key, F.ceil(F.greatest(F.col("w") / (total or 1), F.col("n") / max(n, 1)) * 4 * most).alias("pieces"))
    # at most `most` groups can hold such a share of the bytes, and as many of the rows
    rows = rows.join(F.broadcast(heavy), key, "left").withColumn("piece", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("pieces")), F.lit(0)))
    unit = [*key, "piece"]
    all_dims = ["dim_size", *named]
    units = rows.groupBy(*unit).agg(F.sum("size").alias("weight"), *(F.min(d).alias(d) for d in named))
    units = materialize(units.withColumns({"dim_size": F.col("size").cast("double"), "tie": F.pmod(F.xxhash64(*unit, F.lit("order")), F.lit(1 << 40)).cast("double"), "node": F.lit(1)}), "units")
    limits = units.agg(*(f(d).alias(f"{d}_{k}") for d in all_dims for k, f in (("lo", F.min), ("hi", F.max)))).first()
    spans = {d: (limits[f"{d}_hi"] or 0.0) - (limits[f"{d}_lo"] or 0.0) for d in all_dims}
    for _ in range(depth):
        splits = _split_level(units, all_dims, spans)
        node = F.col("node")
        coordinate = _pick(node, {k: F.col(s.dim) for k, s in splits.items()}, F.lit(0.0))
        at = _pick(node, {k: float(s.value) for k, s in splits.items()}, F.lit(0.0))
        upto = _pick(node, {k: float(s.t_hi) for k, s in splits.items()}, F.lit(0.0))
        right = (coordinate > at) | ((coordinate == at) & (F.col("tie") > upto))
        units = materialize(units.withColumn("node", node * 2 + right.cast("int")), "units")
    placed = rows.join(units.select(*unit, (F.col("node") - (1 << depth)).alias("shard")), unit)
    buckets = max(1, math.ceil(n / (5000 * (1 << depth))))
    placed = materialize(placed.select("doc_id", "size", "text_crc32", "hash", "shard", F.pmod(F.xxhash64("doc_id", "hash"), F.lit(buckets)).alias("bucket")), "placed")
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "hash"))
    return placed.withColumn("rank", rank).join(offsets, ["shard", "bucket"]).select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("rank") - 1).alias("slot"))


def category(column: str) -> Column:
    """A coordinate in [0, 1) for a column of names."""
    return F.crc32(F.col(column).cast("string").cast("binary")) / float(1 << 32)
