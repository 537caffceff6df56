"""Reply trees: paths from roots to leaves, ranked by score, each formatted as one conversation.

Ancestors are found by iterative self-joins of doubling reach: after step k a
message's pointer goes 2**k messages up, and the scores and the depth between
are summed on the way. Depth d takes log2(d) joins on (tree, message), so that a
hot tree spreads over all tasks. A chosen leaf's path is gathered downwards with
the same pointers.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import materialize

#: Control strings of the template and of other common ones; inside a text a backslash breaks each of them.
CONTROLS = ("<|start|>", "<|message|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
START, MIDDLE, END = CONTROLS[:3]

_TO_ESCAPE = re.compile(r"\\|" + "|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """No control string is left in the result; unescape() gives the text back."""
    return _TO_ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:] if len(m[0]) > 1 else "\\\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str]], learn_role: str = "assistant") -> tuple[str, list[int]]:
    """The conversation as one string, and the loss mask: starts and ends (code points) of learn_role's texts, in turn."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{MIDDLE}", escape(text)
        parts += [head, body, END]
        if role == learn_role:
            spans += [at + len(head), at + len(head) + len(body)]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns that format_turns() wrote."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn at {at}")
        middle = formatted.index(MIDDLE, at)
        end = formatted.index(END, middle)
        turns.append((unescape(formatted[at + len(START) : middle]), unescape(formatted[middle + len(MIDDLE) : end])))
        at = end + len(END)
    return turns


def best_paths(messages: DataFrame, n_paths: int = 1) -> DataFrame:
    """(tree, path, depth, role, text) of the messages on each tree's n_paths best root-to-leaf paths.

    messages: tree, node, parent, role, text, score; (tree, node) is unique. A
    parent that is null or not in the tree makes a root. A path's score is the
    sum of its messages' scores (null: 0); equal scores: the smaller leaf
    first. path counts from 1. Messages whose ancestors form a cycle belong to
    no path. A null tree is a tree like any other. An empty table gives no
    rows; other columns are ignored.
    """
    base = messages.select("tree", "node", "parent", "role", "text", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    links = base.select("tree", "node", "parent", "score")
    known = base.select(F.col("tree").alias("_t"), F.col("node").alias("_n"))
    up = links.join(known, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("parent") == F.col("_n")), "left")
    up = materialize(up.select("tree", "node", F.col("_n").alias("up"), F.col("score").alias("total"), F.lit(1).alias("depth"), F.col("_n").alias("parent")), "links")
    largest = up.groupBy("tree").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    steps = max(1, math.ceil(math.log2(largest + 1))) if largest else 0
    jumps = []
    for _ in range(steps):
        jumps.append(up.where(F.col("up").isNotNull()).select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("up").alias("_up")))
        above = up.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("up").alias("_up"), F.col("total").alias("_total"), F.col("depth").alias("_depth"))
        joined = up.join(above, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("up") == F.col("_n")), "left")
        up = materialize(joined.select("tree", "node", F.col("_up").alias("up"), (F.col("total") + F.coalesce("_total", F.lit(0.0))).alias("total"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"), "parent"), "jumps")
    parents = up.where(F.col("parent").isNotNull()).select(F.col("tree").alias("_t"), F.col("parent").alias("_n")).distinct()
    leaves = up.where(F.col("up").isNull()).join(parents, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n")), "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "node"))
    chosen = leaves.select("tree", "node", rank.alias("path")).where(F.col("path") <= n_paths)
    for jump in reversed(jumps):
        higher = chosen.join(jump, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n"))).select("tree", F.col("_up").alias("node"), "path")
        chosen = materialize(chosen.unionByName(higher), "paths")
    facts = base.join(up.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "depth"), F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n"))).drop("_t", "_n")
    marks = chosen.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "path")
    return facts.join(marks, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("node") == F.col("_n"))).select("tree", "path", "depth", "role", "text")


def format_paths(paths: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """One row a path: tree, path, formatted and loss_spans (starts and ends in turn). Null roles and texts count as empty."""
    turns = paths.groupBy("tree", "path").agg(F.array_sort(F.collect_list(F.struct("depth", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [format_turns([(t["role"], t["text"]) for t in turns.as_py()], learn_role) for turns in batch.column("turns")]
            yield pa.RecordBatch.from_arrays([batch.column("tree"), batch.column("path"), pa.array([f for f, _ in out], pa.string()), pa.array([s for _, s in out], pa.list_(pa.int64()))], ["tree", "path", "formatted", "loss_spans"])

    kind = turns.schema["tree"].dataType.simpleString()
    return turns.mapInArrow(run, f"tree {kind}, path int, formatted string, loss_spans array<long>")


def digest_formatted(formatted: DataFrame) -> DataFrame:
    """What the formatted strings and loss masks say when read back, as counts and digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist(), strict=True):
                turns = parse_turns(text)
                said = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                loss = "".join(unescape(text[a:b]) for a, b in zip(spans[::2], spans[1::2], strict=True))
                out.append((len(turns), said, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("tree"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = formatted.schema["tree"].dataType.simpleString()
    return formatted.mapInArrow(run, f"tree {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def threads(conversations: DataFrame) -> DataFrame:
    """Messages of linear conversations: each row replies to the row before it by (turn, role, text), so that repeated turns keep all their rows."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    node = F.row_number().over(order)
    rows = conversations.select("conv_id", "turn", "role", "text")
    return rows.select(F.col("conv_id").alias("tree"), node.alias("node"), F.when(node > 1, node - 1).alias("parent"), "role", "text", F.lit(1.0).alias("score"))
