r"""Reply trees to formatted conversations.

Messages form trees by parent. Root-to-leaf paths come from iterative self-joins with doubled
reach: after each join every message knows the ancestor twice as far up, so the joins number the
logarithm of the depth. Along with the pointer go depth and summed score; leaves are ranked by
their path's score, the best ``branches`` of each tree are chosen, and the same pointers, read
from far to near, mark the messages of the chosen paths. Each path becomes one text.

Template, for each turn: ``### role: text``, newline, ``</turn>``, newline. Inside texts and
roles a backslash goes before each backslash, each ``#`` and each ``</turn`` (in roles also
before ``:``), so the marks never occur inside and the text can be read back.

Defined results: null text and null role are empty; rows of one turn follow each other by role
and text; a null turn comes first; rows with a null conversation form one conversation; a table
without rows gives no conversation. A parent that does not exist makes a message a root. Of rows
that repeat a node of a tree one stays, the first by parent (none before any), highest score, role
and text; a null node is no message. Messages whose parents form a cycle have no root: the smallest
node of the cycle becomes one. A conversation is one text, so a row, in the end: the largest one
must fit a worker. Columns other than those named are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import shared

LOSS_ROLE = "assistant"
END = "\n</turn>\n"
HEADER = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.DOTALL)
FORMATTED = "formatted string, spans array<struct<start:long,stop:long>>, n_turns long"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("#", "\\#").replace("</turn", "\\</turn")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def format_turns(turns: list[tuple[str, str]], loss_role: str = LOSS_ROLE) -> tuple[str, list[tuple[int, int]]]:
    """The text of (role, text) turns and the spans of it that count in the loss."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"### {escape(role).replace(':', chr(92) + ':')}: ", escape(text)
        if role == loss_role:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        head = HEADER.match(formatted, at)
        stop = formatted.index(END, head.end())
        turns.append((unescape(head[1]), unescape(formatted[head.end() : stop])))
        at = stop + len(END)
    return turns


def message_chain(rows: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) as messages: each row answers the one before."""
    tree = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n"))
    order = Window.partitionBy("tree").orderBy(F.asc_nulls_first("turn"), "role", "text")
    rows = rows.select(tree.alias("tree"), "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return rows.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(0.0))


def single(messages: DataFrame) -> DataFrame:
    """One row for each node of a tree; see the module's text."""
    order = Window.partitionBy("tree", "node").orderBy(F.asc_nulls_first("parent"), F.desc_nulls_last("score"), "role", "text")
    rows = messages.filter("node is not null").select("tree", "node", "parent", "score", "role", "text")
    return rows.withColumn("n", F.row_number().over(order)).filter("n = 1").drop("n")


def _reached(nodes: DataFrame, joins: int) -> list[DataFrame]:
    """Pointers of all nodes after 0, 1, 2 ... joins: tree, node, up, depth, score and the least
    node on the way. The last has none left, unless parents form cycles: ``joins`` are enough for
    any path."""
    there = nodes.select("tree", F.col("node").alias("parent"), F.col("node").alias("up"))
    known = nodes.join(there, ["tree", "parent"], "left").select("tree", "node", "up", F.lit(1).cast("long").alias("depth"), "score", F.col("node").alias("least"))
    levels = [shared.stored(known, "chat-level")]
    while len(levels) <= joins and not levels[-1].filter("up is not null").isEmpty():
        last = levels[-1]
        far = last.select("tree", F.col("node").alias("up"), F.col("up").alias("far_up"), F.col("depth").alias("far_depth"), F.col("score").alias("far_score"), F.col("least").alias("far_least"))
        going = last.filter("up is not null").join(far, ["tree", "up"])
        going = going.select("tree", "node", F.col("far_up").alias("up"), (F.col("depth") + F.col("far_depth")).alias("depth"), (F.col("score") + F.col("far_score")).alias("score"), F.least("least", "far_least").alias("least"))
        levels.append(shared.stored(last.filter("up is null").unionByName(going), "chat-level"))
    return levels


def chosen_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """tree, leaf, rank, node, depth of the messages on the best paths.

    ``messages``: tree, node (one row each, see ``single``), parent, score (null: 0). Ties go to
    the smaller leaf. ``branches`` None keeps every path.
    """
    nodes = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    joins = largest.bit_length() + 1
    levels = _reached(nodes, joins)
    lost = levels[-1].filter("up is not null")
    if not lost.isEmpty():
        # where their pointers stand after so many steps is on a cycle, of which the least node is known
        ends = lost.select("tree", F.col("up").alias("node")).distinct().join(lost, ["tree", "node"]).select("tree", F.col("least").alias("node")).distinct()
        ends = shared.stored(ends.withColumn("cut", F.lit(True)), "chat-cycles", narrow=True)
        nodes = nodes.join(ends, ["tree", "node"], "left").select("tree", "node", F.when(F.col("cut").isNull(), F.col("parent")).alias("parent"), "score")
        nodes = shared.stored(nodes, "chat-cut")
        levels = _reached(nodes, joins)
    paths = levels.pop()  # every pointer has reached the root
    inner = nodes.filter("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    leaves = paths.join(inner, ["tree", "node"], "left_anti")
    if branches is not None:
        rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "node"))
    else:
        rank = F.lit(1)
    marked = leaves.withColumn("rank", rank)
    if branches is not None:
        marked = marked.filter(F.col("rank") <= branches)
    marked = marked.select("tree", "rank", F.col("node").alias("leaf"), "node")
    for level in reversed(levels):
        steps = level.filter("up is not null").select("tree", "node", "up")
        above = marked.join(steps, ["tree", "node"]).select("tree", "rank", "leaf", F.col("up").alias("node"))
        marked = shared.stored(marked.unionByName(above), "chat-marked")
    return marked.join(paths.select("tree", "node", "depth"), ["tree", "node"])


def _format(loss_role: str):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            rows = batch.column(1).to_pylist()
            made = [format_turns([(t["role"] or "", t["text"] or "") for t in turns], loss_role) for turns in rows]
            spans = [[{"start": a, "stop": b} for a, b in s] for _, s in made]
            counts = [len(turns) for turns in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t for t, _ in made], pa.string()), pa.array(spans, kind), pa.array(counts, pa.int64())], names=["key", "formatted", "spans", "n_turns"])

    return run


def format_trees(messages: DataFrame, branches: int = 1, loss_role: str = LOSS_ROLE, numbered: bool = False) -> DataFrame:
    """One row for each chosen path: tree, leaf, rank, formatted, spans (of the loss), n_turns.

    ``messages``: tree, node, parent, score, role, text; ``numbered`` says that no node repeats.
    """
    shared.prepare(messages.sparkSession)
    if not numbered:
        messages = shared.stored(single(messages), "chat-single")
    paths = chosen_paths(messages, branches).join(messages.select("tree", "node", "role", "text"), ["tree", "node"])
    turns = F.array_sort(F.collect_list(F.struct("depth", "role", "text")))
    keyed = paths.groupBy("tree", "leaf", "rank").agg(turns.alias("turns"))
    keyed = keyed.select(F.struct("tree", "leaf", "rank").alias("key"), "turns")
    return keyed.mapInArrow(_format(loss_role), f"key struct<tree:string,leaf:long,rank:int>, {FORMATTED}").select("key.*", "formatted", "spans", "n_turns")


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read_back(batches: Iterator) -> Iterator:
    import hashlib

    import pyarrow as pa

    for batch in batches:
        rows = []
        for conv_id, formatted, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            turns = read_turns(formatted)
            said = "".join(f"{role}\n{text}\n" for role, text in turns)
            loss = "".join(unescape(formatted[s["start"] : s["stop"]]) for s in spans)
            rows.append((conv_id, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in READ.split(", ")])


def read_back(formatted: DataFrame) -> DataFrame:
    """What conv_id, formatted and spans hold, read from the formatted text alone; see READ."""
    shared.prepare(formatted.sparkSession)
    return formatted.select("conv_id", "formatted", "spans").mapInArrow(_read_back, READ)
