"""The prefix trie of conversations: one node for each distinct beginning.

A conversation is an array of turns, a turn a digest of its role and text; texts are not moved.
Arrays are sorted over the cluster by range, so the conversations of a node stand together. In each
range one sweep keeps a stack of the open nodes on the path of the last array; the common prefix
with the next array says which of them end. What the first and the last array of a range have on
their paths may go on beyond its borders: these nodes leave the range open, with what is counted so
far, and are stitched by the same sweep over blocks of ranges, and blocks of blocks, until none is
open. A task holds one stack; the hottest prefix is counted in as many ranges as it fills.

``ends`` of a node, the list of conversations that end there, is hashed in its order. A long list
is written in chunks, which one task reads one after the other, as the hash asks for.

Defined results. Turns come by number, null first, equal numbers by digest; null role and text are
empty. A null conv_id is a conversation like others: the last one, of no digits. Repeated rows are
turns of their own. No conversations: no nodes. Other columns are not looked at. The digests of one
conversation are one row (32 characters a turn); its texts never are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import mixing, shared

#: Hex digits of a turn's digest.
KEY = 32
#: Conversations of a range, ranges (or blocks) that one task stitches, characters of a chunk.
RANGE_ROWS, FAN, CHUNK = 50_000, 64, 32_768
#: Parents of more children than this, and than this share of all nodes, are joined apart.
LARGE_ROWS, LARGE_NODES = 10_000, 10_000
#: Every how many conversations one begins whose first turns the others take over, and how many.
FAMILY, HEADS = 20, 4

SCHEMA = (
    "kind string, id binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "words long, ends_sha256 string, text string, start long, chunked boolean, left boolean, right boolean, block long, place long"
)


def placed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), key and words of every turn."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    key = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, KEY)
    turns = conversations.select("conv_id", "turn", key.alias("key"), mixing.word_count(text).alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "key")
    return turns.select("conv_id", (F.row_number().over(order) - 1).alias("place"), "key", "words")


def arrays(turns: DataFrame, where: Column | None = None) -> DataFrame:
    """One row for each conversation: its turns, or those for which ``where`` holds, in order."""
    turn = F.struct("place", "key", "words")
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn if where is None else F.when(where, turn))).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Each conversation c with the first h turns of c - c % FAMILY in place of its own first h;
    h: CRC-32 of its digits, modulo HEADS."""
    turns = placed_turns(conversations)
    h = F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")) % HEADS
    own = arrays(turns, F.col("place") >= h).withColumn("h", h.cast("int")).withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY)
    heads = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS - 1))
    heads = arrays(heads).select(F.col("conv_id").alias("family"), F.col("turns").alias("heads"))
    head = F.coalesce(F.slice("heads", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return own.join(heads, "family", "left").select("conv_id", F.concat(head, "turns").alias("turns"))


class _Node:
    """An open node, with what is known of it so far but for its open children."""

    __slots__ = ("id", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words", "ends", "size", "start", "chunked", "left")

    def __init__(self, id: bytes, parent: bytes | None, depth: int, words: int, left: bool) -> None:
        self.id, self.parent, self.depth, self.words, self.left = id, parent, depth, words, left
        self.conv_id, self.n_convs, self.n_children, self.n_leaves, self.saved_tokens = None, 0, 0, 0, 0
        self.ends, self.size, self.start, self.chunked = [], 0, 0, False

    def take(self, other: _Node) -> None:
        """Add what another fragment, or a child, has counted."""
        if self.conv_id is None or (other.conv_id is not None and other.conv_id < self.conv_id):
            self.conv_id = other.conv_id
        self.n_convs += other.n_convs
        self.n_children += other.n_children
        self.n_leaves += other.n_leaves
        self.saved_tokens += other.saved_tokens


class _Sweep:
    """The stack of one range or block. ``closed``: nothing goes on beyond its borders."""

    def __init__(self, block: int, closed: bool) -> None:
        self.block, self.closed = block, closed
        self.stack: list[_Node] = []
        self.kept: list[_Node] = []
        self.rows: list[dict] = []
        self.first = True

    def _chunk(self, node: _Node) -> None:
        self.rows.append({"kind": "chunk", "id": node.id, "text": ",".join(node.ends), "start": node.start})
        node.ends, node.size, node.chunked = [], 0, True

    def end(self, node: _Node, conv_id: int | None, start: int) -> None:
        """A conversation ends at the node."""
        if conv_id is not None and (node.conv_id is None or conv_id < node.conv_id):
            node.conv_id = conv_id
        node.n_convs += 1
        if not node.ends:
            node.start = start
        node.ends.append("" if conv_id is None else str(conv_id))
        node.size += len(node.ends[-1]) + 1
        if node.size >= CHUNK:
            self._chunk(node)

    def _merge(self, node: _Node, later: _Node) -> None:
        """A fragment of the same node from the next range."""
        node.take(later)
        if later.chunked and node.ends:
            self._chunk(node)
        if not node.ends:
            node.start = later.start
        node.chunked |= later.chunked
        node.ends += later.ends
        node.size += later.size
        if node.size >= CHUNK:
            self._chunk(node)

    def cut(self, depth: int) -> None:
        """Leave the nodes deeper than ``depth``: they are whole, or kept if the left border cuts
        them."""
        while self.stack and self.stack[-1].depth > depth:
            node = self.stack.pop()
            if node.left:
                self.kept.append(node)
                continue
            if not node.n_children:
                node.n_leaves = 1
            node.saved_tokens += (node.n_convs - 1) * node.words
            if node.chunked and node.ends:
                self._chunk(node)
            ends = None if node.chunked else hashlib.sha256(",".join(node.ends).encode()).hexdigest()
            self.rows.append(self._row(node, kind="node", ends_sha256=ends))
            if self.stack:
                parent, n = self.stack[-1], node.n_children
                node.n_children = 1
                parent.take(node)
                node.n_children = n

    def down(self, nodes: list[_Node]) -> None:
        """Go down a path of fragments from the root: merge what is open already, open the rest."""
        same = 0
        while same < min(len(nodes), len(self.stack)) and nodes[same].id == self.stack[same].id:
            same += 1
        self.cut(same - 1)
        for node, later in zip(self.stack, nodes[:same], strict=True):
            self._merge(node, later)
        for node in nodes[same:]:
            node.left = self.first and not self.closed
            self.stack.append(node)
        self.first = False

    def row(self, keys: list[str], words: list[int], same: int, conv_id: int | None, start: int) -> None:
        """One conversation, which has ``same`` turns in common with the one before it."""
        self.cut(same)
        left = self.first and not self.closed
        self.first = False
        if not self.stack:
            self.stack.append(_Node(bytes(16), None, 0, 0, left))
        for depth in range(len(self.stack), len(keys) + 1):
            above = self.stack[-1].id
            self.stack.append(_Node(hashlib.blake2b(above + keys[depth - 1].encode(), digest_size=16).digest(), above, depth, words[depth - 1], left))
        self.end(self.stack[-1], conv_id, start)

    def _row(self, node: _Node, **more) -> dict:
        names = ("id", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words")
        return {n: getattr(node, n) for n in names} | more

    def finish(self) -> None:
        """The nodes that the borders cut, the common part of both paths first."""
        if self.closed:
            self.cut(-1)
            return
        common = [x for x in self.stack if x.left]
        for place, node in enumerate([*common, *reversed(self.kept), *self.stack[len(common) :]]):
            right = place < len(common) or place >= len(common) + len(self.kept)
            held = {"text": ",".join(node.ends) if node.ends else None, "start": node.start, "chunked": node.chunked}
            self.rows.append(self._row(node, kind="spine", left=node.left, right=right, block=self.block, place=place, **held))

    def batches(self, least: int) -> Iterator:
        import pyarrow as pa

        if len(self.rows) >= least:
            yield from pa.Table.from_pylist(self.rows, _arrow_schema()).to_batches(shared.ARROW_ROWS)
            self.rows.clear()


def _arrow_schema():
    import pyarrow as pa

    kinds = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in SCHEMA.split(", "))])


def _swept(batches: Iterator) -> Iterator:
    """One range of sorted arrays."""
    from pyspark import TaskContext

    block = TaskContext.get().partitionId()
    sweep, before, number = _Sweep(block, closed=False), [], block << 40
    for batch in batches:
        for conv_id, path, words in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            keys = [path[i : i + KEY] for i in range(0, len(path), KEY)]
            same = 0
            while same < min(len(keys), len(before)) and keys[same] == before[same]:
                same += 1
            sweep.row(keys, words, same, conv_id, number)
            before, number = keys, number + 1
            yield from sweep.batches(5 * shared.ARROW_ROWS)
    if not sweep.first:
        sweep.finish()
    yield from sweep.batches(1)


def _stitched(closed: bool):
    def stitch(batches: Iterator) -> Iterator:
        """The open nodes of consecutive blocks, by group and block."""
        sweep, block, left, right, common = None, None, [], [], 0

        def add() -> None:
            sweep.down(left)
            sweep.cut(common - 1)
            sweep.stack += right[common:]

        for batch in batches:
            for x in batch.to_pylist():
                if block is not None and x["block"] != block:
                    add()
                    left, right, common = [], [], 0
                if sweep is None or sweep.block != x["group"]:
                    if sweep is not None:
                        sweep.finish()
                        yield from sweep.batches(1)
                    sweep = _Sweep(x["group"], closed)
                block = x["block"]
                node = _Node(x["id"], x["parent"], x["depth"], x["words"], False)
                for name in ("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "start", "chunked"):
                    setattr(node, name, x[name])
                node.ends = [] if x["text"] is None else [x["text"]]
                node.size = sum(len(t) + 1 for t in node.ends)
                left += [node] if x["left"] else []
                right += [node] if x["right"] else []
                common += x["left"] and x["right"]
            if sweep is not None:
                yield from sweep.batches(5 * shared.ARROW_ROWS)
        if sweep is not None:
            add()
            sweep.finish()
            yield from sweep.batches(1)

    return stitch


def _hashed(batches: Iterator) -> Iterator:
    """SHA-256 of each node's chunks, which come in order."""
    import pyarrow as pa

    now, digest = None, None
    out: list[dict] = []
    for batch in batches:
        for id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if id != now:
                out += [] if now is None else [{"id": now, "ends": digest.hexdigest()}]
                now, digest = id, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.encode())
    out += [] if now is None else [{"id": now, "ends": digest.hexdigest()}]
    yield pa.RecordBatch.from_pylist(out, pa.schema([("id", pa.binary()), ("ends", pa.string())]))


def prefix_trie(conversations: DataFrame, range_rows: int = RANGE_ROWS, fan: int = FAN) -> DataFrame:
    """All nodes of the arrays (conv_id, turns with key and words): conv_id (the smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    shared.prepare(spark)
    path = F.array_join(F.transform("turns", lambda t: t["key"]), "")
    rows = shared.stored(conversations.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["words"]).alias("words")), "trie-arrays")
    n = rows.count()
    parts = max(1, min(spark.sparkContext.defaultParallelism, n // 1000), -(-n // range_rows))
    order = ["path", F.col("conv_id").asc_nulls_last()]
    level = shared.stored(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_swept, SCHEMA), "trie-level")
    shared.dropped(rows)
    levels = [level]
    top = level.filter("kind = 'spine'").agg(F.max("block")).first()[0]
    while top is not None:
        groups = top // fan + 1
        open_nodes = level.filter("kind = 'spine'").withColumn("group", F.floor(F.col("block") / fan))
        dealt = open_nodes.repartition(groups, "group").sortWithinPartitions("group", "block", "place")
        level = shared.stored(dealt.mapInArrow(_stitched(groups == 1), SCHEMA), "trie-level")
        levels.append(level)
        top = groups - 1 if groups > 1 else None
    whole = levels[0]
    for x in levels[1:]:
        whole = whole.unionByName(x)
    return _told(whole)


def _told(whole: DataFrame) -> DataFrame:
    """Nodes with the names of their parents and the hashes of long lists."""
    nodes = whole.filter("kind = 'node'").drop("kind", "text", "start", "chunked", "left", "right", "block", "place", "words")
    chunks = whole.filter("kind = 'chunk'").select("id", "text", "start").repartition("id").sortWithinPartitions("id", "start")
    hashed = shared.stored(chunks.select("id", "text").mapInArrow(_hashed, "id binary, ends string"), "trie-ends", narrow=True)
    parents = nodes.filter("n_children > 0").select(F.col("id").alias("parent"), F.col("conv_id").alias("up"), F.col("n_children").alias("c"))
    size = parents.agg(F.count(F.lit(1)), F.sum("c")).first()
    bound = max(LARGE_ROWS, (size[1] or 0) // LARGE_NODES)
    few = parents.filter(F.col("c") > bound).select("parent", F.col("up").alias("u1"))
    most = parents.filter(F.col("c") <= bound).select("parent", F.col("up").alias("u2"))
    out = nodes.join(F.broadcast(few), "parent", "left").join(shared.small(most, size[0]), "parent", "left")
    out = out.join(shared.small(hashed, hashed.count()), "id", "left")
    ends = F.coalesce("ends_sha256", "ends").alias("ends_sha256")
    return out.select("conv_id", "depth", F.coalesce("u1", "u2").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", ends)
