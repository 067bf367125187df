"""The trie of shared beginnings of conversations, by a splitter skeleton.

A turn becomes a symbol of 24 bytes: 16 of the SHA-256 of its role and text, then the length of the
text in UTF-8 bytes. A conversation's path is its symbols on end, so that sorting by (path, ``conv_id``)
puts the members of every node side by side, parents before children. Texts are not moved.

Paths are range-partitioned into shards, cut at splitters. A node that several shards have members of
is a beginning of a splitter's path; these nodes are the skeleton. Their trie is broadcast in flat
form: for each splitter the number of turns that it shares with the row before it and with the last row
of its own shard (16 bytes a shard), which gives every skeleton node a name, (shard it begins in, depth). The shared path of the next
splitter, which only that shard compares with, heads the shard's rows. Every shard then finishes all its
other nodes alone in one pass over its sorted rows with a stack as deep as a path, and gives one partial
aggregate for each skeleton node that it meets. These are reduced by name and combined along the
skeleton, whose size depends on the number of shards and the depth, not on the number of conversations.

Nothing grows with a node's size: a node with more than ``KIDS`` finished children lets them go under its
name, which is resolved by a join at the end, and one with more than ``IDS`` conversations that end there,
or whose conversations span shards, is hashed from written blocks of ids, read in order.

Turns go by ``turn`` (null first), then by role, then by the digest of the text; a null role or text is
the empty one. Rows without ``conv_id`` belong to no conversation. An empty table has no node. One
conversation's symbols are held together, 24 bytes a turn. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window as W

from crawlflow.session import materialize

SYMBOL = 24
#: Finished children that a node holds back until its smallest member is known.
KIDS = 4096
#: Ids that a node holds back until it is finished, and those of a written block.
IDS = 4096
ROWS = 8192
NO_ENDS = hashlib.sha256(b"").hexdigest()
#: Conversations that share a beginning, and the most turns that are shared.
FAMILY, HEAD = 5, 8


def symbols(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, symbol`` (hex) of every turn."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    symbol = F.concat(F.substring(F.sha2(named, 256), 1, 32), F.lpad(F.lower(F.hex(F.octet_length(text))), 16, "0"))
    return conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", role.alias("role"), symbol.alias("symbol"))


def paths(conversations: DataFrame) -> DataFrame:
    """``conv_id, path`` of the conversations as they stand."""
    return _own(symbols(conversations), "conv_id").select("conv_id", F.unhex(F.array_join("own", "")).alias("path"))


def _own(turns: DataFrame, *keys: str) -> DataFrame:
    place = F.struct(F.isnotnull("turn").alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"), "role", "symbol")
    grouped = turns.groupBy(*keys).agg(F.array_sort(F.collect_list(place)).alias("own"))
    return grouped.withColumn("own", F.transform("own", lambda t: t["symbol"]))


def rebuilt_paths(conversations: DataFrame, family: int = FAMILY, head: int = HEAD) -> DataFrame:
    """``conv_id, path`` after conversation c got the first h turns of conversation c - c % ``family`` in
    place of its own first h, h being the crc32 of its decimal id modulo ``head`` + 1.

    One exchange by family serves the grouping and the look-up.
    """
    turns = symbols(conversations).withColumn("base", F.col("conv_id") - F.col("conv_id") % family).repartition("base")
    own = _own(turns, "base", "conv_id")
    first = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, head))).over(W.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (head + 1)).cast("int")
    shared = own.select("conv_id", "own", first.alias("first"), h.alias("h"))
    path = F.concat(
        F.slice(F.coalesce("first", F.array().cast("array<string>")), F.lit(1), F.col("h")),
        F.slice("own", F.col("h") + 1, F.size("own")),
    )
    return shared.select("conv_id", F.unhex(F.array_join(path, "")).alias("path"))


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns at the beginning in which two paths agree."""
    low, high = 0, min(len(a), len(b)) // SYMBOL
    while low < high:
        mid = (low + high + 1) // 2
        if a[low * SYMBOL : mid * SYMBOL] == b[low * SYMBOL : mid * SYMBOL]:
            low = mid
        else:
            high = mid - 1
    return low


def _splitters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each shard in order: turns that its first path shares with the path before, those turns, and how
    many it shares with the last path."""
    last = None
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("shard", "first", "last")), strict=True)
        shards, turns, shown, left, through = [], [], [], [], []
        for shard, first, end in rows:
            n = -1 if last is None else shared_turns(last[1], first)
            shards.append(shard)
            turns.append(n)
            shown.append(first[: max(n, 0) * SYMBOL])
            left.append(None if last is None else last[0])
            through.append(shared_turns(first, end))
            last = shard, end
        types = pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64()
        columns = zip((shards, turns, shown, left, through), types, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], ["shard", "turns", "path", "left", "through"])


OUT = (
    ("kind", "string"), ("conv_id", "long"), ("depth", "long"), ("parent_conv_id", "long"), ("n_convs", "long"),
    ("n_children", "long"), ("n_leaves", "long"), ("saved_tokens", "long"), ("ends", "string"), ("size", "long"),
    ("shard", "int"), ("start", "long"), ("p_shard", "int"), ("p_start", "long"), ("at", "int"), ("seq", "long"),
)
_TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}


class Node:
    """What is known of a node so far. ``key``: the shard it begins in and its row there, -1 in the skeleton."""

    __slots__ = ("begins", "blocks", "children", "depth", "ids", "key", "kids", "least", "leaves", "n", "saved", "size", "wide")

    def __init__(self, depth: int, size: int, key: tuple[int, int], begins: bool):
        self.depth, self.size, self.key, self.begins = depth, size, key, begins
        self.least, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ids: list[str] = []
        self.kids: list[list] = []
        self.wide, self.blocks = False, 0


class Shard:
    """One pass over the sorted rows of a shard."""

    def __init__(self, shard: int, shape: dict[int, tuple], right: bytes | None):
        self.shard, self.shape, self.right = shard, shape, right
        self.stack: list[Node] = []
        self.last: bytes | None = None
        self.row = 0
        self.out: list[list] = []

    def owner(self, depth: int) -> int:
        """The shard in which a skeleton node that the first path begins with has its first member."""
        shard, (turns, before, _) = self.shard, self.shape[self.shard]
        while turns >= depth:
            shard, (turns, before, through) = before, self.shape[before]
            if through < depth:
                break
        return shard

    def add(self, conv_id: int, path: bytes) -> None:
        if self.last is None:
            keep, shared = 0, self.shape[self.shard][0]
        else:
            keep, shared = shared_turns(self.last, path) + 1, -1
        while len(self.stack) > keep:
            self.close()
        open_to = shared_turns(path, self.right) if self.right is not None else -1
        for depth in range(keep, len(path) // SYMBOL + 1):
            size = int.from_bytes(path[depth * SYMBOL - 8 : depth * SYMBOL]) if depth else 0
            begins = depth > shared
            if not begins:
                key = self.owner(depth), -1
            else:
                key = self.shard, -1 if depth <= open_to else self.row
            if begins and self.stack:
                self.stack[-1].children += 1
            self.stack.append(Node(depth, size, key, begins))
        node = self.stack[-1]
        node.n += 1
        node.least = conv_id if node.least is None else min(node.least, conv_id)
        node.ids.append(str(conv_id))
        if len(node.ids) >= IDS:
            self.block(node)
        self.last, self.row = path, self.row + 1

    def block(self, node: Node) -> None:
        """A written block of the ids that end at a node."""
        if node.ids:
            row = dict(kind="ids", depth=node.depth, ends=",".join(node.ids), shard=node.key[0], start=node.key[1], at=self.shard, seq=node.blocks)
            self.put(row)
            node.ids, node.blocks = [], node.blocks + 1

    def put(self, row: dict) -> None:
        self.out.append([row.get(name) for name, _ in OUT])

    def release(self, node: Node, parent: int | None) -> None:
        """The children held back, with their parent's member or, not known yet, its name."""
        for row in node.kids:
            if parent is None:
                row["p_shard"], row["p_start"] = node.key
            else:
                row["parent_conv_id"] = parent
            self.put(row)
        node.kids = []

    def close(self) -> None:
        node = self.stack.pop()
        parent = self.stack[-1] if self.stack else None
        row = dict(conv_id=node.least, depth=node.depth, n_convs=node.n, n_children=node.children)
        if parent:
            parent.n += node.n
            parent.least = node.least if parent.least is None else min(parent.least, node.least)
        if node.key[1] < 0:
            self.block(node)
            self.release(node, None)
            self.put(row | dict(kind="part", n_leaves=node.leaves, saved_tokens=node.saved, size=node.size, shard=node.key[0], start=-1))
            return
        row |= dict(kind="node", n_leaves=node.leaves or 1, saved_tokens=node.saved + (node.n - 1) * node.size)
        if node.blocks:
            self.block(node)
        else:
            row["ends"] = hashlib.sha256(",".join(node.ids).encode()).hexdigest()
        if node.blocks or node.wide:
            row |= dict(shard=node.key[0], start=node.key[1])
        self.release(node, None if node.wide else node.least)
        if not parent:
            self.put(row)
            return
        parent.leaves += row["n_leaves"]
        parent.saved += row["saved_tokens"]
        parent.kids.append(row)
        if len(parent.kids) >= KIDS:
            parent.wide = True
            self.release(parent, None)

    def rows(self) -> Iterator[pa.RecordBatch]:
        columns = zip(*self.out, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, OUT, strict=True)], [n for n, _ in OUT])
        self.out = []

    def finish(self) -> Iterator[pa.RecordBatch]:
        while self.stack:
            self.close()
        if self.out:
            yield from self.rows()


def _finish_shards(batches: Iterator[pa.RecordBatch], shape: dict[int, tuple]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard and path; the one without ``conv_id`` heads a shard and shows the next splitter."""
    work, right = None, {}
    for batch in batches:
        for shard, conv_id, path in zip(*(batch.column(c).to_pylist() for c in ("shard", "conv_id", "path")), strict=True):
            if conv_id is None:
                right[shard] = path
                continue
            if work is None or work.shard != shard:
                if work:
                    yield from work.finish()
                work = Shard(shard, shape, right.pop(shard, None))
            work.add(conv_id, path)
            if len(work.out) >= ROWS:
                yield from work.rows()
    if work:
        yield from work.finish()


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Skeleton nodes, parents first: what lies below is added from the ends up."""
    names = [f.split()[0] for f in NODE.split(", ")] + ["shard"]
    stack: list[dict] = []

    def close(done: list[dict]) -> None:
        node = stack.pop()
        node["n_leaves"] = node["n_leaves"] if node["n_children"] else 1
        node["saved_tokens"] += (node["n_convs"] - 1) * node["size"]
        if stack:
            node["parent_conv_id"] = stack[-1]["conv_id"]
            stack[-1]["n_leaves"] += node["n_leaves"]
            stack[-1]["saved_tokens"] += node["saved_tokens"]
        done.append(node)

    def table(done: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d.get(c) for d in done], pa.int32() if c == "shard" else pa.int64()) for c in names], names)

    for batch in batches:
        done: list[dict] = []
        for node in batch.to_pylist():
            while stack and stack[-1]["depth"] >= node["depth"]:
                close(done)
            stack.append(node)
        yield table(done)
    done = []
    while stack:
        close(done)
    yield table(done)


def _hash_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids from its blocks in order, one block at a time."""
    key, state = None, None
    types = pa.int32(), pa.int64(), pa.int64(), pa.string()

    def table(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["shard", "depth", "start", "ends"])

    for batch in batches:
        done = []
        for *at, ids in zip(*(batch.column(c).to_pylist() for c in ("shard", "depth", "start", "ends")), strict=True):
            if at != key:
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = at, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield table(done)
    if key:
        yield table([(*key, state.hexdigest())])


def prefix_trie(paths: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``: a row for
    every beginning that a conversation of ``conv_id, path`` has, the empty one included."""
    spark = paths.sparkSession
    n_shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = materialize(paths.select("conv_id", "path"), "trie-paths")  # dealt by a sample of itself
    dealt = whole.repartitionByRange(n_shards, "path", "conv_id").withColumn("shard", F.spark_partition_id())
    shards = materialize(dealt, "trie-shards")
    ends = shards.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    splitters = materialize(ends.repartition(1).sortWithinPartitions("shard").mapInArrow(_splitters, "shard int, turns long, path binary, left int, through long"), "trie-splitters")
    known = splitters.select("shard", "turns", "left", "through").collect()  # a row a shard
    skeleton_shape = {r.shard: (r.turns, r.left, r.through) for r in known}
    heads = splitters.where("left is not null").select(F.lit(None).cast("long").alias("conv_id"), "path", F.col("left").alias("shard"))
    rows = shards.unionByName(heads).repartitionById(n_shards, F.col("shard"))
    rows = rows.sortWithinPartitions("shard", F.col("conv_id").isNotNull(), "path", "conv_id")
    shape = ", ".join(f"{n} {t}" for n, t in OUT)
    out = materialize(rows.mapInArrow(lambda it: _finish_shards(it, skeleton_shape), shape), "trie-nodes")

    parts = out.where("kind = 'part'").groupBy("shard", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("size").alias("size"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    skeleton = parts.repartition(1).sortWithinPartitions("shard", "depth").mapInArrow(_combine, f"{NODE}, shard int")
    skeleton = materialize(skeleton, "trie-skeleton")
    blocks = out.where("kind = 'ids'").select("shard", "depth", "start", "at", "seq", "ends").repartition(n_shards, "shard", "depth", "start")
    hashed = blocks.sortWithinPartitions("shard", "depth", "start", "at", "seq").mapInArrow(
        _hash_blocks, "shard int, depth long, start long, ends string"
    )
    hashed = materialize(hashed, "trie-ends")

    columns = [f.split()[0] for f in NODE.split(", ")]
    nodes = out.where("kind = 'node'")
    names = nodes.where("shard is not null").select("shard", "start", "depth", "conv_id").unionByName(
        skeleton.select("shard", F.lit(-1).cast("long").alias("start"), "depth", "conv_id")
    )
    parents = names.select(
        F.col("shard").alias("p_shard"), F.col("start").alias("p_start"), (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("named"),
    )
    under = nodes.where("p_shard is not null").join(parents, ["p_shard", "p_start", "depth"], "left").withColumn("parent_conv_id", F.col("named"))
    placed = nodes.where("p_shard is null").unionByName(under.select(*nodes.columns))
    finished = placed.where("ends is not null").select(*columns, "ends")
    keyed = placed.where("ends is null").select(*columns, "shard", "start").unionByName(
        skeleton.select(*columns, "shard", F.lit(-1).cast("long").alias("start"))
    )
    later = keyed.join(hashed, ["shard", "depth", "start"], "left").select(*columns, F.coalesce("ends", F.lit(NO_ENDS)).alias("ends"))
    return finished.unionByName(later).withColumnRenamed("ends", "ends_sha256")
