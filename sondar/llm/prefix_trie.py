"""The trie of conversations by their first turns.

A turn's id is 16 bytes, big-endian: the length of its text, then a hash of role and text.  A
conversation's key is the ids of its turns.  Keys are dealt to shards by range, so
that a prefix's conversations stand side by side; each shard builds an adaptive radix tree, and
only depths at the end of a turn become nodes.

A shard knows all about a node unless its first or its last key starts with it.  These
two paths are handed on, a row for each shard, and folded together in rounds.
A group of copies or a shared first turn of any size thus costs each shard a path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondar.llm.common import quoted, staged
from sondar.llm.radix import Tree, shared

#: Bytes of a turn's id, and of the text length that it begins with.
TURN, LENGTH = 16, 4
#: Bytes of keys in a shard, each conversation taking ``EACH`` besides; a small table has smaller ones.
SHARD_BYTES, LEAST_BYTES, EACH = 8 << 20, 256 << 10, 64
FAN = 64
NOTHING = hashlib.sha256(b"").hexdigest()


def _big_endian(number: Column, digits: int) -> Column:
    return F.unhex(F.lpad(F.hex(number.cast("long")), 2 * digits, "0"))


def turn_id(role: Column, text: Column) -> Column:
    """A turn's id; null counts as empty."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    framed = F.concat(_big_endian(F.octet_length(role), 4), role.cast("binary"), text.cast("binary"))
    digits = 2 * (TURN - LENGTH)
    return F.concat(_big_endian(F.octet_length(text), LENGTH), F.unhex(F.substring(F.sha2(framed, 256), 1, digits)))


def keys(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, key) of every conversation: the ids of its turns by ``turn``, null first.

    Turns with equal numbers come in the order of their ids, repeated rows are turns of their own.  Rows
    without a conversation id belong to none.  A conversation is one value of 16 bytes a turn.
    """
    turns = conversations.where(quoted(conv).isNotNull()).select(
        quoted(conv).cast("long").alias("conv_id"), quoted(turn).alias("turn"), F.hex(turn_id(quoted(role), quoted(text))).alias("id"))
    listed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id"))).alias("turns"))
    return listed.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("key"))


def with_openings(found: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """The keys with their first turns replaced by those of another conversation: of c, the first
    h = crc32(c as text) % ``most`` by those of c - c % ``every``, as far as it has them."""
    lead = F.col("conv_id") - F.col("conv_id") % every
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most * TURN).cast("int")
    heads = found.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("lead"), F.substring("key", 1, TURN * (most - 1)).alias("head"))
    opened = found.withColumns({"lead": lead, "taken": taken}).join(heads, "lead", "left")
    head = F.substring(F.coalesce("head", F.lit(b"")), F.lit(1), F.col("taken"))
    return opened.select("conv_id", F.concat(head, F.substring(F.col("key"), F.col("taken") + 1, F.length("key"))).alias("key"))


_ROW = ("depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string, ref binary, parent_ref binary, "
        "shard long, first binary, last binary, path array<array<long>>, piece string")
_NAMES = [part.split()[0] for part in _ROW.split(", ")]
_KINDS = [pa.int32(), *[pa.int64()] * 6, pa.string(), pa.binary(), pa.binary(),
          pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.list_(pa.int64())), pa.string()]


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in zip(_NAMES, _KINDS)], names=_NAMES)


def _ref(prefix: bytes) -> bytes:
    return xxhash.xxh3_128_digest(prefix)


def _text_bytes(key: bytes, depth: int) -> int:
    """The length of the last text of the first ``depth`` turns."""
    return int.from_bytes(key[(depth - 1) * TURN : (depth - 1) * TURN + LENGTH], "big") if depth else 0


def _joined(ids: list[int]) -> str:
    return ",".join(map(str, ids))


class Below:
    """What lies under a place of the tree: conversations, and the finished nodes
    that wait for their parent."""

    __slots__ = ("n", "low", "waiting", "leaves", "saved", "key")

    def __init__(self):
        self.n, self.low, self.key = 0, None, None
        self.start_again()

    def start_again(self) -> None:
        self.waiting: list[dict] = []
        self.leaves = self.saved = 0

    def add(self, other: Below) -> None:
        self.n += other.n
        self.low = other.low if self.low is None else min(self.low, other.low)
        self.waiting += other.waiting
        self.leaves += other.leaves
        self.saved += other.saved
        self.key = other.key


def shard_rows(found: list[tuple[bytes, int]], shard: int) -> list[dict]:
    """The rows of a shard, given its (key, conversation) in order: finished nodes, pieces of the
    lists of conversations that end at an open node, and last its two open paths."""
    tree = Tree()
    for key, conv in found:
        tree.add(key, conv)
    first, last = found[0][0], found[-1][0]
    rows: list[dict] = []
    opened: dict[tuple[int, int], list[int]] = {}

    def emitted(here: Below, node, lowest: int, end: int) -> None:
        """The nodes at the turn ends of the bytes that lead into ``node``, deepest first."""
        if node.values:
            here.n += len(node.values)
            here.low = node.values[0] if here.low is None else min(here.low, node.values[0])
            here.key = node.key
        from_first, from_last = shared(first, here.key), shared(last, here.key)
        for depth in range(end // TURN, lowest - 1, -1):
            at = depth * TURN
            ends = node.values if at == end else []
            if at <= max(from_first, from_last):
                ref = _ref(here.key[:at])
                for row in here.waiting:
                    row["parent_ref"] = ref
                if ends:
                    rows.append({"ref": ref, "conv_id": ends[0], "piece": _joined(ends)})
                opened[at > from_first, depth] = [here.n, here.low, len(here.waiting), here.leaves, here.saved]
                here.start_again()
                continue
            here.saved += (here.n - 1) * _text_bytes(here.key, depth)
            here.leaves = here.leaves if here.waiting else 1
            row = {"depth": depth, "conv_id": here.low, "n_convs": here.n, "n_children": len(here.waiting), "n_leaves": here.leaves,
                   "saved_tokens": here.saved, "ends_sha256": hashlib.sha256(_joined(ends).encode()).hexdigest() if ends else NOTHING,
                   "shard": shard}
            for child in here.waiting:
                child["parent_conv_id"] = here.low
            here.waiting = [row]
            rows.append(row)

    # Children before parents, without recursion: a path may be long.
    root = tree.root
    stack = [(root, 0, len(root.prefix), root.items(), Below())]
    while stack:
        node, lowest, end, items, here = stack[-1]
        if (item := next(items, None)) is not None:
            below = item[1]
            stack.append((below, end // TURN + 1, end + 1 + len(below.prefix), below.items(), Below()))
            continue
        stack.pop()
        emitted(here, node, lowest, end)
        if stack:
            stack[-1][4].add(here)
    rows.append({"shard": shard, "first": first, "last": last, "path": [opened[k] for k in sorted(opened)]})
    return rows


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = []
    for batch in batches:
        found += zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist())
    if found:
        rows = shard_rows(found, TaskContext.get().partitionId())
        found.clear()
        for i in range(0, len(rows), 20_000):
            yield _batch(rows[i : i + 20_000])


@dataclass
class Open:
    """A node that may reach into the next shard."""

    depth: int
    n: int
    low: int
    children: int
    leaves: int
    saved: int

    def numbers(self) -> list[int]:
        return [self.n, self.low, self.children, self.leaves, self.saved]


def folded(paths: list[tuple[bytes, bytes, list[list[int]]]], shard: int, final: bool) -> list[dict]:
    """The (first key, last key, path) of neighbouring shards, in order, as one shard's rows:
    nodes that none but these shards have, and the open paths, unless it is the ``final`` fold."""
    rows: list[dict] = []
    stack: list[Open] = []
    kept: dict[int, Open] = {}
    now = first = paths[0][0]

    def back_to(depth: int) -> None:
        """Ends the nodes of the present path that are deeper."""
        of_first = -1 if final else shared(first, now) // TURN
        while stack and stack[-1].depth > depth:
            node = stack.pop()
            if node.depth <= of_first:
                kept[node.depth] = node
                continue
            node.saved += (node.n - 1) * _text_bytes(now, node.depth)
            node.leaves = node.leaves if node.children else 1
            rows.append({"depth": node.depth, "conv_id": node.low, "n_convs": node.n, "n_children": node.children,
                         "n_leaves": node.leaves, "saved_tokens": node.saved, "ref": _ref(now[: node.depth * TURN]),
                         "parent_ref": _ref(now[: (node.depth - 1) * TURN]) if node.depth else None})
            if stack:
                stack[-1].children += 1
                stack[-1].leaves += node.leaves
                stack[-1].saved += node.saved

    for begin, end, numbers in paths:
        both = shared(begin, end) // TURN
        for key, here in ((begin, enumerate(numbers[: len(begin) // TURN + 1])),
                          (end, enumerate(numbers[len(begin) // TURN + 1 :], both + 1))):
            back_to(shared(now, key) // TURN)
            now = key
            for depth, (n, low, children, leaves, saved) in here:
                if depth < len(stack):
                    node = stack[depth]
                    node.n += n
                    node.low = min(node.low, low)
                    node.children += children
                    node.leaves += leaves
                    node.saved += saved
                else:
                    stack.append(Open(depth, n, low, children, leaves, saved))
    if final:
        back_to(-1)
        return rows
    both = shared(first, now) // TURN
    path = {**kept, **{node.depth: node for node in stack[: both + 1]}}
    rows.append({"shard": shard, "first": first, "last": now,
                 "path": [path[d].numbers() for d in sorted(path)] + [node.numbers() for node in stack[both + 1 :]]})
    return rows


def _fold(final: bool):
    def fold(table: pa.Table) -> pa.Table:
        found = sorted(zip(*[table.column(n).to_pylist() for n in ("shard", "first", "last", "path")]))
        return pa.Table.from_batches([_batch(folded([f[1:] for f in found], found[0][0] // FAN, final))])

    return fold


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ref, ends_sha256) from sorted pieces, one at a time."""
    now, state, done = None, None, []
    for batch in batches:
        for ref, piece in zip(batch.column("ref").to_pylist(), batch.column("piece")):
            if ref != now:
                if state is not None:
                    done.append((now, state.hexdigest()))
                now, state = ref, hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.as_buffer())
    if state is not None:
        done.append((now, state.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())],
                                     names=["ref", "ends_sha256"])


def nodes(found: DataFrame, shard_bytes: int = SHARD_BYTES, fan: int = FAN, salts: int = 16) -> DataFrame:
    """The nodes of the trie over (conv_id, key): conv_id (the smallest conversation that starts
    with the node), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves (nodes
    without children in its subtree), saved_tokens (over its subtree, n_convs - 1 times the bytes of the
    last text) and ends_sha256 (of the conversations that end there, ascending, joined by commas).

    ``conv_id`` is unique in ``found``.  No conversations, no nodes; an empty key ends at the root.
    """
    found = staged(found, "keys")
    size = found.agg(F.sum(F.length("key") + EACH)).first()[0] or 0
    parallel = min(found.sparkSession.sparkContext.defaultParallelism, size // LEAST_BYTES)
    shards = max(1, -(-size // shard_bytes), parallel)
    built = staged(
        found.repartitionByRange(shards, "key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_built, _ROW), "shards")
    paths, merged = built.where("path is not null").select("shard", "first", "last", "path"), []
    shards = (paths.agg(F.max("shard")).first()[0] or 0) + 1
    while True:
        final = shards <= fan
        group = F.floor(F.col("shard") / fan)
        turn = staged(paths.groupBy(group.alias("g")).applyInArrow(_fold(final), _ROW), "folded")
        merged.append(turn.where("depth is not null"))
        if final:
            break
        paths, shards = turn.where("path is not null").select("shard", "first", "last", "path"), -(-shards // fan)
    crossing = merged[0]
    for more in merged[1:]:
        crossing = crossing.unionByName(more)
    # The hash of a list is serial by definition; its pieces pass one at a time.
    pieces = built.where("piece is not null").select("ref", "conv_id", "piece")
    ends = pieces.repartition("ref").sortWithinPartitions("ref", "conv_id").mapInArrow(_hashed, "ref binary, ends_sha256 string")
    parent = crossing.select(F.col("ref").alias("parent_ref"), F.col("conv_id").alias("parent"))
    numbers = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    crossing = crossing.drop("ends_sha256").join(ends, "ref", "left").join(parent, "parent_ref", "left").select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), *numbers, F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
    inside = built.where("depth is not null")
    salt = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(salts)).cast("int")
    # Many nodes may wait for one parent.
    spread = parent.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    waited = inside.where("parent_ref is not null").withColumn("salt", salt).join(spread, ["parent_ref", "salt"]).select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), *numbers, "ends_sha256")
    own = inside.where("parent_ref is null").select("conv_id", "depth", "parent_conv_id", *numbers, "ends_sha256")
    return own.unionByName(waited).unionByName(crossing).withColumn("depth", F.col("depth").cast("long"))
