"""The trie of conversations that begin alike: its nodes are the distinct sequences of first turns.

A turn is known by a 128-bit digest, and a sequence of first turns by its depth
and a sum of digests, each times a power of a fixed base that its place gives,
in four lanes modulo a prime: sums along a conversation are one cumulative sum.

Conversations are cut into shards by ranges of their ids. A shard enumerates
the distinct prefix digests of its conversations, gives each a slot by a minimal
perfect hash whose answers are checked against the keys in the slots, and holds
the trie in flat arrays by slot: parent slot, depth, members, smallest member.
What shards say about one node is added up. Then each node is counted once,
in the shard of its smallest member, and sums over subtrees run from the deepest
nodes up through the parent slots; the shards' partial sums are added up again,
so a beginning that a third of all conversations share is one row a shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestay.llm.common import stored

#: Turns in a shard, about: its arrays take some 200 bytes a turn. A conversation is in one shard.
SHARD_TURNS = 1 << 18
#: Rows handed to Spark at a time.
ROWS = 1 << 14

PRIME = (1 << 31) - 1
BASES = np.array([48271, 69621, 742938285, 1583458089], np.int64)

LOCAL = (
    "shard int, slot int, parent_slot int, key binary, parent_key binary, depth long, n_bytes long, n_convs long, "
    "owner long, first_end long, ends binary")


# ---- minimal perfect hash ----------------------------------------------------------------------------------------


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """64 well-spread bits of each key, others at each level."""
    out = np.full(len(keys), 0x9E3779B97F4A7C15 * (2 * level + 1) & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for column in keys.T:
        out = out ^ column
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            out = (out ^ (out >> np.uint64(shift))) * np.uint64(factor)
        out ^= out >> np.uint64(31)
    return out


class MinimalHash:
    """Slots 0 to n - 1 for n distinct keys, rows of a uint64 array.

    Level by level keys are thrown into an array twice as large as their
    number; those alone in their place stay, the others go on. A key's slot is
    the number of kept places before its own. It depends on the set of keys only.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        rest, before, level = keys, 0, 0
        while len(rest):
            place = self._place(rest, level, max(8, 2 * len(rest)))
            kept = np.bincount(place, minlength=max(8, 2 * len(rest))) == 1
            self.levels.append((kept, before + np.cumsum(kept) - 1))
            before += int(kept.sum())
            rest, level = rest[~kept[place]], level + 1
            if level > 64:
                raise ValueError("the keys are not distinct")
        self.keys = np.zeros_like(keys)
        self.keys[self._slots(keys)] = keys

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (_mixed(keys, level) % np.uint64(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (kept, slot) in enumerate(self.levels):
            place = self._place(keys[open_], level, len(kept))
            hit = kept[place]
            out[open_[hit]] = slot[place[hit]]
            open_ = open_[~hit]
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key. A key that is not the one in the slot it is sent to is an error."""
        found = self._slots(keys)
        if len(keys) and (found.min() < 0 or (self.keys[found] != keys).any()):
            raise ValueError("a key that the table does not hold")
        return found


# ---- a shard -----------------------------------------------------------------------------------------------------


def _powers(n: int) -> np.ndarray:
    """BASES to the powers 0 to n - 1, modulo PRIME."""
    out = np.ones((1, 4), np.int64)
    step = BASES % PRIME
    while len(out) < n:
        out = np.concatenate([out, out * step % PRIME])
        step = step * step % PRIME
    return out[:n]


def prefix_keys(starts: np.ndarray, depth: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """The key of the first ``depth`` turns at each row: two words of digest and the depth.

    ``starts`` is the row of depth 0 of each row's conversation, ``turns`` holds four numbers below PRIME a row.
    """
    if not len(depth):
        return np.zeros((0, 3), np.uint64)
    terms = turns * _powers(int(depth.max()) + 1)[depth] % PRIME
    terms[depth == 0] = 0
    sums = np.cumsum(terms, axis=0)
    lanes = ((sums - sums[starts]) % PRIME).astype(np.uint64)
    return np.stack([lanes[:, 0] << np.uint64(32) | lanes[:, 1], lanes[:, 2] << np.uint64(32) | lanes[:, 3], depth.astype(np.uint64)], axis=1)


def _binary(keys: np.ndarray, mask: np.ndarray | None = None) -> pa.Array:
    flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(24), len(keys), [None, pa.py_buffer(np.ascontiguousarray(keys).tobytes())])
    out = flat.cast(pa.binary())
    return out if mask is None else pc.if_else(pa.array(mask), pa.scalar(None, pa.binary()), out)


def _keys(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 3)


def _sent(columns: list[pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    batch = pa.RecordBatch.from_arrays(columns, names)
    for a in range(0, batch.num_rows, ROWS):
        yield batch.slice(a, ROWS)


def _shard_of_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The node table of one partition's conversations, in the order of its slots."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    conv, depth, n_bytes = (table.column(c).to_numpy() for c in ("conv_id", "depth", "n_bytes"))
    turns = np.frombuffer(b"".join(table.column("digest").to_pylist()), "<u4").reshape(-1, 4).astype(np.int64) % PRIME
    del table, held
    begins = np.flatnonzero(depth == 0)
    starts = np.repeat(begins, np.diff(np.append(begins, len(depth))))
    keys = prefix_keys(starts, depth, turns)

    order = np.lexsort((np.arange(len(keys)), keys[:, 2], keys[:, 1], keys[:, 0]))
    fresh = np.append(True, (keys[order[1:]] != keys[order[:-1]]).any(1))
    firsts = order[fresh]  # of each distinct key the first row, that of the smallest conversation
    found = MinimalHash(keys[firsts])
    slot = found.slots(keys)
    n = len(firsts)
    parent, at_depth, size, owner = (np.full(n, -1, np.int64) for _ in range(4))
    deep = firsts[depth[firsts] > 0]
    parent[slot[deep]] = slot[deep - 1]
    at_depth[slot[firsts]], size[slot[firsts]], owner[slot[firsts]] = depth[firsts], n_bytes[firsts], conv[firsts]
    members = np.bincount(slot, minlength=n)

    last = np.append(begins[1:], len(depth)) - 1
    last = last[np.argsort(slot[last], kind="stable")]  # conversations stay in order within a slot
    cuts = np.flatnonzero(np.append(True, np.diff(slot[last]) > 0))
    first_end, ends = np.zeros(n, np.int64), np.full(n, None, object)
    for a, b in zip(cuts, np.append(cuts[1:], len(last))):
        first_end[slot[last[a]]] = conv[last[a]]
        ends[slot[last[a]]] = ",".join(map(str, conv[last[a:b]].tolist())).encode()
    none = np.equal(ends, None)
    shard = TaskContext.get().partitionId()
    yield from _sent([
        pa.array(np.full(n, shard), pa.int32()), pa.array(np.arange(n), pa.int32()), pa.array(parent, pa.int32()),
        _binary(found.keys), _binary(found.keys[np.maximum(parent, 0)], parent < 0), pa.array(at_depth), pa.array(size),
        pa.array(members, pa.int64()), pa.array(owner), pa.array(first_end, mask=none), pa.array(ends, pa.binary()),
    ], [c.split()[0] for c in LOCAL.split(", ")])


def accumulate(values: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> None:
    """Add each node's values to its parent's, from the deepest nodes up: values become sums over subtrees."""
    order = np.argsort(depth, kind="stable")
    edges = np.append(np.flatnonzero(np.append(True, np.diff(depth[order]) > 0)), len(order))
    for a, b in zip(edges[-2:0:-1], edges[:1:-1]):
        nodes = order[a:b]
        np.add.at(values, parent[nodes], values[nodes])


def _sums_of_shard(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(held)
    in_table = rows.filter(pc.is_valid(rows.column("slot")))
    counted = rows.filter(pc.is_null(rows.column("slot")))
    keys = _keys(in_table.column("key"))
    found = MinimalHash(keys)
    if (found.slots(keys) != in_table.column("slot").to_numpy()).any():
        raise ValueError("a node table that is not in the order of its slots")
    values = np.zeros((len(keys), 2), np.int64)
    values[found.slots(_keys(counted.column("key")))] = np.stack(
        [counted.column("saved").to_numpy(), counted.column("leaf").to_numpy()], axis=1)
    accumulate(values, in_table.column("parent_slot").to_numpy(), in_table.column("depth").to_numpy())
    some = np.flatnonzero(values.any(1))
    yield from _sent([_binary(keys[some]), pa.array(values[some, 0]), pa.array(values[some, 1])], ["key", "saved", "leaves"])


def _runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[list[pa.RecordBatch]]:
    """The rows of each value of a sorted integer column."""
    held: list[pa.RecordBatch] = []
    value = None
    for batch in batches:
        values = batch.column(column).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(values)) + 1), len(values)] if len(values) else []
        for a, b in zip(cuts, cuts[1:]):
            if held and values[a] != value:
                yield held
                held = []
            value = values[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield held


def _subtree_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for held in _runs(batches, "shard"):
        yield from _sums_of_shard(held)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the lists of each key, which come in order; a list is a shard's, and only the hash's state is kept."""
    key, state = None, None
    for batch in batches:
        out: list[tuple[bytes, str]] = []
        for k, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if k != key:
                if state:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ends)
            else:
                state.update(b"," + ends)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["key", "ends_sha256"])
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["key", "ends_sha256"])


# ---- tables ------------------------------------------------------------------------------------------------------


def turns_of(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """conv_id, place (from 0), digest and n_bytes (UTF-8 bytes of the text) of each turn.

    Turns go by ``turn``, null first, then by role, then by text; null role or
    text counts as empty, equal rows as turns of their own. Rows without a
    conv_id belong to no conversation and are left out, as are other columns.
    """
    known = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    # the role's length keeps ("a", "bc") apart from ("ab", "c")
    named = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return known.select(
        "conv_id", (F.row_number().over(order) - 1).cast("long").alias("place"), F.unhex(F.md5(named.cast("binary"))).alias("digest"),
        F.octet_length("text").cast("long").alias("n_bytes"))


def paths_of(turns: DataFrame) -> DataFrame:
    """Each conversation's row of depth 0 and those of its turns, for ``prefix_trie``."""
    return _with_roots(turns.select("conv_id", (F.col("place") + 1).alias("depth"), "digest", "n_bytes"), turns)


def _with_roots(paths: DataFrame, turns: DataFrame) -> DataFrame:
    roots = turns.where("place = 0").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(bytes(16)).alias("digest"), F.lit(0).cast("long").alias("n_bytes"))
    return roots.unionByName(paths)


def rebuilt_paths(turns: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Paths in which conversation c begins with the first h turns of conversation c - c % family and goes on with its own after its first h.

    h is crc32(decimal c) % most. A first conversation that is not there gives
    no turns, a shorter one all of its own. ``%`` has the sign of c, as in SQL.
    """
    own = F.col("conv_id")
    head = F.crc32(own.cast("string").cast("binary")) % most
    convs = turns.where("place = 0").select("conv_id", (own - own % family).alias("of"), head.alias("h"))
    heads = turns.where((F.col("place") < most - 1) & (own % family == 0)).select(
        F.col("conv_id").alias("of"), "place", "digest", "n_bytes")
    lengths = heads.groupBy("of").agg(F.max("place").alias("last"))
    begun = convs.join(lengths, "of", "left").select(
        "conv_id", "h", F.least("h", F.coalesce(F.col("last") + 1, F.lit(0))).alias("taken"))
    first = convs.join(heads, "of").where("place < h").select("conv_id", (F.col("place") + 1).alias("depth"), "digest", "n_bytes")
    rest = turns.join(begun, "conv_id").where("place >= h").select(
        "conv_id", (F.col("taken") + F.col("place") - F.col("h") + 1).alias("depth"), "digest", "n_bytes")
    return _with_roots(first.unionByName(rest), turns)


def prefix_trie(paths: DataFrame) -> DataFrame:
    """One row for each distinct sequence of first turns, the empty one (depth 0) included.

    conv_id: its smallest member; depth; parent_conv_id: its parent's conv_id;
    n_convs: members; n_children; n_leaves: nodes without children in its
    subtree; saved_tokens: over its subtree, (members - 1) times the bytes of
    the last text; ends_sha256: of the ids of the members that end there,
    ascending, joined by commas; key and parent_key: digests.

    ``paths`` holds conv_id, depth, digest and n_bytes, a row of depth 0 and
    then every depth once for each conversation. Without rows there is no node.
    One task walks a conversation, holding some 200 bytes a turn and none of
    its text, and one task streams the ids of a node's ends through the hash.
    """
    spark = paths.sparkSession
    paths = stored(paths, "paths")
    n = max(spark.sparkContext.defaultParallelism, paths.count() // SHARD_TURNS + 1)
    dealt = paths.repartitionByRange(n, "conv_id").sortWithinPartitions("conv_id", "depth")
    local = stored(dealt.mapInArrow(_shard_of_paths, LOCAL), "node-tables")

    nodes = stored(local.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.max("n_bytes").alias("n_bytes"),
        F.sum("n_convs").alias("n_convs"), F.min(F.struct("owner", "shard")).alias("first")), "nodes")
    children = nodes.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(children, "key", "left").select(
        "*", F.col("first.owner").alias("conv_id"), F.coalesce("n_children", F.lit(0)).cast("long").alias("children"))
    owned = counted.select(
        F.col("first.shard").alias("shard"), F.lit(None).cast("int").alias("slot"), F.lit(None).cast("int").alias("parent_slot"),
        "depth", "key", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"), (F.col("children") == 0).cast("long").alias("leaf"))
    none = F.lit(None).cast("long")
    tables = local.select("shard", "slot", "parent_slot", "depth", "key", none.alias("saved"), none.alias("leaf"))
    shards = (tables.select(F.max("shard")).first()[0] or 0) + 1
    by_shard = tables.unionByName(owned).repartitionById(shards, "shard").sortWithinPartitions("shard", F.col("slot").asc_nulls_last())
    sums = by_shard.mapInArrow(_subtree_sums, "key binary, saved long, leaves long").groupBy("key").agg(
        F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    ends = local.where("ends is not null").select("key", "first_end", "ends").repartition("key").sortWithinPartitions(
        "key", "first_end").select("key", "ends").mapInArrow(_digests, "key binary, ends_sha256 string")
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("first.owner").alias("parent_conv_id"))
    found = counted.select("key", "parent_key", "conv_id", "depth", "n_convs", "children").join(parents, "parent_key", "left")
    empty = hashlib.sha256(b"").hexdigest()
    return found.join(sums, "key", "left").join(ends, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"),
        F.coalesce("leaves", F.lit(0)).cast("long").alias("n_leaves"), F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"), "key", "parent_key")
