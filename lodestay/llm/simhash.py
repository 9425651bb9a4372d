"""SimHash near-duplicates by vantage-point trees over distinct fingerprints.

Equal fingerprints are one point, so a group of copies, however large, is one
row from here on, and a cluster of different fingerprints is bounded by the
number of points in a ball of the Hamming space.

Two 64-bit fingerprints that differ in at most ``4`` bits differ in at most
one bit within some third of the bits. There is one tree for each third. Each
of its levels measures the Hamming distance, on a few bits of the third, to a
vantage point; the levels' distances are the way to a leaf, and a leaf is a
shard. By the triangle inequality the distances of two points to a vantage
point differ by no more than the points do, and since the levels' bits are
disjoint these gaps add up: a pair that differs in one bit of the third lies in
one shard, or in two whose ways differ by one on one level. So every
fingerprint is at home in one shard of each tree and visits those across such
boundaries. A shard that many fingerprints share is split once more by trees on
the other bits, in the same way: a pair that meets in the shard differs in at
most one bit of some third of those. Inside a shard a further tree prunes with
what is left of the radius, and leaves are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestay.llm.common import LOWER_ASCII, map_slices, stored, texts
from lodestay.llm.components import components

SEED = 42
BITS = 64
#: Points compared with points at a time inside a shard.
TILE = 1 << 21
#: Points of a shard, with visitors to it, that are handled at a time; a larger shard is split by deeper trees, and
#: what these leave together is dealt to several tasks, slice by slice.
SHARD_POINTS = 20_000
#: Rows of a partition, about, where the session's number of partitions would make larger ones.
PARTITION_ROWS = 2_000_000


@dataclass(frozen=True)
class TreeSpec:
    """``radius`` of a link; ``trees`` split the bits evenly, each with levels of ``level_bits`` bits."""

    radius: int = 4
    trees: int = 3
    level_bits: int = 3
    vantage: int = 0x9E3779B97F4A7C15

    def levels(self, below: int | None = None) -> list[list[int]]:
        """For each tree the masks of its levels; ``below`` a shard of that tree: of the trees on the other bits."""
        edges = [BITS * t // self.trees for t in range(self.trees + 1)]
        bits = list(range(BITS))
        if below is not None:
            bits = bits[:edges[below]] + bits[edges[below + 1]:]
        edges = [len(bits) * t // self.trees for t in range(self.trees + 1)]
        return [
            [sum(1 << bit for bit in bits[k:min(k + self.level_bits, b)]) for k in range(a, b, self.level_bits)]
            for a, b in zip(edges, edges[1:])
        ]

    @property
    def budget(self) -> int:
        """Most bits that differ in the third where the fewest do."""
        return self.radius // self.trees


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """Bits set in over half of the shingles' XXH64."""
    words = text.translate(LOWER_ASCII).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(BITS, np.int64), len(words) - shingle + 1
    for k in range(0, n, 1 << 16):
        a, b = starts[k:min(n, k + (1 << 16))].tolist(), ends[k + shingle - 1:k + shingle - 1 + (1 << 16)].tolist()
        h = np.fromiter((digest(joined[i:j], SEED) for i, j in zip(a, b)), np.uint64, len(a))
        counts += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(k) for k in np.flatnonzero(2 * counts > n))


def fingerprints(docs: DataFrame, shingle: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fingerprint, the 64 bits as a signed long."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "print"])

    return map_slices(texts(docs, doc_id, text), "text", "doc_id long, print long", work)


def ways(prints: np.ndarray, masks: list[int], vantage: int) -> np.ndarray:
    """Distance to the vantage point on each level, a row for each print."""
    turned = prints ^ np.uint64(vantage)
    return np.stack([np.bitwise_count(turned & np.uint64(m)) for m in masks], axis=1).astype(np.int64)


def visits(prints: np.ndarray, spec: TreeSpec, below: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shard, at home?) of every print in every tree, or in every tree below a shard of tree ``below``.

    Of two shards whose ways differ, points of the one with the smaller sum of
    distances visit the other: a link across a boundary is looked for once.
    """
    if spec.budget > 1:
        raise ValueError("more trees are needed, so that a link differs in one bit at most in some tree")
    rows, shards, home = [], [], []
    every = np.arange(len(prints))
    for tree, masks in enumerate(spec.levels(below)):
        way = ways(prints, masks, spec.vantage)
        digits = (spec.level_bits + 1) ** np.arange(len(masks), dtype=np.int64)
        shard = (way @ digits) * spec.trees + tree
        rows.append(every), shards.append(shard), home.append(np.ones(len(prints), bool))
        for level, mask in enumerate(masks if spec.budget else []):
            across = every[way[:, level] < mask.bit_count()]
            rows.append(across), shards.append(shard[across] + digits[level] * spec.trees)
            home.append(np.zeros(len(across), bool))
    return np.concatenate(rows), np.concatenate(shards), np.concatenate(home)


class Links:
    """Groups of linked points of one shard, as numbers that meet in the smallest."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def link_shard(
    prints: np.ndarray, home: np.ndarray, radius: int, sides: list[tuple[np.ndarray, np.ndarray]] | None = None,
) -> np.ndarray:
    """For each point the place of the first point of its group; groups hold every link between the two ``sides`` of
    a pair, as places: by default those at home and all."""
    links = Links(len(prints))
    sides = [(np.flatnonzero(home), np.arange(len(prints)))] if sides is None else sides
    blocks = [0xFF << k for k in range(0, BITS, 8)]

    def search(a: np.ndarray, b: np.ndarray, budget: np.ndarray, depth: int) -> None:
        """Links of ``a`` with ``b``; ``budget`` is what the levels above left of the radius to each of ``b``."""
        if not len(a) or not len(b):
            return
        if len(a) * len(b) <= TILE or depth == len(blocks):
            step = max(1, TILE // len(b))
            for k in range(0, len(a), step):
                part = a[k:k + step]
                near = np.bitwise_count(prints[part][:, None] ^ prints[b][None, :]) <= radius
                i, j = np.nonzero(near)
                links.add(part[i], b[j])
            return
        mask = np.uint64(blocks[depth])
        vantage = prints[a[len(a) // 2]]  # a point of the node
        far_a = np.bitwise_count((prints[a] ^ vantage) & mask).astype(np.int64)
        far_b = np.bitwise_count((prints[b] ^ vantage) & mask).astype(np.int64)
        for shell in np.unique(far_a):
            left = budget - np.abs(far_b - shell)
            some = left >= 0
            search(a[far_a == shell], b[some], left[some], depth + 1)

    for a, b in sides:
        search(a, b, np.full(len(b), radius), 0)
    return links.label


#: Roles of a point: at home in the shard of the upper tree, at home in the one of the deeper tree. A point of a shard
#: that is not split has both or none. A pair is wanted if one of the two is at home above, and one below.
ABOVE, BELOW = 1, 2
#: Where a shard is dealt in slices, the side of a pair that a copy of the point stands for; otherwise both.
LEFT, RIGHT = 4, 8


def shard_links(points: DataFrame, spec: TreeSpec) -> DataFrame:
    """(a, b): ids of linked points, a spanning forest of each shard's links. ``points``: distinct print, id."""
    prints = points.select("print", "id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_prints = batch.column("print").to_numpy().view(np.uint64)
            for k in range(0, len(all_prints), 1 << 14):
                _, shard, home = visits(all_prints[k:k + (1 << 14)], spec)
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(home)], ["shard", "home"])

    # the shards of the upper trees are bounded by the trees, not by the rows
    counts = prints.mapInArrow(count, "shard long, home boolean").groupBy("shard").agg(
        F.count_if("home").alias("at_home"), F.count("*").alias("n"))
    many = (F.col("n") > SHARD_POINTS) & (F.col("at_home") > 0)
    seen = counts.agg(
        F.sum("n").alias("n"), F.sum(F.when(many, F.col("n"))).alias("n_many"),
        F.collect_list(F.when(many, F.col("shard"))).alias("large")).first()
    large = np.array(sorted(seen.large), np.int64)
    deeper = 1 + max(len(masks) for masks in spec.levels(0))  # shards of a deeper tree that a point is in, at most
    rows = (seen.n or 0) + (seen.n_many or 0) * spec.trees * deeper
    n_parts = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // PARTITION_ROWS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_prints = batch.column("print").to_numpy().view(np.uint64)
            for k in range(0, len(all_prints), 1 << 14):
                part = all_prints[k:k + (1 << 14)]
                row, shard, home = visits(part, spec)
                odd = np.isin(shard, large)
                dealt = [(row[~odd], shard[~odd], np.full(int((~odd).sum()), -1), np.where(home[~odd], ABOVE | BELOW, 0))]
                for tree in range(spec.trees) if odd.any() else []:
                    at = np.flatnonzero(odd & (shard % spec.trees == tree))
                    again, sub, own = visits(part[row[at]], spec, below=tree)
                    at = at[again]
                    dealt.append((row[at], shard[at], sub, np.where(home[at], ABOVE, 0) | np.where(own, BELOW, 0)))
                row, shard, sub, role = (np.concatenate(x) for x in zip(*dealt))
                at = pa.array(row + k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(sub), pa.array((role | LEFT | RIGHT).astype(np.int32)),
                     batch.column("print").take(at), batch.column("id").take(at)],
                    ["shard", "sub", "role", "print", "id"])

    schema = "shard long, sub long, role int, print long, id long"
    tasks = prints.mapInArrow(deal, schema).select("shard", "sub", F.lit(0).alias("x"), F.lit(0).alias("y"), "role", "print", "id")
    if len(large):
        tasks = _sliced(tasks)
    tasks = tasks.repartition(n_parts, "shard", "sub", "x", "y").sortWithinPartitions("shard", "sub", "x", "y")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches):
            role, ids = group[:, 4], group[:, 6]
            left, right, kind = role & LEFT > 0, role & RIGHT > 0, role & (ABOVE | BELOW)
            sides = [(np.flatnonzero(left & (kind == (ABOVE | BELOW))), np.flatnonzero(right)),
                     (np.flatnonzero(left & (kind == ABOVE)), np.flatnonzero(right & (kind == BELOW)))]
            label = link_shard(group[:, 5].view(np.uint64), left, spec.radius, sides)
            joined = np.flatnonzero(label != np.arange(len(label)))
            a, b = ids[joined], ids[label[joined]]
            differ = a != b
            if differ.any():
                yield pa.RecordBatch.from_arrays([pa.array(a[differ]), pa.array(b[differ])], ["a", "b"])

    return tasks.mapInArrow(link, "a long, b long")


def _sliced(tasks: DataFrame) -> DataFrame:
    """``tasks`` with shards that are large even below a deeper tree in slices: each of those at home above meets each
    of all points. Such shards may be many, so they are joined and not collected."""
    above = (F.col("role").bitwiseAND(F.lit(ABOVE))) > 0
    sizes = tasks.where("sub >= 0").groupBy("shard", "sub").agg(
        F.count_if(above).alias("n_left"), F.count("*").alias("n")).where(f"n > {SHARD_POINTS} and n_left > 0").select(
        F.col("shard").alias("of_shard"), F.col("sub").alias("of_sub"),
        F.ceil(F.col("n_left") / SHARD_POINTS).cast("int").alias("n_x"), F.ceil(F.col("n") / SHARD_POINTS).cast("int").alias("n_y"))
    found = tasks.join(sizes, (F.col("shard") == F.col("of_shard")) & (F.col("sub") == F.col("of_sub")), "left")
    kind = F.col("role").bitwiseAND(F.lit(ABOVE | BELOW))

    def copies(own: str, own_n: str, other: str, other_n: str, side: int):
        """A copy of the point in its own slice for each slice of the other side."""
        mine = F.pmod(F.xxhash64("print", F.lit(side)), F.col(own_n)).cast("int").alias(own)
        parts = {own: mine, "role": kind.bitwiseOR(F.lit(side)).alias("role")}
        return F.transform(F.sequence(F.lit(0), F.col(other_n) - 1), lambda k: F.struct(
            *({**parts, other: k.alias(other)}[c] for c in ("x", "y", "role"))))

    both = F.concat(
        F.when(above, copies("x", "n_x", "y", "n_y", LEFT)).otherwise(F.array()),
        copies("y", "n_y", "x", "n_x", RIGHT))
    whole = F.array(F.struct("x", "y", "role"))
    return found.select("shard", "sub", "print", "id", F.inline(F.when(F.col("n_x").isNull(), whole).otherwise(both))).select(
        "shard", "sub", "x", "y", "role", "print", "id")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Rows of one task after another, from batches sorted by the first four columns."""
    held: list[np.ndarray] = []
    for batch in batches:
        rows = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], axis=1)
        if not len(rows):
            continue
        cuts = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
        parts = np.split(rows, cuts)
        if held and (held[-1][-1, :4] != parts[0][0, :4]).any():
            yield np.concatenate(held)
            held = []
        held.append(parts[0])
        for part in parts[1:]:
            yield np.concatenate(held)
            held = [part]
    if held:
        yield np.concatenate(held)


def near_duplicates(
    docs: DataFrame, shingle: int = 4, spec: TreeSpec = TreeSpec(), doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: its fingerprint (16 hexadecimal digits) and the smallest doc_id it is linked to.

    Documents link where their fingerprints differ in ``spec.radius`` bits or
    fewer, and over chains of links. Null, empty and blank texts have the
    fingerprint zero and link like any other. Repeated rows stay rows of their
    own. A row without a doc_id has the component of the documents with an
    equal fingerprint, or none; it links nothing. Other columns are not read.
    """
    of_docs = stored(fingerprints(docs, shingle, doc_id, text), "prints")
    points = stored(of_docs.where("doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("id")), "points")
    groups = components(shard_links(points, spec))
    labels = points.join(groups, points["id"] == groups["node"], "left").select(
        F.col("print").alias("p"), F.coalesce("component", "id").alias("component_id"))
    found = of_docs.join(labels, of_docs["print"] == labels["p"], "left")
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
