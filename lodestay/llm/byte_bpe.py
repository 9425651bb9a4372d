"""Byte-level BPE in numpy: pieces of like length form padded matrices, and each row merges its
leftmost pair of minimum rank each round."""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lodestay.llm.common import Memo, map_slices, ranges, texts

NONE = np.int32(2**31 - 1)
#: White space of Unicode, stated since libraries differ on the control characters.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Cells of one matrix.
MATRIX_CELLS = 1 << 20

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded binary"


class PairTable:
    """Rank of the token that two neighbouring tokens form, by a hash table of arrays with open addressing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(len(rank), 1) * 3))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        keys = (left.astype(np.int64) << 32) | right
        slots, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            at = slots[todo]
            free = self.keys[at] == -1
            at, first = np.unique(at[free], return_index=True)
            placed = todo[np.flatnonzero(free)[first]]
            self.keys[at], self.ranks[at] = keys[placed], rank[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            slots[todo] = (slots[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``NONE`` where the two form no token or one of them is no token (negative)."""
        shape = left.shape
        keys = ((left.astype(np.int64) << 32) | right.astype(np.int64)).ravel()
        out = np.full(len(keys), NONE, np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slots = self._slot(keys[todo])
        while len(todo):
            found = self.keys[slots]
            hit = found == keys[todo]
            out[todo[hit]] = self.ranks[slots[hit]]
            go = ~hit & (found != -1)
            todo, slots = todo[go], (slots[go] + 1) & ((1 << self.bits) - 1)
        return out.reshape(shape)


class ByteBPE:
    """Encoder and decoder for a rank file and a splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, rank = [], [], []
        for token, r in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(r)
        self.pairs = PairTable(np.array(left, np.int64), np.array(right, np.int64), np.array(rank, np.int32))
        pattern = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")
        self.split = regex.compile(pattern).findall
        # a space between two other characters always begins a match, so texts can be cut there
        self.odd = regex.compile(f"[{SPACE}] | [{SPACE}]|^ | $").search
        self.cut = regex.compile(f"(?<=[^{SPACE}]) (?=[^{SPACE}])").split
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, r in ranks.items():
            tokens[r] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.memo = Memo(self.encode_chunks)

    def merge_rows(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each row of a padded matrix (-1 after the end), flat, and how many each row has."""
        n, width = tokens.shape
        done: list[np.ndarray] = [np.zeros((0, width), np.int32)]
        order: list[np.ndarray] = [np.zeros(0, np.int64)]
        row = np.arange(n)
        while True:
            ranks = self.pairs(tokens[:, :-1], tokens[:, 1:])
            left, right = _neighbours(len(tokens), tokens.shape[1])
            live = np.ones(tokens.shape, bool)
            merges = 0
            while tokens.shape[1] > 1 and len(tokens):
                at = ranks.argmin(axis=1)
                r = np.arange(len(tokens))
                best = ranks[r, at]
                over = best == NONE
                if over.any():  # rows with nothing left to merge leave the matrix
                    done.append(_packed(tokens[over], live[over], width))
                    order.append(row[over])
                    keep = ~over
                    tokens, ranks, left, right, live, row, at, best = (
                        x[keep] for x in (tokens, ranks, left, right, live, row, at, best))
                    r = np.arange(len(tokens))
                    if not len(tokens):
                        break
                gone = right[r, at]
                after = right[r, gone]  # width of the matrix where nothing follows
                tokens[r, at] = best
                live[r, gone] = False
                right[r, at] = after
                some = after < tokens.shape[1]
                left[r[some], after[some]] = at[some]
                ranks[r, np.minimum(gone, ranks.shape[1] - 1)] = np.where(
                    gone < ranks.shape[1], NONE, ranks[r, np.minimum(gone, ranks.shape[1] - 1)])
                follow = np.where(some, tokens[r, np.minimum(after, tokens.shape[1] - 1)], -1)
                ranks[r, at] = self.pairs(best, follow)
                before = left[r, at]
                has = before >= 0
                ranks[r[has], before[has]] = self.pairs(tokens[r[has], before[has]], best[has])
                merges += 1
                if merges * 4 >= tokens.shape[1] and tokens.shape[1] > 8:
                    break  # enough cells are dead: compaction
            if not len(tokens) or tokens.shape[1] <= 1:
                break
            packed = _packed(tokens, live, tokens.shape[1])
            tokens = packed[:, : max(1, int((packed >= 0).sum(axis=1).max()))]
        if len(tokens):
            done.append(_packed(tokens, tokens >= 0, width))
            order.append(row)
        flat, by = np.concatenate(done), np.concatenate(order)
        flat = flat[np.argsort(by, kind="stable")]
        counts = (flat >= 0).sum(axis=1)
        return flat[flat >= 0], counts

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all pieces in order, and the count of each. Whole tokens need no merging."""
        counts = np.zeros(len(pieces), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        known = [self.ranks.get(p, -1) for p in pieces]
        whole = np.array(known, np.int32) if pieces else np.zeros(0, np.int32)
        at = np.flatnonzero(whole >= 0)
        parts.append((at, whole[at], np.ones(len(at), np.int64)))
        rest = [i for i, k in enumerate(known) if k < 0 and pieces[i]]
        lengths = np.array([len(pieces[i]) for i in rest], np.int64)
        bucket = np.ceil(np.log2(np.maximum(lengths, 2)) * 2).astype(int)  # two widths for each power of two
        for b in np.unique(bucket):
            inside = np.flatnonzero(bucket == b)
            step = max(1, MATRIX_CELLS // int(lengths[inside].max()))
            for k in range(0, len(inside), step):
                some = inside[k:k + step]
                ids, n = self.merge_rows(self._matrix([pieces[rest[i]] for i in some], lengths[some]))
                parts.append((np.array([rest[i] for i in some]), ids, n))
        for where, _, n in parts:
            counts[where] = n
        start = np.cumsum(counts) - counts
        flat = np.zeros(int(counts.sum()), np.int32)
        for where, ids, n in parts:
            flat[ranges(start[where], n)] = ids
        return flat, counts

    def _matrix(self, pieces: list[bytes], lengths: np.ndarray) -> np.ndarray:
        width = int(lengths.max())
        out = np.full((len(pieces), width), -1, np.int32)
        out[np.arange(width) < lengths[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        return out

    def chunks(self, text: str) -> list[str]:
        """``text`` cut where a single space stands between two other characters; the space goes with the right part."""
        if self.odd(text):
            first, *rest = self.cut(text)
        else:
            first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]] if text else []

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts in order, and the count of each text."""
        return self.memo([self.chunks(text) for text in batch])

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the chunks in order, and the count of each; equal pieces are merged once."""
        places, which, edges = {}, [], [0]
        for c in chunks:
            which.extend([places.setdefault(p, len(places)) for p in self.split(c)])
            edges.append(len(which))
        ids, counts = self.encode_pieces([p.encode() for p in places])
        at = np.fromiter(which, np.int64, len(which))
        n = counts[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        return ids[ranges((np.cumsum(counts) - counts)[at], n)], np.diff(ends[np.array(edges)])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, gathered from the table of tokens."""
        return self.bytes[ranges(self.starts[ids], self.lengths[ids])].tobytes()


def _neighbours(n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.broadcast_to(np.arange(width, dtype=np.int32), (n, width))
    return (at - 1).copy(), (at + 1).copy()


def _packed(tokens: np.ndarray, live: np.ndarray, width: int) -> np.ndarray:
    """Live tokens moved to the left, -1 after them, in ``width`` columns."""
    live = live & (tokens >= 0)
    out = np.full((len(tokens), width), -1, np.int32)
    n = live.sum(axis=1)
    out[np.arange(width) < n[:, None]] = tokens[live]
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base 64 and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBPE:
    """Once for each worker process."""
    return ByteBPE(read_ranks(path), pattern)


def encode_documents(
    docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", digests_only: bool = False,
    carry: bool = False,
) -> DataFrame:
    """One row per document: its ids, the bytes that these decode to, and the digests of both.

    ``path`` is a rank file that every executor has. A null text counts as
    empty: no ids, and the digests of nothing. Repeated rows are encoded each. ``digests_only`` leaves ids and bytes out;
    with ``carry`` the other columns follow in the struct ``row``.
    """
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(path, pattern)
        ids, counts = bpe.encode([t or "" for t in batch.column("text").cast(pa.string()).to_pylist()])
        ends = np.cumsum(counts)
        per_doc = [ids[a:b] for a, b in zip(ends - counts, ends)]
        decoded = [bpe.decode(x) for x in per_doc]
        columns = [
            batch.column("doc_id"), pa.array(counts, pa.int64()),
            pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in per_doc], pa.string()),
            pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
        ]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if not digests_only:
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            columns += [pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())), pa.array(decoded, pa.binary())]
            names += ["ids", "decoded"]
        return pa.RecordBatch.from_arrays(columns, names)

    schema = SCHEMA.rsplit(", ids", 1)[0] if digests_only else SCHEMA
    return map_slices(texts(docs, doc_id, text, carry), "text", schema, work)
