"""Benchmark decontamination with a generalised suffix automaton of the normalised test items."""

from __future__ import annotations

import hashlib
import re
import uuid
from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestay.llm.common import LOWER_ASCII, map_slices, texts

#: Words of items in one automaton, some 900 bytes each; more items make more automata, one scan of the documents each.
BLOCK_WORDS = 300_000

#: ASCII characters that are no part of a word; all others, letters of any script included, are.
_NO_WORD = bytes(c for c in range(0x80) if not (0x30 <= c <= 0x39 or 0x61 <= c | 0x20 <= 0x7A))
_TO_WORDS = LOWER_ASCII.translate(bytes.maketrans(_NO_WORD, b" " * len(_NO_WORD)))

HITS = "key binary, block int, spans array<int>, full array<int>, items array<string>"  # of one block of items in a text
SCHEMA = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, clean_text string"
)


def normal_words(text: bytes | None) -> list[bytes]:
    """Lower-cased A-Z; runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``."""
    return text.translate(_TO_WORDS).split() if text else []


class SuffixAutomaton:
    """All word sequences of the items: one state for each set of sequences that end at the same places.

    Words are numbered; a state's arrows are a dict. ``window`` consecutive
    words of an item are a window, and so is a whole item of fewer words.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = array("i", [-1]), array("i", [0])
        sequences = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for _, words in items]
        for sequence in sequences:
            last = 0
            for symbol in sequence:
                last = self._add(last, symbol)
        self._own(items, sequences)

    def _state(self, length: int, arrows: dict[int, int], link: int) -> int:
        self.next.append(arrows)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, q: int, symbol: int) -> int:
        """A copy of ``q`` for the shorter sequences that reach it through ``p``."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p != -1 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def _add(self, last: int, symbol: int) -> int:
        known = self.next[last].get(symbol)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, known, symbol)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p != -1 and symbol not in self.next[p]:
            self.next[p][symbol] = new
            p = self.link[p]
        if p != -1:
            q = self.next[p][symbol]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, symbol)
        return new

    def _own(self, items: list[tuple[str, list[bytes]]], sequences: list[list[int]]) -> None:
        """The items whose windows end in each state, and the length of the window that does."""
        self.ends: dict[int, dict[int, set[str]]] = {}
        for (name, _), sequence in zip(items, sequences):
            size = min(self.window, len(sequence))
            if not size:
                continue
            state, length = 0, 0
            for symbol in sequence:
                state, length = self.next[state][symbol], length + 1
                if length >= size:
                    # the state of just the last `size` words
                    while self.length[self.link[state]] >= size:
                        state = self.link[state]
                    length = size
                    self.ends.setdefault(state, {}).setdefault(size, set()).add(name)
        # a state also ends the windows that are suffixes of its own sequences
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        self.suffix: list[int] = [-1] * len(self.next)
        for s in order:
            up = self.link[s]
            self.suffix[s] = up if up in self.ends else self.suffix[up]
        self.shortest = [0] * len(self.next)  # of the windows that end here, or no window
        none = 1 << 30
        self.shortest[0] = none
        for s in order:
            self.shortest[s] = min([*self.ends.get(s, ()), self.shortest[self.link[s]]])

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(state, longest match, place after it) at each word where a window ends."""
        arrows, link, lengths, shortest = self.next, self.link, self.length, self.shortest
        state = length = 0
        for i, symbol in enumerate(map(self.vocabulary.get, words), 1):
            if symbol is None:
                state = length = 0
                continue
            to = arrows[state].get(symbol)
            while to is None and state:
                state = link[state]
                length = lengths[state]
                to = arrows[state].get(symbol)
            if to is None:
                length = 0
                continue
            state, length = to, length + 1
            if length >= shortest[state]:
                yield state, length, i

    def hits(self, words: list[bytes], full: list[tuple[int, int]] | None = None) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of words inside occurrences of windows, merged, and the items that have occurrences.

        ``full`` gets the occurrences of windows of ``window`` words.
        """
        spans: list[list[int]] = []
        items: set[str] = set()
        for state, length, i in self.matches(words):
            s, longest = state, 0
            while s > 0:
                for size, names in self.ends.get(s, {}).items():
                    if size <= length:
                        longest = max(longest, size)
                        items |= names
                s = self.suffix[s]
            if not longest:
                continue
            if longest == self.window and full is not None:
                full.append((i - longest, i))
            start = i - longest
            while spans and spans[-1][0] >= start:
                spans.pop()
            if spans and spans[-1][1] >= start:
                spans[-1][1] = i
            else:
                spans.append([start, i])
        return [(a, b) for a, b in spans], items


def item_blocks(
    items: DataFrame, item_id: str, text: str, unnamed: bool = False,
) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items in blocks of about ``BLOCK_WORDS`` words, with ``unnamed`` also those without an id; the driver
    holds one block at a time."""
    rows = items.select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("binary").alias("t"))
    block, n = [], 0
    for row in rows.where("t is not null" if unnamed else "i is not null and t is not null").toLocalIterator():
        words = normal_words(bytes(row.t))
        if not words:
            continue
        block.append((row.i, words))
        n += len(words)
        if n >= BLOCK_WORDS:
            yield block
            block, n = [], 0
    if block:
        yield block


_PLACES = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the words of ``spans`` and what stands between them."""
    places = [m.span() for m in _PLACES.finditer(text.translate(LOWER_ASCII))]
    out, upto = [], 0
    for a, b in spans:
        out.append(text[upto:places[a][0]])
        upto = places[b - 1][1]
    return b"".join([*out, text[upto:]])


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = 13, one_in: int = 20, doc_id: str = "doc_id",
    text: str = "text", item_id: str = "item_id", item_text: str = "text", carry: bool = False,
    unnamed: bool = False,
) -> DataFrame:
    """One row per document: words hit by windows of items, the items, the verdict, the text without the spans.

    A window is ``window`` consecutive words of an item, or an item of fewer.
    A document is contaminated if a word is hit and at least one of ``one_in``
    of its words is. Null and empty texts have no words and
    are not contaminated; items without words have no window, and those
    without an id only with ``unnamed``: then they count for ``n_hit`` and the
    verdict, all as one item in ``n_items``, and are left out of the digest.
    From a document that is not contaminated only windows of ``window`` words
    are cut: a shorter item may be a common phrase.
    Repeated rows are judged each, an item_id that occurs twice counts once,
    and other columns are not read, or with ``carry`` handed on in the struct
    ``row``.
    """
    spark = docs.sparkSession
    rows = texts(docs, doc_id, text, carry)
    blocks = [
        (uuid.uuid4().hex, spark.sparkContext.broadcast(block)) for block in item_blocks(items, item_id, item_text, unnamed)
    ] or [(uuid.uuid4().hex, spark.sparkContext.broadcast([]))]
    if len(blocks) == 1:
        return map_slices(rows, "text", SCHEMA, _judge(window, one_in, blocks[0]))
    # A task holds one automaton: each block has its own tasks, and hits are few and depend on the text alone.
    keyed = rows.withColumn("key", F.unhex(F.sha2("text", 256)))
    parts = [map_slices(keyed.select("key", "text"), "text", HITS, _find(window, i, b)) for i, b in enumerate(blocks)]
    # copies of a text are one row for each block before they meet, so a text has no more rows than there are blocks
    once = reduce(DataFrame.unionByName, parts).dropDuplicates(["key", "block"])
    hits = once.groupBy("key").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "full", "items")])
    return map_slices(keyed.join(hits, "key", "left").drop("key"), "text", SCHEMA, _judge(window, one_in))


_AUTOMATA: dict = {}


def _automaton(block, window: int) -> SuffixAutomaton:
    """Built once for each worker process from the words sent to it, until the worker gets tasks of another block."""
    key, words_sent = block
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[key] = SuffixAutomaton(words_sent.value, window)
    return _AUTOMATA[key]


def _flat(spans: list[tuple[int, int]]) -> list[int]:
    return [x for span in spans for x in span]


def _paired(flat: list[int] | None) -> list[tuple[int, int]]:
    return merged([*zip((flat or [])[::2], (flat or [])[1::2])])


def _batch(columns: list[tuple[str, pa.DataType]], rows: list[tuple], first: pa.Array | None = None) -> pa.RecordBatch:
    cells = list(zip(*rows)) if rows else [[] for _ in columns]
    arrays = [pa.array(c, kind) for c, (_, kind) in zip(cells, columns)]
    names = [name for name, _ in columns]
    return pa.RecordBatch.from_arrays([*([first] if first is not None else []), *arrays],
                                      [*(["doc_id"] if first is not None else []), *names])


def _find(window: int, number: int, block):
    """Of texts with hits of one block: the spans, those of full windows, and the items."""
    columns = [("key", pa.binary()), ("block", pa.int32()), ("spans", pa.list_(pa.int32())),
               ("full", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        automaton, out = _automaton(block, window), []
        for key, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
            full: list[tuple[int, int]] = []
            found, items = automaton.hits(normal_words(t), full)
            if found:
                out.append((key, number, _flat(found), _flat(merged(full)), list(items)))
        return _batch(columns, out)

    return work


def _judge(window: int, one_in: int, block=None):
    """The verdict on each text, by the hits of ``block``, or those found before."""
    columns = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()),
               ("contaminated", pa.bool_()), ("clean_text", pa.string())]

    def hits(batch: pa.RecordBatch) -> Iterator[tuple]:
        all_texts = batch.column("text").to_pylist()
        if block is None:
            before = zip(*(batch.column(c).to_pylist() for c in ("spans", "full", "items")))
            for t, (spans, full, items) in zip(all_texts, before):
                yield t, normal_words(t), _paired(spans), _paired(full), set(items or ())
            return
        automaton = _automaton(block, window)
        for t in all_texts:
            words, full = normal_words(t), []
            found, items = automaton.hits(words, full)
            yield t, words, found, merged(full), items

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for t, words, found, full, items in hits(batch):
            hit = sum(b - a for a, b in found)
            joined = ",".join(sorted(x for x in items if x is not None)).encode()
            contaminated = hit > 0 and one_in * hit >= len(words)
            cut = found if contaminated else full
            out.append((
                len(words), hit, len(items), hashlib.sha256(joined).hexdigest(), contaminated,
                (without(t, cut) if cut else t or b"").decode() if t is not None else None))
        return _batch(columns, out, batch.column("doc_id"))

    return work


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and out[-1][1] >= a:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
