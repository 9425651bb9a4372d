"""Repeated passages: recurring phrases are confirmed, compiled to sharded Aho-Corasick automata, and located
in the documents.

1. Each text is sketched by anchors: of every window, the phrase with the
   least hash. Equal windows have equal anchors, so a window can only recur
   where its anchor does, and about one phrase in ``stride / 2`` is an anchor.
2. Anchors of two different texts are found by map-side combined minima and
   maxima. Texts that are copies of each other are one text from the start.
3. Windows with such an anchor are counted by 128-bit hash; those of two
   documents are confirmed, and belong to the smallest document. Runs of them
   in that document are passages.
4. Passages are dealt to shards of bounded size, and each document goes to the
   shards whose passages hold the core of one of its windows (all words but a
   few, cut off by the place of the anchor), with the words of those windows
   only. If passages of several shards hold a core, as around a passage that
   very many documents have, the windows themselves tell which. A task compiles an automaton of its shard's phrases (one in every
   ``stride`` words of a passage, so that every window holds one), streams its
   documents' parts through it, and extends each hit word by word: what is
   removed has been compared as text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby, islice, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestay.llm.common import map_slices, ranges, stored, texts, words_of

#: Text of passages in one shard, about; an automaton of it takes some tens of megabytes.
SHARD_BYTES = 1 << 20
#: Documents one task streams through an automaton; a shard with more is dealt to several tasks.
DOCS_PER_TASK = 2000
#: Partitions of the streaming step, at most, unless the session asks for more; a partition takes its tasks one by one.
MOST_PARTITIONS = 20_000
#: A text is joined by broadcast with its first document if it is more than one in this many of all rows.
HOT_SHARE = 2000
#: Words of a passage in one piece. Neighbouring pieces share all words but one of a window.
PIECE_WORDS = 2000
#: Cores that the windows with one anchor have, at most, and one more: with more, cores are longer and less common.
SLACKS = 6
#: Windows in one row of ``cores``, at most.
RUN_WINDOWS = 256
#: Bytes of texts that go through an automaton together, about.
TOGETHER_BYTES = 1 << 18
#: Hits of one text, and places in passages that they stand for, compared at a time, about.
HITS_AT_ONCE = 1 << 16
#: Bytes of a word from which on its code comes from XXH64, one word at a time.
LONG_WORD = 64

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


@dataclass(frozen=True)
class PassageSpec:
    """``window``: words that have to recur; ``phrase``: words of an anchor and of a pattern."""

    window: int = 50
    phrase: int = 16

    @property
    def stride(self) -> int:
        return self.window - self.phrase + 1

    @property
    def slack(self) -> int:
        """Consecutive windows with one anchor that can have one core; a core has all words of a window but these
        (and one)."""
        return (self.stride + SLACKS - 1) // SLACKS


def split_words(texts_: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, flat, as Arrow splits them at the six ASCII white spaces, and the number of each text."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts_.cast(pa.string()), "").cast(pa.large_string()))
    words = split.flatten()
    some = pc.not_equal(pc.binary_length(words), 0)  # ends of a text that begins or ends with white space
    filled = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))]).astype(np.int64)
    offsets = split.offsets.to_numpy()
    return words.filter(some), np.diff(filled[offsets - offsets[0]])


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


#: A mask of the first k bytes of eight, little end first.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_codes(words: pa.LargeStringArray) -> np.ndarray:
    """A 64-bit code of each word, from its length and its bytes, eight at a time for all words together."""
    if not len(words):
        return np.zeros(0, np.uint64)
    edges = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[edges[0]:edges[-1]]
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # the eight bytes from each place on
    starts, sizes = edges[:-1] - edges[0], np.diff(edges)
    codes = _mixed(sizes.astype(np.uint64) * _BASES[0] ^ eights[starts] & _FIRST_BYTES[np.minimum(sizes, 8)])
    done, more = 8, np.flatnonzero((sizes > 8) & (sizes < LONG_WORD))
    while len(more):
        next_ = eights[starts[more] + done] & _FIRST_BYTES[np.minimum(sizes[more] - done, 8)]
        codes[more] = _mixed(codes[more] * _BASES[1] ^ next_)
        done += 8
        more = more[sizes[more] > done]
    for k in np.flatnonzero(sizes >= LONG_WORD):
        codes[k] = xxhash.xxh64_intdigest(data[starts[k]:starts[k] + sizes[k]].tobytes())
    return codes


def codes_of(texts_: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit code of every word of all texts, flat, and the number of words of each."""
    words, lengths = split_words(texts_)
    return word_codes(words), lengths


def gram_hashes(codes: np.ndarray, n: int, base: np.uint64 = _BASES[0]) -> np.ndarray:
    """A hash of each ``n`` consecutive codes, put together from those of powers of two."""
    size = len(codes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    block, width, power = codes, 1, base
    out, have = np.zeros(len(codes), np.uint64), 0
    while True:
        if n & width:
            m = len(codes) - (have + width) + 1
            out = out[:m] * power + block[have:have + m]
            have += width
        if have == n:
            break
        m = len(codes) - 2 * width + 1
        block = block[:m] * power + block[width:width + m]
        with np.errstate(over="ignore"):
            power = power * power
        width *= 2
    return _mixed(out)


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each ``width`` consecutive values."""
    if len(values) < width:
        return values[:0]
    have = 1
    while 2 * have <= width:
        values = pick(values[:-have], values[have:])
        have *= 2
    return pick(values[:len(values) - (width - have)], values[width - have:]) if have < width else values


def window_anchors(codes: np.ndarray, lengths: np.ndarray, spec: PassageSpec) -> tuple[np.ndarray, np.ndarray]:
    """For each place the hash of its phrase, and of the window that begins there the least hash of a phrase; 0 where
    no window of one text begins."""
    phrases = np.zeros(len(codes), np.uint64)
    least = np.zeros(len(codes), np.uint64)
    found = np.maximum(gram_hashes(codes, spec.phrase), np.uint64(1))
    phrases[:len(found)] = found
    minima = sliding(found, spec.stride, np.minimum)
    starts = np.cumsum(lengths) - lengths
    valid = ranges(starts, np.maximum(lengths - spec.window + 1, 0))
    least[valid] = minima[valid]
    return phrases, least


def anchor_places(phrases: np.ndarray, least: np.ndarray, spec: PassageSpec) -> np.ndarray:
    """Places whose phrase is the anchor of some window that covers it."""
    padded = np.concatenate([np.zeros(spec.stride - 1, np.uint64), least])
    most = sliding(padded, spec.stride, np.maximum)
    return np.flatnonzero((most == phrases) & (most > 0))


def window_runs(
    codes: np.ndarray, phrases: np.ndarray, least: np.ndarray, at: np.ndarray, spec: PassageSpec,
) -> tuple[np.ndarray, np.ndarray]:
    """For the windows that begin at the places ``at``: which are the first of a run of consecutive windows with one
    core, and the hashes of the runs' cores.

    The first place of a window's anchor, modulo ``slack``, is how far behind the window's begin its core begins. That
    depends on the window's words alone, so equal windows have equal cores.
    """
    places = anchor_places(phrases, least, spec)
    k, others = np.searchsorted(places, at), np.arange(len(at))
    while len(others):
        others = others[phrases[places[k[others]]] != least[at[others]]]
        k[others] += 1
    begins = at + (places[k] - at) % spec.slack
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (np.diff(begins) != 0) | (at[1:] % RUN_WINDOWS == 0)
    first = np.flatnonzero(new)
    return first, gram_hashes(codes, spec.window - spec.slack + 1)[begins[first]].view(np.int64)


def _lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def sketch(docs: DataFrame, spec: PassageSpec) -> DataFrame:
    """doc_id, n_words, SHA-256 of the words joined by blanks, and the distinct anchors of the text."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, lengths = split_words(batch.column("text"))
        phrases, least = window_anchors(word_codes(words), lengths, spec)
        at = anchor_places(phrases, least, spec)
        doc, found = np.repeat(np.arange(len(lengths)), lengths)[at], phrases[at]
        order = np.lexsort((found, doc))
        doc, found = doc[order], found[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
        edges = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
        lines = pc.binary_join(pa.ListArray.from_arrays(edges, words), pa.scalar(" ", pa.large_string())).cast(pa.large_binary())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(lengths, pa.int64()),
             pa.array([hashlib.sha256(line).digest() for line in lines.to_pylist()], pa.binary()),
             _lists(found[new].view(np.int64), np.bincount(doc[new], minlength=len(lengths)), pa.int64())],
            ["doc_id", "n_words", "sha", "anchors"])

    return map_slices(docs, "text", "doc_id long, n_words long, sha binary, anchors array<long>", work)


def candidates(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """Texts with recurring anchors: doc_id (the first of the text), sha, the words joined by blanks, the anchors, and
    the text's ``home``."""
    joined = docs.join(hits.withColumnRenamed("doc_id", "first"), F.col("doc_id") == F.col("first")).select(
        "doc_id", "text", "sha", "hits", "home")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines = [b" ".join(words_of(t)) for t in batch.column("text").to_pylist()]
        # rows that share a doc_id and not the text have met in the join
        same = [hashlib.sha256(x).digest() == s for x, s in zip(lines, batch.column("sha").to_pylist())]
        rows = batch.filter(pa.array(same, pa.bool_()))
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("sha"), pa.array([x for x, k in zip(lines, same) if k], pa.binary()),
             rows.column("hits"), rows.column("home")], ["doc_id", "sha", "text", "hits", "home"])

    return map_slices(joined, "text", "doc_id long, sha binary, text binary, hits array<long>, home long", work)


def windows(texts_: DataFrame, spec: PassageSpec) -> DataFrame:
    """(w1, w2, doc_id) of every window whose anchor is among the text's ``hits``."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, lengths = codes_of(batch.column("text"))
        _, least = window_anchors(codes, lengths, spec)
        some = _with_anchor(least, lengths, batch.column("hits"))
        w1, w2 = (gram_hashes(codes, spec.window, b)[some].view(np.int64) for b in _BASES)
        ids = np.repeat(batch.column("doc_id").to_numpy(), lengths)[some]
        return pa.RecordBatch.from_arrays([pa.array(w1), pa.array(w2), pa.array(ids)], ["w1", "w2", "doc_id"])

    return map_slices(texts_, "text", "w1 long, w2 long, doc_id long", work)


def _with_anchor(least: np.ndarray, lengths: np.ndarray, hits: pa.Array) -> np.ndarray:
    """Places of windows whose anchor is among the hits of their own text."""
    ends = np.cumsum(lengths)
    out = [
        a + np.flatnonzero(np.isin(least[a:b], np.array(h, np.int64).view(np.uint64)))
        for a, b, h in zip(ends - lengths, ends, hits.to_pylist()) if h and b > a
    ]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def cores(texts_: DataFrame, spec: PassageSpec) -> DataFrame:
    """(h, same, d, k, starts, windows): the core of a run of windows whose anchor is among the text's ``hits``, a hash
    of the run, the text's doc_id and digest, the numbers of the first words of all such runs in the text, and the
    first hash of each window."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, lengths = codes_of(batch.column("text"))
        phrases, least = window_anchors(codes, lengths, spec)
        some = _with_anchor(least, lengths, batch.column("hits"))
        first, found = window_runs(codes, phrases, least, some, spec)
        hashes = gram_hashes(codes, spec.window)[some]
        n = np.diff(np.append(first, len(some)))
        same = _mixed(hashes[first] * _BASES[0] ^ _mixed(hashes[first + n - 1] * _BASES[1] ^ n.astype(np.uint64))).view(np.int64)
        ends = np.cumsum(lengths)
        doc = np.searchsorted(ends, some[first], side="right")
        starts = (some[first] - (ends - lengths)[doc]).astype(np.int32)
        order = np.lexsort((starts, same, found, doc))
        new = np.ones(len(order), bool)
        new[1:] = np.any([np.diff(x[order]) != 0 for x in (same, found, doc)], axis=0)
        one = order[new]
        rows = pa.array(doc[one])
        return pa.RecordBatch.from_arrays(
            [pa.array(found[one]), pa.array(same[one]), batch.column("doc_id").take(rows), batch.column("sha").take(rows),
             _lists(starts[order], np.diff(np.append(np.flatnonzero(new), len(order))), pa.int32()),
             _lists(hashes[ranges(first[one], n[one])].view(np.int64), n[one], pa.int64())],
            ["h", "same", "d", "k", "starts", "windows"])

    return map_slices(
        texts_, "text", "h long, same long, d long, k binary, starts array<int>, windows array<long>", work)


def passages(owned: DataFrame, spec: PassageSpec) -> DataFrame:
    """Runs of confirmed windows in their owner, in pieces: owner, its home, text, and of each run of windows
    with one core the core and the first hashes of the windows.

    ``owned``: doc_id, home, text, and ``confirmed``, first hashes of the windows that belong to the document.
    """
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        owners, homes, pieces, held, hashes, counts = [], [], [], [], [], []
        all_codes, lengths = codes_of(batch.column("text"))
        ends = np.cumsum(lengths)
        for k, (owner, home, t) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "home", "text")))):
            words = words_of(t)
            codes = all_codes[ends[k] - lengths[k]:ends[k]]
            found = gram_hashes(codes, spec.window).view(np.int64)
            places = np.flatnonzero(np.isin(found, batch.column("confirmed")[k].values.to_numpy()))
            for run in np.split(places, np.flatnonzero(np.diff(places) > 1) + 1) if len(places) else []:
                step = PIECE_WORDS - spec.window + 1
                for a in range(int(run[0]), int(run[-1]) + 1, step):
                    b = min(a + PIECE_WORDS, int(run[-1]) + spec.window)
                    owners.append(owner)
                    homes.append(home)
                    pieces.append(b" ".join(words[a:b]))
                    phrases, least = window_anchors(codes[a:b], np.array([b - a]), spec)
                    size = b - a - spec.window + 1
                    first, of_runs = window_runs(codes[a:b], phrases, least, np.arange(size), spec)
                    held.append(of_runs)
                    hashes.append(found[a:a + size])
                    counts.append(np.diff(np.append(first, size)))
        none, of_pieces = np.zeros(0, np.int64), np.array([len(x) for x in held], np.int64)
        of_runs = _lists(np.concatenate([*hashes, none]), np.concatenate([*counts, none]), pa.int64())
        edges = pa.array(np.concatenate([[0], np.cumsum(of_pieces)]), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(owners, pa.int64()), pa.array(homes, pa.int64()), pa.array(pieces, pa.binary()),
             _lists(np.concatenate([*held, none]), of_pieces, pa.int64()), pa.ListArray.from_arrays(edges, of_runs)],
            ["owner", "home", "text", "cores", "windows"])

    return map_slices(
        owned, "text", "owner long, home long, text binary, cores array<long>, windows array<array<long>>", work)


def sharded(pieces: DataFrame) -> DataFrame:
    """``pieces`` with a shard of about ``SHARD_BYTES``. Pieces of one home stay together as far as they fit, so that
    a document that is like others needs few automata."""
    sizes = pieces.groupBy("home").agg(F.sum(F.octet_length("text")).alias("bytes"))
    n_shards = 1 + (sizes.agg(F.sum("bytes")).first()[0] or 0) // SHARD_BYTES
    parts = sizes.select(F.col("home").alias("of_home"), F.ceil(F.col("bytes") / SHARD_BYTES).alias("parts"))
    part = F.pmod(F.xxhash64("owner", "text"), F.col("parts"))
    return pieces.join(parts, F.col("home") == F.col("of_home")).select(
        "owner", "text", "cores", "windows", F.pmod(F.xxhash64("home", part), F.lit(n_shards)).alias("shard"))


def looked_up(rows: DataFrame, key: str, table: DataFrame, at: str) -> DataFrame:
    """``rows`` joined with ``table`` where ``key`` equals ``at``. Keys of more than one in ``HOT_SHARE`` of all rows
    are few, and theirs is broadcast."""
    bound = rows.count() // HOT_SHARE
    hot = F.broadcast(rows.groupBy(key).agg(F.count("*").alias("n_")).where(F.col("n_") > max(bound, 1)).select(
        F.col(key).alias("hot_")))
    same = F.col(key) == F.col(at)
    of_hot = table.join(hot, F.col(at) == F.col("hot_"), "left_semi")
    cold = rows.join(hot, F.col(key) == F.col("hot_"), "left_anti").join(table, same)
    return rows.join(F.broadcast(of_hot), same).union(cold)


def routed(runs: DataFrame, pieces: DataFrame, spec: PassageSpec) -> DataFrame:
    """(d, k, shard, ranges): the shards with a passage of a smaller document that a text's windows can be in, and where
    the words of those windows begin and end. ``runs``: of ``cores``."""
    in_shard = pieces.select("shard", "owner", F.explode("cores").alias("r"))
    of_core = stored(in_shard.groupBy("r").agg(
        F.min("owner").alias("owner"), F.min("shard").alias("s"), F.max("shard").alias("t")), "of_core")
    several = F.col("s") != F.col("t")
    met = stored(looked_up(runs, "h", of_core, "r").where(F.col("owner") < F.col("d")).select(
        "d", "k", "h", "same", "starts", F.size("windows").alias("size"), "s", "t",
        F.when(several, F.col("windows")).alias("windows")), "met")
    in_one = met.where(~several).select("d", "k", F.col("s").alias("shard"), F.transform("starts", lambda x: F.struct(
        x.alias("a"), (x + F.col("size") + spec.window - 1).alias("b"))).alias("ranges"))
    # cores in several shards: by the windows of each different run, each of which has one owner
    common = of_core.where(several).select(F.col("r").alias("c"))
    of_window = stored(pieces.select("shard", "owner", F.explode(F.arrays_zip("cores", "windows")).alias("x")).join(
        common, F.col("x.cores") == F.col("c"), "left_semi").select("shard", "owner", F.explode("x.windows").alias("v")).groupBy(
        "v", "shard").agg(F.min("owner").alias("of")), "of_window")
    met_several = met.where(several)
    single = stored(met_several.groupBy("h", "same").agg(F.first("windows").alias("windows")).select(
        "h", "same", F.posexplode("windows").alias("n", "w")), "single")
    places = stored(looked_up(single, "w", of_window, "v").groupBy(F.col("h").alias("h2"), F.col("same").alias("same2"), "shard").agg(
        F.min("of").alias("of"), F.min("n").alias("low"), F.max("n").alias("high")), "places")
    in_several = looked_up(met_several, "same", places, "same2").where(
        (F.col("h") == F.col("h2")) & (F.col("of") < F.col("d"))).select("d", "k", "shard", F.transform("starts", lambda x: F.struct(
            (x + F.col("low")).alias("a"), (x + F.col("high") + spec.window).alias("b"))).alias("ranges"))
    return in_one.union(in_several).groupBy("d", "k", "shard").agg(F.flatten(F.collect_set("ranges")).alias("ranges"))


class Automaton:
    """Aho-Corasick automaton of the phrases of some passages."""

    def __init__(self, found: list[tuple[int, bytes]], spec: PassageSpec):
        self.spec = spec
        self.reach = spec.stride - 1  # a window that holds a hit goes no more words beyond it
        self.numbers: dict[bytes, int] = {}
        at: dict[str, list[int]] = {}
        numbers, owners = [], []
        for owner, text in found:
            words, begin = text.split(), len(numbers) + self.reach
            numbers += [-2] * self.reach  # equal to no word of a text
            numbers += [self.numbers.setdefault(w, len(self.numbers)) for w in words]
            owners += [owner] * (len(numbers) - len(owners))
            for offset in range(0, len(words) - spec.phrase + 1, spec.stride):
                phrase = b" ".join(words[offset:offset + spec.phrase]).decode()
                at.setdefault(f" {phrase} ", []).append(begin + offset)
        self.passages = np.array(numbers + [-2] * self.reach, np.int32)
        self.counts = np.array([len(where) for where in at.values()], np.int64)
        self.begins = np.cumsum(self.counts) - self.counts
        self.places = np.array([place for where in at.values() for place in where], np.int64)
        self.owners = np.array(owners, np.int64)[self.places] if at else np.zeros(0, np.int64)
        self.automaton = ahocorasick.Automaton()
        for k, phrase in enumerate(at):
            self.automaton.add_word(phrase, k)
        self.any = bool(at)
        if self.any:
            self.automaton.make_automaton()

    def spans(self, doc_ids: list[int], texts_: list[bytes]) -> list[list[int]]:
        """For each text, words joined by a blank, begin and end of each span of words that windows of smaller
        documents' passages cover."""
        out: list[list[int]] = [[] for _ in texts_]
        joined = b" \n ".join(texts_)  # no word of a text has a line break
        line = f" {joined.decode()} "
        hits = self.automaton.iter(line) if self.any else iter(())
        part = list(islice(hits, HITS_AT_ONCE))
        if not part:
            return out
        ends = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), np.uint32) == 32)  # the blank after word k is k + 1
        words = joined.split(b" ")
        begins = np.cumsum([0, *(text.count(b" ") + 2 for text in texts_)])
        ids = np.repeat(np.array(doc_ids, np.int64), np.diff(begins))
        codes = np.full(len(words) + 2 * self.reach, -1, np.int32)
        codes[self.reach:self.reach + len(words)] = np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int32, len(words))
        gone = np.zeros(len(words), bool)
        while part:
            end, phrase = np.array(part, np.int64).T
            start = np.searchsorted(ends, end) - self.spec.phrase
            turn = np.cumsum(self.counts[phrase]) // HITS_AT_ONCE
            cuts = np.flatnonzero(np.diff(turn)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(part)]):
                low, high = max(start[a] - self.reach, 0), start[b - 1] + self.spec.phrase + self.reach
                self._mark(gone[low:high], codes[low:high + 2 * self.reach], start[a:b] - low, phrase[a:b], ids[start[a:b]])
            part = list(islice(hits, HITS_AT_ONCE))
        edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2)
        which = np.searchsorted(begins, edges[:, 0], side="right") - 1
        for k, (a, b) in zip(which.tolist(), (edges - begins[which][:, None]).tolist()):
            out[k] += (a, b)
        return out

    def _mark(self, gone: np.ndarray, codes: np.ndarray, start: np.ndarray, phrase: np.ndarray, ids: np.ndarray) -> None:
        """Mark the words of the windows that hold one of the hits and are a passage's too, compared word by word.
        ``codes`` has ``reach`` more words on both sides than ``gone``."""
        size, reach = self.spec.phrase, self.reach
        # every window holds a hit of its own, so one whose windows are gone to the last word finds nothing new
        before = np.concatenate([[0], np.cumsum(gone)])
        low, high = np.maximum(start - reach, 0), np.minimum(start + size + reach, len(gone))
        new = before[high] - before[low] < high - low
        start, phrase, ids = start[new], phrase[new], ids[new]
        which = ranges(self.begins[phrase], self.counts[phrase])
        start = np.repeat(start, self.counts[phrase])
        smaller = self.owners[which] < np.repeat(ids, self.counts[phrase])
        place, start = self.places[which[smaller]], start[smaller]
        half = (reach + 1) // 2  # a window goes so far beyond the hit on one side at least
        if half:
            far = (codes[start + reach - half] == self.passages[place - half]) | (
                codes[start + reach + size + half - 1] == self.passages[place + size + half - 1])
            place, start = place[far], start[far]
        beside, at_once = np.arange(reach), 1 + HITS_AT_ONCE // self.spec.window
        for k in range(0, len(start), at_once):
            some = slice(k, k + at_once)
            left, right = (
                np.logical_and.accumulate(
                    codes[start[some, None] + reach + step] == self.passages[place[some, None] + step], axis=1).sum(axis=1)
                for step in (-1 - beside, size + beside))
            whole = left + size + right >= self.spec.window
            edges = np.bincount(start[some][whole] - left[whole], minlength=len(gone) + 1)
            edges -= np.bincount(start[some][whole] + size + right[whole], minlength=len(gone) + 1)
            gone |= np.cumsum(edges)[:-1] > 0


def parts(texts_: DataFrame, dealt: DataFrame) -> DataFrame:
    """(shard, task, kind, doc_id, sha, first, text): what ``dealt`` (d, k, shard, task, ranges) sends of each text to
    a task, and the number of the part's first word."""
    sent = dealt.groupBy("d", "k").agg(F.collect_list(F.struct("shard", "task", "ranges")).alias("sent"))
    joined = texts_.join(sent, (F.col("doc_id") == F.col("d")) & (F.col("sha") == F.col("k"))).select("doc_id", "sha", "text", "sent")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for doc_id, sha, text, sent in zip(*(c.to_pylist() for c in batch.columns)):
            words = text.split()
            for to in sent:
                gone_to = np.array([(r["a"], r["b"]) for r in to["ranges"]], np.int64)
                gone_to = gone_to[np.argsort(gone_to[:, 0], kind="stable")]
                upto = np.maximum.accumulate(gone_to[:, 1])
                cuts = np.flatnonzero(gone_to[1:, 0] > upto[:-1]) + 1
                for a, b in zip(gone_to[[0, *cuts], 0].tolist(), upto[[*(cuts - 1), -1]].tolist()):
                    out.append((to["shard"], to["task"], doc_id, sha, a, b" ".join(words[a:b])))
        columns = list(zip(*out)) or [()] * 6
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], ["shard", "task", "doc_id", "sha", "first", "text"])

    found = map_slices(joined, "text", "shard long, task int, doc_id long, sha binary, first int, text binary", work)
    return found.select("shard", "task", F.lit(1).alias("kind"), "doc_id", "sha", "first", "text")


def located(texts_: DataFrame, routes: DataFrame, pieces: DataFrame, spec: PassageSpec) -> DataFrame:
    """(doc_id, sha, spans): documents whose parts are streamed through the automata of the shards that ``routes`` names
    (d, k, shard, and the parts as ``ranges`` of words)."""
    tasks = routes.groupBy("shard").agg(F.ceil(F.count("*") / DOCS_PER_TASK).cast("int").alias("n")).select(
        F.col("shard").alias("s"), "n")
    none = F.lit(None)
    of_pieces = pieces.join(tasks, F.col("shard") == F.col("s")).select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("task"), F.lit(0).alias("kind"),
        F.col("owner").alias("doc_id"), none.cast("binary").alias("sha"), F.lit(0).alias("first"), "text")
    dealt = routes.join(tasks, F.col("shard") == F.col("s")).select(
        "d", "k", "shard", F.pmod(F.xxhash64("d", "k"), F.col("n")).cast("int").alias("task"), "ranges")
    of_docs = parts(texts_, dealt)
    # twice as many partitions as tasks, so that few tasks share one
    n_tasks = tasks.agg(F.sum("n")).first()[0] or 0
    n_parts = max(int(texts_.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(2 * n_tasks, MOST_PARTITIONS))
    rows = of_pieces.union(of_docs).repartition(n_parts, "shard", "task").sortWithinPartitions("shard", "task", "kind")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found, automaton = None, [], None
        for batch in batches:
            ids, shas, spans = [], [], []
            for (shard, task, kind), rows in groupby(zip(*(c.to_pylist() for c in batch.columns)), lambda row: row[:3]):
                _, _, _, doc_ids, digests, firsts, parts_ = zip(*rows)
                if (shard, task) != now:
                    now, found, automaton = (shard, task), [], None
                if kind == 0:
                    found += zip(doc_ids, parts_)
                    continue
                automaton = automaton or Automaton(found, spec)
                cuts = np.flatnonzero(np.diff(np.cumsum([len(x) for x in parts_]) // TOGETHER_BYTES)) + 1
                for a, b in zip([0, *cuts], [*cuts, len(parts_)]):
                    for k, hit in enumerate(automaton.spans(doc_ids[a:b], parts_[a:b]), a):
                        if hit:
                            ids.append(doc_ids[k])
                            shas.append(digests[k])
                            spans.append([firsts[k] + x for x in hit])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(shas, pa.binary()), pa.array(spans, pa.list_(pa.int32()))],
                ["doc_id", "sha", "spans"])

    return rows.mapInArrow(stream, "doc_id long, sha binary, spans array<int>")


def without_spans(found: DataFrame) -> DataFrame:
    """(first, key, removed, rest): each text without the words of its spans."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        removed, rest = [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            words = text.split()
            gone = np.zeros(len(words), bool)
            for a, b in zip(spans[::2], spans[1::2]):
                gone[a:b] = True
            removed.append(int(gone.sum()))
            rest.append(b" ".join(w for w, g in zip(words, gone) if not g).decode())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("sha"), pa.array(removed, pa.int64()), pa.array(rest, pa.string())],
            ["first", "key", "removed", "rest"])

    return map_slices(found, "text", "first long, key binary, removed long, rest string", work)


def with_firsts(slim: DataFrame) -> DataFrame:
    """``slim`` and ``first0``, the smallest doc_id that has a row's text (null if none has an id).

    A text that very many rows hold would bring them all to one task of a join by digest. Of all rows, fewer than
    ``HOT_SHARE`` texts can each hold more than one in ``HOT_SHARE``; these few are broadcast, and only rows of the
    others are shuffled.
    """
    firsts = slim.groupBy("sha").agg(F.min("doc_id").alias("first0"), F.count("*").alias("n")).withColumnRenamed("sha", "key0")
    bound = slim.count() // HOT_SHARE
    hot = F.broadcast(firsts.where(F.col("n") > max(bound, 1)).drop("n"))
    same = F.col("sha") == F.col("key0")
    cold = slim.join(hot, same, "left_anti").join(firsts.drop("n"), same, "left")
    return slim.join(hot, same).select(*slim.columns, "first0").union(cold.select(*slim.columns, "first0"))


def repeated_passages(
    docs: DataFrame, spec: PassageSpec = PassageSpec(), doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: n_words, n_removed, kept_sha256, kept_text (null where nothing is removed), and
    the XXH64 of the text, which tells rows with one doc_id apart.

    A word goes if a window of ``spec.window`` words that covers it begins in
    a document with a smaller doc_id too; windows are judged on the input.
    Null and empty texts have no words. Rows with one doc_id are not smaller
    than each other, so none loses anything to the other. A row without a
    doc_id loses nothing and takes nothing from others. Other columns are not
    read.
    """
    rows = texts(docs, doc_id, text)
    hashed = rows.withColumn("row", F.struct(F.xxhash64("text").alias("text_hash")))
    known = stored(sketch(hashed, spec), "sketch")
    slim = known.select("doc_id", "n_words", "sha", F.col("row.text_hash").alias("text_hash"))
    firsts = slim.where("doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("first")).withColumnRenamed("sha", "key")

    # anchors that two different texts have; copies of a text do not count
    of_text = known.where("doc_id is not null").select(F.explode("anchors").alias("h"), F.xxhash64("sha").alias("t"), "doc_id")
    recurring = of_text.groupBy("h").agg(F.min("t").alias("a"), F.max("t").alias("b"), F.min("doc_id").alias("home")).where(
        "a <> b").select(F.col("h").alias("r"), "home")
    of_first = known.join(firsts, (F.col("sha") == F.col("key")) & (F.col("doc_id") == F.col("first"))).select(
        "doc_id", "sha", F.explode("anchors").alias("h"))
    # a text's home is the document that most of its anchors were first seen in: near copies have one home
    hits = of_first.join(recurring, F.col("h") == F.col("r")).groupBy("doc_id", "sha").agg(
        F.collect_set("h").alias("hits"), F.mode("home", True).alias("home"))
    texts_ = stored(candidates(rows, hits), "candidates")

    owned = windows(texts_, spec).groupBy("w1", "w2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("b"))
    owned = owned.where("owner <> b").groupBy("owner").agg(F.collect_list("w1").alias("confirmed"))
    found = texts_.join(owned, F.col("doc_id") == F.col("owner")).select("doc_id", "home", "text", "confirmed")
    pieces = stored(sharded(stored(passages(found, spec), "passages")), "shards")

    routes = stored(routed(stored(cores(texts_, spec), "cores"), pieces, spec), "routes")

    slim_texts = texts_.select("doc_id", "sha", "text")
    spans = located(slim_texts, routes, pieces, spec).groupBy("doc_id", "sha").agg(
        F.flatten(F.collect_set("spans")).alias("spans")).select(F.col("doc_id").alias("d"), F.col("sha").alias("k"), "spans")
    # rows that repeat a text under one doc_id have come along until here, with equal spans
    changed = without_spans(slim_texts.join(spans, (F.col("doc_id") == F.col("d")) & (F.col("sha") == F.col("k"))).select(
        "doc_id", "sha", "text", "spans")).dropDuplicates(["first", "key"])

    copy = (F.col("doc_id") > F.col("first0")) & (F.col("n_words") >= spec.window)
    judged = with_firsts(slim).join(changed, (F.col("doc_id") == F.col("first")) & (F.col("sha") == F.col("key")), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return judged.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(nothing)).when(F.col("rest").isNotNull(), F.sha2("rest", 256)).otherwise(
            F.lower(F.hex("sha"))).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("rest")).alias("kept_text"), "text_hash")


def without_repeated_passages(
    docs: DataFrame, spec: PassageSpec = PassageSpec(), doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``docs`` without the repeated passages. A text that loses nothing stays to the letter, one that loses words
    has the others joined by blanks, and rows of which no word is left go."""
    found = repeated_passages(docs, spec, doc_id, text).where("kept_text is not null").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("kept_text").alias("_kept"))
    found = found.dropDuplicates(["_id", "_hash"])
    same_row = (F.col(doc_id) == F.col("_id")) & (F.xxhash64(F.col(text).cast("binary")) == F.col("_hash"))
    joined = docs.join(found, same_row, "left").where("_kept is null or _kept <> ''")
    return joined.select(*(F.coalesce("_kept", text).alias(text) if c == text else docs[c] for c in docs.columns))
