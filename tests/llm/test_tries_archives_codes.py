"""Prefix tries, WARC archives and vector codes against brute force, odd rows included."""

import gzip
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestay.llm import prefix_trie, vector_codes, warc
from lodestay.llm.vector_codes import CodeSpec, Part

# ---- prefix tries ------------------------------------------------------------------------------------------------

TALK = "conv_id long, turn long, role string, text string"


def brute_trie(rows, mixed):
    """Rows of the trie, from (conv_id, turn, role, text)."""
    talks = defaultdict(list)
    for c, _, role, text in sorted(
            ((c, (t is not None, t or 0), r or "", x or "") for c, t, r, x in rows if c is not None), key=lambda r: r):
        talks[c].append((role, text))
    paths = dict(talks)
    if mixed:
        for c in talks:
            h = zlib.crc32(str(c).encode()) % 9
            paths[c] = talks.get(c - int(np.fmod(c, 5)), [])[:h] + talks[c][h:]
    members = defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[tuple(paths[c][:d])].append(c)
    out = []
    for node, who in members.items():
        below = [n for n in members if n[:len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = ",".join(str(c) for c in who if len(paths[c]) == len(node))
        out.append((who[0], len(node), members[node[:-1]][0] if node else None, len(who), len(children), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_rows(paths):
    return sorted(map(tuple, prefix_trie.prefix_trie(paths).drop("key", "parent_key").collect()), key=str)


def talk_rows(rng, n):
    rows = []
    for c in range(n):
        for t in range(rng.choice([1, 2, 3, 12])):
            rows.append((c * rng.choice([1, 1, -1]), t, rng.choice(["user", "bot"]) if t else "user", rng.choice(["a", "bé", "", "ccc"]) if t else "hi"))
    return rows


@pytest.mark.parametrize("shard", [prefix_trie.SHARD_TURNS, 7])
@pytest.mark.parametrize("mixed", [True, False])
def test_trie_against_brute_force(spark, monkeypatch, shard, mixed):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shard)
    rows = talk_rows(random.Random(shard), 60)
    # null turn, role and text, rows without a conversation, repeated rows, equal turns, a long text
    rows += [(70, None, None, None), (70, None, None, None), (70, 1, "user", "x"), (70, 1, "user", "w"), (None, 1, "user", "lost"),
             (71, 0, "user", "long " * 50_000), (72, 0, "use", "rhi"), (73, 0, "user", "hi")]
    df = spark.createDataFrame(rows, TALK).withColumn("key", F.lit("clash")).withColumn("depth", F.lit(3)).repartition(5)
    turns = prefix_trie.turns_of(df)
    paths = prefix_trie.rebuilt_paths(turns) if mixed else prefix_trie.paths_of(turns)
    assert trie_rows(paths) == brute_trie(rows, mixed)


def test_trie_of_no_conversations(spark):
    none = spark.createDataFrame([], TALK)
    assert trie_rows(prefix_trie.rebuilt_paths(prefix_trie.turns_of(none))) == []


def test_minimal_hash_gives_every_slot_once():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 1000, 30_000):
        keys = np.unique(rng.integers(0, 2**64, (n, 3), dtype=np.uint64), axis=0)
        table = prefix_trie.MinimalHash(keys)
        slots = table.slots(keys)
        assert sorted(slots.tolist()) == list(range(len(keys))) and (table.keys[slots] == keys).all()
        shuffled = prefix_trie.MinimalHash(rng.permutation(keys))
        assert (shuffled.slots(keys) == slots).all()  # the set decides, not the order
        if n:
            with pytest.raises(ValueError, match="does not hold"):
                table.slots(keys + np.uint64(1))


def test_long_conversation_keys():
    depth = np.arange(200_001)
    turns = np.random.default_rng(1).integers(0, prefix_trie.PRIME, (len(depth), 4))
    keys = prefix_trie.prefix_keys(np.zeros(len(depth), np.int64), depth, turns)
    assert len(np.unique(keys[:, :2], axis=0)) == len(depth) and keys[0].tolist() == [0, 0, 0]


# ---- archives ----------------------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def brute_archive(rows, least=100):
    payloads = defaultdict(list)
    for page, url, html in rows:
        payloads[(html or "").encode()].append((page is None, page or 0, url is None, url or "", page))
    out = []
    for payload, places in payloads.items():
        places.sort(key=lambda p: p[:4])
        for k, p in enumerate(places):
            again = k > 0 and len(payload) >= least
            out.append((p[4], len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", places[0][4] if again else None))
    return sorted(out, key=str)


def test_archive_round_trip(spark):
    long, page = "é" * 500_000, "<p>" + "x" * 100
    rows = [(1, "http://a/", page), (3, "http://b/", page), (2, None, page), (3, "http://b/", page), (None, "http://c/", page),
            (4, "http://d/\r\nX: y", "short"), (5, "u", "short"), (5, "u", "short"), (6, None, None), (7, "u", ""), (8, "u", long), (9, "u", long),
            (10, "u", "y" * 100), (11, "u", "y" * 100), (12, "u", "y" * 99), (13, "u", "y" * 99), (None, None, "z" * 200), (None, None, "z" * 200),
            (14, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9)]
    df = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("clash")).withColumn("warc_type", F.lit(1)).repartition(4)
    assert sorted(map(tuple, warc.round_trip(df).collect()), key=str) == brute_archive(rows)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_predicates_are_pushed_and_payloads_left_alone(spark, tmp_path):
    folder = f"file://{tmp_path}/archive"
    rows = [(i, f"http://h{i % 3}/p", f"{i % 10} " + "text " * 60) for i in range(40)]
    warc.write_warc(warc.page_records(spark.createDataFrame(rows, PAGES)), folder, file_bytes=2000)
    files = list((tmp_path / "archive").glob("*.warc.gz"))
    assert len(files) > 3
    whole = gzip.decompress(files[0].read_bytes())  # any gzip reader reads it
    assert whole.startswith(b"WARC/1.1\r\nWARC-Type: ") and b"\r\n\r\nHTTP/1.1 200 OK\r\n" in whole
    found = warc.read_warc(spark, folder, "warc_type string, warc_page_id long, payload_length long, payload binary", partition_bytes=3000)
    kept = found.where("warc_type = 'response' and warc_page_id >= 4 and warc_page_id in (3, 5, 7)")
    assert {r.warc_page_id: bytes(r.payload).decode() for r in kept.collect()} == {i: rows[i][2] for i in (5, 7)}
    assert "Filter (" not in kept._jdf.queryExecution().executedPlan().toString()
    assert found.where("payload_length > 0").count() == 40  # not a header: Spark decides it
    assert warc.read_warc(spark, folder).where("warc_type <> 'response'").where("payload is null and warc_refers_to is not null").count() == 30
    # what a task left that does not count is in no list
    (tmp_path / "archive" / "part-lost.warc.gz").write_bytes(files[0].read_bytes())
    assert found.count() == 40
    read = []

    class Seen:
        def __init__(self, data):
            self.data, self.at = data, 0

        def size(self):
            return len(self.data)

        def seek(self, at):
            self.at = at

        def read(self, n):
            got = self.data[self.at:self.at + n]
            self.at += n
            read.append(len(got))
            return got

    big = b"".join(warc.packed(warc.record_bytes(
        [("WARC-Type", "response"), ("Content-Type", "application/http; msgtype=response")], random.Random(k).randbytes(2_000_000), None), 1) for k in range(3))
    assert [r.payload_length for r in warc.records(Seen(big), True)] == [2_000_000] * 3
    assert sum(read) < 3 * 4 * warc.READ_BYTES  # three of some thirty blocks a record


def test_foreign_archives(spark, tmp_path):
    """Plain files, members without a stated length, folded and odd headers, other record types."""
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\nContent-Type: text/plain\r\n\r\nabc\r\n\r\n"
    folded = b"WARC/1.0\r\nwarc-type: resource\r\nWARC-Target-URI: http://a/\r\n  b\r\nno colon\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    http = warc.record_bytes([("WARC-Type", "response"), ("Content-Type", "application/http; msgtype=response")], b"\r\n\r\nbody", None)
    (tmp_path / "a.warc").write_bytes(info + folded + http)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(folded) + gzip.compress(http))
    (tmp_path / "empty.warc").write_bytes(b"")
    got = warc.read_warc(spark, f"file://{tmp_path}").select("warc_type", "warc_target_uri", "http_status", "payload").collect()
    each = [("resource", "http://a/ b", None, b""), ("response", None, 200, b"\r\n\r\nbody"), ("warcinfo", None, None, b"abc")]
    assert sorted((r[0], r[1], r[2], bytes(r[3])) for r in got) == sorted(each * 2)
    (tmp_path / "cut.warc").write_bytes(info + http[:-20])
    with pytest.raises(Exception, match="cut.warc"):
        warc.read_warc(spark, f"file://{tmp_path}/cut.warc").collect()
    assert warc.read_warc(spark, f"file://{tmp_path}/nothing").count() == 0


# ---- vector codes ------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label string"


def brute_codes(rows, spec):
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    if not kept:
        return {}
    whole = {k: [int(np.floor(spec.scale * x)) for x in r[1]] for k, r in enumerate(kept)}
    first = sorted((r[0], r[1], k) for k, r in enumerate(kept) if r[0] is not None)[:spec.entries]
    width = len(kept[0][1]) // spec.parts
    books = [[whole[k][p * width:(p + 1) * width] for _, _, k in first] for p in range(spec.parts)]

    def nearest(book, part):
        d = [sum((a - b) ** 2 for a, b in zip(e, part)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(spec.rounds):
        for p in range(spec.parts):
            parts = [whole[k][p * width:(p + 1) * width] for k in whole]
            where = [nearest(books[p], x)[0] for x in parts]
            books[p] = [
                [sum(c) // len(c) for c in zip(*(x for x, e in zip(parts, where) if e == n))] if n in where else entry
                for n, entry in enumerate(books[p])]
    out = []
    for k, r in enumerate(kept):
        found = [nearest(books[p], whole[k][p * width:(p + 1) * width]) for p in range(spec.parts)]
        out.append((r[0], "".join(f"{e:02x}" for e, _ in found), min(sum(d for _, d in found), vector_codes.LONG_MAX), r[2]))
    sums = defaultdict(int)
    for _, _, error, label in out:
        sums[label] += error
    name = hashlib.sha256(",".join(str(v) for book in books for e in book for v in e).encode()).hexdigest()
    return sorted(((i, c, e, min(sums[n], vector_codes.LONG_MAX), name) for i, c, e, n in out), key=str)


def odd_vectors(rng, n, size):
    centres = rng.normal(size=(9, 8))
    rows = []
    for i in range(n):
        v = (centres[rng.integers(9)] + rng.normal(scale=rng.choice([0.0, 0.01, 1.0]), size=8)) * size
        rows.append((int(i), [float(x) for x in v], [None, "a", "b"][i % 3]))
    rows += [(rows[5][0], rows[5][1], "a"), (rows[5][0], rows[5][1], "a"), (None, rows[7][1], None), (n + 1, None, "a"),
             (n + 2, [None] * 8, "a"), (n + 3, [float("nan")] * 8, "a"), (n + 4, [float("inf")] + [0.0] * 7, "b"), (-5, [0.0] * 8, "c"), (-4, [0.0] * 8, "c")]
    return rows


@pytest.mark.parametrize("size", [1.0, 1e6, 1e30])
def test_codes_against_brute_force(spark, size):
    rows = odd_vectors(np.random.default_rng(4), 300, size)
    df = spark.createDataFrame(rows, VECTORS).withColumn("code", F.lit("clash")).withColumn("vector", F.lit(1)).repartition(5)
    spec = CodeSpec(parts=4)
    assert sorted(map(tuple, vector_codes.vector_codes(df, spec).collect()), key=str) == brute_codes(rows, spec)


def test_few_vectors_other_lengths_and_none(spark):
    spec = CodeSpec(parts=2)
    few = [(1, [1.0, 2.0], "a"), (2, [1.0, 2.5], None)]
    odd = [(3, [1.0], "a"), (4, [], "a"), (0, [1.0, 2.0, 3.0], None)]
    got = {r.vec_id: tuple(r) for r in vector_codes.vector_codes(spark.createDataFrame(few + odd, VECTORS), spec).collect()}
    want = {r[0]: r for r in brute_codes(few, spec)}
    assert {k: got[k] for k in (1, 2)} == want
    assert [got[k][1:3] for k in (3, 4, 0)] == [(None, None)] * 3
    none = vector_codes.vector_codes(spark.createDataFrame([(1, None, "a")], VECTORS), spec)
    assert none.count() == 0 and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_bounds_settle_most_rows_and_never_wrongly():
    """Each round's assignments are the nearest entries, while most rows need no distance but to their own."""
    rng = np.random.default_rng(9)
    x = np.floor(4096 * (rng.normal(size=(16, 8))[rng.integers(16, size=4000)] + rng.normal(scale=0.1, size=(4000, 8)))).astype(np.int64)
    round_, state, needed = vector_codes.Round(CodeSpec(parts=1), [Part(x[:16], np.zeros(16), 4, 4)]), None, []
    for _ in range(8):
        state, need = round_.run(x, state)
        entries = round_.parts[0].entries
        d = ((x[:, None, :] - entries) ** 2).sum(-1)
        assert (state["p0"]["entry"] == d.argmin(1)).all()
        totals = [np.zeros(s, object) for s in round_.shapes]
        round_.gather(totals, x, state, need)
        needed.append((need[0] > 0).mean())
        round_ = round_.next(totals)
    assert needed[-1] < 0.2 and round_.parts[0].b == 2
