"""Near-duplicates, repeated passages and the pipeline against brute force, odd rows included."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lodestay.llm import quality, queries, simhash, substrings
from lodestay.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_print(text):
    words = [w.encode() for w in WORD.findall((text or "").translate(str.maketrans(
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_components(points, radius=4):
    """{id: smallest id reachable} for (id, print) pairs."""
    prints = np.array([p for _, p in points], np.uint64)
    label = np.array([i for i, _ in points])
    moved = True
    while moved:
        moved = False
        for k in range(len(points)):
            near = np.bitwise_count(prints ^ prints[k]) <= radius
            least = label[near].min()
            if (label[near] != least).any():
                label[near], moved = least, True
    return dict(zip([i for i, _ in points], label.tolist()))


def near_prints(rng, n):
    """Clusters, chains and single points, some pairs exactly four or five bits apart."""
    out = []
    while len(out) < n:
        p = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 30])):
            out.append(p)
            for k in rng.sample(range(64), rng.choice([0, 1, 3, 4, 5])):
                p ^= 1 << k
    return out[:n]


@pytest.mark.parametrize("shard_points", [simhash.SHARD_POINTS, 3])
def test_trees_find_every_link(spark, monkeypatch, shard_points):
    monkeypatch.setattr(simhash, "SHARD_POINTS", shard_points)
    rng = random.Random(8)
    found = sorted(set(near_prints(rng, 700)))
    ids = list(range(len(found)))
    rng.shuffle(ids)
    rows = [(int(np.uint64(p).view(np.int64)), i) for p, i in zip(found, ids)]
    points = spark.createDataFrame(rows, "print long, id long").repartition(5)
    links = simhash.shard_links(points, simhash.TreeSpec())
    got = {r.node: r.component for r in components(links).collect()}
    assert {i: got.get(i, i) for i in ids} == brute_components(list(zip(ids, found)))


def test_a_large_shard_is_split_by_deeper_trees(spark, monkeypatch):
    """Prints that agree in a third of the bits share a shard of ten times its size; no group of a task holds more."""
    monkeypatch.setattr(simhash, "SHARD_POINTS", 60)
    spec = simhash.TreeSpec()
    rng = random.Random(10)
    low = rng.getrandbits(21)
    found = sorted({p >> 21 << 21 | low ^ (1 << rng.randrange(21) if rng.random() < 0.3 else 0) for p in near_prints(rng, 600)})
    prints = np.array(found, np.uint64)
    _, shard, _ = simhash.visits(prints, spec)
    assert np.bincount(np.unique(shard, return_inverse=True)[1]).max() >= 10 * simhash.SHARD_POINTS * 0.7
    ids = list(range(len(found)))
    rows = [(int(p), i) for p, i in zip(prints.view(np.int64), ids)]
    links = simhash.shard_links(spark.createDataFrame(rows, "print long, id long").repartition(3), spec)
    got = {r.node: r.component for r in components(links).collect()}
    assert {i: got.get(i, i) for i in ids} == brute_components(list(zip(ids, found)))
    # every link meets in a deeper shard, with one of the two at home
    for tree in range(spec.trees):
        row, sub, own = simhash.visits(prints, spec, below=tree)
        homes = {(int(r), int(s)) for r, s in zip(row[own], sub[own])}
        shards = {}
        for r, s in zip(row.tolist(), sub.tolist()):
            shards.setdefault(r, set()).add(s)
        edges = [0, 21, 42, 64]
        keep = np.uint64((1 << 64) - 1 ^ ((1 << edges[tree + 1]) - (1 << edges[tree])))
        for i in range(0, len(prints), 7):
            for j in np.flatnonzero(np.bitwise_count((prints ^ prints[i]) & keep) <= 4).tolist():
                assert any((i, s) in homes or (j, s) in homes for s in shards[i] & shards[j])


def test_inner_tree_compares_what_brute_force_does(monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 50)
    rng = random.Random(9)
    prints = np.array(near_prints(rng, 400), np.uint64)
    home = np.array([rng.random() < 0.5 for _ in prints])
    label = simhash.link_shard(prints, home, 4)
    want = simhash.Links(len(prints))
    for i in np.flatnonzero(home):
        near = np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 4)
        want.add(np.full(len(near), i), near)
    assert (label == want.label).all()


def test_a_long_chain_is_one_component(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    rows = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1001, 1000), (2000, 2000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, n)}, 1001: 1000}


def test_near_duplicates_of_odd_rows(spark):
    rng = random.Random(2)
    base = " ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(80))
    rows = [(5, base), (3, base + " more"), (9, base.upper()), (9, base.upper()), (7, None), (8, ""), (4, " \n"), (1, "one two"),
            (2, "One  TWO"), (6, "one two three four five"), (None, base), (None, "nothing like it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("clash"))
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    with_id = sorted({(i, brute_print(t)) for i, t in rows if i is not None})
    labels = brute_components(with_id)
    of_print = {p: labels[i] for i, p in with_id}
    want = [(i, f"{brute_print(t):016x}", labels[i] if i is not None else of_print.get(brute_print(t))) for i, t in rows]
    assert got == sorted(want, key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicates_of_the_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    prints = [(i, brute_print(t)) for i, t in docs]
    labels = brute_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op6_simhash(spark, sf).collect()}
    assert got == {i: (f"{p:016x}", labels[i]) for i, p in prints}


def brute_passages(rows, window=50):
    """(doc_id, n_words, n_removed, sha of what is kept) of each row."""
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - window + 1) if i is not None else ():
            key = tuple(words[k:k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1) if i is not None else ():
            if first[tuple(words[k:k + window])] < i:
                gone |= set(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def passage_rows(seed):
    """Few words and shared passages: many windows recur, also inside one text and across passages."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(30)] + ["é", "中"]
    shared = [[rng.choice(words) for _ in range(rng.randint(5, 40))] for _ in range(6)] + [["For"] * 25, ["the", "end"] * 12]
    rows = []
    for i in rng.sample(range(200), 90):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts += rng.choice(shared) if rng.random() < 0.6 else [rng.choice(words) for _ in range(rng.randint(1, 15))]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(parts)))
    rows += [(rng.randrange(250), rng.choice(rows)[1]) for _ in range(20)]  # copies, perhaps under an id that is there
    rows += [rows[0], rows[0], (None, rows[1][1]), (0, None), (1, ""), (2, " \n ")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_of_short_windows(spark, seed, monkeypatch):
    monkeypatch.setattr(substrings, "PIECE_WORDS", 20)
    monkeypatch.setattr(substrings, "SHARD_BYTES", 300)
    monkeypatch.setattr(substrings, "DOCS_PER_TASK", 7)
    rows = passage_rows(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("clash")).repartition(4)
    got = substrings.repeated_passages(docs, substrings.PassageSpec(window=12, phrase=5))
    assert sorted((tuple(r)[:4] for r in got.collect()), key=str) == brute_passages(rows, 12)
    changed = got.where("kept_text is not null").collect()
    assert changed and all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in changed)


def test_passages_of_the_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op1_repeated_passages(spark, sf).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    want = brute_passages(rows)
    assert sorted(map(tuple, got), key=str) == want and any(r[2] for r in want)


def test_passages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.repeated_passages(docs).count() == 0
    assert substrings.without_repeated_passages(docs).count() == 0


def test_texts_go_only_where_their_windows_are(spark, monkeypatch):
    """Pairs of texts with a passage of their own, around one that all have: a text meets the pieces of the first text
    and those of its pair, not those of all pairs."""
    monkeypatch.setattr(substrings, "SHARD_BYTES", 300)
    rng = random.Random(7)
    common = [f"c{k}" for k in range(20)]
    rows = []
    for pair in range(40):
        own = [[f"p{pair}x{rng.randrange(10 ** 6)}" for _ in range(15)] for _ in range(2)]
        rows += [(2 * pair + half, " ".join([*own[0], *common, *own[1], f"end{half}"])) for half in range(2)]
    sent, located = [], substrings.located

    def spy(texts_, routes, pieces, spec):
        sent.append((routes.count(), pieces.select("shard").distinct().count()))
        return located(texts_, routes, pieces, spec)

    monkeypatch.setattr(substrings, "located", spy)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.repeated_passages(docs, substrings.PassageSpec(window=12, phrase=5))
    assert sorted((tuple(r)[:4] for r in got.collect()), key=str) == brute_passages(rows, 12)
    [(routes, shards)] = sent
    assert shards > 10 and routes <= 4 * len(rows)


def test_spans_in_small_portions(monkeypatch):
    rng = random.Random(3)
    spec = substrings.PassageSpec(window=9, phrase=4)
    passages = [(rng.randrange(20), " ".join(rng.choice(["a", "b", "é", "long" * 20]) for _ in range(rng.randint(9, 40))).encode())
                for _ in range(30)]
    texts = [(rng.randrange(25), b" ".join(rng.choice(passages)[1][:rng.randint(1, 60)].decode(errors="ignore").strip().encode() or b"x"
                                           for _ in range(rng.randint(1, 4)))) for _ in range(60)]
    want = []
    for i, text in texts:
        words, gone = text.split(), set()
        held = {tuple(p.split()[k:k + 9]) for owner, p in passages if owner < i for k in range(len(p.split()) - 8)}
        for k in range(len(words) - 8):
            gone |= set(range(k, k + 9)) if tuple(words[k:k + 9]) in held else set()
        want.append(gone)
    assert any(want)
    automaton = substrings.Automaton(passages, spec)
    for portion in (1, 7, 1 << 16):
        monkeypatch.setattr(substrings, "HITS_AT_ONCE", portion)
        got = automaton.spans([i for i, _ in texts], [t for _, t in texts])
        assert [{w for a, b in zip(x[::2], x[1::2]) for w in range(a, b)} for x in got] == want


def test_word_codes():
    words = [b"a", b"a\0", b"\0", b"abcdefgh", b"abcdefghi", b"h" * 63, b"h" * 64, b"h" * 65, "é中".encode(), b"h" * 200]
    flat, lengths = substrings.codes_of(pa.array([b" ".join(words), None, b" ", b"\n ".join(words[::-1]) + b"\t"], pa.binary()))
    assert lengths.tolist() == [10, 0, 0, 10] and len(set(flat.tolist())) == 10
    assert flat[:10].tolist() == flat[:9:-1].tolist()


def test_text_without_passages(spark):
    words = [f"w{k}" for k in range(60)]
    rows = [(1, "  " + "  ".join(words)), (2, "x " + " ".join(words) + " y"), (3, " ".join(words)), (4, "few\n\nwords")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept_text", F.lit(1))
    got = substrings.without_repeated_passages(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: rows[0][1], 2: "x y", 4: "few\n\nwords"}


def brute_pipeline(docs, items):
    """{doc_id: text} after the four filtering stages."""
    kept = {}
    for i, t in docs:
        judged = quality.judge((t or "").encode(), quality.LineRules())
        if judged[6]:
            kept[i] = judged[-1]
    labels = brute_components([(i, brute_print(t)) for i, t in kept.items()])
    kept = {i: t for i, t in kept.items() if labels[i] == i}
    first = {}
    for i in sorted(kept):
        words = WORD.findall(kept[i])
        for k in range(len(words) - 49):
            first.setdefault(tuple(words[k:k + 50]), i)
    for i in sorted(kept):
        words = WORD.findall(kept[i])
        gone = {j for k in range(len(words) - 49) if first[tuple(words[k:k + 50])] < i for j in range(k, k + 50)}
        if gone:
            kept[i] = " ".join(w for k, w in enumerate(words) if k not in gone)
    normal = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    windows = set()
    for t in items:
        words = normal.findall((t or "").translate(lower))
        size = min(13, len(words))
        windows |= {tuple(words[k:k + size]) for k in range(len(words) - size + 1)} if size else set()
    out = {}
    for i, t in kept.items():
        places = list(normal.finditer(t.translate(lower)))
        words = [m[0] for m in places]
        hit = {j for size in {len(w) for w in windows} for k in range(len(words) - size + 1)
               if tuple(words[k:k + size]) in windows for j in range(k, k + size)}
        if t and not (hit and 20 * len(hit) >= len(words)):
            chars, upto, k = [], 0, 0
            while k < len(words):
                if k in hit:
                    chars.append(t[upto:places[k].start()])
                    while k in hit:
                        upto = places[k].end()
                        k += 1
                else:
                    k += 1
            out[i] = "".join([*chars, t[upto:]])
    return out


def test_pipeline_equals_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in brute_pipeline(docs, items).items()}
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want and 0 < len(got) < len(docs)


def test_stages_take_odd_rows(spark, sf):
    prose = "This line says one thing and ends here. Then another line of {} says something else, and ends too.\nAnd so it goes."
    rows = [(1, prose.format("one"), "en", "a", 10, "x"), (1, prose.format("one"), "en", "a", 10, "x"), (None, prose.format("none"), None, None, None, None),
            (2, None, None, None, None, None), (3, "", "de", None, 0, "y"), (4, prose.format("four " * 30000), "en", "b", None, "z")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, component_id string"
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
            assert out.count() <= len(data)
            if name == "quality" and data:
                docs = out.cache()
                assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "1", "None"]
