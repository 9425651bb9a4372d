"""Operators that work row by row: each against brute force, and the defined results of odd rows."""

import hashlib
import html
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestay.llm import byte_bpe, decontaminate, html_text, language, quality, queries, token_counts, token_files, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALPHABET = list("abAB  \n\t\r\x0b\x1c\x85\xa0 é'strm1２½.,!?中文😀\u0301|<>ΣİK\u200b") + [
    "  ", "'s", "'ll", "<|endoftext|>", "<|ENDOFTEXT|>", "The ", "ing "]


def odd_texts(n=600, seed=1):
    rng = random.Random(seed)
    return [None, "", " ", "\n\n", "x" * 3000, "word " * 4000, "a\x00b", *(
        "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n))]


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, ties, repeated rows, and columns whose names the operators use themselves."""
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(odd_texts())]
    rows += [(3, "again", "x", 1, "y"), (3, "again", "x", 1, "y"), (None, "no id", "x", 1, "y"), (None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, row int, hits string").repartition(3)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def expected(odd, one):
    return sorted(((r.doc_id, *one(r.text)) for r in odd.collect()), key=str)


def test_byte_bpe_equals_the_library(odd):
    path = queries.BYTE_BPE
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})

    def one(text):
        ids = own.encode_ordinary(text or "")
        return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest(), ids)

    got = byte_bpe.encode_documents(odd, path, public_tokenizers.PATTERN)
    assert rows_of(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids") == expected(odd, one)
    assert got.where("decoded is null").count() == 0


def test_long_rows_of_the_matrices():
    bpe = byte_bpe.load(queries.BYTE_BPE, public_tokenizers.PATTERN)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    rng = random.Random(4)
    pieces = ["a" * 700, "ab" * 333, "".join(rng.choice("abcde") for _ in range(2000)), "é" * 500, "\n" * 300]
    ids, counts = bpe.encode(pieces)
    assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == [own.encode_ordinary(p) for p in pieces]


def test_pair_table_survives_collisions():
    n = 3000
    table = byte_bpe.PairTable(np.arange(n) % 60, np.arange(n) // 60, np.arange(n, dtype=np.int32))
    assert (table(np.arange(n) % 60, np.arange(n) // 60) == np.arange(n)).all()
    assert table(np.array([60, -1, 5]), np.array([1, 3, 70])).tolist() == [byte_bpe.NONE] * 3


def greedy(word, pieces):
    total = at = 0
    while at < len(word):
        size = next((k for k in range(len(word) - at, 0, -1) if word[at:at + k] in pieces), 0)
        total += 1 if size else len(word[at].encode())
        at += size or 1
    return total


def test_token_counts_are_greedy(odd):
    pieces = token_counts.vocabulary(queries.PIECES)

    def one(text):
        words = WORD.findall(text or "")
        return len(words), sum(greedy("▁" + w, pieces) for w in words)

    rows = [r for r in expected(odd, one)]
    assert rows_of(token_counts.token_counts(odd, queries.PIECES), "doc_id", "n_words", "n_tokens") == rows


def test_failure_links_on_a_small_vocabulary():
    rng = random.Random(5)
    for _ in range(300):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 12))}
        automaton = token_counts.LongestMatch(pieces)
        for _ in range(20):
            word = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 15)))
            assert automaton.count(word) == greedy(word, pieces)


def test_token_files_round_trip(odd, spark):
    library = Tokenizer.from_file(queries.WORD_BPE)
    folder_rows = odd.where("doc_id is not null and doc_id <> 3")
    start, want = 0, []
    for r in sorted(folder_rows.collect(), key=lambda r: r.doc_id):
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = token_files.round_trip(folder_rows, queries.WORD_BPE, end_id=1)
    assert sorted(map(tuple, got.collect())) == want
    # rows that share an id or have none are written and read like all others, those without one first
    whole = token_files.round_trip(odd, queries.WORD_BPE, end_id=1).orderBy("start").collect()
    assert len(whole) == odd.count() and [r.doc_id for r in whole[:2]] == [None, None]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(whole, whole[1:]))
    assert token_files.round_trip(odd.limit(0), queries.WORD_BPE, end_id=1).count() == 0


def test_token_files_hold_the_ids(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"some words of number {i}") for i in range(50)], "doc_id long, text string")
    folder = f"file://{tmp_path}/tokens"
    token_files.write_tokens(docs, folder, queries.WORD_BPE, 1, n_parts=4)
    library = Tokenizer.from_file(queries.WORD_BPE)
    got = {r.doc_id: r.ids for r in token_files.read_tokens(spark, folder, with_ids=True).collect()}
    assert got == {i: [*library.encode(f"some words of number {i}").ids, 1] for i in range(50)}
    manifest = spark.read.parquet(f"{folder}/manifest")
    assert manifest.count() == 4 and manifest.agg(F.sum("n_docs")).first()[0] == 50
    assert {r.width for r in manifest.collect()} == {2}


def base_figures(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words))


def test_quality_figures(odd):
    got = quality.quality_rules(odd)
    assert rows_of(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == expected(
        odd, base_figures)
    assert got.where("kept and base_failed").count() == 0


def test_lines_are_removed_before_documents():
    rules = quality.LineRules()
    prose = b"This is a line of prose that says something about the world, and it ends.\n" \
            b"Another one follows it here, no less sensible than the first of them.\n"
    menu = b"Home | News | Sport | Weather | About\n"
    kept = quality.judge(prose + menu + b"All rights reserved.\nShort one.\nShort one.", rules)
    assert kept[6] and kept[-1].encode() == prose + b"Short one."
    assert kept[8:11] == (0, 1, 2)
    assert not quality.judge(menu * 3 + prose.splitlines()[0], rules)[6]
    assert not quality.judge(b"one### two$$$ three%%% four&&& five*** six### seven$$$ eight%%% nine&&& ten###", rules)[6]


def test_clean_documents_are_kept_and_junk_goes(spark, sf):
    judged = queries.op5_quality_rules(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1")
    clean = judged.join(labels, "doc_id").where("not base_failed")
    assert clean.where("not kept").count() <= 0.01 * clean.count()


RULES = queries.URL_RULES


def brute_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(url_filter._LOWER), m[2]) if m else ("", "")
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best.name if best else None, best.verdict if best else "allow"


def test_url_rules(spark):
    rng = random.Random(2)
    parts = ["http", "://", "Example", "example", ".org", "org", ".com", "/", "/es", "/es/", "/en/1", "/en/", "/fr/", "/de/", "?q=/",
             "#a", ":80", "user@", "x", "é"]
    urls = [None, "", "org/", "://", "http://org", "http://org/", "https://EXAMPLE.org/en/17?x://y", "http://a.example.org/es",
            *("".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(500)),
            *("http://" + "".join(rng.choice(parts[2:]) for _ in range(rng.randint(1, 6))) for _ in range(1500))]
    pages = spark.createDataFrame([*enumerate(urls), (0, "http://org/"), (None, None)], "page_id long, url string").withColumn("rule", F.lit(1))
    got = url_filter.judge_urls(pages, RULES)
    assert rows_of(got, "page_id", "host", "path", "rule", "verdict") == sorted(
        ((r.page_id, *brute_rule(r.url)) for r in pages.collect()), key=str)
    assert url_filter.judge_urls(pages.limit(0), RULES).count() == 0


def test_of_equally_long_rules_the_block_wins():
    trie = url_filter.build_trie([url_filter.Rule("a.b", "/x", "allow"), url_filter.Rule("b", "/x/yz", "block"), url_filter.Rule("b", "", "block")])
    assert url_filter.longest_rule(trie, "a.b", "/x/y").verdict == "allow"
    assert url_filter.longest_rule(trie, "a.b", "/x/yz").name == "b/x/yz"
    assert url_filter.longest_rule(trie, "c.b", "").name == "b"
    with pytest.raises(ValueError):
        url_filter.build_trie([url_filter.Rule("a", "x", "allow")])


def test_language_of_held_out_documents(spark, sf):
    got = queries.op8_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.98 * held.count() > 0
    assert got.where("score < 0 or score > 1").count() == 0
    ids = [r.doc_id for r in held.collect()]
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in ids)


def test_language_of_odd_texts(odd, spark):
    model = language.fit(spark.createDataFrame(
        [(1, "der die das und nicht", "de"), (2, "the and of not", "en"), (3, None, "fr"), (4, "x", None)],
        "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en"]
    got = rows_of(language.predict(odd, model), "doc_id", "lang_pred")
    assert got == expected(odd, lambda t: ("und",) if not any(c.isalpha() for c in t or "") else next(
        (p,) for p in [_brute_language(t, model)]))
    nothing = language.fit(odd.limit(0).withColumn("lang", F.lit("x")))
    assert {r.lang_pred for r in language.predict(odd, nothing).collect()} == {"und"}


def _brute_language(text, model):
    codes, total = language.code_points(text), np.zeros(len(model.languages))
    for k in range(len(codes)):
        for n in model.spec.orders:
            if k + 1 >= n:
                bucket = language.grams(codes[k + 1 - n:k + 1], language.LanguageSpec(orders=(n,), buckets=model.spec.buckets))[0, -1]
                total += model.log_probability[bucket]
    return model.languages[int(total.argmax())]


def test_language_in_pieces(monkeypatch):
    codes = language.code_points("some text of a few words, more than one piece")
    whole = np.concatenate(list(language._pieces(codes, language.LanguageSpec())))
    monkeypatch.setattr(language, "CHARS_AT_ONCE", 7)
    assert sorted(np.concatenate(list(language._pieces(codes, language.LanguageSpec())))) == sorted(whole)


def brute_hits(items, words, window):
    hit, names = set(), set()
    for name, of_item in items:
        size = min(window, len(of_item))
        for k in range(len(of_item) - size + 1) if size else ():
            for i in range(len(words) - size + 1):
                if words[i:i + size] == of_item[k:k + size]:
                    hit |= set(range(i, i + size))
                    names.add(name)
    return hit, names


def test_suffix_automaton_finds_every_window():
    rng = random.Random(3)
    for _ in range(800):
        letters = [b"a", b"b", b"c"][:rng.randint(2, 3)]
        items = [(str(i), [rng.choice(letters) for _ in range(rng.randint(0, 9))]) for i in range(rng.randint(1, 5))]
        window = rng.randint(1, 5)
        automaton = decontaminate.SuffixAutomaton(items, window)
        for _ in range(3):
            words = [rng.choice([*letters, b"z"]) for _ in range(rng.randint(0, 25))]
            spans, names = automaton.hits(words)
            assert ({x for a, b in spans for x in range(a, b)}, names) == brute_hits(items, words, window)


SENTENCES = {  # of twelve words or more without any other mark
    "Hindi": "यह एक साफ वाक्य है जिसमें बारह से अधिक शब्द हैं और कुछ नहीं {}।",
    "Urdu": "یہ ایک صاف جملہ ہے جس میں بارہ سے زیادہ الفاظ ہیں اور کچھ نہیں {}۔",
    "Arabic": "هل هذه جملة نظيفة فيها أكثر من اثنتي عشرة كلمة ولا شيء غير ذلك {}؟",
    "Armenian": "Սա մաքուր նախադասություն է որի մեջ տասներկու բառից ավելի կա և ուրիշ ոչինչ {}։",
    "Amharic": "ይህ ንጹህ ዓረፍተ ነገር ነው ከአሥራ ሁለት ቃላት በላይ አለው እና ሌላ ምንም {}።",
    "Burmese": "ဤ သည် သန့်ရှင်း သော ဝါကျ ဖြစ် ပြီး စကားလုံး ဆယ့်နှစ် လုံး ထက် ပို {}။",
    "Khmer": "នេះ ជា ប្រយោគ ស្អាត មួយ ដែល មាន ពាក្យ លើស ពី ដប់ ពីរ {}។",
    "Greek": "είναι αυτή μια καθαρή πρόταση με περισσότερες από δώδεκα λέξεις και τίποτα άλλο {}\u037e",
    "Tibetan": "བོད ཡིག གི ཚིག གྲུབ འདི ལ ཚིག བཅུ གཉིས ལྷག ཙམ {}།",
}


@pytest.mark.parametrize("script", SENTENCES)
def test_prose_of_all_scripts_is_kept(script):
    text = SENTENCES[script].format("one")
    assert len(text.split()) >= 12
    found = dict(zip(quality._NAMES[1:], quality.judge(text.encode(), quality.LineRules())))
    assert not found["base_failed"] and found["kept"] and found["n_words_removed"] == 0 and found["clean_text"] == text


def test_decontamination_by_blocks_of_items(spark, monkeypatch):
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(6)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 8)))) for k in range(25)] + [(3, "w1 w2"), (None, "w3"), (99, None)]
    docs = [(k, " ".join(rng.choice([*vocabulary, "W1,", "é", "--"]) for _ in range(rng.randint(0, 60)))) for k in range(60)]
    docs += [(None, "w1 w2"), (7, None), (7, ""), *[(100 + k, "w0 w1 w2 w3 w4 w5 " * 3) for k in range(50)]]
    item_rows = spark.createDataFrame(items, "item_id long, text string")
    doc_rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("spans", F.lit("clash"))
    normal = [(str(i), decontaminate.normal_words(t.encode())) for i, t in items if i is not None and t is not None]
    want = []
    for doc_id, text in docs:
        words = decontaminate.normal_words((text or "").encode())
        hit, names = brute_hits(normal, words, 4)
        want.append((doc_id, len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(),
                     bool(hit) and 20 * len(hit) >= len(words)))
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    for block in (1 << 20, 4):  # all items in one automaton, and some twenty
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
        got = decontaminate.decontaminate(doc_rows, item_rows, window=4)
        assert rows_of(got, *columns) == sorted(want, key=str)
    assert decontaminate.decontaminate(doc_rows, item_rows.limit(0)).where("n_hit > 0").count() == 0


def test_clean_documents_lose_full_windows_only(spark, monkeypatch):
    items = spark.createDataFrame([(1, "by the way"), (2, " ".join(f"w{k}" for k in range(14)))], "item_id long, text string")
    filler = " ".join(f"x{k}" for k in range(400))
    long = " ".join(f"w{k}" for k in range(13))
    docs = spark.createDataFrame(
        [(1, f"By the way, {filler}"), (2, f"By the way, {filler} {long} end"), (3, "by the way it goes")], "doc_id long, text string")
    for block in (1 << 20, 3):
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
        got = {r.doc_id: r for r in decontaminate.decontaminate(docs, items).collect()}
        assert {i: (r.n_hit, r.contaminated) for i, r in got.items()} == {1: (3, False), 2: (16, False), 3: (3, True)}
        assert got[1].clean_text == f"By the way, {filler}" and got[2].clean_text == f"By the way, {filler}  end"
        assert got[3].clean_text == " it goes"


def test_spans_are_cut_out():
    text = "Keep THIS, but not-these four words; and that.".encode()
    assert decontaminate.without(text, [(3, 7)]) == b"Keep THIS, but ; and that."


def page(main, **around):
    return ("<!DOCTYPE html><html><head><title>T and more words</title><style>p{}</style><script>var a='<p>no</p>';</script></head><body>"
            "<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul></nav>"
            f"{around.get('before', '')}<article>{main}</article>{around.get('after', '')}<footer>&copy; 2020 someone or other</footer></body></html>")


CASES = [
    (page("<h1>Title</h1><p>First &amp; second\n line.<p><b>Bold</b>ly<br>said.</p>"), "Title\n\nFirst & second line.\n\nBoldly said."),
    (page("<p>A text of some words.</p>", before="<div class='ad'>Buy now, a lot of words of an advert</div>"), "A text of some words."),
    (page("<p>A text of some words.</p><aside>See also this</aside><p>More text.</p>"), "A text of some words.\n\nMore text."),
    (page("<p>A text of some words.</p>", after="<div id='comments'><p>Great words from a reader, so many of them here.</p></div>"),
     "A text of some words."),
    (page("<p>Text with <form><input name=q><button>Go</button></form>enough words.</p>"), "Text with\n\nenough words."),
    (page("<p>One <!-- a > b --> two <a href='x>y'>three</a>.</p>"), "One two three."),
    (page("<div class='cookie-notice'>We use cookies</div><p>a &lt; b and 3 < 4 &#233;&nbsp;x</p>"), "a < b and 3 < 4 é x"),
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("just words", "just words"), ("<p>unclosed", "unclosed"),
]


def test_main_text_of_labelled_layouts(spark):
    rows = [(i, "u", p) for i, (p, _) in enumerate(CASES)]
    pages = spark.createDataFrame([*rows, (0, None, CASES[0][0])], "page_id long, url string, html string").withColumn("text", F.lit(1))
    weights = html_text.learn_weights(pages)
    assert all(v > 0 for k, v in weights.words.items() if k == "w:text") and all(v < 0 for v in weights.tags.values())
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in html_text.extract_text(pages, weights).collect()}
    for i, (_, text) in enumerate(CASES):
        assert got[i, "u"] == (text, len(text)), i
    assert got[0, None][0] == CASES[0][1]
    assert html_text.extract_text(pages.limit(0), html_text.learn_weights(pages.limit(0))).count() == 0


WRAPPED = [
    *[(f"<html><body><nav><a href='/'>Home</a></nav>{start}{inner}{end}<footer>Someone or other</footer></body></html>", want)
      for start, end in (("<div class='layout has-sidebar'>", "</div>"), ("<div id='page-with-comments'>", "</div>"),
                         ("<div class='no-footer'><div class=x>", "</div></div>"), ("<form id='aspnetForm'>", "</form>"))
      for inner, want in (
          ("<article><p>A text of some words.</p></article><div class='sidebar'>So many other words stand here</div>", "A text of some words."),
          ("<main><p>A text of some words.</p></main><div class='comments'><article class='comment'>Great</article></div>", "A text of some words."),
          ("<p>A text of some words without an article.</p><div class='sidebar'>Other words</div>", "A text of some words without an article."))],
    ("<article><p>A text of some words.</p><div class='comments'><article><p>A reader has many words to say here</p></article></div></article>",
     "A text of some words."),
]


def test_main_text_in_wrappers(spark):
    for p, want in WRAPPED:
        assert html_text.main_text(p, html_text.Weights()) == want, p
    pages = spark.createDataFrame([(i, "u", p) for i, (p, _) in enumerate(WRAPPED)], "page_id long, url string, html string")
    weights = html_text.learn_weights(pages)
    assert weights.words["w:text"] > weights.words["w:outside"]
    got = {r.page_id: r.text for r in html_text.extract_text(pages, weights).collect()}
    assert got == {i: want for i, (_, want) in enumerate(WRAPPED)}


@pytest.mark.parametrize("around", [("<article>", "</article>"), ("<main>", "</main>"), ("<div>", "</div>")])
def test_links_at_the_edges_stay(around):
    text = "<p><a href='/b'>Some place</a> has a text of some words, and more of them.<p>The last words. Source: <a href='/s'>a name</a></p>"
    want = "Some place has a text of some words, and more of them.\n\nThe last words. Source: a name"
    nav, foot = "<nav><a href='/'>Home</a></nav>", "<footer><a href='/f'>Someone</a></footer>"
    title = "" if around[0] == "<div>" else "<h1><a href='/t'>Title</a></h1>"
    end = "" if around[0] == "<div>" else "<p><a href='/e'>At the end</a></p>"
    for weights in (html_text.Weights(), html_text.Weights({"w:text": 0.6, "w:link": -4.0, "w:outside": -5.0}, {}, -0.5)):
        got = html_text.main_text(f"<body>{nav}{around[0]}{title}{text}{end}{around[1]}{foot}</body>", weights)
        assert got == (f"Title\n\n{want}\n\nAt the end" if title else want), weights


def test_main_text_of_the_table(spark, sf):
    for r in queries.op10_main_text(spark, sf).join(spark.read.parquet(f"{sf}/pages.parquet").drop("url"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))]
        assert r.text == "\n\n".join(b for b in blocks if b)


@pytest.mark.parametrize("scores", [[1, -2, 3, 4, -1, 2, -9, 5], [-1, -2], [], [0, 0, 1, 0], [2, -2, 2]])
def test_best_region(scores):
    a, b = html_text.best_region(scores)
    best = max([0, *(sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))])
    assert sum(scores[a:b]) == best


def test_broken_pages_are_read_in_time():
    """A megabyte of tags that are never closed, never ended or never opened."""
    n = 80_000
    for page in ("<a " * 330_000, "<b>" * n + "</i>" * n, '<a "x' * n, "<b>" * n + "<hr>" * n, "<script " * n + ">", "<!--" * n, "<p>" * n + "</div>" * n):
        start = time.perf_counter()
        html_text.main_text(page, html_text.Weights())
        assert time.perf_counter() - start < 8


def test_unclosed_ends_of_pages():
    for page, text in (("one two <b>three</b> four <a", "one two three four <a"), ("one <i>two</i> three <!-- four", "one two three"),
                       ("one <i>two</i><script>x = 1; y > 2", "one two"), ("one <i>two</i><!-- a > b", "one two"),
                       ("one <i>two</i> three <? four", "one two three"), ("one <b>two</b><script></script> three", "one two three")):
        assert html_text.main_text(page, html_text.Weights()) == text


def test_pages_without_article_or_main(spark, sf):
    """The scan alone finds the text where no element names it; weights are learned from the pages of the table."""
    weights = html_text.learn_weights(queries.table(spark, sf, "pages"))
    rng = random.Random(11)
    menu = "<ul class=nav>" + "".join(f"<li><a href=/{k}>item {k}</a></li>" for k in range(9)) + "</ul>"
    for k in range(24):
        paragraphs = [" ".join(rng.choice(["water", "stone", "river", "<b>old</b>", "a <a href=x>bridge</a> of"]) for _ in range(rng.randint(25, 60)))
                      for _ in range(rng.randint(2, 6))]
        wrap = rng.choice([("<div>", "</div>"), ("<section>", "</section>"), ("<table><tr><td>", "</td></tr></table>"), ("<div><div id=c>", "</div></div>")])
        page = (f"<html><head><title>t {k}</title></head><body><div class=header><h2>Site</h2>{menu}</div>{wrap[0]}"
                + "".join(f"<p>{p}</p>\n" for p in paragraphs) + f"{wrap[1]}<div class=sidebar>{menu}</div><div id=footer>all rights {menu}</div></body></html>")
        want = "\n\n".join(" ".join(re.sub("<[^>]*>", "", p).split()) for p in paragraphs)
        assert html_text.main_text(page, weights) == want
