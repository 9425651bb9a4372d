"""Line-first cleaning: lines are judged and removed first, then documents that lost too much go."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame

from lodestay.llm.common import map_slices, texts

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_punctuation_lines long, n_navigation_lines long, "
    "n_boilerplate_lines long, n_words_removed long, clean_text string"
)
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]

SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
_CONTINUED = bytes(range(0x80, 0xC0))
_NON_CHARS = WHITE + _CONTINUED

#: Unicode's sentence ends (Sentence_Terminal) of all scripts besides those that ``LineRules.ends`` names itself, the
#: Greek question mark, the Arabic semicolon and the Tibetan shads.
SENTENCE_ENDS = (
    "\u037e\u0589\u061b\u061d\u061e\u061f\u06d4\u0700\u0701\u0702\u07f9\u0837\u0839\u083d\u083e\u0964"
    "\u0965\u0f0d\u0f0e\u104a\u104b\u1362\u1367\u1368\u166e\u1735\u1736\u17d4\u17d5\u1803\u1809\u1944"
    "\u1945\u1aa8\u1aa9\u1aaa\u1aab\u1b4e\u1b4f\u1b5a\u1b5b\u1b5e\u1b5f\u1b7d\u1b7e\u1b7f\u1c3b\u1c3c"
    "\u1c7e\u1c7f\u2024\u203c\u203d\u2047\u2048\u2049\u2cf9\u2cfa\u2cfb\u2e2e\u2e3c\u2e53\u2e54\u2e60"
    "\u2e61\ua4ff\ua60e\ua60f\ua6f3\ua6f7\ua876\ua877\ua8ce\ua8cf\ua92f\ua9c8\ua9c9\uaa5d\uaa5e\uaa5f"
    "\uaaf0\uaaf1\uabeb\ufe12\ufe15\ufe16\ufe52\ufe56\ufe57\uff0e\uff61\U00010a56\U00010a57\U00010f55"
    "\U00010f56\U00010f57\U00010f58\U00010f59\U00010f86\U00010f87\U00010f88\U00010f89\U00011047\U00011048"
    "\U000110be\U000110bf\U000110c0\U000110c1\U00011141\U00011142\U00011143\U000111c5\U000111c6\U000111cd"
    "\U000111de\U000111df\U00011238\U00011239\U0001123b\U0001123c\U000112a9\U000113d4\U000113d5\U0001144b"
    "\U0001144c\U000115c2\U000115c3\U000115c9\U000115ca\U000115cb\U000115cc\U000115cd\U000115ce\U000115cf"
    "\U000115d0\U000115d1\U000115d2\U000115d3\U000115d4\U000115d5\U000115d6\U000115d7\U00011641\U00011642"
    "\U0001173c\U0001173d\U0001173e\U00011944\U00011946\U00011a42\U00011a43\U00011a9b\U00011a9c\U00011c41"
    "\U00011c42\U00011ef7\U00011ef8\U00011f43\U00011f44\U00016a6e\U00016a6f\U00016af5\U00016b37\U00016b38"
    "\U00016b44\U00016d6e\U00016d6f\U00016e98\U0001bc9f\U0001da88"
)


@dataclass(frozen=True)
class LineRules:
    """When a line fails, and how much of a document may fail.

    ``punctuation``: a line fails if it has no letter, if it holds
    ``symbols_per_word`` or more characters of ``SYMBOLS`` for each word, or if
    it has ``long_line`` words and none ends with a mark of ``ends``.
    ``navigation``: ``min_separators`` or more words are single separators and
    these are ``separator_share`` of all its words.
    ``boilerplate``: a line of up to ``boilerplate_words`` words holds one of
    the phrases, or a line with a word equals an earlier one of the document.
    A document is rejected if more than ``max_removed`` of its words go.
    """

    symbols_per_word: float = 1.0
    long_line: int = 12
    ends: tuple[bytes, ...] = tuple(x.encode() for x in ".!?:;…\"'»”’)]。！？" + SENTENCE_ENDS)
    separators: frozenset[bytes] = frozenset(x.encode() for x in ("|", "•", "·", "»", "›", ">", "/", "-", "–"))
    min_separators: int = 3
    separator_share: float = 0.25
    boilerplate_words: int = 25
    phrases: tuple[bytes, ...] = (
        b"all rights reserved", b"cookie", b"privacy policy", b"terms of use", b"terms of service",
        b"enable javascript", b"subscribe to our newsletter", b"sign up for our newsletter", b"skip to content",
        b"click here to", b"powered by",
    )
    max_removed: float = 0.5

    @cached_property
    def last_bytes(self) -> frozenset[int]:
        """Of the marks in ``ends``: few words need to be compared with all of them."""
        return frozenset(x[-1] for x in self.ends)


def repeated_words(words: list[bytes], n: int = 5) -> int:
    """Words inside windows of ``n`` words that occur twice or more, the first occurrence included."""
    if len(words) <= n:
        return 0
    windows = list(zip(*(words[i:] for i in range(n))))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    covered, upto = 0, 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            covered += i + n - max(i, upto)
            upto = i + n
    return covered


def failing_rule(line: bytes, words: list[bytes], rules: LineRules) -> str | None:
    """The first rule that a line with words fails."""
    n = len(words)
    symbols = len(line) - len(line.translate(None, SYMBOLS))
    separators = sum(w in rules.separators for w in words)
    if separators >= rules.min_separators and separators >= rules.separator_share * n:
        return "navigation"
    if symbols >= rules.symbols_per_word * n:
        return "punctuation"
    if n >= rules.long_line and not any(
            w[-1] in rules.last_bytes and w.endswith(rules.ends) for w in words):
        return "punctuation"
    if not any(c >= 0x80 or 0x61 <= c | 0x20 <= 0x7A for c in words[0]) and not line.translate(
            None, bytes(c for c in range(0x80) if not 0x61 <= c | 0x20 <= 0x7A)):
        return "punctuation"
    if n <= rules.boilerplate_words:
        low = line.lower()
        if any(p in low for p in rules.phrases):
            return "boilerplate"
    return None


def judge(text: bytes | None, rules: LineRules) -> tuple:
    """Figures, verdict and remaining text of one document, in the order of ``SCHEMA`` without the id."""
    text = text or b""
    words = text.split()
    n_words = len(words)
    word_chars = len(text.translate(None, _NON_CHARS))
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    n_repeat = repeated_words(words)
    base_failed = n_words < 10 or 100 * n_repeat > 20 * n_words
    lines, seen, left = text.split(b"\n"), set(), []
    dup, removed = 0, 0
    failed: Counter[str] = Counter()
    for line in lines:
        of_line = line.split()
        if not of_line:
            left.append(line)
            continue
        repeated = line in seen
        dup += repeated
        seen.add(line)
        rule = failing_rule(line, of_line, rules) or ("boilerplate" if repeated else None)
        if rule:
            failed[rule] += 1
            removed += len(of_line)
        else:
            left.append(line)
    kept = not base_failed and removed <= rules.max_removed * n_words
    clean = b"\n".join(left) if failed else text
    return (n_words, word_chars, n_symbols, dup, n_repeat, base_failed, kept, len(seen) + dup,
            failed["punctuation"], failed["navigation"], failed["boilerplate"], removed, clean.decode())


def quality_rules(
    docs: DataFrame, rules: LineRules = LineRules(), doc_id: str = "doc_id", text: str = "text",
    carry: bool = False,
) -> DataFrame:
    """One row per document with its figures, the lines failed by rule, the verdict and the remaining text.

    A null or empty text has no words: it fails the base rule and is not kept.
    Repeated rows are judged each. Lines without a word are neither judged nor
    removed. Other columns of ``docs``, whatever
    their names, are not read, or with ``carry`` handed on in the struct ``row``.
    """
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [judge(t, rules) for t in batch.column("text").to_pylist()]
        columns = list(zip(*rows)) if rows else [[] for _ in _NAMES[1:]]
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 5 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], _NAMES)

    return map_slices(texts(docs, doc_id, text, carry), "text", SCHEMA, work)
