"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestay.llm.common import map_slices

#: Characters whose n-grams are scored at a time.
CHARS_AT_ONCE = 1 << 19
#: The matrix sent to executors has this many rows at most.
MAX_LANGUAGES = 256

UNKNOWN = "und"
SCHEMA = "doc_id long, lang_pred string, score double"


@dataclass(frozen=True)
class LanguageSpec:
    """``orders`` of the n-grams, ``buckets`` they are hashed to, the smoothing, and about how many
    documents of each language the model learns from (a bounded sample by hash of the id)."""

    orders: tuple[int, ...] = (1, 2, 3)
    buckets: int = 1 << 16
    smoothing: float = 0.5
    documents_per_language: int = 2000


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_probability: np.ndarray  # bucket x language
    spec: LanguageSpec


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    """Lower-cased letters, every run of other characters as one blank, a blank at both ends."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    codes = np.where(letter, codes, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    return codes[keep]


def grams(codes: np.ndarray, spec: LanguageSpec) -> np.ndarray:
    """Buckets of the n-grams that end at each place, one row for each order; -1 where it would begin outside."""
    out = np.full((len(spec.orders), len(codes)), -1, np.int64)
    codes = codes.astype(np.uint64)
    for row, n in enumerate(spec.orders):
        if len(codes) < n:
            continue
        mixed = np.full(len(codes) - n + 1, n, np.uint64)
        for k in range(n):
            mixed = (mixed ^ codes[k:len(codes) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(32)
        out[row, n - 1:] = (mixed % np.uint64(spec.buckets)).astype(np.int64)
    return out


def _pieces(codes: np.ndarray, spec: LanguageSpec):
    """The buckets of a text, a bounded number of characters at a time."""
    back = max(spec.orders) - 1
    for a in range(0, len(codes), CHARS_AT_ONCE):
        found = grams(codes[max(0, a - back):a + CHARS_AT_ONCE], spec)[:, a - max(0, a - back):]
        yield found[found >= 0]


def fit(docs: DataFrame, spec: LanguageSpec = LanguageSpec(), doc_id: str = "doc_id", text: str = "text",
        lang: str = "lang") -> LanguageModel:
    """Learn from the rows of ``docs`` that have a text and a language.

    Of each language the documents enter whose id has a small enough hash for
    about ``documents_per_language`` of them.
    """
    rows = docs.select(
        F.xxhash64(F.col(doc_id)).alias("h"), F.col(text).cast("string").alias("text"),
        F.col(lang).cast("string").alias("lang")).where("text is not null and lang is not null")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros((spec.buckets, 0)), spec)
    share = F.coalesce(*(F.when(F.col("lang") == k, F.lit(min(1.0, spec.documents_per_language / counts[k])))
                         for k in languages))
    sample = rows.where(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)).select("text", "lang")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums: dict[str, np.ndarray] = {}
        for t, k in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            into = sums.setdefault(k, np.zeros(spec.buckets, np.int64))
            for found in _pieces(code_points(t), spec):
                into += np.bincount(found, minlength=spec.buckets)
        some = {k: np.flatnonzero(v) for k, v in sums.items()}
        columns = (
            pa.array(np.repeat(np.array(list(some), object), [len(v) for v in some.values()]), pa.string()),
            pa.array(np.concatenate([*some.values(), []]).astype(np.int32)),
            pa.array(np.concatenate([*(sums[k][v] for k, v in some.items()), []]).astype(np.int64)),
        )
        return pa.RecordBatch.from_arrays(list(columns), ["lang", "bucket", "n"])

    found = map_slices(sample, "text", "lang string, bucket int, n long", count)
    table = found.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()  # languages x buckets at most
    sums = np.full((spec.buckets, len(languages)), spec.smoothing)
    np.add.at(sums, (table["bucket"].to_numpy(int), np.searchsorted(languages, table["lang"].to_numpy(str))),
              table["n"].to_numpy(float))
    return LanguageModel(languages, np.log(sums / sums.sum(axis=0)), spec)


def predict(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the language of greatest likelihood over its whole text and its posterior.

    Languages are taken as equally likely beforehand; of equal ones the first
    in order wins. A null text, one without a letter, and any text when no
    language was learned give ``und`` with score 0. Only the text is looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = sent.value
        best, scores = [], []
        for t in batch.column("text").to_pylist():
            codes = code_points(t or "")
            if not m.languages or len(codes) < 2:
                best.append(UNKNOWN)
                scores.append(0.0)
                continue
            total = np.zeros(len(m.languages))
            for found in _pieces(codes, m.spec):
                total += m.log_probability[found].sum(axis=0)
            k = int(total.argmax())
            best.append(m.languages[k])
            scores.append(float(1 / np.exp(total - total[k]).sum()))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(best, pa.string()), pa.array(scores, pa.float64())],
            ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_slices(rows, "text", SCHEMA, work)
