"""Token ids in flat files of unsigned integers with 64-bit offsets of the documents, memory-mapped to read.

A data set is a folder of parts, ranges of doc_id in ascending order. Part k has
``ids-k-*.bin``, the ids of its documents one after another as little-endian
unsigned integers, and ``offsets-k-*.bin``, for each document and for the end
the number of ids before it in the part, as little-endian 64-bit integers.
The part's base, the number of ids in all parts before it, is a prefix sum
over the parts' counts. The manifest, a Parquet table, names the files of
each part that count: a task that ran twice leaves files that nobody reads.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestay.llm.common import Memo, shared_folder, slices, texts

#: Ids in a part, about; the number of parts follows the number of documents and tokens.
PART_BYTES = 64 << 20

MANIFEST = "part int, n_docs long, n_tokens long, width int, ids_file string, offsets_file string, docs_file string"


class WordEncoder:
    """Ids of words by the tokenizers library.

    Most words are lower-case letters of the Latin blocks with perhaps a mark
    at the end. The vocabulary's normaliser leaves those as they are and its
    splitter makes one piece of the letters and one of the mark, so they go to
    the library's merges at once. All others go through all of its steps.
    """

    MARKS = ".,;:!?"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.of_mark = {m: self.encode(m) for m in self.MARKS}
        # the visible characters that stand for bytes, by the library's own splitter
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        latin = [chr(c) for c in range(0x80, 0x250) if chr(c).isalpha()]
        self.visible = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in latin})

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def of_word(self, word: str) -> list[int]:
        mark = self.of_mark.get(word[-1])
        letters = word[:-1] if mark else word
        if not (letters.isalpha() and max(letters) < "\u0250" and letters == letters.lower()):
            return self.encode(word)
        if not letters.isascii():
            letters = letters.translate(self.visible)
        ids = [t.id for t in self.merge(letters)]
        return ids + mark if mark else ids

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.of_word(w.decode()) for w in words]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum())), counts


@lru_cache(maxsize=2)
def load(path: str) -> Memo:
    """Once for each worker process."""
    return Memo(WordEncoder(path))


def plain(texts_: pa.Array) -> pa.Array:
    """The texts as the memory has their words: the vocabulary is lower-case, its special tokens are not."""
    values = texts_.cast(pa.string())
    return pc.if_else(pc.match_substring(values, "<|"), values, pc.ascii_lower(values))


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def encode_batch(batch: pa.RecordBatch, path: str, width: int, end_id: int) -> pa.RecordBatch:
    """doc_id and the ids as bytes of ``width`` each, ``end_id`` last.

    The vocabulary ends words at white space and no special token holds any,
    so that the ids of a text are those of its words, one after another.
    """
    ids, counts = load(path).of_words(plain(batch.column("text")))
    ends = np.cumsum(counts)
    flat = np.insert(ids.astype(f"<u{width}"), ends, end_id).tobytes()
    offsets = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]) * width
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array([flat[a:b] for a, b in zip(offsets, offsets[1:])], pa.binary())], ["doc_id", "ids"])


def _open(folder: str, name: str):
    fs, path = pafs.FileSystem.from_uri(f"{folder}/{name}")
    return fs, path


def write_files(docs: DataFrame, folder: str, path: str, width: int, end_id: int, n_parts: int) -> DataFrame:
    """Write the parts and return the manifest's rows.

    Spark deals the documents to ``n_parts`` ranges of doc_id, rows without
    one first, and sorts each range, spilling where it must. One Python worker
    a task then encodes and writes the documents as they stream by, a slice of
    text at a time. A part is a range, numbered in their order.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: _Part | None = None
        for batch in batches:
            for piece in slices(batch, "text"):
                part = part or _Part(TaskContext.get().partitionId(), folder, width)
                part.add(encode_batch(piece, path, width, end_id))
        if part:
            yield part.close()

    # texts of one doc_id stand in a fixed order, that of their bytes
    ranged = docs.repartitionByRange(n_parts, F.col("doc_id").asc_nulls_first())
    rows = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return rows.mapInArrow(write, MANIFEST)


class _Part:
    """The files of one part while they are written."""

    def __init__(self, part: int, folder: str, width: int):
        self.part, self.width, self.docs, self.tokens = part, width, 0, 0
        tag = f"{part:07d}-{uuid.uuid4().hex}"
        self.names = [f"{kind}-{tag}.bin" for kind in ("ids", "offsets", "docs")]
        fs, path = _open(folder, "")
        fs.create_dir(path, recursive=True)
        self.files = [fs.open_output_stream(_open(folder, name)[1]) for name in self.names]
        self.files[1].write(np.zeros(1, "<i8").tobytes())

    def add(self, batch: pa.RecordBatch) -> None:
        values = batch.column("ids").to_pylist()
        ends = self.tokens + np.cumsum([len(v) // self.width for v in values])
        self.files[0].write(b"".join(values))
        self.files[1].write(ends.astype("<i8").tobytes())
        ids = batch.column("doc_id")
        # a missing id is the smallest number, which no document has
        self.files[2].write(ids.fill_null(np.iinfo(np.int64).min).to_numpy().astype("<i8").tobytes())
        self.docs, self.tokens = self.docs + len(values), int(ends[-1])

    def close(self) -> pa.RecordBatch:
        for f in self.files:
            f.close()
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
        row = [self.part, self.docs, self.tokens, self.width, *self.names]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(row, kinds)], [c.split()[0] for c in MANIFEST.split(", ")])


def write_tokens(
    docs: DataFrame, folder: str, path: str, end_id: int, n_parts: int, doc_id: str = "doc_id", text: str = "text",
) -> None:
    """Encode every document and write the data set to ``folder``, its manifest last.

    16-bit integers serve a vocabulary of up to 65,536 tokens, 32-bit ones a larger.
    """
    width = 2 if max(vocabulary_size(path), end_id + 1) <= 1 << 16 else 4
    write_files(texts(docs, doc_id, text), folder, path, width, end_id, n_parts).write.parquet(f"{folder}/manifest")


def mapped(folder: str, name: str, dtype: str) -> np.ndarray:
    """The numbers of a file: memory-mapped in a local or mounted folder, else read."""
    fs, path = _open(folder, name)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 and, if asked for, the ids.

    ``start`` counts the ids of all documents before it: the part's base, a
    prefix sum over the manifest's rows, and the document's offset.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    # one row for each part, some thousands at most: the running sum over them is no funnel for rows
    base = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = manifest.select("*", F.coalesce(base, F.lit(0)).alias("base"))
    n = max(1, spark.sparkContext.defaultParallelism)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                ids = mapped(folder, part["ids_file"], f"<u{part['width']}")
                offsets = mapped(folder, part["offsets_file"], "<i8")
                docs = mapped(folder, part["docs_file"], "<i8")
                for a in range(0, len(docs), 1024):
                    at = np.asarray(offsets[a:a + 1025])
                    each = [np.asarray(ids[i:j]) for i, j in zip(at, at[1:])]
                    doc = np.asarray(docs[a:a + 1024])
                    columns = [
                        pa.array(doc, pa.int64(), mask=doc == np.iinfo(np.int64).min),
                        pa.array(at[:-1] + part["base"], pa.int64()), pa.array(np.diff(at), pa.int64()),
                        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in each], pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.array([x.astype(np.int32) for x in each], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    return parts.repartition(n * 4, "part").mapInArrow(read, schema)


def round_trip(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the documents' ids to files in the shared folder and read these back, one row per document.

    A null text has the end id alone; an empty table writes no part. Documents
    with one doc_id stand together, ordered by their texts. A very long text
    is encoded alone; its ids are one binary value, so that it may have up to
    2 GB of them. Other columns are not read.
    """
    spark = docs.sparkSession
    size = docs.select(F.sum(F.coalesce(F.octet_length(F.col(text)), F.lit(0))).alias("n")).first().n or 0
    n_parts = max(spark.sparkContext.defaultParallelism, int(size * 0.5) // PART_BYTES + 1) if size else 1
    folder = shared_folder(spark, "tokens")
    write_tokens(docs, folder, path, end_id, n_parts, doc_id, text)
    return read_tokens(spark, folder)
