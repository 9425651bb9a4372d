"""Helpers shared by the operators: Arrow slices, words, and the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text handled at a time inside a task; a longer text is handled alone.
SLICE_BYTES = 4 << 20

LOWER_ASCII = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words_of(text: bytes | None) -> list[bytes]:
    """The runs of ``[^\\x20\\x09-\\x0D]`` of a UTF-8 text; None has none.

    ``bytes.split`` cuts at exactly these six characters, and no byte of a
    multi-byte character is one of them.
    """
    return text.split() if text else []


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in pieces of about ``limit`` bytes of ``column``, one row at least."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes, dtype=np.int64) // limit
    cuts = np.flatnonzero(np.diff(piece)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(a, b - a)


def map_slices(
    df: DataFrame, column: str, schema: str, work: Callable[[pa.RecordBatch], pa.RecordBatch],
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """``work`` over bounded slices of each partition; rows of ``df`` are not gathered anywhere.

    A column ``row`` of ``df`` is handed on beside what ``work`` returns for each row.
    """
    carried = "row" in df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, column, limit):
                out = work(piece)
                yield out.append_column("row", piece.column("row")) if carried else out

    kind = StructType.fromDDL(schema)
    return df.mapInArrow(run, kind.add(df.schema["row"]) if carried else kind)


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """Only the id and the UTF-8 bytes of the text, under fixed names, whatever else ``docs`` holds.

    With ``carry`` all other columns follow in the struct ``row``, where no name of theirs can clash.
    """
    columns = [F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")]
    if carry:
        columns.append(F.struct(*(F.col(c) for c in docs.columns if c != text)).alias("row"))
    return docs.select(*columns)


def uncarried(found: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` again, their values from ``row``, with the new text and its length."""
    fresh = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return found.select(*(fresh.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder that the driver and all executors see.

    It lies below ``spark.checkpoint.dir`` as the cluster names it. Only a
    local session without that setting, such as a test, gets one of its own;
    on a cluster the executors would not see it, so that is an error.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        set_by_code = spark.sparkContext._jsc.sc().getCheckpointDir()
        if set_by_code.isDefined():
            top = set_by_code.get()
        elif spark.sparkContext.master.split("[")[0] == "local":
            top = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
    return f"{top.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def discarded(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``shared_folder`` that no later step reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps do not compute it anew,
    and a lost executor takes none of it along."""
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``start[0], start[0] + 1, ...`` with ``n[0]`` numbers, then those of the next start, and so on."""
    ends = np.cumsum(n)
    return np.repeat(start - (ends - n), n) + np.arange(int(n.sum()))


#: Bytes that a task's memory of frequent words may take, about.
MEMO_BYTES = 32 << 20
#: Of them for a key beside its own: the object, its place in the table, its number, where its codes begin.
KEY_BYTES = 170


class _Places(dict):
    """The place of each key, new keys being numbered as they are asked for."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, key):
        self[key] = place = len(self)
        self.new.append(key)
        return place


class Memo:
    """Integer codes of the keys seen lately, so that a task computes those of a frequent word once.

    ``learn`` returns the flat codes of a list of keys and how many each has.
    Results do not depend on ``limit``, the bytes of keys and codes after which
    the memory begins anew; a slice of text may exceed it once.
    """

    def __init__(self, learn: Callable[[list], tuple[np.ndarray, np.ndarray]], limit: int = MEMO_BYTES, dtype=np.int32):
        self.learn, self.limit, self.dtype = learn, limit, dtype
        self._reset()

    def _reset(self) -> None:
        self.held = 0
        self.places, self.codes, self.starts = _Places(), np.zeros(0, self.dtype), np.zeros(1, np.int64)

    def __call__(self, groups: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """Flat codes of all keys of all groups in order, and how many codes each group has."""
        places = self._room()
        which: list[int] = []
        edges = [0]
        for keys in groups:
            which.extend(map(places.__getitem__, keys))
            edges.append(len(which))
        return self._codes_of(np.fromiter(which, np.int64, len(which)), np.array(edges))

    def of_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for the words of each text, which Arrow splits at the six ASCII white spaces."""
        places = self._room()
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), "").cast(pa.large_string()))
        words = split.flatten()
        some = pc.not_equal(pc.binary_length(words), 0)  # ends of a text that begins or ends with white space
        filled = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))]).astype(np.int64)
        offsets = split.offsets.to_numpy()
        table = words.filter(some).dictionary_encode()
        known = np.fromiter(map(places.__getitem__, table.dictionary.cast(pa.large_binary()).to_pylist()), np.int64, len(table.dictionary))
        return self._codes_of(known[table.indices.to_numpy()], filled[offsets - offsets[0]])

    def _room(self) -> _Places:
        if self.held > self.limit:
            self._reset()
        return self.places

    def _codes_of(self, at: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.places.new:
            codes, counts = self.learn(self.places.new)
            self.held += sum(map(len, self.places.new)) + KEY_BYTES * len(self.places.new) + codes.nbytes
            self.places.new = []
            self.codes = np.concatenate([self.codes, codes])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)]).astype(np.int64)
        n = self.starts[at + 1] - self.starts[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        return self.codes[ranges(self.starts[at], n)], np.diff(ends[edges])
