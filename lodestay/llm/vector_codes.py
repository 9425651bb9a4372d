"""Short codes of vectors: each part of a vector is replaced by the number of the nearest entry of the part's codebook.

Codebooks are fitted by rounds of assignment and averaging over all vectors, in
whole numbers, so that the result does not depend on how rows are dealt to
tasks. Most assignments of a round are settled without a distance (J. Drake and
G. Hamerly, "Accelerated k-means with adaptive distance bounds", 2012): beside
its entry each part keeps an upper bound of the distance to it, the b next
closest entries with lower bounds in order, and one outer bound for all others.
Bounds are loosened by how far entries moved and rounded outward, so a strict
gap between them is proof; every other case is settled by squared distances in
whole numbers, ties going to the lower entry. b follows, part by part, how many
of the listed entries the round before had to look at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from lodestay.llm.common import discarded, shared_folder

#: Components below this size (and their differences) have squared distances of at most 2^63 in vectors of some 100
#: components; larger ones are computed with Python's unbounded integers.
PLAIN = 1 << 27
#: Sums leave a task as digits of this base, so that adding them up over any number of tasks stays in 64 bits.
LIMB_BITS = 40
#: Vectors handled at a time inside a task.
ROWS = 8192
MOST = float(np.finfo(np.float32).max)
LONG_MAX = (1 << 63) - 1


@dataclass(frozen=True)
class CodeSpec:
    """parts: equal pieces of a vector; entries: of each codebook, 256 at most; rounds: of assigning and averaging;
    scale: components become floor(scale * x), a power of two; outrun: the share of parts that may need more than b entries."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096
    outrun: float = 0.01

    def __post_init__(self):
        if not 1 <= self.entries <= 256:
            raise ValueError("a code has two hex digits a part: 1 to 256 entries")
        if self.scale < 1 or self.scale & (self.scale - 1):
            raise ValueError("scale must be a power of two, so that scaling is exact")


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, or as Python's where they are large."""
    scaled = vectors.astype(np.float64) * scale
    if scaled.size == 0 or np.abs(scaled).max() < PLAIN:
        return np.floor(scaled).astype(np.int64)
    # beyond 2^53 a double is a whole number already
    flat = [int(v) * scale if abs(v) >= 2.0 ** 53 else int(np.floor(v * scale)) for v in vectors.astype(np.float64).ravel().tolist()]
    return np.array(flat, object).reshape(vectors.shape)


def _up(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nextafter(np.minimum(x, MOST).astype(np.float32), np.float32(-np.inf))


def _root(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64))


def bounds_type(b: int) -> np.dtype:
    return np.dtype([("entry", "u1"), ("upper", "<f4"), ("near", "u1", (b,)), ("low", "<f4", (b,)), ("outer", "<f4")])


class Part:
    """One part of a codebook: its entries, how far each moved in the last round, and the number b of listed entries."""

    def __init__(self, entries: np.ndarray, moved: np.ndarray, b: int, last_b: int):
        self.entries, self.b, self.last = entries, b, bounds_type(last_b)
        self.moved = np.zeros(256)
        self.moved[:len(moved)] = moved
        self.far = float(moved.max(initial=0.0))

    def squared(self, x: np.ndarray, which: np.ndarray | None = None) -> np.ndarray:
        """Squared distances to all entries, or to those of each row of ``which``."""
        entries = self.entries if which is None else self.entries[which]
        gap = x[:, None, :] - entries
        return (gap * gap).sum(-1)

    def fresh(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds from the distances to all entries."""
        out = np.zeros(len(x), bounds_type(self.b))
        d = self.squared(x)
        order = np.argsort(d, axis=1, kind="stable")
        ranked = _root(np.take_along_axis(d, order, 1))
        out["entry"], out["upper"] = order[:, 0], _up(ranked[:, 0])
        out["near"], out["low"] = order[:, 1:self.b + 1], _down(ranked[:, 1:self.b + 1])
        out["outer"] = _down(ranked[:, self.b + 1]) if self.b + 1 < len(self.entries) else MOST
        return out, np.full(len(x), self.b + 1)

    def loosened(self, old: np.ndarray) -> np.ndarray:
        """The last round's bounds after the entries moved, for the present b."""
        out = np.zeros(len(old), bounds_type(self.b))
        # lower by a few units of rounding first, as a difference may be small against its terms
        low = _down(old["low"].astype(np.float64) * (1 - 1e-15) - self.moved[old["near"]])
        outer = _down(old["outer"].astype(np.float64) * (1 - 1e-15) - self.far)
        kept = min(self.b, low.shape[1])
        out["entry"] = old["entry"]
        out["upper"] = _up(old["upper"] + self.moved[old["entry"]])
        out["near"], out["low"] = 255, MOST  # a list that has room names nothing there
        out["near"][:, :kept], out["low"][:, :kept] = old["near"][:, :kept], low[:, :kept]
        out["outer"] = np.minimum(outer, low[:, kept:].min(1, initial=MOST))
        return out

    def needed(self, bounds: np.ndarray) -> np.ndarray:
        """How many of the listed entries may be as close as the held one; b + 1 if one that is not listed may be."""
        ordered = np.minimum.accumulate(bounds["low"][:, ::-1], axis=1)[:, ::-1]
        n = (ordered <= bounds["upper"][:, None]).sum(1)
        return np.where(bounds["outer"] <= bounds["upper"], self.b + 1, n)

    def assign(self, x: np.ndarray, old: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The bounds of this round, the held entry among them, and how many listed entries each row needed."""
        if old is None:
            return self.fresh(x)
        out = self.loosened(old)
        need = self.needed(out)
        open_ = np.flatnonzero(need)
        if len(open_):  # the true distance to the held entry often settles it
            part = out[open_]
            part["upper"] = _up(_root(self.squared(x[open_], part["entry"][:, None].astype(np.int64))[:, 0]))
            out[open_], need[open_] = part, self.needed(part)
        for n in range(1, self.b + 1):
            rows = np.flatnonzero(need == n)
            if len(rows):
                part = out[rows]
                among = np.sort(np.concatenate([part["entry"][:, None], part["near"][:, :n]], axis=1), axis=1).astype(np.int64)
                known = among < len(self.entries)  # room in the list is never closer
                d = self.squared(x[rows], np.where(known, among, 0))
                far = np.where(known, 0.0, MOST)
                order = np.lexsort((among, d, far)) if d.dtype != object else _object_order(far, d)
                among, d = np.take_along_axis(among, order, 1), np.take_along_axis(d, order, 1)
                ranked = np.maximum(_root(d), np.take_along_axis(far, order, 1))
                part["entry"], part["upper"] = among[:, 0], _up(ranked[:, 0])
                part["near"][:, :n], part["low"][:, :n] = among[:, 1:], _down(ranked[:, 1:])
                out[rows] = part
        rows = np.flatnonzero(need == self.b + 1)
        if len(rows):
            out[rows] = self.fresh(x[rows])[0]
        return out, need


def _object_order(far: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Row by row the order by (far, d), ties by place: of Python integers, which lexsort does not take."""
    return np.array([sorted(range(len(a)), key=lambda i: (a[i], b[i], i)) for a, b in zip(far.tolist(), d.tolist())]).reshape(d.shape)


@dataclass
class Round:
    """What the tasks of a round are sent: some thousands of numbers."""

    spec: CodeSpec
    parts: list[Part]

    @property
    def width(self) -> int:
        return self.parts[0].entries.shape[1]

    def state_type(self, last: bool) -> np.dtype:
        return np.dtype([(f"p{k}", p.last if last else bounds_type(p.b)) for k, p in enumerate(self.parts)])

    def run(self, x: np.ndarray, old: np.ndarray | None) -> tuple[np.ndarray, list[np.ndarray]]:
        out, need = np.zeros(len(x), self.state_type(last=False)), []
        for k, part in enumerate(self.parts):
            out[f"p{k}"], n = part.assign(self.piece(x, k), None if old is None else old[f"p{k}"])
            need.append(n)
        return out, need

    def piece(self, x: np.ndarray, k: int) -> np.ndarray:
        return x[:, k * self.width:(k + 1) * self.width]

    @property
    def shapes(self) -> list[tuple[int, ...]]:
        """Of sums, counts and numbers of needed entries, which tasks gather."""
        n, entries = len(self.parts), len(self.parts[0].entries)
        return [(n, entries, self.width), (n, entries), (n, entries + 2)]

    def gather(self, totals: list[np.ndarray], x: np.ndarray, state: np.ndarray, need: list[np.ndarray]) -> None:
        for k in range(len(self.parts)):
            entry = state[f"p{k}"]["entry"]
            sums = np.zeros(self.shapes[0][1:], x.dtype)
            np.add.at(sums, entry, self.piece(x, k))
            totals[0][k] += sums
            totals[1][k] += np.bincount(entry, minlength=self.shapes[1][1])
            totals[2][k] += np.bincount(need[k], minlength=self.shapes[2][1])

    def next(self, totals: list[np.ndarray]) -> Round:
        """Entries moved to the floor of their parts' means; b as the share ``outrun`` of the parts needed it."""
        parts = []
        for part, sums, counts, need in zip(self.parts, *totals):
            entries = part.entries.astype(object)
            used = np.flatnonzero(counts)
            entries[used] = sums[used] // counts[used][:, None]
            gap = entries - part.entries
            moved = np.nextafter(_root((gap * gap).sum(1)), np.inf) * (gap != 0).any(1)
            over = np.append(np.cumsum(need[::-1])[::-1][1:], 0)  # over[z]: parts that needed more than z
            wish = int(np.argmax(over <= self.spec.outrun * need.sum()))
            k = len(entries)
            b = min(max(wish, k // 8, 1), max(k // 4, 1), k - 1)
            plain = np.abs(entries).max(initial=0) < PLAIN
            parts.append(Part(entries.astype(np.int64) if plain else entries, moved, b, part.b))
        return Round(self.spec, parts)


def _fixed(values: np.ndarray) -> pa.Array:
    """Rows of a numpy array as binary values."""
    n = len(values)
    width = values.nbytes // n if n else 1
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), n, [None, pa.py_buffer(values.tobytes())]).cast(pa.binary())


def _rows(column: pa.Array, dtype: np.dtype) -> np.ndarray:
    """Binary values of one length as rows of numbers or records."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(dtype)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            yield batch.slice(a, ROWS)


def _vectors(column: pa.Array, kind: str, dims: int) -> np.ndarray:
    if pa.types.is_binary(column.type):
        return _rows(column, np.dtype(kind)).reshape(-1, dims)
    return column.flatten().to_numpy().astype(kind).reshape(-1, dims)


def _limbs(totals: list[np.ndarray]) -> Iterator[tuple[int, int, int]]:
    for slot, v in enumerate(int(v) for a in totals for v in a.ravel()):
        limb, sign, rest = 0, 1 if v >= 0 else -1, abs(v)
        while rest:
            yield slot, limb, sign * (rest & ((1 << LIMB_BITS) - 1))
            limb, rest = limb + 1, rest >> LIMB_BITS


def _totals(found: DataFrame, shapes: list[tuple[int, ...]]) -> list[np.ndarray]:
    """The sums over all tasks: one number for each component, entry and needed length, whatever the rows."""
    flat = [0] * sum(int(np.prod(s)) for s in shapes)
    for r in found.groupBy("slot", "limb").agg(F.sum("value").alias("value")).collect():
        flat[r.slot] += r.value << (r.limb * LIMB_BITS)
    ends = np.cumsum([int(np.prod(s)) for s in shapes])
    return [np.array(flat[e - int(np.prod(s)):e], object).reshape(s) for s, e in zip(shapes, ends)]


def fitted_codes(
    df: DataFrame, spec: CodeSpec = CodeSpec(), vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> tuple[DataFrame, list[np.ndarray] | None]:
    """vec_id, label, code and error of each vector, and the final codebook of each part, (entries, width) integers.

    Rows whose vector is null or holds a null, NaN or infinite component are
    dropped. A part's codebook begins with that part of the vectors of the
    smallest ids, fewer if there are fewer rows; of rows with one id the order
    is that of their vectors, and a row without an id is coded but begins no
    codebook. The length of the first of these vectors that can be cut into
    equal parts counts: a vector of another length, or any if there is no first
    one, is handed on with null code and error. Repeated rows count as often
    as they stand there. An error beyond 64 bits becomes the largest long.
    An empty table gives no rows. Other columns are not read.

    A round reads the state that the last one wrote, vectors with their bounds,
    and writes its own, together with each task's sums; the older state is then
    deleted. Only sums, counts and entries reach the driver.
    """
    spark = df.sparkSession
    number = FloatType() if df.schema[vector].dataType.elementType == FloatType() else None
    kind = "<f4" if number else "<f8"
    values = F.col(vector) if number else F.col(vector).cast("array<double>")
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), values.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vector").isNotNull() & finite)

    fits = rows.where((F.size("vector") > 0) & (F.size("vector") % spec.parts == 0) & F.col("vec_id").isNotNull())
    first = fits.orderBy("vec_id", "vector").limit(spec.entries).collect()
    dims = len(first[0].vector) if first else 0
    if any(len(r.vector) != dims for r in first):
        first = fits.where(F.size("vector") == dims).orderBy("vec_id", "vector").limit(spec.entries).collect()
    label_field = StructField("label", df.schema[label].dataType)
    coded = StructType([StructField("vec_id", LongType()), label_field, StructField("code", StringType()), StructField("error", LongType())])
    if not first:
        return rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), None

    start = whole(np.array([r.vector for r in first], kind), spec.scale)
    width, k = dims // spec.parts, len(first)
    b = min(max(k // 4, 1), k - 1)
    this = Round(spec, [Part(start[:, p * width:(p + 1) * width], np.zeros(k), b, b) for p in range(spec.parts)])
    state_schema = StructType([
        StructField("vec_id", LongType()), label_field, StructField("vector", BinaryType()), StructField("bounds", BinaryType()),
        StructField("slot", IntegerType()), StructField("limb", IntegerType()), StructField("value", LongType())])

    def opened(piece: pa.RecordBatch, now: Round):
        vectors = _vectors(piece.column("vector"), kind, dims)
        held = _rows(piece.column("bounds"), now.state_type(last=True)) if "bounds" in piece.schema.names else None
        x = whole(vectors, spec.scale)
        return vectors, x, *now.run(x, held)

    def round_of(now: Round):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals = [np.zeros(s, object) for s in now.shapes]
            types = [pa.int32(), pa.int32(), pa.int64()]
            for piece in _pieces(batches):
                vectors, x, state, need = opened(piece, now)
                now.gather(totals, x, state, need)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("vec_id"), piece.column("label"), _fixed(vectors), _fixed(state), *(pa.nulls(len(x), t) for t in types)],
                    state_schema.names)
            sums = list(zip(*_limbs(totals)))
            if sums:
                n = len(sums[0])
                empty = [pa.nulls(n, pa.int64()), None, pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())]
                empty[1] = pa.nulls(n, piece.schema.field("label").type)
                yield pa.RecordBatch.from_arrays([*empty, *(pa.array(s, t) for s, t in zip(sums, types))], state_schema.names)
        return work

    def final_of(now: Round):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in _pieces(batches):
                _, x, state, _ = opened(piece, now)
                entry = np.stack([state[f"p{p}"]["entry"] for p in range(spec.parts)], axis=1)
                codes = entry.tobytes().hex()
                error = reduce(np.add, (
                    part.squared(now.piece(x, p), entry[:, p:p + 1].astype(np.int64))[:, 0] for p, part in enumerate(now.parts)))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("vec_id"), piece.column("label"),
                     pa.array([codes[a:a + 2 * spec.parts] for a in range(0, len(codes), 2 * spec.parts)], pa.string()),
                     pa.array([min(int(e), LONG_MAX) for e in error], pa.int64())], coded.names)
        return work

    source, path = rows.where(F.size("vector") == dims), None
    for _ in range(spec.rounds):
        last, path = path, shared_folder(spark, "codes-round")
        source.mapInArrow(round_of(this), state_schema).write.parquet(path)
        if last:
            discarded(spark, last)
        written = spark.read.schema(state_schema).parquet(path)
        this = this.next(_totals(written.where("slot is not null"), this.shapes))
        source = written.where("slot is null").select("vec_id", "label", "vector", "bounds")
    out = shared_folder(spark, "codes")
    source.mapInArrow(final_of(this), coded).write.parquet(out)
    if path:
        discarded(spark, path)
    others = rows.where(F.size("vector") != dims).select("vec_id", "label", F.lit(None).cast("string"), F.lit(None).cast("long"))
    return spark.read.schema(coded).parquet(out).union(others), [part.entries for part in this.parts]


def digest(codebooks: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(v)) for part in codebooks for v in part.ravel()).encode()).hexdigest()


def vector_codes(
    df: DataFrame, spec: CodeSpec = CodeSpec(), vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """vec_id, code, error, label_error (the errors of all rows with the label added up, nulls being one label) and the
    digest of the codebooks; odd rows as ``fitted_codes`` has them. Sums are bounded by the largest long."""
    codes, books = fitted_codes(df, spec, vec_id, vector, label)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
    sums = codes.groupBy(F.col("label").alias("of_label")).agg(total.alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of_label")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books) if books else None).cast("string").alias("codebooks_sha256"))
