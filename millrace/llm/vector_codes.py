"""Compression of vectors to codes of a byte a part, with codebooks learnt by Lloyd's rounds in
integers, pruned by the triangle inequality as Elkan has it.

The state of each vector is written between rounds: for each part the entry it belongs to, an upper
bound of the distance to it, and a lower bound of the distance to each entry. Bounds are whole numbers,
upper ones rounded up and lower ones down (these in 16 bits; one that is cut to 65,535 still holds), and are
shifted by the way each entry moved. An entry is skipped only if a bound says that it is strictly
farther; for all others squared distances are compared as integers, so ties go to the lower number.
Codebooks and their sums are bounded by the number of entries and components, and pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Tables, kept_row, mapped, written

SCALE = 1024
#: Components from here on, in magnitude, would let squared distances pass 64 bits.
LARGEST = 1 << 28
MOST = (1 << 16) - 1
#: Rows whose distances are laid out at a time.
ROWS = 512
#: Labels up to which their sums are broadcast: 1 MB or so.
BROADCAST_LABELS = 20_000


def down(square: np.ndarray) -> np.ndarray:
    """The square root, rounded down."""
    root = np.sqrt(square.astype(np.float64)).astype(np.int64)
    root -= root * root > square
    root += (root + 1) * (root + 1) <= square
    return root


def up(square: np.ndarray) -> np.ndarray:
    root = down(square)
    return root + (root * root < square)


def squares(vectors: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all vectors to all entries, exact."""
    most = max(int(np.abs(vectors).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * most * most * entries.shape[1] < 1 << 53:  # whole numbers of float64, whatever the order of its sums
        a, b = vectors.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)).astype(np.int64)
    out = np.empty((len(vectors), len(entries)), np.int64)
    for j, entry in enumerate(entries):
        away = vectors - entry
        out[:, j] = (away * away).sum(1)
    return out


def first_bounds(vectors: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """assigned, upper and lower of vectors without bounds."""
    square = squares(vectors, entries)
    assigned = square.argmin(1)
    return assigned, up(square[np.arange(len(square)), assigned]), np.minimum(down(square), MOST)


def again(vectors, entries, moved, apart, assigned, upper, lower) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The same after entries have ``moved``, and how many distances were computed. ``apart``: rounded
    down distances between entries."""
    n = np.arange(len(vectors))
    upper = upper + moved[assigned]
    lower = np.maximum(lower - moved, 0)

    def near(rows):
        found = (lower[rows] <= upper[rows, None]) & (apart[assigned[rows]] <= 2 * upper[rows, None])
        found[np.arange(len(rows)), assigned[rows]] = False
        return found

    rows = np.flatnonzero(near(n).any(1))
    away = vectors[rows] - entries[assigned[rows]]
    own = (away * away).sum(1)
    upper[rows] = up(own)
    lower[rows, assigned[rows]] = np.minimum(down(own), MOST)
    which, entry = np.nonzero(near(rows))
    away = vectors[rows[which]] - entries[entry]
    found = (away * away).sum(1)
    lower[rows[which], entry] = np.minimum(down(found), MOST)
    square = np.full((len(rows), len(entries)), np.iinfo(np.int64).max)
    square[which, entry] = found
    square[np.arange(len(rows)), assigned[rows]] = own
    best = square.argmin(1)
    assigned[rows] = best
    upper[rows] = up(square[np.arange(len(rows)), best])
    return assigned, upper, lower, len(rows) + len(which)


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _packed(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    values = np.ascontiguousarray(values)
    size = values.itemsize * values.shape[1]
    offsets = np.arange(len(values) + 1, dtype=np.int64) * size
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(values)]).cast(pa.binary())


def _unpacked(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


class Codebooks:
    """Entries of all parts (part, entry, component), and how far each entry moved, rounded up."""

    def __init__(self, entries: np.ndarray, before: np.ndarray | None = None):
        self.entries = entries
        if before is not None:
            away = entries - before
            self.moved = up((away * away).sum(2))
            self.apart = [down(squares(x, x)) for x in entries]

    @property
    def sha256(self) -> str:
        """Of all components as decimal numbers, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assigned(self, batches: Iterator[pa.RecordBatch], fresh: bool) -> Iterator[tuple]:
        """Slices of batches with numbers, their parts' assigned, upper and lower."""
        parts, k, wide = self.entries.shape
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                numbers = _numbers(rows.column("numbers"), parts * wide)
                held = None if fresh else (
                    _unpacked(rows.column("assigned"), np.uint8, parts), _unpacked(rows.column("upper"), np.int64, parts),
                    _unpacked(rows.column("lower"), np.uint16, parts * k),
                )
                out = []
                for p in range(parts):
                    own = numbers[:, p * wide : (p + 1) * wide]
                    if fresh:
                        out.append(first_bounds(own, self.entries[p]))
                    else:
                        bounds = held[0][:, p].astype(np.int64), held[1][:, p].copy(), held[2][:, p * k : (p + 1) * k].astype(np.int64)
                        out.append(again(own, self.entries[p], self.moved[p], self.apart[p], *bounds)[:3])
                assigned, upper, lower = zip(*out, strict=True)
                yield rows, numbers, np.stack(assigned, 1), np.stack(upper, 1), np.concatenate(lower, 1)


def _state(rows: DataFrame, books: Codebooks, fresh: bool) -> DataFrame:
    """row, numbers and the bounds against ``books``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, assigned, upper, lower in books.assigned(batches, fresh):
            bounds = [_packed(assigned.astype(np.uint8)), _packed(upper), _packed(lower.astype(np.uint16))]
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("numbers"), *bounds], ["row", "numbers", "assigned", "upper", "lower"])

    schema = rows.select("row", "numbers").schema
    for name in ("assigned", "upper", "lower"):
        schema = schema.add(name, "binary")
    return mapped(rows, run, schema)


def _updated(state: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry as the mean of its parts, rounded down; an unused one stays. Tasks add up first."""
    parts, k, wide = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, k, wide), np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            if batch.num_rows:
                numbers = _numbers(batch.column(0), parts * wide)
                assigned = _unpacked(batch.column(1), np.uint8, parts)
                for p in range(parts):
                    np.add.at(total[p], assigned[:, p], numbers[:, p * wide : (p + 1) * wide])
                    count[p] += np.bincount(assigned[:, p], minlength=k)
        part, entry = np.nonzero(count)
        sums = pa.FixedSizeListArray.from_arrays(pa.array(total[part, entry].ravel()), wide).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]), sums], ["part", "entry", "n", "sums"])

    sums = mapped(state.select("numbers", "assigned"), run, "part int, entry int, n long, sums array<long>")
    whole = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(wide)]).alias("sums"))
    entries = books.entries.copy()
    for row in whole.collect():
        entries[row["part"], row["entry"]] = [x // row["n"] for x in row["sums"]]
    return Codebooks(entries, books.entries)


def compress(vectors: DataFrame, *, vector: str = "embedding", key: str = "vec_id", parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[DataFrame, Codebooks]:
    """``vectors`` without ``vector`` but with numbers (floor(1024 x) of its components), code (two hex
    digits a part) and error (squared distance to what the code stands for), and the codebooks.

    A codebook starts as that part of the vectors with the smallest keys (null last, equal keys by
    components), and has fewer entries than ``entries`` if there are fewer vectors. Rows go if the vector is null or empty,
    holds nulls, NaN or infinities, or has another length than that with the smallest key. Equal rows stay
    rows of their own; an empty table gives no rows and empty codebooks. Columns named as results are replaced;
    others pass through. Components of 2^18 or more in magnitude raise an error, as distances would pass 64 bits, and
    so do lengths that can't be cut into equal parts."""
    if entries > 256:
        raise ValueError("a code has a byte for a part")
    spark = vectors.sparkSession
    usable = F.col("vec").isNotNull() & (F.size("vec") > 0) & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = lambda x: F.floor(x * F.lit(float(SCALE)))
    number = lambda x: F.when(F.abs(x) < LARGEST / SCALE, whole(x)).otherwise(F.raise_error(F.lit("a component is too large for exact distances"))).cast("int")
    read = vectors.select(kept_row(vectors, vector, "numbers", "code", "error"), F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vec")).filter(usable)
    with Tables(spark) as tables:
        base = tables(read.select("row", "id", F.transform("vec", number).alias("numbers")), "vectors")
        order = (F.col("id").asc_nulls_last(), F.col("numbers"))
        least = base.orderBy(*order).select("numbers").first()
        width = len(least["numbers"]) if least else parts
        if width % parts:
            raise ValueError(f"{width} components can't be cut into {parts} equal parts")
        base = base.filter(F.size("numbers") == width)
        seeds = base.orderBy(*order).limit(entries).select("numbers").collect()
        start = np.array([r["numbers"] for r in seeds], np.int64).reshape(len(seeds), parts, width // parts).transpose(1, 0, 2)
        books = Codebooks(np.ascontiguousarray(start))
        if not seeds:
            return written(base.select("row.*", "numbers", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).drop("none"), "codes"), books
        state = tables(_state(base.select("row", "numbers"), books, True), "state-0")
        for done in range(1, rounds + 1):
            books = _updated(state, books)
            if done < rounds:
                state, old = tables(_state(state, books, False), f"state-{done}"), state
                tables.drop(old)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, numbers, assigned, _, _ in books.assigned(batches, rounds == 0):
                away = numbers - np.concatenate([books.entries[p][assigned[:, p]] for p in range(parts)], 1)
                code = pa.array([x.tobytes().hex() for x in assigned.astype(np.uint8)], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("numbers"), code, pa.array((away * away).sum(1))], ["row", "numbers", "code", "error"])

        schema = state.select("row", "numbers").schema.add("code", "string").add("error", "long")
        return written(mapped(state, run, schema).select("row.*", "numbers", "code", "error").drop("none"), "codes"), books


def label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with label_error, the errors of all rows of its label added up; nulls are one label.
    Few labels are broadcast; many are joined, where adaptive execution splits those with many rows."""
    total = written(coded.groupBy(F.col(label).alias("of_label")).agg(F.sum("error").alias("label_error")), "labels")
    few = total.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    return coded.join(F.broadcast(total) if few else total, F.col(label).eqNullSafe(F.col("of_label")), "left").drop("of_label")


def sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The same in SQL for the query's columns: every distance, round by round."""
    steps = [
        f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), cut AS MATERIALIZED (
  SELECT rid, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x FROM kept, (SELECT unnest(range({parts})) AS p)
), book0 AS MATERIALIZED (SELECT p, rid - 1 AS j, x AS c FROM cut WHERE rid <= {entries})"""
    ]
    for done in range(rounds + 1):
        steps.append(f"""near{done} AS MATERIALIZED (
  SELECT rid, p, x, min(struct_pack(d := list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(x, c)])::BIGINT, j := j)) AS best
  FROM cut JOIN book{done} USING (p) GROUP BY rid, p, x
)""")
        if done < rounds:
            steps.append(f"""means{done} AS MATERIALIZED (
  SELECT p, j, list(m ORDER BY i) AS c FROM (
    SELECT p, best.j AS j, i, (sum(x[i])::BIGINT - ((sum(x[i])::BIGINT % count(*)) + count(*)) % count(*)) // count(*) AS m
    FROM near{done}, (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM cut))) AS i) GROUP BY p, best.j, i
  ) GROUP BY p, j
), book{done + 1} AS MATERIALIZED (SELECT p, j, coalesce(m.c, b.c) AS c FROM book{done} b LEFT JOIN means{done} m USING (p, j))""")
    steps.append(f"""coded AS (
  SELECT rid, string_agg(lpad(lower(to_hex(best.j)), 2, '0'), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY rid
)""")
    return ",\n".join(steps) + f"""
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  sha256((SELECT string_agg(array_to_string(c, ','), ',' ORDER BY p, j) FROM book{rounds})) AS codebooks_sha256
FROM kept JOIN coded USING (rid)"""


SQL = sql()
