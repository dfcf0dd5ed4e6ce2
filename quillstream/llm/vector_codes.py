"""Vector code compression: part codebooks, with distances read from value dictionaries.

Components become integers, and a vector is cut into ``PARTS`` equal parts, each replaced by
the number of its nearest codebook entry.  Vectors are stored once in blocks; a block holds,
for each dimension, the dictionary of the distinct integers there and each row's place in it.
For a codebook the squared difference of every dictionary value to every entry is tabulated
once per block; the distances of a part are then gathers from those tables and adds.

Each round of learning sends the codebooks (``ENTRIES`` vectors) to the tasks and gets one sum
for each entry and dimension back, added in the tasks and by a grouped sum, so nothing that
grows with the rows meets in one place.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.llm.common import Written, set_aside, small_or_shuffled
from quillstream.llm.topk import finite

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
# Rows of a block: its tables hold at most as many values for each dimension.
BLOCK = 4096
# Rows whose distances are held at a time.
SLICE = 1024
# Largest integer: squared differences over 64 dimensions still fit 63 bits.
LIMIT = 1 << 27

BLOCKS = "vec_ids array<bigint>, labels array<string>, sizes array<int>, values array<bigint>, places binary"


def integers(vectors, width: int) -> np.ndarray:
    """``floor(1024 * x)``, cut at ``LIMIT``; shorter vectors are filled with zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    with np.errstate(over="ignore"):
        return np.clip(np.floor(out * SCALE), -LIMIT, LIMIT).astype(np.int64)


def encode_block(whole: np.ndarray) -> tuple[list[int], np.ndarray, bytes]:
    """Dictionary sizes, all dictionaries one after the other, and the rows' places."""
    sizes, values, places = [], [], np.empty(whole.T.shape, np.uint16)
    for d, column in enumerate(whole.T):
        found, places[d] = np.unique(column, return_inverse=True)
        sizes.append(len(found))
        values.append(found)
    return sizes, np.concatenate(values) if values else np.empty(0, np.int64), places.tobytes()


class Block:
    """A stored block of vectors."""

    def __init__(self, sizes, values, places: bytes):
        ends = np.cumsum(sizes)
        values = np.asarray(values, np.int64)
        self.dictionaries = [values[e - s:e] for s, e in zip(sizes, ends)]
        self.places = np.frombuffer(places, np.uint16).reshape(len(sizes), -1)

    def column(self, d: int) -> np.ndarray:
        return self.dictionaries[d][self.places[d]]

    def nearest(self, book: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of ``book`` (entries x dimensions, from dimension ``first`` on) for each
        row, ties to the lower one, and its squared distance."""
        tables = [(self.dictionaries[first + d][:, None] - book[:, d]) ** 2 for d in range(book.shape[1])]
        rows = self.places.shape[1]
        codes, errors = np.empty(rows, np.int64), np.empty(rows, np.int64)
        for at in range(0, rows, SLICE):
            cut = slice(at, at + SLICE)
            distance = np.zeros((len(self.places[0, cut]), len(book)), np.int64)
            for d, table in enumerate(tables):
                distance += table[self.places[first + d, cut]]
            codes[cut] = distance.argmin(axis=1)
            errors[cut] = distance[np.arange(len(distance)), codes[cut]]
        return codes, errors


def blocks(vectors: DataFrame, width: int, vector: str = "embedding") -> DataFrame:
    """The rows (vec_id, label, vector) in blocks of dictionary codes."""
    rows = vectors.select(F.col("vec_id").cast("bigint"), F.col("label").cast("string"), F.col(vector).cast("array<double>"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                sizes, values, places = encode_block(integers(part.column(2).to_pylist(), width))
                yield pa.RecordBatch.from_arrays([
                    pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                    pa.array([part.column(1).to_pylist()], pa.list_(pa.string())), pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([values.tolist()], pa.list_(pa.int64())), pa.array([places], pa.binary())],
                    ["vec_ids", "labels", "sizes", "values", "places"])

    return rows.mapInArrow(run, BLOCKS)


def _loaded(batch: pa.RecordBatch):
    for row in batch.select(["sizes", "values", "places"]).to_pylist():
        yield Block(row["sizes"], row["values"], row["places"])


def learn(stored: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks (parts x entries x dimensions) after some rounds over the blocks."""
    spark = stored.sparkSession
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)

        def add(batches, shared=shared):
            books = shared.value
            parts, entries, size = books.shape
            sums, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
            for batch in batches:
                for block in _loaded(batch):
                    for p in range(parts):
                        codes, _ = block.nearest(books[p], p * size)
                        counts[p] += np.bincount(codes, minlength=entries)
                        for d in range(size):
                            # Exact: a block's sums stay below 2**53.
                            sums[p, :, d] += np.bincount(codes, block.column(p * size + d), entries).astype(np.int64)
            used = np.argwhere(counts)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.repeat(used[:, 0], size), pa.int32()), "entry": pa.array(np.repeat(used[:, 1], size), pa.int32()),
                "at": pa.array(np.tile(np.arange(size), len(used)), pa.int32()),
                "sum": pa.array(sums[used[:, 0], used[:, 1]].ravel(), pa.int64()),
                "n": pa.array(np.repeat(counts[used[:, 0], used[:, 1]], size), pa.int64())})

        # As many rows as the codebooks have components.
        found = stored.mapInArrow(add, "part int, entry int, at int, sum bigint, n bigint").groupBy("part", "entry", "at").agg(
            F.sum("sum").alias("sum"), F.sum("n").alias("n")).toPandas()
        books = books.copy()
        books[found["part"], found["entry"], found["at"]] = (found["sum"] // found["n"]).to_numpy(np.int64)
        shared.unpersist()
    return books


def first_books(vectors: DataFrame, width: int, vector: str = "embedding", entries: int = ENTRIES) -> np.ndarray:
    """The parts of the vectors with the smallest ids; nulls last, ties to the smaller vector."""
    first = vectors.select("vec_id", F.col(vector).cast("array<double>").alias("v")) \
        .orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).toPandas()
    whole = integers(first["v"], width)
    return np.ascontiguousarray(whole.reshape(len(whole), PARTS, width // PARTS).transpose(1, 0, 2))


def compress(vectors: DataFrame, vector: str = "embedding", rounds: int = ROUNDS, entries: int = ENTRIES) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, codes array<int>, error) of every usable row, and the codebooks.

    Null vectors and those with null or non-finite components are left out.  The width is
    that of the longest vector, rounded up to a multiple of ``PARTS``; shorter vectors,
    empty ones too, are as if filled with zeros.  Integers are cut at 2**27 in size (|x|
    of 131,072), beyond which squared errors would not fit a long.  With fewer rows than
    ``entries``, the codebooks hold an entry for each; with none there are no rows and no
    entries.  Repeated rows and ids are rows of their own; null ids come last in the choice
    of the first entries.  ``label`` is given as a string.
    """
    usable = vectors.filter(finite(vector))
    longest = usable.agg(F.coalesce(F.max(F.size(vector)), F.lit(0))).first()[0]
    width = max(PARTS, -(-longest // PARTS) * PARTS)
    stored = Written(blocks(usable, width, vector), "vector-blocks").df
    books = learn(stored, first_books(usable, width, vector, entries), rounds)
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    size = width // PARTS

    def run(batches):
        for batch in batches:
            for ids, labels, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _loaded(batch)):
                found = [block.nearest(book, p * size) for p, book in enumerate(shared.value)]
                codes, errors = np.array([c for c, _ in found]).T, sum(e for _, e in found)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(codes.tolist(), pa.list_(pa.int32())),
                    pa.array(errors, pa.int64())], ["vec_id", "label", "codes", "error"])

    return stored.mapInArrow(run, "vec_id bigint, label string, codes array<int>, error bigint"), books


def decode(rows: DataFrame, books: np.ndarray, codes: str = "codes", column: str = "vector") -> DataFrame:
    """``rows`` with the vector that ``codes`` stand for in ``column`` (replaced if there).

    Components are those of the entries, scaled back.  Null codes give null; all other
    columns and repeated rows stay.
    """
    apart, back = set_aside(rows.drop(column), codes)
    place, names = apart.columns.index(codes), [*apart.columns, "_vector"]
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        scaled = shared.value / SCALE
        for batch in batches:
            found = [None if c is None else np.concatenate([scaled[p, e] for p, e in enumerate(c)])
                     for c in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.float64()))], names)

    schema = T.StructType([*apart.schema.fields, T.StructField("_vector", T.ArrayType(T.DoubleType()))])
    return apart.mapInArrow(run, schema).select(*back, F.col("_vector").alias(column))


def digest(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable row."""
    found, books = compress(vectors.select("vec_id", "embedding", "label"))
    rows = Written(found, "codes")
    sums = Written(rows.df.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").df
    sums = small_or_shuffled(sums.withColumnRenamed("label", "_label"))
    written = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return rows.fresh().join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit(written).alias("codebooks_sha256"))
