"""Exact top-k by inner product on a bit-sliced index.

Rows are dealt to blocks by a hash, equal ones each for itself.  In a block an attribute is a
few bitmaps, one per binary digit of its value above the block's minimum: bit r
of a bitmap belongs to the block's r-th row by id.  A query's scores of all the
block's rows are sums of slices: each set digit of a query component adds the
attribute's slices, shifted; a negative component adds their complements.
Sums are formed by carry-save steps, three numbers to two, on whole bitmaps.

The top k are then selected from the most significant slice of the sum
downward: rows in the slice are taken as long as they are not too many, and
what is still undecided at the last slice has one common score, of which the rows with the smallest ids
complete the k exactly.  Per query the blocks' results, k rows each, meet in a last ranking.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysieve.llm.common import stored

MOST_TASKS = 20_000


# --- index of one block ----------------------------------------------------


def _bitmaps(flags: np.ndarray) -> np.ndarray:
    """(..., rows) booleans -> (..., words) of 64 rows."""
    rows = flags.shape[-1]
    padded = np.zeros((*flags.shape[:-1], -(-rows // 64) * 64), np.uint8)
    padded[..., :rows] = flags
    return np.packbits(padded, axis=-1, bitorder="little").view("<u8")


class BlockIndex:
    """Slices of the attributes of rows sorted by id; ``values`` is (rows, attributes), whole numbers."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, values = ids[order], values[order]
        self.rows, self.attributes = values.shape
        self.least = values.min(axis=0)
        raised = (values - self.least).T
        self.width = max(1, int(raised.max(initial=0)).bit_length())
        digits = (raised[:, None, :] >> np.arange(self.width)[None, :, None]) & 1
        self.slices = _bitmaps(digits.astype(bool))  # (attributes, width, words)
        self.exists = _bitmaps(np.ones(self.rows, bool))

    def sum_slices(self, query: np.ndarray) -> tuple[np.ndarray, int]:
        """(slices of score - offset, offset) for all rows."""
        top = (1 << self.width) - 1
        magnitude = np.abs(query)
        offset = int((query * self.least).sum()) - int((magnitude[query < 0] * top).sum())
        highest = int(magnitude.sum()) * top
        width = max(1, highest.bit_length())
        digits = max(1, int(magnitude.max(initial=0)).bit_length())
        own = np.where((query < 0)[:, None, None], ~self.slices, self.slices)
        # Horner's rule from the query's highest digit: double, then add the
        # attributes whose components have the digit.
        words = self.exists.shape[-1]
        total = np.zeros((1, width, words), np.uint64)
        for digit in range(digits - 1, -1, -1):
            chosen = own[(magnitude >> digit) & 1 == 1]
            doubled = np.zeros((len(total), width, words), np.uint64)
            doubled[:, 1:] = total[:, :-1]
            wide = np.zeros((len(chosen), width, words), np.uint64)
            wide[:, : min(width, self.width)] = chosen[:, :width]
            total = _carry_save(np.concatenate([doubled, wide]))
        return _ripple(total), offset

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows but the query's own; ties to smaller ids."""
        slices, offset = self.sum_slices(query)
        open_ = self.exists.copy()
        for at in np.flatnonzero(self.ids == query_id):
            open_[at // 64] &= ~(np.uint64(1) << np.uint64(at % 64))
        sure, k = np.zeros_like(open_), min(k, int(np.bitwise_count(open_).sum()))
        if k == 0:
            return self.ids[:0], np.zeros(0, np.int64)
        for level in range(len(slices) - 1, -1, -1):
            high = open_ & slices[level]
            count = int(np.bitwise_count(sure).sum() + np.bitwise_count(high).sum())
            if count > k:
                open_ = high
            else:
                sure |= high
                open_ = open_ & ~slices[level]
                if count == k:
                    break
        taken = _rows(sure)
        boundary = _rows(open_)[: k - len(taken)]  # one common score, ids ascending
        rows = np.concatenate([taken, boundary])
        word, bit = rows // 64, (rows % 64).astype(np.uint64)
        digits = (slices[:, word] >> bit) & np.uint64(1)
        scores = (digits.astype(np.int64) << np.arange(len(slices))[:, None]).sum(axis=0) + offset
        return self.ids[rows], scores


def _rows(bitmap: np.ndarray) -> np.ndarray:
    words = np.flatnonzero(bitmap)
    bits = np.unpackbits(bitmap[words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(bits)
    return words[at] * 64 + bit


def _carry_save(numbers: np.ndarray) -> np.ndarray:
    """(n, width, words) -> at most (2, width, words) with the same sum."""
    while len(numbers) > 2:
        n = len(numbers) // 3
        a, b, c = numbers[:n], numbers[n : 2 * n], numbers[2 * n : 3 * n]
        half = a ^ b
        carry = np.zeros_like(half)
        carry[:, 1:] = ((a & b) | (half & c))[:, :-1]
        numbers = np.concatenate([half ^ c, carry, numbers[3 * n :]])
    return numbers


def _ripple(numbers: np.ndarray) -> np.ndarray:
    if len(numbers) == 1:
        return numbers[0]
    a, b = numbers
    total = np.empty_like(a)
    carry = np.zeros(a.shape[1], np.uint64)
    for level in range(len(a)):
        half = a[level] ^ b[level]
        total[level] = half ^ carry
        carry = (a[level] & b[level]) | (half & carry)
    return total


# --- Spark -----------------------------------------------------------------


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; NULL unless all are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return F.when(vector.isNotNull() & finite, whole)


def _matrix(vectors: pa.Array, attributes: int) -> np.ndarray:
    """Vectors of fewer components than others end in zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    found = np.zeros((len(vectors), attributes), np.int64)
    found[np.repeat(np.arange(len(vectors)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return found


def top_k(
    vectors: DataFrame,
    *,
    k: int = 5,
    query: Column | None = None,
    block_rows: int = 8192,
    block_queries: int = 64,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other rows.

    ``query`` says which rows are queries (default: ids divisible by 50).
    Vectors that are NULL, hold NULL or a non-finite component, or have a NULL
    id take no part; an empty vector scores 0, and so does a missing component.
    Rows that repeat an id are rows of their own as candidates, though not for a
    query of that id.  Equal rows are one query; rows of one id with different vectors are
    queries of their own, whose results are all returned under that id.  Scores
    must fit a long.  Ties go to the smaller id, fewer than k rows give fewer
    results, and an empty table none.  Other columns are not read.

    Queries meet all rows in blocks: a block of the index is one row of a
    table, so is a block of queries, and a task works on a few pairs of them.
    Of equal rows k are enough for any query, so that no block overflows with copies.
    """
    asked = query if query is not None else F.col(id_column) % 50 == 0
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        quantised(F.col(vector_column)).alias("values"),
        F.coalesce(asked, F.lit(False)).alias("asked"),
    ).where("id IS NOT NULL AND values IS NOT NULL")
    copies = F.least(F.count(F.lit(1)), F.lit(k)).cast("int")
    distinct = stored(rows.groupBy("id", "values").agg(copies.alias("copies"), F.bool_or("asked").alias("asked")), "vectors")
    total, questions, attributes = distinct.agg(F.sum("copies"), F.count_if("asked"), F.max(F.size("values"))).first()
    blocks = max(1, math.ceil((total or 0) / block_rows))
    asking = max(1, math.ceil(questions / block_queries))
    # a number of partitions of one's own is not merged by size: a task's work is far more than its bytes
    tasks = min(4 * blocks, MOST_TASKS)
    each = distinct.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    index = (
        each.withColumn("block", F.pmod(F.xxhash64("id", "values", "copy"), F.lit(blocks)))
        .repartition(tasks, "block")
        .groupBy("block")
        .agg(F.collect_list(F.struct("id", "values")).alias("rows"))
    )
    lots = (
        distinct.where("asked")
        .groupBy(F.pmod(F.xxhash64("id", "values"), F.lit(asking)).alias("lot"))
        .agg(F.sort_array(F.collect_list(F.struct("id", "values"))).alias("queries"))
    )
    pairs = (
        lots.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        .repartition(tasks, "at")
        .join(index, F.col("at") == F.col("block"))
    )
    width = int(attributes or 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column(0)[i].as_py()
                if block != at:
                    inside = batch.column(1)[i].values
                    at, held = block, BlockIndex(
                        inside.field("id").to_numpy(), _matrix(inside.field("values"), width)
                    )
                ask = batch.column(2)[i].values
                lot = batch.column(3)[i].as_py()
                found = [
                    (q, *held.top(int(q), values, k))
                    for q, values in zip(ask.field("id").to_numpy(), _matrix(ask.field("values"), width))
                ]
                sizes = [len(ids) for _, ids, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(sum(sizes), lot), pa.int64()),
                        pa.array(np.repeat(np.arange(len(found)), sizes), pa.int64()),
                        pa.array(np.repeat([q for q, _, _ in found], sizes), pa.int64()),
                        pa.array(np.concatenate([ids for _, ids, _ in found]), pa.int64()),
                        pa.array(np.concatenate([scores for _, _, scores in found]), pa.int64()),
                    ],
                    names=["lot", "place", "query_id", "vec_id", "score"],
                )

    schema = "lot long, place long, query_id long, vec_id long, score long"
    best = pairs.select("block", "rows", "queries", "lot").mapInArrow(run, schema)
    # a query is known by its place in its lot
    order = Window.partitionBy("lot", "place").orderBy(F.col("score").desc(), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
asked AS (SELECT vec_id, q, row_number() OVER () AS place FROM (SELECT DISTINCT vec_id, q FROM v WHERE vec_id % 50 = 0)),
scored AS (
  SELECT a.place, a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM asked a JOIN v b ON a.vec_id <> b.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
