import math
import random

import numpy as np
import pytest

from paysieve.llm import topk

NAN, INF = float("nan"), float("inf")


def expected(rows, k=5, every=50):
    own = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for q, a in own:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in own if i != q)
            found += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(found)


@pytest.mark.parametrize("low,high", [(-3, 4), (0, 1), (-1000, 2000), (5, 6)])
@pytest.mark.parametrize("rows", [1, 2, 63, 64, 65, 300])
def test_block_against_products(rows, low, high):
    rng = np.random.default_rng(rows)
    values, ids = rng.integers(low, high, (rows, 5)), rng.permutation(rows)
    index = topk.BlockIndex(ids, values)
    for at in range(min(rows, 20)):
        found, scores = index.top(int(ids[at]), values[at], 5)
        product = values @ values[at]
        want = [i for i in np.lexsort((ids, -product)) if i != at][:5]
        assert sorted(zip(-scores, found)) == [(-product[i], ids[i]) for i in want]


def test_rows_of_all_kinds(spark):
    rng = random.Random(4)
    rows = [(i, [round(rng.uniform(-1, 1), 1) for _ in range(4)]) for i in range(260)]  # many ties
    rows += [(300, None), (350, [1.0, None, 0.0, 1.0]), (400, [NAN, 1.0, 1.0, 1.0]), (450, [INF, 0.0, 0.0, 0.0])]
    rows += [(None, [9.0] * 4), (500, []), (501, [2.0]), (550, [0.0] * 4), (1001, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    small = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    from pyspark.sql import functions as F

    clashing = df.withColumns({n: F.lit(1) for n in ("id", "values", "block", "rows", "score", "rank", "asked")})
    found = topk.top_k(clashing, block_rows=50, block_queries=2)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in found.collect()) == expected(small)


def test_fewer_rows_than_asked_for(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df).collect()] == [(0, 1, 3, 256 * 256 * 3)]
    assert topk.top_k(df.limit(0)).count() == 0


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [2.0]), (1, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = [r.vec_id for r in topk.top_k(df, k=2).where("query_id = 0").collect()]
    assert found == [1, 1]


def test_a_repeated_query_row_is_one_query(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [3.0]), (2, [2.0]), (3, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted((r.rank, r.vec_id) for r in topk.top_k(df, k=2).where("query_id = 0").collect())
    assert found == [(1, 1), (2, 2)]


def test_rows_of_one_id_are_queries_of_their_own(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [3.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 3.0]), (4, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted((r.rank, r.vec_id) for r in topk.top_k(df, k=2).where("query_id = 0").collect())
    assert found == [(1, 1), (1, 3), (2, 2), (2, 4)]


def test_copies_fill_no_block(spark):
    """A third of the rows equal: each query has its five, of the copies five at most."""
    rng = random.Random(9)
    rows = [(i, [float(rng.randint(-4, 4)) for _ in range(3)]) for i in range(2000)] + [(5000, [4.0, 4.0, 4.0])] * 1000
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk.top_k(df, block_rows=100, k=5).collect()
    best = max(range(2000), key=lambda i: (sum(rows[i][1]), -i))
    for r in found:
        own = rows[r.query_id][1] if r.query_id < 2000 else rows[-1][1]
        other = rows[r.vec_id][1] if r.vec_id < 2000 else rows[-1][1]
        assert r.score == 65536 * sum(a * b for a, b in zip(own, other))
    copies = [r for r in found if r.query_id == best // 50 * 50 and r.vec_id == 5000]
    assert len(copies) in (0, 5)
    per_query = {}
    for r in found:
        per_query[r.query_id] = per_query.get(r.query_id, 0) + 1
    assert set(per_query.values()) == {5}
