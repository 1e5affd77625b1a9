import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import CLASHING

from paysieve.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_all_entries(rows, entries, parts=16, rounds=2):
    """(code, error) per usable row, and the codebooks, in plain integers."""
    usable = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    width = max((len(r[1]) for r in usable), default=0)
    size = -(-width // parts)
    whole = [[int(np.floor(256 * float(np.float32(x)))) for x in r[1]] + [0] * (parts * size - len(r[1])) for r in usable]
    first = sorted(range(len(usable)), key=lambda i: (usable[i][0] is None, usable[i][0] or 0, whole[i][: len(usable[i][1])]))[:entries]
    cut = [[w[p * size : (p + 1) * size] for p in range(parts)] for w in whole]
    books = [[cut[i][p] for i in first] for p in range(parts)]

    def assigned():
        return [
            [min((sum((x - y) ** 2 for x, y in zip(own, e)), k) for k, e in enumerate(book)) for own, book in zip(c, books)]
            for c in cut
        ]

    for _ in range(rounds):
        at = assigned()
        for p, book in enumerate(books):
            for k in range(len(book)):
                own = [c[p] for c, a in zip(cut, at) if a[p][1] == k]
                if own:
                    book[k] = [sum(x) // len(own) for x in zip(*own)]
    found = [("".join(f"{k:02x}" for _, k in a), sum(d for d, _ in a)) for a in assigned()]
    return usable, found, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def check(spark, rows, extra=False, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if extra:
        table = table.withColumns({name: F.lit("other") for name in (*CLASHING, "code", "error", "label_error", "numbers")})
    found = codes.encode(table, codes.learn(table, **options)).collect()
    usable, want, digest = by_all_entries(rows, options.get("entries", 64), options.get("parts", 16), options.get("rounds", 2))
    totals = {}
    for r, (_, error) in zip(usable, want):
        totals[r[2]] = totals.get(r[2], 0) + error
    want = [(r[0], code, error, totals[r[2]], digest, r[2]) for r, (code, error) in zip(usable, want)]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("entries,components,high", [(64, 4, 300), (64, 4, 4), (1, 4, 9), (7, 2, 3), (64, 1, 50), (200, 8, 1000), (9, 0, 3)])
def test_tree_finds_what_all_entries_give(entries, components, high):
    rng = np.random.default_rng(entries + high)
    held = rng.integers(-high, high, (entries, components))
    asked = np.concatenate([rng.integers(-2 * high, 2 * high, (3000, components)), held])
    index, best = codes.Gnat(held).nearest(asked)
    apart = ((asked[:, None] - held[None]) ** 2).sum(-1)
    assert (index == apart.argmin(axis=1)).all() and (best == apart.min(axis=1)).all()


def test_tree_leaves_whole_subtrees_out(monkeypatch):
    rng = np.random.default_rng(2)
    held = rng.integers(-1000, 1000, (64, 4))
    work = []
    plain = codes.squared
    tree = codes.Gnat(held)
    monkeypatch.setattr(codes, "squared", lambda rows, entry: work.append(rows.shape[1]) or plain(rows, entry))
    tree.nearest(held + rng.integers(-20, 20, held.shape))
    assert sum(work) < 0.6 * 64 * 64


def test_numbers_too_large_for_exact_roots():
    held = np.array([[0], [3 * 10**8], [3 * 10**8 + 1]])
    index, best = codes.Gnat(held, degree=2).nearest(np.array([[3 * 10**8 - 10**5], [15 * 10**7], [-(10**9)]]))
    assert index.tolist() == [1, 0, 0] and best.tolist() == [10**10, 225 * 10**14, 10**18]


def test_codes_and_codebooks_in_plain_integers(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(32)], rng.choice([1, 2, None])) for i in range(300)]
    check(spark, rows)
    check(spark, rows, entries=5, parts=4, rounds=3)


def test_awkward_rows(spark):
    rng = random.Random(6)
    some = [rng.uniform(-1, 1) for _ in range(32)]
    rows = [(i, [rng.choice([0.0, 0.5, -0.25]) for _ in range(32)], 1) for i in range(50)]  # ties
    rows += [(60, some, None)] * 40 + [(60, some[::-1], 2)] * 3  # a third equal, an id repeated
    rows += [(None, some, 2), (None, some[::-1], None), (None, None, None), (61, None, 1), (62, [*some[:-1], None], 1)]
    rows += [(63, [*some[:-1], float("nan")], 1), (64, [float("inf"), *some[1:]], 1), (65, [], 3), (66, some[:7], 3), (-5, some[:31], 3)]
    rows += [(67, [float("nan")] * 90, 1)]  # longer than the others, but not usable
    check(spark, rows, extra=True)
    check(spark, rows, entries=16)


def test_few_or_no_rows(spark):
    check(spark, [(2, [1.0] * 16, 1), (1, [0.5] * 16, 1)])
    check(spark, [(2, None, 1)])
    check(spark, [])


def test_decoded(spark):
    rows = [(i, [i / 8 + j for j in range(20)], 0) for i in range(10)]  # no more rows than entries
    table = spark.createDataFrame(rows, SCHEMA)
    books = codes.learn(table, rounds=0)
    for r in codes.encode(table, books).collect():
        assert books.decoded(r.code)[:20] == [int(256 * x) for x in rows[r.vec_id][1]] and r.error == 0
    with pytest.raises(ValueError):
        codes.learn(table, entries=257)
