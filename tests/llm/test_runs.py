import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from tests.llm.helpers import awkward_rows, collected, table, words

from paysieve.llm import queries, runs

SF = "/root/testdata/sf0.001"


def all_runs(own, least=24, repeats=3):
    """By comparing the words at every lag."""
    found = {}
    for lag in range(1, len(own) // repeats + 1):
        at = 0
        while at + lag < len(own):
            end = at
            while end + lag < len(own) and own[end] == own[end + lag]:
                end += 1
            if end > at and end - at + lag >= max(least, repeats * lag):
                found.setdefault((at, end - at + lag), lag)
            at = max(end, at + 1)
    return sorted((start, length, lag) for (start, length), lag in found.items())


def some_words(rng):
    kinds = rng.choice([1, 2, 3, 5, 50])
    own = []
    for _ in range(rng.randint(0, 12)):
        if rng.random() < 0.3:
            own += [rng.randrange(kinds) for _ in range(rng.randint(0, 30))]
        else:
            period = rng.choice([1, 2, 3, 4, 7, 8, 9, 12, 13, 18, 19, 27, 28, 40, 41, 61])
            block = [rng.randrange(kinds) for _ in range(period)]
            own += (block * 7)[: int(period * rng.choice([2, 2.9, 3, 3.1, 4, 6]))]
            if rng.random() < 0.3 and own:
                own[rng.randrange(len(own))] = rng.randrange(kinds)
    return [b"%d" % x for x in own]


def listed(documents, **limits):
    return [[tuple(r) for r in found.tolist()] for found in runs.found_in(documents, **limits)]


def test_random_documents_by_comparing_all_lags():
    rng = random.Random(5)
    for _ in range(60):
        documents = [some_words(rng) for _ in range(rng.randint(1, 6))]
        assert listed(documents) == [all_runs(d) for d in documents]
        assert listed(documents, least=1, repeats=4) == [all_runs(d, 1, 4) for d in documents]


def test_words_of_combinatorics():
    a, b = ["a"], ["a", "b"]
    while len(b) < 1500:
        a, b = b, b + a
    morse = [str(bin(i).count("1") % 2) for i in range(2000)]
    for own in (b, morse, ["x"] * 3000, (["a"] * 50 + ["b"]) * 30, ["p", "q", "r"] * 8, ["p", "q", "r"] * 7):
        own = [w.encode() for w in own]
        assert listed([own]) == [all_runs(own)]


@pytest.mark.parametrize("period", range(1, 80))
def test_every_period_at_its_shortest(period):
    length = max(24, 3 * period)
    block = [b"w%d" % i for i in range(period)]
    own = [b"x", *(block * 24)[:length], b"y"]
    assert listed([own, own[:-2], own]) == [[(1, length, period)], [], [(1, length, period)]]


def test_equal_hashes_of_other_words_are_no_run(monkeypatch):
    """Seeds are looked up in the words, whatever the hashes say."""
    monkeypatch.setattr(runs, "mixed", lambda x: x % np.uint64(2))
    rng = random.Random(8)
    own = [b"%d" % rng.randrange(40) for _ in range(400)]
    assert listed([own]) == [all_runs(own)] == [[]]


def test_runs_stay_in_their_documents():
    own = [b"a", b"b"] * 10
    assert listed([own, own, own]) == [[], [], []]


def in_plain_python(doc_id, text):
    own = (text or "").encode().split()
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    g, n = h // 10, len(own)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        own = [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]
    found = all_runs(own)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    text = b" ".join(w for i, w in enumerate(own) if i not in gone)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    milli = 1000 * best[1] // best[2] if found else None
    rows = "".join("%d,%d,%d\n" % r for r in found)
    return doc_id, len(found), *best, milli, hashlib.sha256(rows.encode()).hexdigest(), hashlib.sha256(text).hexdigest()


def test_whole_table_by_comparing_all_lags(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = [in_plain_python(r.doc_id, r.text) for r in rows]
    assert collected(queries.op11_runs(spark, SF)) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in want) > len(want) // 20


def test_awkward_rows(spark):
    """Long texts are left to the other tests: comparing all their lags takes too long."""
    rows = [r for r in awkward_rows() if len(r[1] or "") < 5000]
    rows += [(None, "a b " * 30, None, None, None), (7, "\x0b\x0c a b \t\r\n" * 30, None, None, None)]
    rows += [(i, words(random.Random(i), 60), None, None, None) for i in range(200, 260)]
    docs = table(spark, rows, extra=True)
    want = [in_plain_python(r[0], r[1]) for r in rows]
    assert collected(runs.periodic_runs(docs, edit=True)) == sorted(want, key=repr)


def test_long_texts_and_details(spark):
    long = " ".join(f"w{i % 40_000}" for i in range(130_000))
    docs = table(spark, [(3, long, None, None, None), (1, "x " + "p q r " * 9 + "y", None, None, None), (2, None, None, None, None)])
    found = {r.doc_id: r for r in runs.periodic_runs(docs, details=True).collect()}
    assert [tuple(r) for r in found[3].runs] == [(0, 130_000, 40_000)] and found[3].exponent_milli == 3250
    assert [tuple(r) for r in found[1].runs] == [(1, 27, 3)] and found[1].collapsed == "x p q r y"
    assert found[2].runs == [] and found[2].collapsed == "" and found[2].n_runs == 0


def test_empty_table(spark):
    assert runs.periodic_runs(table(spark, [])).count() == 0
