import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from tests.llm.helpers import awkward_rows, table

from paysieve.llm import simhash
from paysieve.llm.components import connected_components


def slow(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values):
    label = {v: v for v in values}

    def root(v):
        while label[v] != v:
            v = label[v]
        return v

    for v in values:
        for w in values:
            if (v ^ w).bit_count() <= 3:
                label[root(v)] = root(w)
    groups = {}
    for v in values:
        groups.setdefault(root(v), set()).add(v)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("text", [None, "", " ", "a", "A b", "a b c", "x y z w x y z", "ÄB äb  c\x0bd e f"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow(text)


@pytest.mark.parametrize("spread", [64, 16, 24])
def test_buckets_connect_what_is_close(spread):
    rng = random.Random(spread)
    for size in (5, 60, 300):
        base = [rng.getrandbits(64) for _ in range(3)]
        values = set()
        for _ in range(size):
            v = rng.choice(base)
            for bit in rng.sample(range(spread), rng.randint(0, 5)):
                v ^= 1 << bit
            values.add(v)
        values = sorted(values)
        batch = pa.RecordBatch.from_arrays([pa.array(np.array(values, np.uint64).view(np.int64))], names=["f"])
        emitted = list(simhash._emit(iter([batch])))
        keys = np.concatenate([e.column(0).to_numpy() for e in emitted])
        members = np.concatenate([e.column(1).to_numpy() for e in emitted])
        order = np.argsort(keys, kind="stable")
        batches = [
            pa.RecordBatch.from_arrays([pa.array(keys[order[i : i + 999]]), pa.array(members[order[i : i + 999]])], names=["k", "f"])
            for i in range(0, len(order), 999)
        ]
        links = [
            (a, b)
            for r in simhash._meet(iter(batches))
            for a, b in zip(r.column(0).to_numpy().view(np.uint64).tolist(), r.column(1).to_numpy().view(np.uint64).tolist())
        ]
        assert all((a ^ b).bit_count() <= 3 for a, b in links)
        label = {v: v for v in values}

        def root(v):
            while label[v] != v:
                v = label[v]
            return v

        for a, b in links:
            label[root(a)] = root(b)
        groups = {}
        for v in values:
            groups.setdefault(root(v), set()).add(v)
        assert sorted(map(sorted, groups.values())) == components(values)


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 200), (None, 3)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200}
    assert found == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_match_brute_force(spark):
    rows = awkward_rows()
    base = "one two three four five six seven eight nine ten " * 30
    rows += [(300 + i, base + f"x{i}", "xx", "s0", 1) for i in range(30)]
    prints = [slow(r[1]) for r in rows]
    by_print = {v: group for group in components(sorted(set(prints))) for v in group}
    want = []
    for row, v in zip(rows, prints):
        ids = [r[0] for r, p in zip(rows, prints) if p in set(by_print[v]) and r[0] is not None]
        want.append((row[0], f"{v:016x}", min(ids, default=None)))
    found = [tuple(r) for r in simhash.near_duplicates(table(spark, rows, extra=True)).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicates(table(spark, [])).count() == 0
