import re

from tests.llm.helpers import awkward_rows, collected, table

from paysieve.llm import mixing


def targets(sizes):
    """Share by weight, hold what is above its ceiling, share the rest again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    held, left, free = {}, float(sum(sizes.values())), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        above = [s for s in free if weight[s] * level >= 3 * sizes[s]]
        if not above:
            return held | {s: weight[s] * level for s in free}
        for s in above:
            held[s] = 3.0 * sizes[s]
            left -= held[s]
            free.discard(s)
    return held


def test_targets_sizes_and_limits(spark):
    rows = awkward_rows()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    want = targets(sizes)
    found = mixing.mix(table(spark, rows, extra=True), block_words=4, shard_words=500).collect()
    assert len(found) == len(rows)
    taken = {}
    for r in found:
        assert r["size"] == size(r.text) and r.source_size == sizes[r.source] and 0 <= r.taken <= 3 * r["size"]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 0.02 * sum(sizes.values())


def test_highest_quotients_by_listing_them(spark):
    cells = [(0, 0, 500, 130.0), (0, 1, 90, 270.0), (0, 2, 300, 31.0), (0, 3, 0, 0.0), (1, 0, 50, 17.0), (1, 2, 64, 64.0)]
    df = spark.createDataFrame(cells, "__shard long, __turn int, __words long, __share double")
    found = {(r[0], r[1]): r[3] for r in mixing._quotas(df, 10, 3).collect()}
    for shard in (0, 1):
        own = [c for c in cells if c[0] == shard]
        seats = round(sum(c[3] for c in own) / 10)
        best = sorted(((-c[3] / (2 * k - 1), c[1]) for c in own if c[3] for k in range(1, 200)))[:seats]
        for c in own:
            assert found[shard, c[1]] == min(sum(t == c[1] for _, t in best), 3 * -(-c[2] // 10))


def test_reruns_and_other_partitions_agree(spark):
    docs = table(spark, awkward_rows()).select("doc_id", "text", "source")
    first = collected(mixing.mix(docs, block_words=8).drop("text"))
    assert first == collected(mixing.mix(docs.repartition(5), block_words=8).drop("text"))


def test_short_documents_in_many_shards_come_near_their_target(spark):
    rows = [(i, "w " * 500, None, "a", None) for i in range(400)]
    rows += [(10_000 + i, "w " * 10, None, "c", None) for i in range(300)]
    rows += [(20_000 + i, "w", None, "d", None) for i in range(900)]
    found = mixing.mix(table(spark, rows), shard_words=1 << 10, least_blocks=64).collect()
    target, taken = {r.source: r.target for r in found}, {}
    for r in found:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] / t - 1) < 0.05 for s, t in target.items()), (target, taken)


def test_few_words_take_no_part_in_the_blocks(spark):
    big, small = [(i, "w " * 500, None, "a", None) for i in range(60)], [(900, "w " * 10, None, "c", None)]
    found = mixing.mix(table(spark, big + small), least_blocks=64).collect()
    taken, target = sum(r.taken for r in found if r.source == "a"), next(r.target for r in found if r.source == "a")
    assert [r.taken for r in found if r.source == "c"] == [30] and abs(taken - target) < 64


def test_empty_and_wordless_tables(spark):
    assert mixing.mix(table(spark, [])).count() == 0
    found = mixing.mix(table(spark, [(1, None, None, None, None), (2, " ", None, "a", None)])).collect()
    assert [(r["size"], r.source_size, r.target, r.taken) for r in found] == [(0, 0, 0.0, 0)] * 2


def test_documents_are_repeated_as_taken(spark):
    docs = table(spark, [(i, "w " * 50, None, "a" if i else "b", None) for i in range(60)])
    mixed = mixing.mix(docs, block_words=10)
    found = mixing.repeated(mixed)
    assert found.columns == docs.columns
    times = {r.doc_id: r["count"] for r in found.groupBy("doc_id").count().collect()}
    for r in mixed.collect():
        assert r.taken // 50 <= times.get(r.doc_id, 0) <= -(-r.taken // 50)
