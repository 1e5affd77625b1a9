import hashlib
import random

from paysieve.llm import imatch
from tests.llm.helpers import awkward_rows, table, words

WIDE = (0.0, 1.0)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5((r[1] or "").encode()).hexdigest()))


def test_edits_and_neighbours(spark):
    rows = awkward_rows()
    found = imatch.fingerprints(table(spark, rows, extra=True), band=WIDE).collect()
    line = ordered(rows)
    want, prints = [], {}
    for i, r in enumerate(line):
        text, after = r[1] or "", line[(i + 1) % len(line)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        want.append((r[0], len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in found], key=repr) == sorted(want, key=repr)
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert len(prints[3]) == 1  # a row that is there three times
    assert prints[107] == prints[5]  # equal texts


def test_ids_far_apart_and_few_rows_in_a_bucket(spark):
    rows = [(i, f"t{i}", None, None, None) for i in (0, 1, 2, 7, 1000, 1001, 10**12, -(10**9))]
    for rows_in_bucket in (1, 3, 100):
        found = imatch.with_next(
            table(spark, rows), ["text"], id_column="doc_id", text_column="text", bucket_rows=rows_in_bucket
        )
        line = ordered(rows)
        want = {r[0]: line[(i + 1) % len(line)][1] for i, r in enumerate(line)}
        assert {r["doc_id"]: r["__next_text"] for r in found.collect()} == want


def test_an_edit_leaves_a_likeness(spark):
    rng = random.Random(9)
    rows = [(i, words(rng, 200), None, None, None) for i in range(60)]
    found = imatch.fingerprints(table(spark, rows), band=(0.02, 0.6)).collect()
    assert sum(r.near_edited > r.near_next for r in found) > 50


def test_small_tables(spark):
    assert imatch.fingerprints(table(spark, [])).count() == 0
    (row,) = imatch.fingerprints(table(spark, [(5, "a b c d", None, None, None)])).collect()
    assert row.near_next == 1.0 and row.n_chars == 7
    (row,) = imatch.fingerprints(table(spark, [(None, None, None, None, None)])).collect()
    assert (row.near_edited, row.near_next, row.n_chars) == (1.0, 1.0, 0)


def test_quotes_and_backslashes_in_the_lexicon(spark):
    rows = [(1, "it's a \\ 'quoted' \\' x", None, None, None), (2, "it's a \\ 'quoted' \\' y", None, None, None)]
    found = imatch.fingerprints(table(spark, rows), band=WIDE).collect()
    assert all(r.near_next < 1 and r.fingerprint.count("-") < len(r.fingerprint) for r in found)


def test_no_python_in_the_plan(spark):
    plan = imatch.fingerprints(table(spark, awkward_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_a_third_of_the_rows_equal_keep_their_fingerprint(spark):
    rng = random.Random(3)
    one, two = words(rng, 80), words(rng, 80, ("zu", "ri", "bak", "o"))
    rows = [(i, words(rng, 60), None, None, None) for i in range(200)]
    rows += [(1000 + i, one, None, None, None) for i in range(200)] + [(2000 + i, two, None, None, None) for i in range(200)]
    found = imatch.fingerprints(table(spark, rows)).collect()
    assert all(set(r.fingerprint) != {"-"} for r in found)
    prints = {r.doc_id // 1000: r.fingerprint for r in found if r.doc_id >= 1000}
    assert imatch_share(prints[1], prints[2]) < 0.5
    between = next(r for r in found if r.doc_id == 2000)  # followed by a copy of the other text
    assert between.near_next < 0.5


def imatch_share(one, other):
    cut = [(one[i : i + 4], other[i : i + 4]) for i in range(0, len(one), 4)]
    used = [(a, b) for a, b in cut if a != "----" or b != "----"]
    return sum(a == b for a, b in used) / max(len(used), 1)


def test_outlying_repeated_and_missing_ids_fill_no_bucket(spark):
    rng = random.Random(5)
    rows = [(i, f"t{i}", None, None, None) for i in range(1500)] + [(1 << 62, "far", None, None, None), (-(1 << 62), "far", None, None, None)]
    rows += [(700, f"same id {i}", None, None, None) for i in range(700)] + [(None, f"none {i}", None, None, None) for i in range(700)]
    rng.shuffle(rows)
    docs = table(spark, rows).repartition(4)
    edges = imatch.id_edges(docs, "doc_id", 80)
    sizes = [r["count"] for r in docs.groupBy(imatch._bucket(imatch.F.col("doc_id"), edges).alias("b")).count().where("b >= 0").collect()]
    assert sorted(sizes)[-1] == 701 and sorted(sizes)[-2] < 150  # the repeated id alone, cut by hash below
    found = imatch.with_next(docs, ["text"], id_column="doc_id", text_column="text", bucket_rows=32)
    line = ordered(rows)
    want = sorted((r[0], r[1], line[(i + 1) % len(line)][1]) for i, r in enumerate(line) if r[0] is not None)
    got = found.collect()
    assert sorted((r["doc_id"], r["text"], r["__next_text"]) for r in got if r["doc_id"] is not None) == want
    assert sorted(r["__next_text"] for r in got) == sorted(r[1] for r in rows)
    tasks = [r["n"] for r in found.groupBy(imatch.F.spark_partition_id()).agg(imatch.F.count("*").alias("n")).collect()]
    assert sum(tasks) == len(rows)
