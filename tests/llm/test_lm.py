import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paysieve.llm import lm, queries
from tests.llm.helpers import awkward_rows, table

SF = "/root/testdata/sf0.001"
TEXTS = ["a b a b c", "a b c a", "c c a b", "b", "a b a b c"]
BEGIN, END = "<begin>", "<end>"


def tokens_of(text):
    lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), END]


class Model:
    """The probabilities by their definition, with counts in dictionaries."""

    def __init__(self, texts, priors=lm.PRIORS):
        self.a, self.b = priors
        self.counts = Counter()
        for text in texts:
            own = [BEGIN, *tokens_of(text)]
            self.counts[BEGIN,] += 1
            for n in (1, 2, 3):
                self.counts.update(tuple(own[i - n + 1 : i + 1]) for i in range(max(n - 1, 1), len(own)))
        words = {g[0]: c for g, c in self.counts.items() if len(g) == 1 and g[0] != BEGIN}
        self.total, self.seen, self.words = sum(words.values()), len(words), words

    def single(self, word):
        return (self.words.get(word, 0) + 0.1) / (self.total + 0.1 * (self.seen + 1))

    def probability(self, context, word):
        if not context:
            return self.single(word)
        prior = (self.a, self.b)[len(context) - 1]
        shorter = self.probability(context[1:], word)
        return (self.counts[*context, word] + prior * shorter) / (self.counts[context] + prior)

    def score(self, text):
        own = [BEGIN, *tokens_of(text)]
        return sum(math.log10(self.probability(tuple(own[max(0, i - 2) : i]), own[i])) for i in range(1, len(own)))

    def row(self, text):
        own = tokens_of(text)
        base = sum(math.log10(self.single(t)) for t in own)
        return len(own), sum(t in self.words for t in own), self.total, round(base, 6), round(self.score(text), 6)


def lot_of(texts, trained):
    tokens, sizes = lm.token_hashes(pa.array(texts, pa.string()))
    return lm.Lot(tokens, sizes, np.array(trained))


def automaton_of(texts, trained, priors=lm.PRIORS):
    lot = lot_of(texts, trained)
    counts = [n for *_, n in lot.ngrams()]
    return lot, lm.Automaton(lot, counts, int(counts[0].sum()), int((counts[0] > 0).sum()), priors)


def test_words_are_hashed_as_words():
    texts = ["A b\tC\x0bcc", None, "", "  x ", "été É a", "a" * 5000, "b c", "cc a b 　"] + ["w%d" % i for i in range(2000)]
    tokens, sizes = lm.token_hashes(pa.array(texts))
    want = [t for text in texts for t in [BEGIN, *tokens_of(text)]]
    assert sizes.tolist() == [len(tokens_of(t)) + 1 for t in texts]
    of = {}
    for word, key in zip(want, tokens.tolist()):
        assert of.setdefault(word, key) == key
    assert len(set(of.values())) == len(of) and all(k % 2 == 0 for k in of.values())
    sliced = lm.token_hashes(pa.array(texts).slice(3, 4))
    assert sliced[0].tolist() == tokens[sizes[:3].sum() : sizes[:7].sum()].tolist()


def test_parts_of_a_lot_are_hashed_alike(monkeypatch):
    texts = ["some words here", "x" * 50, None, "more of them"] * 30
    whole = lm.token_hashes(pa.array(texts))[0].tolist()
    monkeypatch.setattr(lm, "PART_BYTES", 1)
    assert lm.token_hashes(pa.array(texts))[0].tolist() == whole


def test_numbers_are_packed_and_unpacked():
    numbers = np.array([0, 1, 255, 256, 2**63 + 5, 2**64 - 1], np.uint64)
    assert lm._unpacked(lm._packed(numbers)).tolist() == numbers.tolist()


def test_small_numbers_are_packed_into_few_bytes():
    assert len(lm._packed(np.arange(200, dtype=np.uint64))) <= 201
    assert len(lm._packed(np.zeros(0, np.uint64))) <= 1 and lm._unpacked(lm._packed(np.zeros(0, np.uint64))).tolist() == []
    for numbers in ([7], [0, 1, 2**56 - 1], [2**55 + 2 * i for i in range(300)]):
        packed = lm._packed_ascending(np.array(numbers, np.uint64))
        assert lm._unpacked_ascending(packed).tolist() == numbers
    assert len(packed) < 8 + 2 + 300


def test_every_bucket_has_a_partition_of_its_own(spark):
    texts = [(0, " ".join(f"w{(i * j) % 977}" for j in range(300)), True) for i in range(40)]
    rows = spark.createDataFrame(texts, "partition int, text string, trained boolean").coalesce(1)
    found = lm.answers(lm.questions(rows, 16, 1 << 12), 16).withColumn("task", F.spark_partition_id())
    tasks = found.groupBy("task").agg(F.countDistinct("bucket").alias("n"))
    assert {r["n"] for r in tasks.collect()} == {1} and tasks.count() == 16


def test_every_state_is_a_distribution():
    model = Model(TEXTS)
    words = [*model.words, "never seen"]
    for context in [(), ("a",), ("c",), (BEGIN,), (BEGIN, "a"), ("a", "b"), ("b", "b")]:
        assert sum(model.probability(context, w) for w in words) == pytest.approx(1)


@pytest.mark.parametrize("few", (0, 1000))
@pytest.mark.parametrize("priors", (lm.PRIORS, (0.5, 3.0)))
def test_traversal_matches_the_definition(monkeypatch, few, priors):
    monkeypatch.setattr(lm, "FEW", few)
    rng = random.Random(2)
    held = ["b a", "c b a c b a b", "", "never b seen", "a b a b c a b a b c", *(" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 30))) for _ in range(40))]
    texts = TEXTS + held
    lot, automaton = automaton_of(texts, [True] * len(TEXTS) + [False] * len(held), priors)
    model = Model(TEXTS, priors)
    assert automaton.traverse(lot.sizes) == pytest.approx([model.score(t) for t in texts])


def test_failure_arcs_lead_to_the_shorter_context():
    lot, automaton = automaton_of(["a b c", "b c"], [True, False])
    assert set(automaton.depth.tolist()) == {0, 1, 2}
    for state in np.flatnonzero(automaton.depth == 2):
        assert automaton.depth[automaton.failure[state]] == 1 and automaton.backoff[state] <= 0
    assert (automaton.failure[automaton.depth == 1] == 0).all() and automaton.backoff[0] == 0


def check(spark, rows, **options):
    docs = table(spark, rows, extra=True)
    found = lm.score(docs, training=F.col("doc_id") % 10 != 0, **options).collect()
    model = Model([r[1] for r in rows if r[0] is not None and r[0] % 10])
    want = [(r[0], r[0] is None or r[0] % 10 == 0, *model.row(r[1])) for r in rows]
    assert sorted([(*tuple(r)[:5], round(r.base_score, 6), round(r.score, 6)) for r in found], key=repr) == sorted(want, key=repr)


def test_scores_by_the_definition(spark):
    check(spark, awkward_rows())


@pytest.mark.parametrize("size", (300, 3000))
def test_many_lots_and_buckets_give_the_same(spark, size):
    rows = [r for r in awkward_rows() if len(r[1] or "") < 5000]
    rows += [(900 + i, "seldom seen words " * 2 + "very often here " * 300, None, None, None) for i in range(5)]
    check(spark, rows if size > 300 else rows[:12], lot_bytes=size)


def test_lots_are_cut_by_text_alone():
    texts = ["abc", "defgh", None, "i" * 30, "jj", "", "k" * 9, "l", "m"]
    cut = []
    for step in (1, 2, 3, 20):
        batches = [pa.RecordBatch.from_pydict({"p": [2] * len(texts[i : i + step]), "t": pa.array(texts[i : i + step], pa.string())}) for i in range(0, 9, step)]
        found = {}
        ends = []
        for lot, batch, last in lm.lots(iter(batches), 10):
            found.setdefault(lot, []).extend(batch.column(1).to_pylist())
            ends += [lot] * last
        assert ends == sorted(found) and min(found) == 2 * lm.LOTS_PER_PARTITION
        cut.append(list(found.values()))
    assert all(c == cut[0] for c in cut) and cut[0] == [["abc", "defgh", None, "i" * 30], ["jj", "", "k" * 9], ["l", "m"]]


def test_nothing_to_learn_from(spark):
    assert lm.score(table(spark, [])).count() == 0
    (row,) = lm.score(table(spark, [(1, "a b", None, None, None)]), training=F.lit(False)).collect()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)
    assert row.score == pytest.approx(0) and row.base_score == pytest.approx(0)


def test_a_lot_that_has_changed_is_refused():
    lot = lot_of(["a b c"], [True])
    with pytest.raises(RuntimeError):
        lm.Automaton(lot, [np.ones(2, np.uint64)] * 3, 3, 3)


def test_whole_table_by_the_definition(spark):
    import zlib

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    held = {d for d, _ in rows if zlib.crc32(str(d).encode()) % 10 == 0}
    model = Model([t for d, t in rows if d not in held])
    want = {d: (d in held, *model.row(t)) for d, t in rows}
    found = queries.op10_lm(spark, SF).collect()
    assert {r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in found} == want


def test_context_helps_on_held_out_text(spark):
    found = queries.op10_lm(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1]
