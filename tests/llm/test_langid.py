import random
import sys
import time

import numpy as np
import pytest
from tests.llm.helpers import awkward_rows, table
from pyspark.sql import functions as F

from paysieve.llm import langid

REFERENCES = {"aa": "the cat sat on the mat and the dog", "bb": "der hund und die katze", "cc": "le chat noir"}


def phrases(text, reference):
    """Longest pieces that occur in the reference, by trying."""
    count = at = 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in reference:
            end += 1
        count, at = count + 1, end
    return count


def reduced(text):
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    return "".join(c for i, c in enumerate(letters) if c != " " or (i and letters[i - 1] != " "))


def test_phrases_match_trying():
    parser = langid.Parser(REFERENCES)
    rng = random.Random(2)
    texts = ["", "a", "zzz", "the cat", "hund und cat", *("".join(rng.choice("thecatdr un") for _ in range(rng.randint(1, 60))) for _ in range(80))]
    found = parser.phrases([parser.codes(t) for t in texts])
    for row, lang in enumerate(parser.languages):
        assert found[row].tolist() == [phrases(reduced(t), reduced(REFERENCES[lang])) for t in texts]


def large_alphabets(seed=4, letters=3000, length=32 * 1024):
    rng = random.Random(seed)
    first = {"h1": 0x4E00, "h2": 0x4E00 + 1500, "ko": 0xAC00, "yi": 0xA000 - 0x1000}
    return {lang: "".join(" " if rng.random() < 0.1 else chr(at + int(letters * rng.random() ** 2)) for _ in range(length)) for lang, at in first.items()}


def test_large_alphabets_fit_in_memory_and_phrases_match_trying():
    references = large_alphabets()
    parser = langid.Parser(references)
    held = parser.table.nbytes + parser.keys.nbytes + parser.targets.nbytes + sys.getsizeof(parser.arcs) + 64 * len(parser.arcs)
    assert held < 300 << 20 and parser.rare > 4000
    rng = random.Random(1)
    texts = [r[at : at + 60] for r in references.values() for at in range(100, 1100, 100)] + ["latin 東京 \uac01\uac02", "x" * 30]
    texts += ["".join(rng.choice(rng.choice([*references.values()])) for _ in range(50)) for _ in range(20)]
    codes = [parser.codes(t) for t in texts]
    found = parser.phrases(codes)
    for row, lang in enumerate(parser.languages):
        reference = reduced(references[lang])
        assert found[row].tolist() == [phrases(reduced(t), reference) for t in texts]
    alone = [parser.phrases([c])[:, 0].tolist() for c in codes]
    assert alone == found.T.tolist()
    assert all(parser.predict([r[500:900]])[0] == [lang] for lang, r in references.items())


@pytest.mark.parametrize("entries", (0, 200, 500, 1 << 25))
def test_dense_and_sparse_arcs_agree(monkeypatch, entries):
    monkeypatch.setattr(langid, "TABLE", entries)
    parser = langid.Parser(REFERENCES)
    rng = random.Random(2)
    texts = ["".join(rng.choice("thecatdr unzß") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    found = parser.phrases([parser.codes(t) for t in texts])
    for row, lang in enumerate(parser.languages):
        assert found[row].tolist() == [phrases(reduced(t), reduced(REFERENCES[lang])) for t in texts]


def test_many_languages():
    references = {f"l{i:03}": " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{j}x" for j in range(50)) for i in range(120)}
    parser = langid.Parser(references)
    assert parser.predict(["ca zx ca x ca", references["l077"][10:60]])[0][1] == "l077"


def test_a_long_text_takes_seconds():
    parser = langid.Parser(REFERENCES)
    text = "the cat and der hund zzz " * 60_000
    start = time.perf_counter()
    found = parser.predict([text])[0]
    assert time.perf_counter() - start < 10 and found == [parser.predict([text[:2500]])[0][0]]


def test_letters_of_no_reference_are_phrases_of_their_own():
    parser = langid.Parser({"aa": "ab ab"})
    assert parser.phrases([parser.codes("東京ab")]).tolist() == [[3]]


def test_rows_pass_and_texts_without_letters_are_undetermined(spark):
    rows = awkward_rows()
    docs = table(spark, rows, extra=True)
    found = langid.identify(docs, langid.learn(docs)).collect()
    assert len(found) == len(rows)
    for r in found:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("xx", "yy") and 0.5 <= r.score <= 1
        assert r["size"] == "other"


def test_nothing_to_learn_from(spark):
    docs = table(spark, [(1, "some text", None, None, None)])
    assert langid.learn(docs) == {}
    assert [tuple(r)[-2:] for r in langid.identify(docs, {}).collect()] == [("und", 0.0)]
    assert langid.identify(table(spark, []), REFERENCES).count() == 0
    assert langid.learn(table(spark, [])) == {}


def test_the_sample_is_bounded_and_labels_of_others_teach_nothing(spark):
    docs = table(spark, [(i, f"word{i} " * 50, "xx", None, None) for i in range(50)] + [(99, "secret", "yy", None, None)])
    found = langid.learn(docs, where=F.col("doc_id") != 99, rows_per_language=3, chars_per_row=20)
    assert set(found) == {"xx"} and len(found["xx"]) == 3 * 21


def test_held_out_accuracy(spark):
    from paysieve.llm.queries import op3_language

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = op3_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right = np.mean([r.lang == r.lang_pred for r in found.collect()])
    assert right > 0.95


def test_fit_is_letters_per_phrase(spark):
    docs = table(spark, [(1, "the cat sat", None, None, None), (2, "東京都庁", None, None, None), (3, "12", None, None, None)], extra=True)
    found = {r.doc_id: r.score_fit for r in langid.identify(docs, REFERENCES, fit_column="score_fit").collect()}
    assert found == {1: 9.0, 2: 1.0, 3: 0.0}
