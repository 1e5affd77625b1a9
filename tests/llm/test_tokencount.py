import random

import pytest
from tests.llm.helpers import awkward_rows, collected, table
from tokenizers import Tokenizer

from paysieve.llm import queries, tokencount
from paysieve.llm.packing import default_tokenizer

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    whole = Tokenizer.from_file(default_tokenizer())
    return lambda text: len(whole.encode(text or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def own():
    return tokencount.Counting(default_tokenizer())


def test_classes_of_all_settled_code_points(own):
    """Where the pattern cuts, the library cuts, for every code point that is left to the pattern."""
    for point in range(0x110000):
        if 0xD800 <= point < 0xE000 or tokencount.SETTLED.search(chr(point)):
            continue
        text = f"a{chr(point)}1 {chr(point)}{chr(point)}!"
        spans = [span for _, span in own.library.pre_tokenize_str(text)]
        assert [m.span() for m in own.pattern.finditer(text)] == spans, hex(point)


def texts():
    rng = random.Random(1)

    def drawn(n, letters):
        return "".join(rng.choice(letters) for _ in range(n))

    return {
        "blanks": " " * 1_000_000,
        "newlines": "\n" * 300_001,
        "one letter": "a" * 100_000,
        "letters": drawn(100_000, "abcdefgh"),
        "han": "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(50_000)),
        "mixture": drawn(50_000, "aàαж中 \n'1!­ \U0001f600"),
        "any": "".join(chr(rng.choice([rng.randint(0, 0x2FFF), rng.randint(0x10000, 0x1FFFF)])) for _ in range(40_000)),
        "unassigned": "՘a͸ \U000e0fff" * 50,
        "pairs": "ab" * 3000 + "abc" * 3000 + "the" * 4000,
        "endings": "i'll we've 'tis's I'M don't" * 50,
        "special": "<|endoftext|>",
        "specials": " <|endoftext|><|endoftext|> a <|endoftext|>\n<|endoftext|",
    }


@pytest.mark.parametrize("name", texts())
def test_counts_are_the_library_s(own, library, name):
    text = texts()[name]
    assert own.count(["x", text, ""]) == [1, library(text), 0]


@pytest.mark.parametrize("long", (1, 4, 1 << 30))
def test_rounds_and_queue_merge_alike(own, library, monkeypatch, long):
    monkeypatch.setattr(tokencount, "LONG", long)
    rng = random.Random(3)
    pieces = ["".join(rng.choice("etaoin s") for _ in range(rng.randint(1, 40))) for _ in range(400)] + ["aaaaa", "zz", "é" * 9, "   "]
    pieces = [p for p in pieces if len(own.pattern.findall(p)) == 1]
    assert own.merges.counts([p.encode() for p in pieces]).tolist() == [library(p) for p in pieces]


def test_memory_of_pieces_is_bounded(library, monkeypatch):
    monkeypatch.setattr(tokencount, "KEPT", 10)
    monkeypatch.setattr(tokencount, "PIECES", 5)
    monkeypatch.setattr(tokencount, "LOT_CHARS", 100)
    own = tokencount.Counting(default_tokenizer())
    rows = [" ".join(str(i * j) for j in range(i)) for i in range(60)]
    assert own.count(rows) == [library(t) for t in rows]


def test_merges_out_of_order_are_refused():
    with pytest.raises(ValueError):
        vocabulary = {chr(c): i for i, c in enumerate(range(0x21, 0x200))} | {"ab": 900, "abc": 901}
        tokencount.Merges(vocabulary, [("ab", "c"), ("a", "b")])


def test_whole_table_is_the_library_s(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = [(r.doc_id, len((r.text or "").encode()), n := library(r.text), n > 1024) for r in rows]
    assert collected(queries.op13_tokens(spark, SF)) == sorted(want, key=repr)


def test_awkward_rows(spark, library):
    rows = awkward_rows()
    want = [(r[0], len((r[1] or "").encode()), n := library(r[1]), n > 50) for r in rows]
    assert collected(tokencount.token_counts(table(spark, rows, extra=True), limit=50)) == sorted(want, key=repr)


def test_empty_table(spark):
    assert tokencount.token_counts(table(spark, [])).count() == 0
