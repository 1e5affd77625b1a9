"""Small tables with every awkward case in them."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for their results or inside.
CLASHING = (
    "score", "size", "taken", "target", "spans", "fingerprint", "component_id", "component", "sequence_id", "offset",
    "start", "length", "id", "row", "rows", "key", "n", "token", "term", "held_out", "lang_pred", "predicted", "block",
    "shard", "rank", "node", "a", "b", "total", "words", "blocks", "turn", "kind", "low", "high", "first",
)


def table(spark, rows, extra=False):
    found = spark.createDataFrame([tuple(r) for r in rows], SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        found = found.withColumns({name: F.lit("other") for name in CLASHING})
    return found


def words(rng, n, alphabet=("ka", "lo", "mi", "ten", "sur", "vo", "pra", "eq", "hin", "du")):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 3))) for _ in range(n))


def awkward_rows(seed=1):
    """NULLs in any column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(seed)
    rows = [(i, words(rng, rng.randint(1, 80)) + ".", rng.choice(["xx", "yy"]), f"s{i % 3}", 1) for i in range(40)]
    rows += [
        (100, None, "xx", "s0", None),
        (101, "", None, "s1", 0),
        (102, "   \n\t ", "yy", None, 5),
        (None, words(rng, 30), None, None, None),
        (None, None, None, None, None),
        (103, words(rng, 30_000), "xx", "s2", 9),
        (104, "x" * 20_000, "yy", "s2", 9),
        (105, "12345 !!! ...", "yy", "", 9),
        (106, "\U0001f600 été 東京 ÄÖ", "xx", "s0", 9),
        rows[3],
        rows[3],
        (107, rows[5][1], "yy", "s1", 3),
    ]
    return rows


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
