"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and gives a table that is written and
read again as the next one's ``docs``.  All but the last keep the columns of
``docs``; they accept NULLs in any column, repeated rows, empty tables and
further columns as the operators do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysieve.llm import langid, mixing, packing, secrets, simhash
from paysieve.llm.common import stored


# A text of this many letters whose phrases have fewer letters on average is in none of the languages.
LEAST_LETTERS, LEAST_FIT = 20, 1.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled rows teach; a missing ``lang`` is filled in.

    What goes: texts that are NULL or have no letter, and texts of which no language knows
    more than single letters, as of an unknown script or a mere key.  Where no row teaches anything, all with a letter stay.
    """
    references = langid.learn(docs)
    found = langid.identify(docs, references, lang_column="__lang", score_column="__score", fit_column="__fit")
    letters = F.length(F.regexp_replace("text", r"\P{L}+", ""))
    if references:
        fits = (F.col("__lang") != langid.UNDETERMINED) & ((F.col("__fit") >= LEAST_FIT) | (letters < LEAST_LETTERS))
        named = F.coalesce("lang", F.when(F.col("__lang") != langid.UNDETERMINED, F.col("__lang")))
        # letters of a newer Unicode than the parser's are letters still
        kept = found.where(fits | ((F.col("__lang") == langid.UNDETERMINED) & (letters > 0)))
        return kept.withColumn("lang", named).select(docs.columns)
    return found.where(letters > 0).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group of close fingerprints.

    Rows are numbered by their place in the stored table, so that ids may be
    NULL or repeated; a scan of the same files numbers them alike each time.
    """
    numbered = docs.withColumn("__row", F.monotonically_increasing_id())
    groups = simhash.near_duplicates(numbered, id_column="__row")
    first = groups.where(F.col("__row") == F.col("component_id")).select("__row")
    return numbered.join(first, "__row", "left_semi").select(docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` follows the text."""
    clean = secrets.redacted(secrets.with_spans(docs, output="__spans", pieces=True), spans_column="__spans")
    return clean.withColumn(
        "n_chars", F.when(F.size("__spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, zero to three times."""
    whole = docs.select(F.struct(*docs.columns).alias("__document"), "doc_id", "text", "source")
    return mixing.repeated(mixing.mix(whole, least_blocks=64)).select("__document.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a sequence."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", without_secrets),
    ("mixing", mix),
    ("packing", pack),
]

# Cross-parsing, fingerprints and packing are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the last stage.  When they are read, ``paysieve.sources.remove_scratch`` deletes what the stages have stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
