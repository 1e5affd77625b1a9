"""Substring de-duplication by hashing lines, paragraphs and runs of sentences.

A text is cut into units, each normalised and hashed to 128 bits.  Of all units
of a kind with one digest the earliest is kept, by document id, then by place; the rest
are repeats, and keep the places they had in the original text.

Three kinds of units are looked at.  A line or a paragraph that repeats and has ``least_words``
words is removed.  Passages are pasted into the middle of lines as well, where
no whole line repeats, so sentences are hashed, too: they end at a full stop, question or
exclamation mark or at the end of a line.  A sentence alone is too common to be
a copy: what is removed are runs of neighbouring sentences that all repeat and have
``least_words`` words together, however short each of them is.

Texts are cut and hashed once, into a stored table of digests and places.  Digests are
combined in each task to one row before they are shuffled, then joined with
the stored rows, which adaptive execution splits where one digest is very
common.  Only repeated sentences come together by document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paysieve.llm.common import stored

SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+")
NOT_LETTERS = re.compile(r"[^\w]+|_+")
DIGIT = re.compile(r"[0-9]")
KINDS = ("sentence", "line", "paragraph")

UNIT_SCHEMA = "kind int, place long, start long, length long, n_words int, high long, low long, again boolean"
LAST_ID = (1 << 63) - 1


def normalised(unit: str) -> str:
    """Lower case, words separated by single spaces, digits made 0, no punctuation."""
    return DIGIT.sub("0", NOT_LETTERS.sub(" ", unit.lower())).strip()


class _Group:
    """A line or paragraph as it is gathered from its sentences."""

    __slots__ = ("first", "last", "members", "plain", "words")

    def __init__(self, start: int):
        self.first, self.last, self.members, self.plain, self.words = start, start, 0, [], 0

    def add(self, end: int, plain: str, words: int) -> None:
        self.last = end
        self.plain.append(plain)
        self.words += words
        self.members += 1


def units(text: str | None, least_words: int) -> Iterator[tuple[int, int, int, int, int, int, int, bool]]:
    """(kind, place, start, length, words, digest's halves, whether the text has had it before).

    All sentences with a word; lines of several sentences and paragraphs of
    several lines, if they have ``least_words`` words (those of one are that
    sentence or line).  Lines are parted by a line end, paragraphs by two or more.
    """
    seen: set[tuple[int, bytes]] = set()

    def row(kind: int, place: int, start: int, end: int, plain: str, words: int):
        digest = hashlib.md5(plain.encode(), usedforsecurity=False).digest()
        again = (kind, digest) in seen
        seen.add((kind, digest))
        high, low = int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)
        return kind, place, start, end - start, words, high, low, again

    place = breaks = lines = 0
    line = paragraph = None

    def ended(kind: int, group: _Group | None, members: int):
        if group and members > 1 and group.words >= least_words:
            yield row(kind, -1, group.first, group.last, " ".join(group.plain), group.words)

    for match in SENTENCE.finditer(text or ""):
        unit = match[0]
        plain = normalised(unit)
        if plain:
            if line is None or breaks:
                yield from ended(1, line, line.members if line else 0)
                if paragraph is None or breaks > 1:
                    yield from ended(2, paragraph, lines)
                    paragraph, lines = _Group(match.start()), 0
                line, lines = _Group(match.start()), lines + 1
            words = plain.count(" ") + 1
            yield row(0, place, match.start(), match.end(), plain, words)
            line.add(match.end(), plain, words)
            paragraph.add(match.end(), plain, words)
            place, breaks = place + 1, 0
        breaks += unit.count("\n")
    yield from ended(1, line, line.members if line else 0)
    yield from ended(2, paragraph, lines)


def with_units(docs: DataFrame, *, least_words: int = 20, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per unit: id, and what ``units`` says of it; places and starts count from 0, in code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows += [(doc, *found) for found in units(text.as_py(), least_words)]
                if len(rows) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    names = ["id", "kind", "place", "start", "length", "n_words", "high", "low", "again"]
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
    narrow = docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string"))
    return narrow.mapInArrow(run, "id long, " + UNIT_SCHEMA)


def removals(
    docs: DataFrame, *, least_words: int = 20, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per unit to remove: id, kind, start, length, n_words, and the id of the
    document that keeps the unit (``kept_in``; the row's own, if it repeats itself).

    Ids are whole numbers; a NULL id ranks last.  Rows of one id count as one
    document, whose units are kept in each of them.  NULL and empty texts have no units, an empty table
    gives no rows.  Spans of different kinds may overlap.
    Other columns are not read.  Starts count code points of the whole text.  A very long text is
    cut in one task, at a cost in proportion to its length.
    """
    found = stored(with_units(docs, least_words=least_words, id_column=id_column, text_column=text_column), "units")
    ranked = F.coalesce("id", F.lit(LAST_ID))
    first = stored(
        found.groupBy("kind", "high", "low")
        .agg(F.min(ranked).alias("first"), F.max(ranked).alias("last"), F.max("again").alias("within"))
        .where("first < last OR within")
        .select(F.col("kind").alias("__kind"), F.col("high").alias("__high"), F.col("low").alias("__low"), "first"),
        "repeated",
    )
    same = (F.col("kind") == F.col("__kind")) & (F.col("high") == F.col("__high")) & (F.col("low") == F.col("__low"))
    repeats = found.join(first, same).where(F.col("again") | (ranked > F.col("first")))
    sentences = repeats.where("kind = 0")
    # neighbours have places in a row; a row's copies have the same places, and are one
    order = Window.partitionBy("id").orderBy("place")
    run = sentences.withColumn("__run", F.col("place") - F.dense_rank().over(order))
    together = Window.partitionBy("id", "__run")
    copies = Window.partitionBy("id", "__run", "place")
    run = run.withColumn("__share", F.col("n_words") / F.count(F.lit(1)).over(copies)).withColumn(
        "__words", F.round(F.sum("__share").over(together)).cast("long")
    )
    kept = run.where(F.col("__words") >= least_words).drop("__run", "__share", "__words")
    named = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    return (
        kept.unionByName(repeats.where("kind > 0"))
        .select(
            F.col("id").alias(id_column),
            named.alias("kind"),
            "start",
            "length",
            "n_words",
            F.when(F.col("first") < LAST_ID, F.col("first")).alias("kept_in"),
        )
    )


def without_repeats(docs: DataFrame, removed: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the removed units cut out of their texts, overlapping ones together; other columns stay."""
    spans = removed.groupBy(F.col(id_column).alias("__id")).agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("__spans")
    )
    text = F.col(text_column)

    def step(state, span):
        between = F.greatest(span["start"] - state["at"], F.lit(0))
        kept = F.substring(text, (state["at"] + 1).cast("int"), between.cast("int"))
        end = F.greatest(state["at"], span["start"] + span["length"])
        return F.struct(F.concat(state["text"], kept).alias("text"), end.alias("at"))

    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at"))
    cut = F.aggregate(
        "__spans",
        start,
        step,
        lambda s: F.concat(s["text"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))),
    )
    joined = docs.join(spans, F.col(id_column).eqNullSafe(F.col("__id")), "left")
    return joined.withColumn(text_column, F.when(F.col("__spans").isNotNull(), cut).otherwise(text)).select(docs.columns)


# Lower-casing and letters beyond ASCII are left to the engines' Unicode tables.
REMOVALS_SQL = r"""
WITH pieces AS (
  SELECT doc_id, generate_subscripts(u, 1) AS n, unnest(u) AS unit
  FROM (SELECT doc_id, regexp_extract_all(text, '[^.!?\n]*[.!?\n]+|[^.!?\n]+') AS u FROM documents)),
placed AS (
  SELECT doc_id, n, length(unit) AS length,
         sum(length(unit)) OVER w - length(unit) AS start,
         sum(length(unit) - length(replace(unit, chr(10), ''))) OVER w - (length(unit) - length(replace(unit, chr(10), ''))) AS breaks,
         regexp_replace(trim(regexp_replace(lower(unit), '[^\p{L}\p{N}]+', ' ', 'g')), '[0-9]', '0', 'g') AS plain
  FROM pieces WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
sentences AS (
  SELECT *, length(plain) - length(replace(plain, ' ', '')) + 1 AS n_words, row_number() OVER w AS place,
         coalesce(breaks - lag(breaks) OVER w, 0) AS gap
  FROM placed WHERE plain <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
numbered AS (
  SELECT *, count(*) FILTER (gap > 0) OVER w AS line, count(*) FILTER (gap > 1) OVER w AS paragraph
  FROM sentences WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
units AS (
  SELECT doc_id, 'sentence' AS kind, place, start, length, n_words, plain FROM numbered
  UNION ALL
  SELECT doc_id, 'line', -1, min(start), max(start + length) - min(start), sum(n_words), string_agg(plain, ' ' ORDER BY n)
  FROM numbered GROUP BY doc_id, line HAVING count(*) > 1 AND sum(n_words) >= 20
  UNION ALL
  SELECT doc_id, 'paragraph', -1, min(start), max(start + length) - min(start), sum(n_words), string_agg(plain, ' ' ORDER BY n)
  FROM numbered GROUP BY doc_id, paragraph HAVING count(DISTINCT line) > 1 AND sum(n_words) >= 20),
ranked AS (
  SELECT *, row_number() OVER w AS nth, first_value(doc_id) OVER w AS kept_in
  FROM units WINDOW w AS (PARTITION BY kind, md5(plain) ORDER BY doc_id, start)),
repeated AS (
  SELECT *, place - row_number() OVER (PARTITION BY doc_id, kind ORDER BY place) AS run FROM ranked WHERE nth > 1),
summed AS (SELECT *, sum(n_words) OVER (PARTITION BY doc_id, kind, run) AS run_words FROM repeated)
SELECT doc_id, kind, start::BIGINT AS start, length::BIGINT AS length, n_words::INTEGER AS n_words, kept_in
FROM summed WHERE kind <> 'sentence' OR run_words >= 20
"""
