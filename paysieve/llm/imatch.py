"""I-Match fingerprints over randomised lexicons.

The lexicon is all terms whose inverse document frequency lies in a band: not so
common that every text has them, not so rare that one edit decides.  A text's
distinct lexicon terms are sorted, and for each of several random subsets of the
lexicon those in it are hashed.  A subset's hash survives an edit that
touches none of its terms, so the share of equal hashes tells how alike two
texts are.  Subsets come in three sizes, for texts of few and of many terms;
those that hold no term of either text do not count.  A text without any term in
the band stands for itself: all its terms are hashed, as if they were in the lexicon.

Terms are words in lower case.  Everything is expressions: the lexicon is a
constant in them, bounded by the average number of terms over the band's
lower end, however many documents there are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysieve.llm.common import WORD, stored

# Least and greatest share of the documents that hold a term: idf of ln 5 to ln 100.
BAND = (0.01, 0.20)
# A term's place among 16, 64 and 256 parts of the lexicon; the parts that are hashed.
SUBSETS = ((16, 16), (64, 24), (256, 24))
DIGITS = 4
PARTS = 1 << 20  # of a bucket that one id fills, at most
EMPTY = "-" * DIGITS


def terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def lexicon(docs: DataFrame, *, band: tuple[float, float] = BAND, text_column: str = "text") -> list[str]:
    """The terms in the band, in order.

    Copies of a text count once, so that no group of copies moves the band; the
    empty text counts as well.  Texts are shuffled once by their hash, after each task has
    dropped its copies, and one row per task and term.  At
    most (average distinct terms) / band[0] terms reach the driver.
    """
    low, high = band
    texts = docs.select(F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    different = texts.groupBy(F.md5("text").alias("hash")).agg(F.any_value("text").alias("text"))
    frequency = (
        # the number of texts is the count of a term that is no word
        different.select(F.explode(F.concat(terms(F.col("text")), F.array(F.lit(" ")))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counted = stored(frequency, "terms")
    total = counted.where("term = ' '").select("n").first()
    total = total[0] if total else 0
    kept = counted.where((F.col("n") >= math.ceil(low * total)) & (F.col("n") <= math.floor(high * total)) & (F.col("term") != " "))
    return [r["term"] for r in kept.select("term").orderBy("term").collect()]


def with_fingerprint(docs: DataFrame, words: list[str], text_column: str, output: str) -> DataFrame:
    """``docs`` with the hashes of all subsets in one string, ``DIGITS`` hexadecimal digits each."""
    subsets = [(i, part) for i, (_, used) in enumerate(SUBSETS) for part in range(used)]
    def parts(term: Column) -> Column:
        digest = F.md5(term)
        places = [
            (F.conv(F.substring(digest, 1 + 4 * i, 4), 16, 10).cast("int") % of).alias(f"p{i}")
            for i, (of, _) in enumerate(SUBSETS)
        ]
        return F.struct(term.alias("term"), *places)

    def hashed(found: Column) -> Column:
        return F.when(
            F.size(found) > 0, F.substring(F.md5(F.array_join(F.transform(found, lambda t: t["term"]), " ")), 1, DIGITS)
        ).otherwise(F.lit(EMPTY))

    # an IN list of literals is looked up in a hash set
    quoted = ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)
    in_band = F.expr(f"filter(__terms, t -> t IN ({quoted}))") if words else F.array().cast("array<string>")
    chosen = (
        docs.withColumn("__terms", terms(F.col(text_column)))
        .withColumn("__band", in_band)
        .withColumn("__terms", F.array_sort(F.when(F.size("__band") > 0, F.col("__band")).otherwise(F.col("__terms"))))
        .drop("__band")
    )

    def subset(i: int, part: int) -> Column:
        return F.filter("__parts", lambda t: t[f"p{i}"] == part)

    own = F.array(*[subset(i, part) for i, part in subsets])
    return (
        chosen.withColumn("__parts", F.transform("__terms", parts))
        .withColumn(output, F.array_join(F.transform(own, hashed), ""))
        .drop("__terms", "__parts")
    )


def likeness(one: Column, other: Column) -> Column:
    """Share of equal hashes among the subsets with a term of either text; equal fingerprints are 1."""
    at = F.sequence(F.lit(0), F.lit(sum(n for _, n in SUBSETS) - 1))

    def cut(fingerprint: Column, i: Column) -> Column:
        return F.substring(fingerprint, i * DIGITS + 1, F.lit(DIGITS))

    used = F.filter(at, lambda i: (cut(one, i) != EMPTY) | (cut(other, i) != EMPTY))
    same = F.filter(at, lambda i: (cut(one, i) != EMPTY) & (cut(one, i) == cut(other, i)))
    share = F.size(same) / F.greatest(F.size(used), F.lit(1))
    return F.when(one == other, F.lit(1.0)).otherwise(share.cast("double"))


def id_edges(docs: DataFrame, id_column: str, wanted: int) -> list[int]:
    """Ids that cut the rows into about equal buckets; an id with more rows than a bucket gets one of its own."""
    if wanted < 2:
        return []
    shares = [i / wanted for i in range(1, wanted)]
    found = docs.agg(F.percentile_approx(F.col(id_column).cast("long"), shares, 4 * wanted)).first()[0] or []
    return sorted({*found, *(a + 1 for a, b in zip(found, found[1:]) if a == b)})


def _bucket(id_: Column, edges: list[int]) -> Column:
    """How many edges are not above the id, found in two steps; NULL ids are before all others."""
    if not edges:
        return F.when(id_.isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("long")
    step = math.isqrt(len(edges)) + 1

    def listed(numbers: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")

    def passed(numbers: Column) -> Column:
        return F.size(F.filter(numbers, lambda edge: edge <= id_))

    whole = F.greatest(passed(listed(edges[::step])) - 1, F.lit(0)) * step
    return F.when(id_.isNull(), F.lit(-1)).otherwise(whole + passed(F.slice(listed(edges), whole + 1, F.lit(step)))).cast("long")


def with_next(
    docs: DataFrame, columns: list[str], *, id_column: str, text_column: str, bucket_rows: int = 256, buckets: int = 1 << 16
) -> DataFrame:
    """``docs`` with, as ``__next_<column>``, values of the next row by descending id
    (NULL last, equal ids by the MD5 of the text); after the last comes the first.

    Rows go to buckets between quantiles of the ids, at most ``buckets`` of them, and are ordered
    there, so a few ids far from the others make no difference.  A bucket of one
    id alone, or of NULL, is cut by the hash into as many as its rows call for.  A
    bucket's first row also goes, as a guest, to the bucket whose last row it follows;
    which rows these are is a table of one row per bucket, and broadcast.
    """
    total = docs.count()
    edges = id_edges(docs, id_column, max(1, min(buckets, math.ceil(total / bucket_rows))))
    id_ = F.col(id_column)
    hashed = docs.withColumn("__hash", F.md5(text_column)).withColumn("__bucket", _bucket(id_, edges))
    # one row per bucket: those of a single id that are too large, with the number of their parts
    large = (
        hashed.groupBy("__bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min(id_column).alias("low"), F.max(id_column).alias("high"))
        .where((F.col("n") > 4 * max(bucket_rows, math.ceil(total / buckets))) & F.col("low").eqNullSafe(F.col("high")))
        .select(F.col("__bucket").alias("__large"), F.least(F.ceil(F.col("n") / bucket_rows), F.lit(PARTS)).alias("__parts"))
    )
    share = F.conv(F.substring("__hash", 1, 8), 16, 10).cast("long") / (1 << 32)
    part = F.coalesce(F.floor(share * F.col("__parts")), F.lit(0))
    # ascending in the order of the rows
    slot = (-F.col("__bucket") * PARTS + part).cast("long")
    placed = hashed.join(F.broadcast(large), F.col("__bucket") == F.col("__large"), "left").withColumn("__at", slot)
    order = Window.orderBy("__at")
    tops = (
        placed.groupBy("__at")
        .agg(F.min(F.struct(F.bitwise_not(id_.cast("long")).alias("turned"), "__hash")).alias("top"))
        .select(
            F.col("__at").alias("__of"),
            F.bitwise_not("top.turned").alias("__top_id"),
            F.col("top.__hash").alias("__top_hash"),
            F.coalesce(F.lag("__at").over(order), F.max("__at").over(Window.partitionBy())).alias("__guest_of"),
        )
    )
    first = (
        (F.col("__at") == F.col("__of")) & id_.cast("long").eqNullSafe(F.col("__top_id")) & (F.col("__hash") == F.col("__top_hash"))
    )
    slots = F.when(F.col("__of").isNull(), F.array("__at")).otherwise(F.array("__at", "__guest_of"))
    sent = placed.join(F.broadcast(tops), first, "left").select(
        *docs.columns, "__hash", F.posexplode(slots).alias("__guest", "__slot")
    )
    ordered = Window.partitionBy("__slot").orderBy("__guest", id_.desc_nulls_last(), "__hash")
    ahead = [F.lead(c).over(ordered).alias(f"__next_{c}") for c in columns]
    return sent.select(*docs.columns, "__guest", *ahead).where(F.col("__guest") == 0).drop("__guest")


def fingerprints(
    docs: DataFrame, *, band: tuple[float, float] = BAND, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last n_chars // 2 code points replaced
    by as many of the next document's first, by descending id, or by all of
    them.  NULL texts are empty.  A text without words has the empty
    fingerprint, which is like itself alone.  NULL ids come last; rows of one id are ordered by their text's MD5; other
    columns are not read; an empty table gives no rows.  A very long text costs in proportion to its length.
    """
    rows = docs.select(F.col(id_column).alias("__id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("__text"))
    words = lexicon(rows, band=band, text_column="__text")
    own = with_fingerprint(rows, words, "__text", "__own")
    paired = with_next(own, ["__text", "__own"], id_column="__id", text_column="__text")
    chars = F.length("__text")
    lost = F.floor(chars / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("__text"), F.lit(1), chars - lost), F.substring(F.col("__next___text"), F.lit(1), lost)
    )
    found = with_fingerprint(paired.withColumn("__edited", edited), words, "__edited", "__edited_print")
    return found.select(
        F.col("__id").alias(id_column),
        chars.cast("long").alias("n_chars"),
        F.sha2("__edited", 256).alias("edited_sha256"),
        F.col("__own").alias("fingerprint"),
        F.col("__edited_print").alias("edited_fingerprint"),
        likeness(F.col("__own"), F.col("__edited_print")).alias("near_edited"),
        likeness(F.col("__own"), F.col("__next___own")).alias("near_next"),
    )


IMATCH_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC, md5(coalesce(text, ''))),
                  first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC, md5(coalesce(text, '')))) AS following,
         row_number() OVER () AS id,
         row_number() OVER (ORDER BY doc_id DESC, md5(coalesce(text, ''))) AS place FROM documents),
texts AS (
  SELECT id, 0 AS edited, text FROM docs
  UNION ALL SELECT id, 1, text[1:n_chars - n_chars // 2] || following[1:n_chars // 2] FROM docs),
words AS (
  SELECT id, edited, unnest(list_distinct(regexp_extract_all(lower(text), '[^ 	-
]+'))) AS term FROM texts),
different AS (SELECT DISTINCT text FROM docs),
band AS (
  SELECT term FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+'))) AS term FROM different)
  GROUP BY term
  HAVING count(*) >= ceil(0.01 * (SELECT count(*) FROM different)) AND count(*) <= floor(0.20 * (SELECT count(*) FROM different))),
flagged AS (
  SELECT w.*, b.term IS NOT NULL AS in_band, bool_or(b.term IS NOT NULL) OVER (PARTITION BY w.id, w.edited) AS has_band
  FROM words w LEFT JOIN band b USING (term)),
chosen AS (SELECT id, edited, term FROM flagged WHERE in_band OR NOT has_band),
lexicon AS (
  SELECT term, unnest([0, 1, 2]) AS size, md5(term) AS digest FROM (SELECT DISTINCT term FROM chosen)),
parts AS (
  SELECT term, size, ('0x' || digest[1 + 4 * size:4 + 4 * size])::INTEGER % [16, 64, 256][size + 1] AS part FROM lexicon),
hashes AS (
  SELECT id, edited, [0, 16, 40][size + 1] + part AS subset, md5(string_agg(term, ' ' ORDER BY term))[1:4] AS hash
  FROM chosen JOIN parts USING (term) WHERE part < [16, 24, 24][size + 1] GROUP BY id, edited, size, part),
grid AS (
  SELECT t.id, t.edited, string_agg(coalesce(h.hash, '----'), '' ORDER BY s.subset) AS fingerprint
  FROM texts t, range(64) s(subset) LEFT JOIN hashes h ON h.id = t.id AND h.edited = t.edited AND h.subset = s.subset
  GROUP BY t.id, t.edited),
joined AS (
  SELECT d.doc_id, d.n_chars, sha256(x.text) AS edited_sha256, d.place, a.fingerprint, b.fingerprint AS edited_fingerprint
  FROM docs d JOIN texts x ON x.id = d.id AND x.edited = 1
  JOIN grid a ON a.id = d.id AND a.edited = 0 JOIN grid b ON b.id = d.id AND b.edited = 1),
paired AS (
  SELECT *, coalesce(lead(fingerprint) OVER (ORDER BY place), first_value(fingerprint) OVER (ORDER BY place)) AS next_print
  FROM joined),
compared AS (
  SELECT *, list_transform(range(64), lambda i: fingerprint[4 * i + 1:4 * i + 4]) AS f,
         list_transform(range(64), lambda i: edited_fingerprint[4 * i + 1:4 * i + 4]) AS e,
         list_transform(range(64), lambda i: next_print[4 * i + 1:4 * i + 4]) AS n FROM paired),
counted AS (
  SELECT *, len(list_filter(range(1, 65), lambda i: f[i] <> '----' OR e[i] <> '----')) AS used_e,
         len(list_filter(range(1, 65), lambda i: f[i] <> '----' AND f[i] = e[i])) AS same_e,
         len(list_filter(range(1, 65), lambda i: f[i] <> '----' OR n[i] <> '----')) AS used_n,
         len(list_filter(range(1, 65), lambda i: f[i] <> '----' AND f[i] = n[i])) AS same_n FROM compared)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
       CASE WHEN fingerprint = edited_fingerprint THEN 1.0 ELSE same_e::DOUBLE / greatest(used_e, 1) END::DOUBLE AS near_edited,
       CASE WHEN fingerprint = next_print THEN 1.0 ELSE same_n::DOUBLE / greatest(used_n, 1) END::DOUBLE AS near_next
FROM counted
"""
