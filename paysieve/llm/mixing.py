"""Mixing sources to target weights by Sainte-Laguë apportionment.

A source's target follows from its weight and a ceiling of ``max_repeats``
times its size.  The documents are dealt to shards by a hash of their id.  In
each shard every source's words, in hash order, are blocks of ``block_words``
words; the shard's blocks are given to the sources by highest quotients
(target / 1, / 3, / 5, ...), so a source has a whole number of blocks per shard.
A quota above the number of blocks takes all of them that many times over; the
rest of it is a seeded systematic selection: every n-th block from a seeded start.

A source with few words in a shard has no block to give that is full, and shares below half a block.  Cells of fewer than
``least_blocks`` blocks therefore give their share in words, rounded by a seeded draw, and take
no part in the shard's blocks.

Quotients are not listed block by block.  For S sources and N blocks the
divisor at which the seats add up to N lies between those that give each source its
exact share of N - S/2 and of N + S/2, so all but about 2 S quotients are known to win or lose.

Only sizes are shuffled, once, by shard and source: a source that holds most
rows is spread over as many shards as its words call for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysieve.llm.common import WORD, stored

WEIGHTS = (1, 2, 3)


def word_count(text_column: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")


def hash32(*parts: Column) -> Column:
    """The first 32 bits of the MD5 of the parts' text, NULL being empty: the same in any engine."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """(source, turn, source_size, target, total) of rows (source, size).

    Sources in code point order, NULL last, have the weights in turn.  Targets
    add up to the total of all sizes; one above ``max_repeats`` times its
    source's size is held there and the rest is shared again by weight.  One
    row per source is brought together, nothing larger.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = by_source.withColumn("__turn", turn).withColumn(
        "__weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod("__turn", F.lit(len(weights))) + 1)
    )
    # Ceilings are reached in the order of ceiling over weight: with those before
    # held, is a source's share of what is left above its own ceiling?
    ceiling = F.lit(max_repeats) * F.col("source_size")
    before = Window.orderBy("__ratio", "__turn").rowsBetween(Window.unboundedPreceding, -1)
    shared = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("__weights", F.sum("__weight").over(everything))
        .withColumn("__ratio", ceiling / F.col("__weight"))
        .withColumn("__held", F.coalesce(F.sum(ceiling).over(before), F.lit(0)))
        .withColumn("__gone", F.coalesce(F.sum("__weight").over(before), F.lit(0)))
        .withColumn("__share", (F.col("total") - F.col("__held")) / (F.col("__weights") - F.col("__gone")))
        .withColumn("__free", F.col("__ratio") > F.col("__share"))
        .withColumn("__level", F.max(F.when(F.col("__free"), F.col("__share"))).over(everything))
    )
    target = F.when(F.col("__free"), F.col("__weight") * F.col("__level")).otherwise(ceiling.cast("double"))
    return shared.select("source", F.col("__turn").alias("turn"), "source_size", target.alias("target"), "total")


def _quotas(cells: DataFrame, block_words: int, max_repeats: int) -> DataFrame:
    """(shard, turn, blocks, quota) of cells (shard, turn, words, share), ``share``
    being the words a cell should give: the shard's blocks by highest quotients."""
    shard = Window.partitionBy("__shard")
    n = F.col("__seats")
    exact = F.when(F.col("__shares") > 0, F.col("__share") / F.col("__shares")).otherwise(F.lit(0.0))
    half = F.col("__sources") / 2
    bounded = (
        cells.withColumn("__shares", F.sum("__share").over(shard))
        .withColumn("__sources", F.count(F.lit(1)).over(shard))
        .withColumn("__seats", F.round(F.col("__shares") / block_words).cast("long"))
        .withColumn("__sure", F.greatest(F.floor(exact * (n - half) + 0.5) - 1, F.lit(0)).cast("long"))
        .withColumn("__most", (F.floor(exact * (n + half) + 0.5) + 1).cast("long"))
        .withColumn("__open", F.col("__seats") - F.sum("__sure").over(shard))
    )
    cell = [F.col("__shard"), F.col("__turn"), F.col("__words"), F.col("__sure"), F.col("__share")]
    seats = bounded.select(
        *cell, "__open", F.explode(F.sequence(F.col("__sure") + 1, F.col("__most"))).alias("__seat")
    ).withColumn("__quotient", F.col("__share") / (2 * F.col("__seat") - 1))
    order = shard.orderBy(F.col("__quotient").desc(), "__turn", "__seat")
    won = (F.col("__rank") <= F.col("__open")) & (F.col("__share") > 0)
    blocks = F.ceil(F.col("__words") / block_words).cast("long")
    return (
        seats.withColumn("__rank", F.row_number().over(order))
        .groupBy("__shard", "__turn", "__words", "__sure")
        .agg(F.count_if(won).alias("__won"))
        .select(
            "__shard",
            "__turn",
            F.greatest(blocks, F.lit(1)).alias("__blocks"),
            F.least(F.col("__sure") + F.col("__won"), max_repeats * blocks).alias("__quota"),
        )
    )


def _word_quotas(cells: DataFrame, max_repeats: int, seed: int) -> DataFrame:
    """As ``_quotas``, in blocks of one word (``__unit``): each cell's share, rounded up with the odds of its fraction."""
    draw = hash32(F.lit(seed), F.lit("round"), F.col("__shard"), F.col("__turn")) / (1 << 32)
    return cells.select(
        "__shard",
        "__turn",
        F.greatest("__words", F.lit(1)).cast("long").alias("__blocks"),
        F.least(F.floor(F.col("__share") + draw).cast("long"), max_repeats * F.col("__words")).alias("__quota"),
        F.lit(1).alias("__unit"),
    )


def mix(
    docs: DataFrame,
    *,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = 3,
    block_words: int = 64,
    shard_words: int = 1 << 18,
    least_blocks: int = 0,
    seed: int = 7,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    size_column: str | None = None,
) -> DataFrame:
    """``docs`` with size, source_size, target and taken.

    ``size`` is the number of words, or what ``size_column`` says (sizes are read three times), ``taken`` how many of them the mix takes,
    repeats counted, at most ``max_repeats`` times the size.  NULL texts have
    size 0 and are taken 0 times; a NULL source is a source like any other, and so is
    an empty one.  Rows that agree in id and size are interchangeable.  Columns named as the
    results are replaced, all others are passed on.  An empty table gives no rows.  Reruns agree.
    """
    results = ("size", "source_size", "target", "taken")
    own = [c for c in docs.columns if c not in results]
    size = word_count(text_column) if size_column is None else F.col(size_column)
    sized = docs.select(*own, size.alias("__size"), F.col(source_column).alias("__source"))
    sizes = sized.select(F.col("__source").alias("source"), F.col("__size").alias("size"))
    targets = stored(source_targets(sizes, weights=weights, max_repeats=max_repeats), "targets")
    goals = targets.select(
        F.col("source").alias("__of"),
        F.col("turn").alias("__turn"),
        F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"),
        F.col("total").alias("__total"),
    )
    shards = F.greatest(F.ceil(F.col("__total") / shard_words), F.lit(1))
    # from here on a source is its number, which is never NULL
    dealt = (
        sized.join(goals, F.col("__source").eqNullSafe(F.col("__of")))
        .withColumn("__hash", hash32(F.lit(seed), F.col(id_column)))
        .withColumn("__shard", F.pmod("__hash", shards))
    )
    cells = dealt.groupBy("__shard", "__turn").agg(
        F.sum("__size").alias("__words"), F.first(F.col("__target") / F.greatest("__source_size", F.lit(1))).alias("__rate")
    )
    cells = cells.withColumn("__share", F.col("__rate") * F.col("__words"))
    unit = F.lit(block_words)
    if least_blocks:
        few = F.col("__words") < least_blocks * block_words
        quotas = _quotas(cells.where(~few), block_words, max_repeats).withColumn("__unit", F.lit(block_words))
        quotas = quotas.unionByName(_word_quotas(cells.where(few), max_repeats, seed))
        unit = F.col("__unit")
    else:
        quotas = _quotas(cells, block_words, max_repeats)

    # hash first; the id again, as two ids may share a hash
    order = Window.partitionBy("__shard", "__turn").orderBy("__hash", id_column, "__size")
    placed = dealt.withColumn(
        "__end", F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).join(quotas, ["__shard", "__turn"])
    n, extra = F.col("__blocks"), F.col("__quota") % F.col("__blocks")
    start = F.pmod(hash32(F.lit(seed), F.lit("start"), F.col("__shard"), F.col("__turn")), n)

    def selected(blocks: Column) -> Column:
        """How many of the first blocks the seeded selection holds."""
        return F.floor((blocks * F.col("__extra") + F.col("__start")).cast("decimal(38,0)") / n).cast("long")

    def words(upto: Column) -> Column:
        whole = F.floor(upto / unit).cast("long")
        return selected(whole) * unit + (upto - whole * unit) * (selected(whole + 1) - selected(whole))

    size = F.col("__size")
    rest = words(F.col("__end")) - words(F.col("__end") - size)
    return (
        placed.withColumn("__extra", extra)
        .withColumn("__start", start)
        .select(
            *own,
            size.alias("size"),
            F.col("__source_size").alias("source_size"),
            F.col("__target").alias("target"),
            (F.floor(F.col("__quota") / n) * size + rest).cast("long").alias("taken"),
        )
    )


def repeated(mixed: DataFrame, *, seed: int = 7, id_column: str = "doc_id") -> DataFrame:
    """Each document as many times as the mix takes it: once per full taking, and
    once more with the odds, seeded by the id, of what is left.  Columns of the mix are dropped."""
    size, taken = F.col("size"), F.col("taken")
    whole = F.when(size > 0, F.floor(taken / size)).otherwise(0)
    odds = F.when(size > 0, (taken - whole * size) / size).otherwise(0.0)
    once_more = (hash32(F.lit(seed), F.lit("repeat"), F.col(id_column)) < odds * (1 << 32)).cast("int")
    own = [c for c in mixed.columns if c not in ("size", "source_size", "target", "taken")]
    return mixed.withColumn("__times", F.explode(F.array_repeat(F.lit(1), (whole + once_more).cast("int")))).select(own)


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM by_source),
ratios AS (
  SELECT *, sum(source_size) OVER ()::BIGINT AS total, sum(weight) OVER () AS weights,
         (3 * source_size)::DOUBLE / weight AS ratio FROM ranked),
shared AS (
  SELECT *, (total - coalesce(sum(3 * source_size) OVER w, 0))::DOUBLE / (weights - coalesce(sum(weight) OVER w, 0))::DOUBLE AS share
  FROM ratios WINDOW w AS (ORDER BY ratio, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, turn, source_size, total,
         CASE WHEN ratio > share THEN weight * max(CASE WHEN ratio > share THEN share END) OVER ()
              ELSE (3 * source_size)::DOUBLE END AS target FROM shared),
dealt AS (
  SELECT s.*, t.turn, t.source_size, t.target, ('0x' || md5('7|' || s.doc_id)[1:8])::BIGINT AS h, t.total
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
placed AS (SELECT *, h % greatest(ceil(total / 262144.0)::BIGINT, 1) AS shard FROM dealt),
cells AS (
  SELECT shard, turn, sum(size)::BIGINT AS words,
         any_value(target / greatest(source_size, 1)) * sum(size)::DOUBLE AS share
  FROM placed GROUP BY shard, turn),
totals AS (SELECT shard, round(sum(share) / 64)::BIGINT AS blocks FROM cells WHERE words >= 4096 GROUP BY shard),
seats AS (
  SELECT c.shard, c.turn, row_number() OVER (PARTITION BY c.shard ORDER BY c.share / (2 * k - 1) DESC, c.turn, k) AS place, t.blocks
  FROM cells c JOIN totals t USING (shard), range(1, 100000) r(k)
  WHERE c.words >= 4096 AND c.share > 0 AND k <= c.share / 64 * 1.5 + 3),
won AS (SELECT shard, turn, count(*) AS seats FROM seats WHERE place <= blocks GROUP BY shard, turn),
quotas AS (
  SELECT c.shard, c.turn, ceil(c.words / 64.0)::BIGINT AS n, 64 AS unit,
         least(coalesce(w.seats, 0), 3 * ceil(c.words / 64.0)::BIGINT) AS quota
  FROM cells c LEFT JOIN won w USING (shard, turn) WHERE c.words >= 4096
  UNION ALL
  SELECT shard, turn, greatest(words, 1), 1,
         least(floor(share + ('0x' || md5('7|round|' || shard || '|' || turn)[1:8])::BIGINT::DOUBLE / 4294967296::DOUBLE)::BIGINT,
               3 * words) FROM cells WHERE words < 4096),
chosen AS (
  SELECT p.*, q.n, q.unit, q.quota // q.n AS full_times, q.quota % q.n AS extra,
         ('0x' || md5('7|start|' || p.shard || '|' || p.turn)[1:8])::BIGINT % q.n AS start,
         sum(p.size) OVER (PARTITION BY p.shard, p.turn ORDER BY p.h, p.doc_id, p.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS stop
  FROM placed p JOIN quotas q USING (shard, turn)),
ends AS (SELECT *, unnest([stop - size, stop]) AS x, unnest([-1, 1]) AS sign FROM chosen),
upto AS (
  SELECT *, ((x // unit) * extra + start) // n * unit
          + (x % unit) * (((x // unit + 1) * extra + start) // n - ((x // unit) * extra + start) // n) AS w FROM ends)
SELECT doc_id, size, source_size, target, (full_times * size + sum(sign * w))::BIGINT AS taken
FROM upto GROUP BY doc_id, size, source_size, target, full_times, stop, shard, turn
"""
