"""Payments of users on a blacklist (our extension)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64  # of a row besides its text
# A Bloom filter has this many bits per user, but no more than so many longs in all (8 MiB).
BITS_PER_USER = 16
MAX_WORDS = 1 << 20
PROBES = 4


def bloom_words(users: int) -> int:
    """Longs of a filter for so many users, a power of two."""
    longs = max(1, -(-users * BITS_PER_USER // 64))
    return min(MAX_WORDS, 1 << (longs - 1).bit_length())


def _probes(user: str, words: int) -> list[tuple[Column, Column]]:
    """(word, bit) of each probe: two hashes give them all."""
    bits = F.lit(words * 64).cast("long")
    first, second = F.pmod(F.xxhash64(user), bits), F.pmod(F.xxhash64(F.lit("second"), user), bits)
    places = [F.pmod(first + F.lit(i) * second, bits) for i in range(PROBES)]
    return [(F.floor(p / 64).cast("int"), (p % 64).cast("int")) for p in places]


def bloom_filter(keys: DataFrame, key: str, words: int) -> DataFrame:
    """One row with an array of ``words`` longs, made of one row per word that has a bit."""
    places = F.array(*[F.struct(word.alias("word"), bit.alias("bit")) for word, bit in _probes(key, words)])
    bits = keys.select(F.explode(places).alias("at")).select(
        F.col("at.word").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at.bit")).alias("bits")
    )
    held = bits.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    every = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("every"))
    whole = every.join(held, F.col("every") == F.col("word"), "left").select("every", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return whole.agg(F.transform(F.sort_array(F.collect_list(F.struct("every", "bits"))), lambda w: w["bits"]).alias("bloom"))


def may_contain(bloom: Column, key: str, words: int) -> Column:
    """False only for keys that the filter does not hold; NULL keys are not in it."""
    found = F.col(key).isNotNull()
    for word, bit in _probes(key, words):
        found = found & (F.get(bloom, word).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bit)) != 0)
    return F.coalesce(found, F.lit(False))


def with_blacklist(
    payments: DataFrame,
    blacklist: DataFrame,
    *,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    as_of: str | None = "event_ts",
) -> DataFrame:
    """Add ``blacklist_reason``, ``blacklist_severity`` and ``is_blacklisted``.

    A payment is marked by the latest entry of its user that had been added by
    its ``as_of`` time.  An entry without a time has always been there, and a payment
    without one sees only such entries.  With ``as_of=None``, or where payments
    have no such column, all entries count for all payments.

    The list is broadcast when it measures no more than ``max_broadcast_bytes``,
    which costs one short job.  Of a longer one a Bloom filter of 8 MiB at most goes to the scan:
    payments that it rules out are not shuffled, the others meet the list in a
    join that adaptive execution splits where a listed user is busy.  The
    payments are scanned twice then.  The result is the same.
    A user's entries are one row, in order of time, so no payment is doubled
    however often its user is listed.
    """
    entry = F.struct("added_at", "reason", "severity")
    listed = (
        blacklist.where(F.col("user_id").isNotNull())
        .groupBy(F.col("user_id").alias("__user"))
        # no time sorts before all others
        .agg(F.sort_array(F.collect_set(entry)).alias("__entries"))
    )
    text = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in ("user_id", "reason", "severity")), F.lit(ROW_BYTES))
    size, users = blacklist.agg(F.sum(text), F.approx_count_distinct("user_id")).first()
    same = F.col("user_id") == F.col("__user")
    if (size or 0) <= max_broadcast_bytes:
        joined = payments.join(F.broadcast(listed), same, "left").drop("__user")
    else:
        maybe, ruled_out = split_by_list(payments, listed, users)
        nothing = F.lit(None).cast(listed.schema["__entries"].dataType)
        joined = maybe.join(listed, same, "left").drop("__user").unionByName(ruled_out.withColumn("__entries", nothing))
    known = F.col("__entries")
    if as_of in payments.columns:
        time = F.col(as_of)
        known = F.filter(known, lambda e: e["added_at"].isNull() | F.coalesce(e["added_at"] <= time, F.lit(False)))
    marked = joined.withColumn("__entry", F.try_element_at(known, F.lit(-1)))
    return marked.select(
        *payments.columns,
        F.col("__entry.reason").alias("blacklist_reason"),
        F.col("__entry.severity").alias("blacklist_severity"),
        F.col("__entry").isNotNull().alias("is_blacklisted"),
    )


def split_by_list(payments: DataFrame, listed: DataFrame, users: int) -> tuple[DataFrame, DataFrame]:
    """(payments whose user may be in ``__user`` of the list, payments whose user is not)."""
    words = bloom_words(users)
    bloom = bloom_filter(listed, "__user", words).scalar()
    there = may_contain(bloom, "user_id", words)
    return payments.where(there), payments.where(~there)
