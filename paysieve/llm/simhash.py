"""SimHash fingerprints, and groups of documents whose fingerprints lie close.

Close means at most three differing bits.  Meet in the middle: two fingerprints that differ in two bits
both have the one between them among their variants in one changed bit.  Half
of three is no whole number, so the third bit is met by erasing: the 64 bits
are four blocks, and for each block a fingerprint emits, of the other 48
bits, itself and all variants in one changed bit (4 x 49 keys).  Two
fingerprints at distance three or less share a key in at least one of two ways:

* some block holds exactly one differing bit, or none while at most two differ: without that block they differ
  in two bits at most and meet halfway, and in the erased block they differ in one bit at most;
* one block holds all three: without it they are equal.

So in the bucket of a key it is enough to link members whose erased blocks
differ in at most one bit, and members that are equal to the key and whose
erased blocks differ in at most three.  Both follow from tables of 65,536
places, not from all pairs, whatever the bucket's size; links between buckets are
deduplicated, verified and joined to components.  (Emitting all variants in
two bits would be the same join with 2,081 keys a fingerprint instead of 196.)
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysieve.llm.common import stored, words_of
from paysieve.llm.components import connected_components

MAX_DISTANCE = 3
BLOCK = 16
BLOCKS = 64 // BLOCK
LOW = np.uint64((1 << BLOCK) - 1)
CHUNK = 1 << 15
# Nothing, or one of the 48 bits of a key; and its number beside an erased block.
FLIPS = np.concatenate([[0], 1 << np.arange(64 - BLOCK)]).astype(np.uint64)
CHANGED = (np.arange(64 - BLOCK + 1) << BLOCK).astype(np.int32)


# --- fingerprints ----------------------------------------------------------


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes."""
    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    total = len(starts)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, CHUNK):
        pairs = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        hashes = np.array([digest(joined[s:e], seed) for s, e in pairs], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * ones > total).tolist())


def with_fingerprints(
    docs: DataFrame, *, shingle: int = 3, text_column: str = "text", output: str = "__fingerprint"
) -> DataFrame:
    """``docs`` without the text, with its fingerprint as a signed long."""
    kept = [c for c in docs.columns if c not in (text_column, output)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(0)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(found.view(np.int64))], names=[*kept, output]
            )

    schema = docs.select(kept).schema.add(output, "long")
    return docs.select(F.col(text_column).cast("string"), *kept).mapInArrow(run, schema)


# --- variants --------------------------------------------------------------


def _erased(values: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(the 48 other bits, with the block's number above them; the block)."""
    low = np.uint64(block * BLOCK)
    inside = (values >> low) & LOW
    below = values & np.uint64((1 << (block * BLOCK)) - 1)
    above = (values >> low >> np.uint64(BLOCK)) << low
    return above | below | np.uint64(block << (64 - BLOCK)), inside


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, rest): the rest is what the fingerprint is besides its key, the
    erased block and the number of the changed bit, which shuffles in half the bytes."""
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(values), 4096):
            own = values[at : at + 4096]
            for block in range(BLOCKS):
                key, inside = _erased(own, block)
                keys = (key[:, None] ^ FLIPS[None, :]).ravel()
                rest = (inside.astype(np.int32)[:, None] | CHANGED[None, :]).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(rest)], names=["key", "rest"])


def _restored(keys: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The fingerprints of emitted rows."""
    low = (keys >> np.uint64(64 - BLOCK)) * np.uint64(BLOCK)
    kept = (keys & np.uint64((1 << (64 - BLOCK)) - 1)) ^ FLIPS[rest >> BLOCK]
    inside = (rest & ((1 << BLOCK) - 1)).astype(np.uint64)
    below = kept & ((np.uint64(1) << low) - np.uint64(1))
    return below | inside << low | kept >> low << low << np.uint64(BLOCK)


# --- buckets ---------------------------------------------------------------


_NEAR = [1 << i for i in range(BLOCK)]
_THREE = [*_NEAR, *(sum(c) for n in (2, 3) for c in combinations(_NEAR, n))]


def bucket_links(key: int, members: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what lies close in one bucket; chains, not all pairs."""
    block = key >> (64 - BLOCK)
    kept, inside = _erased(members, block)
    inside = inside.astype(np.int64)
    links = _forest(members, inside, _NEAR, 1)
    exact = kept == np.uint64(key)
    if exact.sum() > 1:
        links += _forest(members[exact], inside[exact], _THREE, MAX_DISTANCE)
    return links


def _forest(members: np.ndarray, places: np.ndarray, masks: list[int], most: int) -> list[tuple[int, int]]:
    """A spanning forest: members of one place hang on its first, and places are
    searched breadth first, by whichever is fewer: the masks or the places left."""
    first: dict[int, int] = {}
    links = []
    for place, member in zip(places.tolist(), members.tolist()):
        if place in first:
            links.append((first[place], member))
        else:
            first[place] = member
    left = set(first)
    queue: list[int] = []
    while left:
        here = queue.pop() if queue else left.pop()
        if len(left) < len(masks):
            close = [p for p in left if (p ^ here).bit_count() <= most]
        else:
            close = [here ^ m for m in masks if here ^ m in left]
        left.difference_update(close)
        queue += close
        links += [(first[here], first[p]) for p in close]
    return links


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key in; links out.  One bucket at a time is held."""
    held_keys, held = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    for batch in batches:
        own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        keys = np.concatenate([held_keys, own])
        members = np.concatenate([held, _restored(own, batch.column(1).to_numpy(zero_copy_only=False))])
        if not len(keys):
            continue
        last = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        yield _found(keys[:last], members[:last])
        held_keys, held = keys[last:], members[last:]
    yield _found(held_keys, held)


def _found(keys: np.ndarray, members: np.ndarray) -> pa.RecordBatch:
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    sizes = np.diff(np.append(starts, len(keys)))
    # two members: whether they are close is all there is to ask
    two = starts[sizes == 2]
    a, b = members[two], members[two + 1]
    close = np.bitwise_count(a ^ b) <= MAX_DISTANCE
    links = np.stack([a[close], b[close]], axis=1)
    more = [
        link
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist())
        for link in bucket_links(int(keys[s]), members[s : s + n])
    ]
    if more:
        links = np.concatenate([links, np.array(more, np.uint64)])
    links = np.unique(np.sort(links, axis=1), axis=0).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(links[:, 0].copy()), pa.array(links[:, 1].copy())], names=["a", "b"])


# --- groups ----------------------------------------------------------------


def close_links(fingerprints: DataFrame) -> DataFrame:
    """(a, b), both signed longs: links that connect all fingerprints at distance
    three or less.  ``fingerprints`` has one distinct, non-NULL long column."""
    variants = fingerprints.mapInArrow(_emit, "key long, rest int")
    placed = variants.repartition("key").sortWithinPartitions("key")
    return (
        placed.mapInArrow(_meet, "a long, b long")
        .distinct()
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_DISTANCE)
    )


def near_duplicates(
    docs: DataFrame, *, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hexadecimal digits) and
    ``component_id``, the smallest id of its group.

    NULL and empty texts have fingerprint zero and are linked like any other.
    Rows with a NULL id are grouped too, but name no group: a group of such
    rows alone has component NULL.  Repeated rows stay; columns but the two
    named are not read; an empty table gives no rows.
    """
    rows = stored(
        with_fingerprints(docs.select(F.col(id_column).alias("__id"), F.col(text_column)), shingle=shingle, text_column=text_column),
        "fingerprints",
    )
    distinct = stored(rows.groupBy("__fingerprint").agg(F.min("__id").alias("__first")), "distinct")
    near = connected_components(close_links(distinct.select(F.col("__fingerprint").alias("fingerprint"))))
    placed = distinct.join(near, distinct["__fingerprint"] == near["node"], "left").select(
        "__fingerprint", "__first", F.coalesce("component", "__fingerprint").alias("__component")
    )
    least = stored(
        placed.groupBy("__component").agg(F.min("__first").alias("component_id")), "least"
    )
    by_fingerprint = stored(
        placed.join(least, "__component").select(F.col("__fingerprint").alias("__key"), "component_id"), "components"
    )
    return rows.join(by_fingerprint, rows["__fingerprint"] == by_fingerprint["__key"]).select(
        F.col("__id").alias(id_column),
        F.lower(F.lpad(F.hex("__fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
