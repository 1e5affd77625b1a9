"""Language-model scores from a weighted backoff automaton learned from the corpus.

Every n-gram of the training rows up to three words is counted, whatever its
words and however rare; nothing is cut.  Probabilities are smoothed with the
shorter context's as a prior:

    P(w)      = (c(w) + 0.1) / (N + 0.1 (V + 1))
    P(w | v)  = (c(v w) + a P(w)) / (c(v) + a)
    P(w | u v) = (c(u v w) + b P(w | v)) / (c(u v) + b)

States are contexts: the root, words, and pairs of words.  A state's arcs are
the words seen after it, weighted with log10 of their probability there.  A
word without an arc follows the failure arc to the shorter context, whose weight is
log10 of a / (c(v) + a), or of b / (c(u v) + b).  Every word's probabilities
add up to one in every state.  A text is traversed from left to right: a step
takes the state's arc of the next token, or failure arcs until there is one, adds up the
weights and carries on in the state that it leads to.

The automaton is as large as the corpus and nobody holds it whole.  Documents
are taken in lots of about ``lot_bytes`` of text.  A lot sends the hashes of its
distinct n-grams, sorted, with how often its training rows have them; hashes are dealt
to buckets by range, where equal ones are added up; and the
sums go back, in the order of the question.  Then each lot builds the part of
the automaton that its own texts can reach and traverses them.  So a word
pair that is in every document is one number per lot in its bucket, and a lot, a bucket
and its answers have a bounded size however large the corpus is.

N-grams are known by 55 bits of hash: two that share theirs share their counts,
which of n different ones befalls a share of n / 2^55.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from paysieve.llm.common import stored
from paysieve.llm.runs import joined, mixed

SMOOTHING = 0.1
PRIORS = (500.0, 5.0)  # a and b above
ORDERS = (1, 2, 3)
LOT_BYTES = 1 << 22
LOTS_PER_BUCKET = 2  # a bucket takes less memory than a lot
PART_BYTES = 1 << 20  # of a lot, hashed at a time
BATCH_BYTES = 1 << 22
HASH_BITS = 55
ENTRIES = 1 << 15  # hashes in a row that is shuffled
FEW = 64  # texts so few that they are traversed one by one
LOTS_PER_PARTITION = 1 << 32

# what begins and ends a text; no word hashes like a number that small but by chance
BEGIN, END = np.uint64(2), np.uint64(4)


# --- tokens -------------------------------------------------------------------

_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= ord("A")) & (_BYTES <= ord("Z")), _BYTES + 32, _BYTES).astype(np.uint8)
BLANK = np.isin(_BYTES, [0x20, *range(0x09, 0x0E)])
VALUE = mixed(np.arange(256, dtype=np.uint64) + np.uint64(0x5DEECE66D))
MULTIPLIER = np.uint64(0x2545F4914F6CDD1D)


def _known(hashes: np.ndarray) -> np.ndarray:
    """The bits that n-grams are known by, above a bit that marks training rows in what is sorted."""
    return (hashes >> np.uint64(63 - HASH_BITS)) & ~np.uint64(1)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), MULTIPLIER)]))


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words per text) of texts laid end to end; ``ends`` are where they end."""
    blank = BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = edge[0] = True
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = blank[:-1], blank[1:]
    first = np.flatnonzero(~blank & (before | edge[:-1]))
    last = np.flatnonzero(~blank & (after | edge[1:]))
    sizes = last - first + 1
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    letters = VALUE[LOWER[data[~blank]]]
    start = np.cumsum(sizes) - sizes
    place = np.arange(len(letters)) - np.repeat(start, sizes)
    sums = np.add.reduceat(letters * _powers(int(sizes.max()))[place], start)
    # 0 to 15 are not words
    hashes = _known(mixed(sums + mixed(sizes.astype(np.uint64)))) | np.uint64(16)
    return hashes, np.diff(np.searchsorted(first, ends), prepend=0)


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of [BEGIN, words.., END] of every text, how many of them), NULL being empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    parts, counts = [], []
    at = 0
    while at < len(texts):
        # a few texts at a time: a word takes some twenty bytes per letter while it is hashed
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PART_BYTES, "right")) - 1)
        own, n = word_hashes(whole[offsets[at] : offsets[stop]], offsets[at + 1 : stop + 1] - offsets[at])
        parts.append(own)
        counts.append(n)
        at = stop
    words, sizes = np.concatenate(parts), np.concatenate(counts) + 2
    found = np.empty(sizes.sum(), np.uint64)
    ends = np.cumsum(sizes)
    inner = np.ones(len(found), bool)
    inner[ends - 1] = inner[ends - sizes] = False
    found[ends - sizes], found[ends - 1], found[inner] = BEGIN, END, words
    return found, sizes


def ngram_hashes(tokens: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the hashes of the n-grams that end at a place, and which places these are."""
    begins = np.cumsum(sizes) - sizes
    there = np.ones(len(tokens), bool)
    there[begins] = False
    yield tokens[there], there
    pairs = _known(joined(tokens[:-1], tokens[1:]))  # a pair by its first place
    yield pairs[there[1:]], there
    there = there.copy()
    there[begins + 1] = False
    ends = np.flatnonzero(there)
    yield _known(joined(pairs[ends - 2], tokens[ends])), there


# --- counting -----------------------------------------------------------------


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers by their first bytes, then their second ones, and so on, as many as the largest has, which comes first."""
    planes = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
    return bytes([planes]) + numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T[:planes].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    found = np.zeros((planes.shape[1], 8), np.uint8)
    found[:, : len(planes)] = planes.T
    return found.view("<u8").ravel()


def _packed_ascending(numbers: np.ndarray) -> bytes:
    """At least one number: the first whole, of the others how much more they are than the one before."""
    return numbers[:1].astype("<u8").tobytes() + _packed(np.diff(numbers))


def _unpacked_ascending(data: bytes) -> np.ndarray:
    return np.cumsum(np.concatenate([np.frombuffer(data, "<u8", 1), _unpacked(data[8:])]), dtype=np.uint64)


def _bucket_edges(buckets: int) -> np.ndarray:
    """The first hash of each bucket but the first."""
    return np.array([(i << HASH_BITS + 1) // buckets for i in range(1, buckets)], np.uint64)


def _gathered(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Batches of some megabytes."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, bytes))
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def distinct(hashes: np.ndarray, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes, and how many of each are of training rows."""
    marked = np.sort(hashes | trained.astype(np.uint64))
    own = marked & ~np.uint64(1)
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])[: len(own)])
    counts = np.add.reduceat(marked & np.uint64(1), first) if len(first) else np.zeros(0, np.uint64)
    return own[first], counts


def lots(batches: Iterator[pa.RecordBatch], lot_bytes: int = LOT_BYTES) -> Iterator[tuple[int, pa.RecordBatch, bool]]:
    """(lot, rows, whether the lot ends with them): rows (partition, text, ...) in order, cut wherever ``lot_bytes`` of text are full."""
    number, held, waiting = None, 0, None
    for batch in batches:
        if number is None and batch.num_rows:
            number = batch.column(0)[0].as_py() * LOTS_PER_PARTITION
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0), np.int64)
        start, reach = 0, held + np.cumsum(sizes)
        while start < batch.num_rows:
            stop = int(np.searchsorted(reach, lot_bytes)) + 1
            full, stop = stop <= batch.num_rows, min(stop, batch.num_rows)
            if waiting:
                yield *waiting, False
            waiting = number, batch.slice(start, stop - start)
            held = int(reach[stop - 1])
            if full:
                yield *waiting, True
                number, waiting, held, reach = number + 1, None, 0, reach - reach[stop - 1]
            start = stop
    if waiting:
        yield *waiting, True


def numbered(hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """(place of each hash among the sorted distinct ones, how many these are)."""
    order = np.argsort(hashes)
    own = hashes[order]
    found = np.empty(len(hashes), np.int32)
    new = np.ones(len(own), bool)
    new[1:] = own[1:] != own[:-1]
    found[order] = np.cumsum(new, dtype=np.int32) - 1
    return found, int(new.sum())


@dataclass
class Lot:
    """The tokens of a lot's texts."""

    tokens: np.ndarray
    sizes: np.ndarray
    trained: np.ndarray  # of each text

    @staticmethod
    def of(batches: list[pa.RecordBatch], text: int, trained: int) -> Lot:
        texts = pa.concat_arrays([b.column(text) for b in batches])
        flags = pa.concat_arrays([b.column(trained) for b in batches])
        return Lot(*token_hashes(texts), flags.to_numpy(zero_copy_only=False).astype(bool))

    def ngrams(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each order: hashes and places of all, sorted distinct hashes and their counts."""
        flags = np.repeat(self.trained, self.sizes)
        for hashes, places in ngram_hashes(self.tokens, self.sizes):
            yield hashes, places, *distinct(hashes, flags[places])


def questions(rows: DataFrame, buckets: int, lot_bytes: int = LOT_BYTES) -> DataFrame:
    """(bucket, order, lot, part, hashes, counts): the n-grams of each lot of (partition, text, trained)."""
    edges = _bucket_edges(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held: list[pa.RecordBatch] = []
        for lot, batch, ends in lots(batches, lot_bytes):
            held.append(batch)
            if not ends:
                continue
            for order, (_, _, own, counts) in zip(ORDERS, Lot.of(held, 1, 2).ngrams()):
                cuts = np.concatenate([[0], np.searchsorted(own, edges), [len(own)]])
                for bucket in np.flatnonzero(np.diff(cuts)):
                    for part, at in enumerate(range(cuts[bucket], cuts[bucket + 1], ENTRIES)):
                        stop = min(at + ENTRIES, cuts[bucket + 1])
                        yield int(bucket), order, lot, part, _packed_ascending(own[at:stop]), _packed(counts[at:stop])
            held = []

    names = ["bucket", "order", "lot", "part", "hashes", "counts"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    return rows.select("partition", "text", "trained").mapInArrow(
        lambda batches: _gathered(run(batches), names, types), "bucket int, order int, lot long, part int, hashes binary, counts binary"
    )


def answers(asked: DataFrame, buckets: int) -> DataFrame:
    """(lot, order, bucket, part, counts): for every question how often all training rows have its n-grams.
    Rows with lot -1 say how many tokens of the training rows fall into a bucket, different ones and in all."""

    def answer(order: int, bucket: int, rows: list[tuple]) -> Iterator[tuple]:
        hashes = [_unpacked_ascending(r[2]) for r in rows]
        ends = np.cumsum([len(h) for h in hashes])
        whole = np.concatenate(hashes)
        del hashes
        sorting = np.argsort(whole, kind="stable")
        own = whole[sorting]
        new = np.concatenate([[True], own[1:] != own[:-1]])
        del whole, own
        counts = np.concatenate([_unpacked(r[3]) for r in rows])[sorting]
        totals = np.add.reduceat(counts, np.flatnonzero(new))
        del counts
        found = np.empty(len(sorting), np.uint64)
        found[sorting] = totals[np.cumsum(new, dtype=np.int32) - 1]
        del sorting, new
        for (lot, part, _, _), some in zip(rows, np.split(found, ends[:-1])):
            yield lot, order, bucket, part, _packed(some), 0, 0
        if order == 1:
            yield -1, order, bucket, 0, None, int((totals > 0).sum()), int(totals.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, held = None, []
        for batch in batches:
            for row in zip(*batch.columns):  # one at a time: a batch of them is large
                bucket, order, *rest = (v.as_py() for v in row)
                if (bucket, order) != now:
                    if held:
                        yield from answer(now[1], now[0], held)
                    now, held = (bucket, order), []
                held.append(rest)
        if held:
            yield from answer(now[1], now[0], held)

    names = ["lot", "order", "bucket", "part", "counts", "seen", "total"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    # a partition per bucket: by hash, several would meet in one task
    dealt = asked.repartitionById(buckets, "bucket").sortWithinPartitions("bucket", "order", "lot", "part")
    return dealt.mapInArrow(lambda batches: _gathered(run(batches), names, types), "lot long, order int, bucket int, part int, counts binary, seen long, total long")


# --- the automaton of a lot -----------------------------------------------------


class Automaton:
    """States and arcs that a lot's texts can reach.

    States are the root (0), the words seen in training, and the pairs of words seen there.  ``arcs[n]`` has for
    every place the arc of its token out of a state of n words: its weight, or NaN.
    """

    def __init__(self, lot: Lot, counts: list[np.ndarray], total: int, seen: int, priors: tuple[float, float] = PRIORS):
        a, b = priors
        # per place, the number of its word, pair and triple
        word, pair, triple = (np.full(len(lot.tokens), -1, np.int32) for _ in ORDERS)
        texts = 0.0  # how often BEGIN is a context: as often as texts end
        for numbers, (hashes, places), n in zip((word, pair, triple), ngram_hashes(lot.tokens, lot.sizes), counts):
            numbers[places], different = numbered(hashes)
            if different != len(n):
                raise RuntimeError("the input has changed since it was counted; score a stored table")
        if len(lot.sizes):
            texts = float(counts[0][word[lot.sizes[0] - 1]])
        c1, c2, c3 = (n.astype(float) for n in counts)
        p1 = (c1 + SMOOTHING) / (total + SMOOTHING * (seen + 1))

        # a pair's last word, and how often its first one goes on
        there = np.flatnonzero(pair >= 0)
        first_total, last_word = np.zeros(len(c2)), np.zeros(len(c2), np.int32)
        last_word[pair[there]] = word[there]
        before = word[there - 1]
        first_total[pair[there]] = np.where(before >= 0, c1[np.maximum(before, 0)], texts)
        p2 = (c2 + a * p1[last_word]) / (first_total + a)
        there = np.flatnonzero(triple >= 0)
        first_pair, last_pair = np.zeros(len(c3), np.int32), np.zeros(len(c3), np.int32)
        first_pair[triple[there]], last_pair[triple[there]] = pair[there - 1], pair[there]
        p3 = (c3 + b * p2[last_pair]) / (c2[first_pair] + b)
        del there, before, first_pair, last_pair

        def log(p: np.ndarray, n: np.ndarray) -> np.ndarray:
            return np.where(n > 0, np.log10(p), np.nan)

        self.n_words = len(c1)
        self.begin = 1 + self.n_words  # the state of BEGIN
        first_of_pairs = self.begin + 1
        self.arcs = (
            self._at(np.log10(p1), word),
            self._at(log(p2, c2), pair),
            self._at(log(p3, c3), triple),
        )
        self.base, self.known = self.arcs[0], word >= 0
        self.known[self.known] = c1[word[self.known]] > 0
        # where arcs lead, longest context first: a pair that was seen, a word that was, the root
        alone = np.where(self.known, word + 1, 0)
        paired = np.append(c2 > 0, False)[pair]
        self.leads = alone, np.where(paired, first_of_pairs + pair, alone)
        self.depth = np.zeros(first_of_pairs + len(c2), np.int8)
        self.depth[1:first_of_pairs], self.depth[first_of_pairs:] = 1, 2
        self.failure = np.zeros(len(self.depth), np.int32)
        self.backoff = np.zeros(len(self.depth))
        self.backoff[1 : self.begin] = np.log10(a / (c1 + a))
        self.backoff[self.begin] = math.log10(a / (texts + a))
        self.failure[first_of_pairs:] = 1 + last_word
        self.backoff[first_of_pairs:] = np.log10(b / (c2 + b))

    @staticmethod
    def _at(weights: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        padded = np.append(weights, np.nan)  # number -1: no such n-gram at the place
        return padded[numbers]

    def traverse(self, sizes: np.ndarray) -> np.ndarray:
        """log10 of each text's probability; the texts advance together, each carrying its state."""
        order = np.argsort(-sizes, kind="stable")
        starts = (np.cumsum(sizes) - sizes)[order]
        steps = sizes[order] - 1
        state = np.full(len(order), self.begin)
        score = np.zeros(len(order))
        longest = int(steps[0]) if len(steps) else 0
        alive_at = len(order) - np.searchsorted(steps[::-1], np.arange(longest), side="right")
        root, one, two = self.arcs
        alone, longest_state = self.leads
        for t in range(longest):
            alive = int(alive_at[t])
            if alive <= FEW:
                for text in range(alive):
                    score[text] += self._alone(int(state[text]), int(starts[text]) + 1 + t, int(starts[text] + steps[text]) + 1)
                break
            now, place = state[:alive], starts[:alive] + 1 + t
            depth = self.depth[now]
            weight = np.where(depth == 2, two[place], np.nan)
            missing = np.isnan(weight)
            # failure arcs, from pairs to words and from words to the root
            spent = np.where(missing & (depth == 2), self.backoff[now], 0.0)
            now = np.where(missing & (depth == 2), self.failure[now], now)
            depth = np.where(missing, np.minimum(depth, 1), depth)
            weight = np.where(missing & (depth == 1), one[place], weight)
            missing = np.isnan(weight)
            spent += np.where(missing & (depth == 1), self.backoff[now], 0.0)
            weight = np.where(missing, root[place], weight)
            score[:alive] += spent + weight
            state[:alive] = np.where(missing, alone[place], longest_state[place])
        found = np.empty(len(order))
        found[order] = score
        return found

    def _alone(self, state: int, place: int, end: int) -> float:
        """What one text adds from a place on."""
        total = 0.0
        depth, backoff, failure = self.depth.item, self.backoff.item, self.failure.item
        slices = [arc[place:end].tolist() for arc in self.arcs]
        alone, longest = (lead[place:end].tolist() for lead in self.leads)
        for at in range(end - place):
            deep = depth(state)
            while deep:
                weight = slices[deep][at]
                if weight == weight:
                    break
                total += backoff(state)
                state, deep = failure(state), deep - 1
            else:
                weight = slices[0][at]
            total += weight
            state = longest[at] if deep else alone[at]
        return total


# --- Spark -----------------------------------------------------------------------


def score(
    docs: DataFrame,
    *,
    training: Column | None = None,
    priors: tuple[float, float] = PRIORS,
    lot_bytes: int = LOT_BYTES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens,
    base_score and score, both log10.

    Learned from the rows where ``training`` holds (default: all); the others
    are held out, as are those where it is NULL.  A NULL or empty text is its end alone, which is a
    token.  With nothing to learn from, N, V and all counts are 0.  Repeated rows and NULL ids are rows like any other;
    other columns are not read, and an empty table gives no rows.  A very long text is a
    lot of its own, at some hundred bytes of memory per word.

    ``docs`` is read twice and must give the same rows in the same order each
    time, as a stored table does: lots are cut by place.  One that doesn't is noticed and refused.
    """
    trained = F.lit(True) if training is None else F.coalesce(training, F.lit(False))
    rows = docs.select(
        F.spark_partition_id().alias("partition"),
        F.col(text_column).cast("string").alias("text"),
        trained.alias("trained"),
        F.col(id_column).alias("id"),
    )
    bytes_ = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(bytes_ / lot_bytes))
    buckets = -(-parts // LOTS_PER_BUCKET)
    told = stored(answers(questions(rows, buckets, lot_bytes), buckets), "answers")
    seen, total = told.where("lot = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("seen", "total")]).first()

    def with_lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot, batch, _ in lots(batches, lot_bytes):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, lot)), *batch.columns], names=["lot", *batch.schema.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts, texts = None, {n: [] for n in ORDERS}, []

        def settled() -> Iterator[pa.RecordBatch]:
            if not texts:
                return
            own = Lot.of(texts, 1, 2)
            whole = [np.concatenate(counts[n]) if counts[n] else np.zeros(0, np.uint64) for n in ORDERS]
            yield _scored(own, pa.concat_arrays([t.column(0) for t in texts]), Automaton(own, whole, total, seen, priors))

        for batch in batches:
            lot_of, order_of = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at in _same(lot_of, order_of):
                if lot_of[at.start] != now:
                    yield from settled()
                    now, counts, texts = lot_of[at.start], {n: [] for n in ORDERS}, []
                part = batch.slice(at.start, at.stop - at.start)
                if order_of[at.start] == 0:
                    texts.append(pa.RecordBatch.from_arrays([part.column(i) for i in (7, 5, 6)], names=["id", "text", "trained"]))
                else:
                    counts[int(order_of[at.start])] += [_unpacked(data) for data in part.column(4).to_pylist()]
        yield from settled()

    schema = rows.select("id").schema
    for name, kind in (("held_out", "boolean"), ("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"), ("score", "double")):
        schema = schema.add(name, kind)
    with_lot = StructType([StructField("lot", LongType()), *rows.schema.fields])
    texts = rows.mapInArrow(with_lots, with_lot).drop("partition").withColumn("order", F.lit(0))
    both = told.where("lot >= 0").drop("seen", "total").unionByName(texts, allowMissingColumns=True)
    # a lot's answers come in the order of the hashes, its texts before or after them
    dealt = both.repartition(parts, "lot").sortWithinPartitions("lot", "order", "bucket", "part")
    found = dealt.select("lot", "order", "bucket", "part", "counts", "text", "trained", "id").mapInArrow(run, schema)
    return found.select(
        F.col("id").alias(id_column),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def _same(*keys: np.ndarray) -> Iterator[slice]:
    """The stretches in which all keys stay the same."""
    n = len(keys[0])
    new = np.ones(n, bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    cuts = np.append(np.flatnonzero(new), n)
    return (slice(a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()))


def _scored(lot: Lot, ids: pa.Array, automaton: Automaton) -> pa.RecordBatch:
    ends = np.cumsum(lot.sizes)
    begins = ends - lot.sizes

    def per_text(values: np.ndarray) -> np.ndarray:
        """Sums over a text's tokens, without BEGIN."""
        values = values.copy()
        values[begins] = 0
        return np.add.reduceat(values, begins)

    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(~lot.trained),
            pa.array(lot.sizes - 1, pa.int64()),
            pa.array(per_text(automaton.known.astype(np.int64))),
            pa.array(per_text(automaton.base)),
            pa.array(automaton.traverse(lot.sizes)),
        ],
        names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"],
    )
