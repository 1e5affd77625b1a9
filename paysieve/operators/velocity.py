"""Trailing-window transaction count per user.

The count of a row is the number of the same user's rows whose whole second
lies in [second - W, second].  Both ends count, all rows of one second see each
other, rows without a timestamp see exactly the other rows without one, and
rows without a user are counted as one user.

A window over the raw rows by user does it, as long as no task gets too many
rows.  Users are counted by hash cell first: one narrow pass that hands on a few numbers
per task.  Where no cell is above ``hot_rows``, no user is, and the plain
window it is.  The users of a full cell are counted per second, from which
everything else about them follows:

- their rows are dealt to time buckets, and the last W seconds of a bucket are
  shown to the next one as narrow rows that carry their number;
- a bucket above ``hot_rows`` is cut between seconds where the running sum of
  its rows passes a multiple of it.  The rows of a piece count for nothing
  themselves; the piece gets the seconds it covers, and the W seconds carried over its
  cut, as narrow rows with the number of rows in each;
- a single second above ``hot_rows`` is spread over several copies of its piece.

So a group of the window holds at most twice ``hot_rows`` rows and a number
per second, whatever the size of the input.  What is broadcast is one number
per full cell and one entry per piece, of which there are 2^21 at most: beyond 2^20
times ``hot_rows`` rows in all, the limit grows with them.

"bucketed" slides a frame, which is summed anew whenever it moves; "linear"
keeps a running sum, to which a row is added at its second and subtracted W + 1
seconds later, at the same cost for any width.  "auto" slides over narrow
windows and runs over wide ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysieve.functions.times import epoch_seconds

COUNT_COLUMN = "tx_count_window"
HOT_ROWS = 1_000_000  # that one group of a window may hold
MIN_BUCKET_SECONDS = 3600
LINEAR_FROM_SECONDS = 600
CELLS = 1 << 16
MAX_PIECES = 1 << 20
STEP = 32  # cuts that are passed over at once when a row looks for its own
METHODS = ("auto", "bucketed", "linear")
KEY = ["__bucket", "__piece", "__salt"]


def per_second(payments: DataFrame, *, user: str = "user_id", ts: str = "event_ts") -> DataFrame:
    """(user, second, n): rows of each user in each second."""
    return payments.groupBy(F.col(user).alias("user"), epoch_seconds(ts).alias("second")).agg(
        F.count(F.lit(1)).alias("n")
    )


def crowded_cells(users: DataFrame, user: str, *, hot_rows: int = HOT_ROWS, cells: int = CELLS) -> tuple[int, list[int]]:
    """(limit, cells above it): the hash cells of users that one group of a window may be too small for.

    One short job; at most ``cells`` numbers come to the driver.
    """
    sizes = users.groupBy(F.pmod(F.xxhash64(user), F.lit(cells)).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    above = F.collect_list(F.when(F.col("n") > hot_rows, F.struct("cell", "n")))
    total, found = sizes.agg(F.sum("n"), above).first()
    limit = max(hot_rows, (total or 0) // MAX_PIECES, 1)
    return limit, [r["cell"] for r in found if r["n"] > limit]


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    first, second = (F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right))
    return first & second


@dataclass
class Placement:
    """Where rows go in the window: ``KEY`` besides the user."""

    narrow: DataFrame  # user, __second
    user: str
    seconds: int
    limit: int
    cells: int
    crowded: list[int]

    def __post_init__(self):
        self.width = max(MIN_BUCKET_SECONDS, 2 * self.seconds)
        if self.crowded:
            listed = self.narrow.sparkSession.createDataFrame([(c,) for c in self.crowded], "__full long")
            self.full = F.broadcast(listed)
            self.per_second = self._per_second()
            self.busy = F.broadcast(self._busy())

    def start(self) -> Column:
        second = F.col("__second")
        return second - F.pmod(second, F.lit(self.width).cast("long"))

    def in_full_cell(self) -> Column:
        return F.pmod(F.xxhash64(self.user), F.lit(self.cells)) == F.col("__full")

    def _per_second(self) -> DataFrame:
        """(user, second, bucket, n, before, total) of the users of full cells."""
        counted = (
            self.narrow.join(self.full, self.in_full_cell(), "left_semi")
            .groupBy(self.user, "__second")
            .agg(F.count(F.lit(1)).alias("__n"))
            .withColumn("__bucket", self.start())
        )
        # a bucket has at most ``width`` seconds
        bucket = Window.partitionBy(self.user, "__bucket")
        before = bucket.orderBy("__second").rowsBetween(Window.unboundedPreceding, -1)
        return counted.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).withColumn(
            "__total", F.sum("__n").over(bucket)
        )

    def _busy(self) -> DataFrame:
        """(user, bucket, cuts) of the buckets above the limit; a cut is (at, next, piece, salts)."""
        limit = F.lit(self.limit).cast("long")
        pieces = (
            self.per_second.where(F.col("__total") > limit)
            .groupBy(self.user, "__bucket", F.expr(f"__before DIV {self.limit}").cast("int").alias("__piece"))
            .agg(F.min("__second").alias("__first"), F.sum("__n").alias("__n"))
        )
        order = Window.partitionBy(self.user, "__bucket").orderBy("__piece")
        following = F.lead("__first", 1).over(order)
        cut = F.struct(
            # the first piece takes what the bucket before hands on
            F.when(F.row_number().over(order) == 1, F.col("__bucket")).otherwise(F.col("__first")).alias("at"),
            F.coalesce(following, F.col("__bucket") + self.width).alias("next"),
            F.col("__piece").alias("piece"),
            F.ceil(F.col("__n") / limit).cast("int").alias("salts"),
        )
        return (
            pieces.select(F.col(self.user).alias("__busy_user"), F.col("__bucket").alias("__busy_bucket"), cut.alias("cut"))
            .groupBy("__busy_user", "__busy_bucket")
            .agg(F.sort_array(F.collect_list("cut")).alias("__cuts"))
            .withColumn("__at", F.transform("__cuts", lambda cut: cut["at"]))
            .withColumn("__steps", F.filter("__at", lambda _, i: i % STEP == 0))
        )

    def _cut(self) -> Column:
        """The last cut of ``__cuts`` that is not after the row, found in two steps."""

        def passed(places: Column) -> Column:
            return F.greatest(F.size(F.filter(places, lambda at: at <= F.col("__second"))) - 1, F.lit(0))

        step = passed(F.col("__steps")) * STEP
        return F.get("__cuts", step + passed(F.slice("__at", step + 1, F.lit(STEP))))

    def own(self, rows: DataFrame, spread: Sequence[str] = ()) -> DataFrame:
        """``rows`` with ``KEY``, ``__n`` (what a row counts for) and ``__end`` (of its bucket)."""
        if not self.crowded:
            known = F.when(F.col("__second").isNotNull(), F.lit(0)).cast("long")
            nothing = F.lit(None).cast("long")
            return rows.withColumns(
                {"__bucket": known, "__piece": F.lit(0), "__salt": F.lit(0), "__n": F.lit(1).cast("long"), "__end": nothing}
            )
        bucket = F.when(F.col("__full").isNotNull(), self.start()).when(F.col("__second").isNotNull(), F.lit(0).cast("long"))
        marked = rows.join(self.full, self.in_full_cell(), "left").withColumn("__bucket", bucket)
        marked = marked.join(self.busy, _same([self.user, "__bucket"], ["__busy_user", "__busy_bucket"]), "left")
        marked = marked.withColumn("__cut", F.when(F.col("__cuts").isNotNull(), self._cut()))
        # the partition's number and the row itself: the same when a task is run again
        salts = F.col("__cut.salts")
        spreading = F.pmod(F.pmod(F.xxhash64(*spread), salts) + F.spark_partition_id(), salts) if spread else F.lit(0)
        return marked.withColumns(
            {
                "__piece": F.coalesce("__cut.piece", F.lit(0)),
                "__salt": F.when(F.col("__cut.salts") > 1, spreading).otherwise(0).cast("int"),
                "__n": F.when(F.col("__cut").isNull(), 1).otherwise(0).cast("long"),
                "__end": F.when(F.col("__full").isNotNull(), F.col("__bucket") + self.width),
            }
        ).drop("__full", "__busy_user", "__busy_bucket", "__cuts", "__at", "__steps", "__cut")

    def numbers(self) -> DataFrame:
        """Seconds as narrow rows: those carried over a cut or a bucket's end, and all of a cut bucket."""
        own = F.struct(F.col("__bucket").alias("to"), F.lit(True).alias("own"))
        following = F.struct((F.col("__bucket") + self.width).alias("to"), F.lit(False).alias("own"))
        near_end = F.coalesce(F.col("__second") >= F.col("__bucket") + (self.width - self.seconds), F.lit(False))
        moved = self.per_second.select(
            self.user, "__second", "__n", F.explode(F.when(near_end, F.array(own, following)).otherwise(F.array(own))).alias("__place")
        ).select(self.user, "__second", "__n", F.col("__place.to").alias("__bucket"), F.col("__place.own").alias("__own"))
        moved = moved.join(self.busy, _same([self.user, "__bucket"], ["__busy_user", "__busy_bucket"]), "left")
        second = F.col("__second")
        whole = F.struct(
            F.col("__bucket").alias("at"),
            (F.col("__bucket") + self.width).alias("next"),
            F.lit(0).alias("piece"),
            F.lit(1).alias("salts"),
        )
        seen = F.filter(
            "__cuts", lambda cut: second.isNull() | ((cut["at"] - F.lit(self.seconds) <= second) & (second < cut["next"]))
        )
        targets = F.when(F.col("__cuts").isNotNull(), seen).when(~F.col("__own"), F.array(whole))
        placed = moved.select(self.user, "__second", "__n", "__bucket", F.explode(targets).alias("__cut"))
        return placed.select(
            self.user,
            "__second",
            "__bucket",
            F.col("__cut.piece").alias("__piece"),
            F.explode(F.sequence(F.lit(0), F.col("__cut.salts") - 1)).alias("__salt"),
            "__n",
            F.col("__cut.next").alias("__end"),
        )


def with_velocity(
    payments: DataFrame,
    seconds: int = 60,
    *,
    method: str = "auto",
    user: str = "user_id",
    ts: str = "event_ts",
    hot_rows: int = HOT_ROWS,
    cells: int = CELLS,
) -> DataFrame:
    """Add ``tx_count_window``.

    Runs one short job over the user column when called; the rows are read in full once
    later, and two of their columns once or twice more if some user is busy, so
    pass a stored layer rather than a long computation.  ``hot_rows`` and
    ``cells`` say which users are dealt to buckets and pieces; they never change the result.
    """
    if seconds < 0:
        raise ValueError("the window cannot be negative")
    if method not in METHODS:
        raise ValueError(f"method: {method!r}, expected one of {METHODS}")
    payments = payments.drop(COUNT_COLUMN)
    linear = method == "linear" or (method == "auto" and seconds >= LINEAR_FROM_SECONDS)

    second = epoch_seconds(ts).alias("__second")
    narrow = payments.select(user, second)
    limit, crowded = crowded_cells(payments.select(user), user, hot_rows=hot_rows, cells=cells)
    place = Placement(narrow, user, seconds, limit, cells, crowded)

    spread = [name for name, kind in payments.dtypes if "map<" not in kind and kind != "variant"]
    both = place.own(payments.withColumn("__second", second), spread).withColumn("__kept", F.lit(True))
    counting = [place.numbers()] if crowded else []
    for numbers in counting:
        both = both.unionByName(numbers, allowMissingColumns=True)
    order = Window.partitionBy(user, *(KEY if crowded else KEY[:1])).orderBy("__second")
    if linear:
        for part in (place.own(narrow).where("__n = 1"), *counting):
            gone = part.withColumn("__second", F.col("__second") + F.lit(seconds + 1)).withColumn("__n", -F.col("__n"))
            # what leaves after the end changes no count in it
            inside = F.col("__second") < F.coalesce("__end", F.lit(1 << 62))
            both = both.unionByName(gone.where(inside), allowMissingColumns=True)
        frame = order.rangeBetween(Window.unboundedPreceding, 0)
    else:
        frame = order.rangeBetween(-seconds, 0)
    return (
        both.withColumn(COUNT_COLUMN, F.sum("__n").over(frame))
        .where("__kept")
        .select(*payments.columns, COUNT_COLUMN)
    )


def recount(
    rows: DataFrame, touched: DataFrame, seconds: int = 60, *, user: str = "user_id", ts: str = "event_ts"
) -> DataFrame:
    """The rows whose count may have changed, with their count.

    ``rows`` are all rows as they are now; ``touched`` has the user and time of
    every row that came or went.  Time is cut into stretches of the window's
    width: a touched row changes counts in its own stretch and the next one, for which
    the one before must be seen.  Only these stretches of these users are shuffled and counted.
    """
    width = max(seconds, 1)

    stretch = F.floor(epoch_seconds(ts) / F.lit(width)).cast("long")
    at = touched.select(F.col(user).alias("__user"), stretch.alias("__of")).distinct()
    moves = F.array(F.lit(-1), F.lit(0), F.lit(1))
    near = (
        at.withColumn("__move", F.explode(moves))
        .groupBy("__user", (F.col("__of") + F.col("__move")).alias("__stretch"))
        # rows without a time have one stretch, which is changed
        .agg(F.max((F.col("__move") >= 0) | F.col("__of").isNull()).alias("__changed"))
    )
    same = F.col(user).eqNullSafe(F.col("__user")) & F.col("__at").eqNullSafe(F.col("__stretch"))
    seen = rows.withColumn("__at", stretch).join(near, same).drop("__at", "__stretch", "__user")
    return with_velocity(seen, seconds, user=user, ts=ts).where("__changed").drop("__changed")
