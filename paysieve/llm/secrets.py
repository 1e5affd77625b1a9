"""Secrets: fixed patterns, and strings of high entropy, with their places.

Everything is expressions over the text column.  Places come from splitting a
text at a pattern and adding up the lengths of the pieces and of the matches.

High entropy: candidates are runs of at least ``WINDOW`` characters out of which keys are made.  A
window of that many characters slides over a candidate; the counts of the
characters in it change by the one that enters and the one that leaves, and so
does the sum of c log2 c, which is Shannon's entropy but for constants.  Sums are whole numbers (of 2^-20), so adding and
taking away leaves no error.  Each character class has a threshold of its own.
An allow list suppresses candidates.

A key may be glued to its name or to a word of the allow list.  With ``pieces``, runs of fewer kinds of characters inside
candidates, hexadecimal digits among them, are judged on their own as well, and
removed whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns and the least lengths of their matches.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LENGTH = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_mixed")
BASE_KINDS = 3

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# What a key is made of, without what sets it apart from a name: hexadecimal, letters and digits, base64, its form for URLs.
PIECES = (r"[0-9a-fA-F]{20,}", r"[A-Za-z0-9]{20,}", r"[A-Za-z0-9+/]{20,}", r"[A-Za-z0-9_-]{20,}")
# Bits per character, of at most log2(20) = 4.32.
THRESHOLDS = {"entropy_hex": 3.0, "entropy_mixed": 3.8}
# Words, numbers, separators, placeholders and paths are no keys.
ALLOW = (
    r"^[A-Za-z]+$",
    r"^[0-9]+$",
    r"^[0-9_=+/-]+$",
    r"^[A-Za-z]+([/_=+-]+[A-Za-z]+)*[/_=+-]*$",
    r"(?i)example|sample|placeholder|changeme|redacted",
)

SCALE = 1 << 20
FIRST_CODE, CODES = 43, 80  # from "+" to "z"
COUNT_SIZE, COUNTS_IN_LONG = 32, 12  # counts up to 21 as digits of a long
LOT = 256  # matches that are placed together


def _weight(count: int) -> int:
    return round(count * math.log2(count) * SCALE) if count > 1 else 0


def entropy_limit(threshold: float, window: int = WINDOW) -> int:
    """The largest sum of c log2 c at which a window's entropy reaches the threshold."""
    return math.floor((math.log2(window) - threshold) * window * SCALE)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; an expression is computed wherever it is named."""
    return F.transform(F.array(value), body)[0]


SPANS = "array<struct<start:bigint,kind:int,end:bigint,part:string>>"


def _located(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """array<struct<start, kind, end, part>> of the pattern's matches; ``part`` is a group's text.

    Matches are placed ``LOT`` at a time and the lots are then moved to their
    places, as growing an array by one costs its length.
    """
    none = F.array().cast(SPANS)

    def step(state: Column, each: Column) -> Column:
        start = state["at"] + F.length(each["gap"])
        end = start + F.length(each["found"])
        span = F.struct(
            start.cast("long").alias("start"),
            F.lit(kind).alias("kind"),
            end.cast("long").alias("end"),
            each["part"].alias("part"),
        )
        return F.struct(end.cast("long").alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    def pieces(found: Column) -> Column:
        parts = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        return F.arrays_zip(
            F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("gap"),
            found.alias("found"),
            parts.alias("part"),
        )

    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))

    def in_lots(all_: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(all_), F.lit(1)), F.lit(LOT))
        return F.transform(firsts, lambda i: F.aggregate(F.slice(all_, i, F.lit(LOT)), start, step))

    def moved(lots: Column) -> Column:
        nothing = F.array().cast("array<bigint>")
        begin = F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("places"))
        places = F.aggregate(
            lots,
            begin,
            lambda s, lot: F.struct((s["at"] + lot["at"]).alias("at"), F.concat(s["places"], F.array(s["at"])).alias("places")),
        )["places"]

        def move(lot: Column) -> Column:
            return F.transform(
                lot["lot"]["spans"],
                lambda span: F.struct(
                    (span["start"] + lot["place"]).alias("start"),
                    span["kind"].alias("kind"),
                    (span["end"] + lot["place"]).alias("end"),
                    span["part"].alias("part"),
                ),
            )

        return F.flatten(F.transform(F.arrays_zip(lots.alias("lot"), places.alias("place")), move))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _let(found, lambda f: F.when(F.size(f) > 0, _let(_let(pieces(f), in_lots), moved)).otherwise(none))


def _covered(span: Column, base: Column) -> Column:
    """Whether a span lies inside one of ``base``, which ascend and do not overlap: the last that starts before it is looked at."""

    def passed(starts: Column) -> Column:
        return F.size(F.filter(starts, lambda start: start <= span["start"]))

    # starts are passed over in lots first
    def last(lots: Column) -> Column:
        at = lots * LOT
        return at + passed(F.slice(base["starts"], at + 1, F.lit(LOT)))

    index = _let(F.greatest(passed(base["firsts"]) - 1, F.lit(0)), last)
    return F.coalesce(_let(index, lambda i: F.get(base["ends"], i - 1)) >= span["end"], F.lit(False))


def _places(spans: Column) -> Column:
    starts = F.transform(spans, lambda s: s["start"])
    return F.struct(
        starts.alias("starts"),
        F.filter(starts, lambda _, i: i % LOT == 0).alias("firsts"),
        F.transform(spans, lambda s: s["end"]).alias("ends"),
    )


def _high_entropy(candidate: Column, limit: Column) -> Column:
    """struct<first, last>: ends of the first and last window that reach the threshold (0: none)."""
    digits = F.array(*[F.lit(COUNT_SIZE**i).cast("long") for i in range(COUNTS_IN_LONG)])

    def place(letter: Column) -> Column:
        code = F.ascii(letter) - FIRST_CODE
        slot = F.floor(code / COUNTS_IN_LONG).cast("int")
        return F.struct(slot.alias("slot"), F.element_at(digits, code % COUNTS_IN_LONG + 1).alias("unit"))

    def slide(codes: Column) -> Column:
        absent = F.array_repeat(F.lit(None).cast("struct<slot:int,unit:bigint>"), WINDOW)
        leaving = F.concat(absent, F.slice(codes, F.lit(1), F.greatest(F.size(codes) - WINDOW, F.lit(0))))
        return _slide(F.arrays_zip(codes.alias("entering"), leaving.alias("leaving")), limit)

    return _let(F.transform(F.split(candidate, ""), place), slide)


def _slide(letters: Column, limit: Column) -> Column:
    """Counts of the window's letters are digits of base ``COUNT_SIZE`` in a few longs."""
    gains = F.array(*[F.lit(_weight(c) - _weight(c - 1)).cast("long") for c in range(1, WINDOW + 2)])
    nothing = F.lit(0).cast("long")

    def seen(state: Column) -> dict[str, Column]:
        """First and last with the window that the state ends with."""
        high = (state["at"] >= WINDOW) & (state["total"] <= limit)
        return {
            "first": F.when(high & (state["first"] == 0), state["at"]).otherwise(state["first"]),
            "last": F.when(high, state["at"]).otherwise(state["last"]),
        }

    def step(state: Column, letter: Column) -> Column:
        enters, leaves = letter["entering"], letter["leaving"]

        def count(place: Column) -> Column:
            return (F.call_function("div", F.get(state["counts"], place["slot"]), place["unit"]) % COUNT_SIZE).cast("int")

        stays = (enters["slot"] == leaves["slot"]) & (enters["unit"] == leaves["unit"])
        lost = F.coalesce(F.element_at(gains, F.greatest(count(leaves), F.lit(1))), nothing)
        won = F.element_at(gains, count(enters) + 1)
        # a letter that enters as it leaves changes nothing
        same = F.coalesce(stays, F.lit(False))
        counts = F.transform(
            state["counts"],
            lambda c, i: c
            + F.when(i == enters["slot"], enters["unit"]).otherwise(nothing)
            - F.when(i == leaves["slot"], leaves["unit"]).otherwise(nothing),
        )
        return F.struct(
            F.when(same, state["counts"]).otherwise(counts).alias("counts"),
            F.when(same, state["total"]).otherwise(state["total"] - F.when(leaves.isNull(), nothing).otherwise(lost) + won).alias("total"),
            (state["at"] + 1).alias("at"),
            *[value.alias(name) for name, value in seen(state).items()],
        )

    zero = F.struct(
        F.array_repeat(nothing, -(-CODES // COUNTS_IN_LONG)).alias("counts"),
        nothing.alias("total"),
        *[F.lit(0).alias(name) for name in ("at", "first", "last")],
    )
    return F.aggregate(letters, zero, step, lambda s: F.struct(*[value.alias(name) for name, value in seen(s).items()]))


def with_spans(
    docs: DataFrame, *, text_column: str = "text", output: str = "spans", allow: tuple[str, ...] = ALLOW, pieces: bool = False
) -> DataFrame:
    """``docs`` with array<struct<start, kind, end>>, by start and kind.

    ``kind`` counts in ``KINDS``; places are code points, the end exclusive.
    Matches of each pattern are leftmost and do not overlap.  A candidate of
    high entropy adds one span, from its first such window to its last, unless
    it lies inside a span of a pattern or an allow list entry is found in it.
    With ``pieces``, so does each piece in which a window is high, but from the piece's start to
    its end; the allow list is searched in the piece alone.
    NULL and empty texts have no spans.  All other columns are passed on.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    none = F.array().cast(SPANS)
    assigned = F.filter(_located(text, ASSIGN, 0, 2), lambda s: F.length(s["part"]) >= ASSIGN_LENGTH)
    patterns = [
        F.when(F.contains(text, F.lit(":")) | F.contains(text, F.lit("=")), assigned).otherwise(none),
        F.when(F.contains(text, F.lit("AKIA")), _located(text, ACCESS, 1)).otherwise(none),
        F.when(text.rlike(HEX), _located(text, HEX, 2)).otherwise(none),
    ]
    bases = [f"__base{kind}" for kind in range(BASE_KINDS)]
    base = docs.withColumns(dict(zip(bases, patterns)))
    base = base.withColumns({f"{name}_at": _places(F.col(name)) for name in bases})
    candidate = text.rlike(CANDIDATE)

    def open_(span: Column) -> Column:
        """What lies in a pattern's span is not looked at: its windows would, too."""
        shut = F.lit(False)
        for name in bases:
            shut = shut | _covered(span, F.col(f"{name}_at"))
        for pattern in allow:
            shut = shut | span["part"].rlike(pattern)
        return ~shut

    def kind(span: Column) -> Column:
        return F.when(span["part"].rlike("^[0-9a-fA-F]+$"), 3).otherwise(4)

    def windows(span: Column) -> Column:
        limit = F.when(span["kind"] == 3, F.lit(entropy_limit(THRESHOLDS["entropy_hex"]))).otherwise(
            F.lit(entropy_limit(THRESHOLDS["entropy_mixed"]))
        )
        return F.struct(
            span["start"].alias("start"), span["kind"].alias("kind"), span["end"].alias("end"), _high_entropy(span["part"], limit).alias("ends")
        )

    def judged(spans: Column) -> Column:
        """The spans that have a high window."""
        named = F.transform(
            F.filter(spans, open_),
            lambda s: F.struct(s["start"].alias("start"), kind(s).alias("kind"), s["end"].alias("end"), s["part"].alias("part")),
        )
        return F.filter(F.transform(named, windows), lambda w: w["ends"]["first"] > 0)

    def located(found: Column) -> Column:
        return F.struct(
            (found["start"] + found["ends"]["first"] - WINDOW).cast("long").alias("start"),
            found["kind"].alias("kind"),
            (found["start"] + found["ends"]["last"]).cast("long").alias("end"),
        )

    def plain(span: Column) -> Column:
        return F.struct(span["start"].alias("start"), span["kind"].alias("kind"), span["end"].alias("end"))

    def distinct(spans: Column) -> Column:
        """Once each, in order."""
        return _let(F.array_sort(spans), lambda held: F.filter(held, lambda s, i: (i == 0) | (s != F.get(held, i - 1))))

    def uncovered(span: Column) -> Column:
        covered = F.lit(False)
        for name in bases:
            covered = covered | _covered(span, F.col(f"{name}_at"))
        return ~covered

    nothing = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    found = judged(_located(text, CANDIDATE, 4))
    scanned = base.withColumn("__high", F.when(candidate, F.transform(found, located)).otherwise(nothing))
    high = F.filter("__high", uncovered)
    if pieces:
        # all of them lie in candidates; the same piece may be of several kinds
        parts = distinct(F.concat(*[_located(text, pattern, 4) for pattern in PIECES]))
        scanned = scanned.withColumn("__keys", F.when(candidate, F.transform(judged(parts), plain)).otherwise(nothing))
        high = distinct(F.concat(high, F.col("__keys")))
    own = F.transform(F.concat(*bases), plain)
    return scanned.withColumn(output, F.array_sort(F.concat(own, high))).drop(
        *bases, *[f"{name}_at" for name in bases], "__high", "__keys"
    )


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def redacted(docs: DataFrame, *, text_column: str = "text", spans_column: str = "spans", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span, or run of overlapping spans, of the text replaced by ``mark``."""
    text = F.col(text_column)

    def step(state: Column, span: Column) -> Column:
        apart = span["start"] >= state["at"]
        between = F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        return F.struct(
            F.when(apart, F.concat(state["text"], between, F.lit(mark))).otherwise(state["text"]).alias("text"),
            F.greatest(state["at"], span["end"]).alias("at"),
        )

    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at"))
    whole = F.aggregate(
        F.col(spans_column),
        start,
        step,
        lambda s: F.concat(s["text"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))),
    )
    return docs.withColumn(text_column, F.when(F.size(spans_column) > 0, whole).otherwise(text))


def scan(docs: DataFrame, *, pieces: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: id, number of spans by pattern, digest of the patterns' spans, all spans as text.

    See ``with_spans``.  Repeated rows and NULL ids are rows like any other, and
    an empty table gives no rows.  A very long text costs in proportion to its
    candidates' characters, some microseconds each.
    """
    found = with_spans(
        docs.select(F.col(id_column), F.col(text_column)), text_column=text_column, output="__spans", pieces=pieces
    )
    patterns = F.filter("__spans", lambda s: s["kind"] < BASE_KINDS)

    def count(kind: int) -> Column:
        return F.size(F.filter("__spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select(
        F.col(id_column),
        *[count(kind) for kind in range(BASE_KINDS)],
        F.sha2(listed(patterns), 256).alias("base_sha256"),
        listed(F.col("__spans")).alias("spans"),
    )


def _secrets_sql() -> str:
    """``scan`` with pieces in DuckDB: windows one by one instead of by increments."""
    text = lambda pattern: "'" + pattern.replace("'", "''") + "'"

    def found(kind: int, pattern: str, group: int = 0) -> str:
        return (
            f"SELECT id, {kind} AS kind, regexp_split_to_array(text, {text(pattern)}) AS gaps, "
            f"regexp_extract_all(text, {text(pattern)}, 0) AS found, regexp_extract_all(text, {text(pattern)}, {group}) AS part FROM docs"
        )

    allowed = " OR ".join(f"regexp_matches(part, {text(p)})" for p in ALLOW)
    weights = [_weight(c) for c in range(WINDOW + 1)]
    limits = {kind: entropy_limit(bits) for kind, bits in THRESHOLDS.items()}
    judged = " UNION ALL ".join(found(kind, pattern) for kind, pattern in enumerate((CANDIDATE, *PIECES), BASE_KINDS))
    last = WINDOW - 1
    names = list(KINDS)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({found(0, ASSIGN, 2)} UNION ALL {found(1, ACCESS)} UNION ALL {found(2, HEX)} UNION ALL {judged}),
placed AS (
  SELECT id, kind, part[i] AS part, length(found[i]) AS size,
         list_sum(list_transform(gaps[1:i], lambda g: length(g)))
           + coalesce(list_sum(list_transform(found[1:i - 1], lambda g: length(g))), 0) AS start
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM found)),
base AS (
  SELECT id, kind, start::BIGINT AS start, (start + size)::BIGINT AS stop FROM placed
  WHERE kind < {BASE_KINDS} AND (kind > 0 OR length(part) >= {ASSIGN_LENGTH})),
windows AS (
  SELECT id, start, kind AS part_of, CASE WHEN regexp_full_match(part, '[0-9a-fA-F]+') THEN 3 ELSE 4 END AS kind, part,
         list_filter(range(1, length(part) - {last - 1}), lambda i: list_sum(list_transform(
           list_distinct(string_split(part[i:i + {last}], '')),
           lambda c: {weights}[{WINDOW + 1} - length(replace(part[i:i + {last}], c, ''))]))
           <= CASE WHEN regexp_full_match(part, '[0-9a-fA-F]+') THEN {limits["entropy_hex"]} ELSE {limits["entropy_mixed"]} END) AS high
  FROM placed WHERE kind >= {BASE_KINDS} AND NOT ({allowed})),
entropy AS (
  SELECT id, kind, (start + high[1] - 1)::BIGINT AS start, (start + high[-1] + {last})::BIGINT AS stop
  FROM windows WHERE len(high) > 0 AND part_of = 3
  UNION
  SELECT id, kind, start::BIGINT, (start + length(part))::BIGINT FROM windows WHERE len(high) > 0 AND part_of > 3),
spans AS (
  SELECT * FROM base UNION ALL
  SELECT * FROM entropy e WHERE NOT EXISTS (
    SELECT 1 FROM base b WHERE b.id = e.id AND b.start <= e.start AND e.stop <= b.stop)),
listed AS (
  SELECT id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         coalesce(string_agg({names}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop) FILTER (kind < {BASE_KINDS}), '') AS base,
         string_agg({names}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop) AS spans
  FROM spans GROUP BY id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (id)
"""


SECRETS_SQL = _secrets_sql()
