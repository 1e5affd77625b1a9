"""Language identification by cross-parsing.

A text is parsed from left to right into phrases, each the longest piece that
occurs somewhere in a language's reference text.  The fewer phrases a language
needs, times the logarithm of its reference's length, the closer the text.  A
suffix automaton finds the longest match in one step per letter, and many texts
advance through all languages' automata together.  Arcs of the commonest letters
are a dense table, of as many letters as ``TABLE`` entries have room for; those of
rarer ones are sorted keys that are searched.  So memory grows with the
references' length alone, however large the alphabets and however many the languages.

Texts are reduced to lower-case letters with single spaces between words.
The references come from a bounded sample of labelled rows: ``rows_per_language``
rows by smallest hash of the id, ``chars_per_row`` characters of each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
LANES = 4096  # texts that are parsed together
FEW = 8  # texts so few that they are parsed one by one
TABLE = 1 << 25  # entries of the dense table, at most, but for three per state
SPACE, OTHER = 0, 1  # codes of any run of non-letters, and of letters no reference holds


class SuffixAutomaton:
    """States and transitions of all substrings of a sequence of codes."""

    def __init__(self, codes):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for code in codes:
            state = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and code not in self.next[at]:
                self.next[at][code] = state
                at = link[at]
            if at >= 0:
                target = self.next[at][code]
                if length[at] + 1 == length[target]:
                    link[state] = target
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[target]))
                    length.append(length[at] + 1)
                    link.append(link[target])
                    while at >= 0 and self.next[at].get(code) == target:
                        self.next[at][code] = clone
                        at = link[at]
                    link[target] = link[state] = clone
            last = state


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


class Parser:
    """Counts phrases of many texts against all references at once."""

    def __init__(self, references: dict[str, str]):
        self.languages = sorted(references)
        kept = {lang: self._reduced(_points(references[lang])) for lang in self.languages}
        automata = {}
        counts: dict[int, int] = {}
        for lang in self.languages:
            found, times = np.unique(kept[lang][kept[lang] != 0], return_counts=True)
            for point, n in zip(found.tolist(), times.tolist()):
                counts[point] = counts.get(point, 0) + n
        common = sorted(counts, key=lambda point: (-counts[point], point))
        self.code = np.full(0x110000, OTHER, np.int32)
        self.code[~_letters()] = SPACE
        self.code[common] = np.arange(2, len(common) + 2)
        for lang in self.languages:
            automata[lang] = SuffixAutomaton([int(self.code[p]) if p else SPACE for p in kept[lang]])
        states = sum(len(a.next) for a in automata.values())
        self.width = max(3, min(len(common) + 2, TABLE // max(states, 1)))
        self.rare = len(common) + 2  # a rare arc's key is its state times this, plus its code
        tables, self.roots, base, arcs = [], [], 0, []
        for lang in self.languages:
            automaton = automata.pop(lang)
            tables.append(self._table(automaton, base))
            arcs += [
                ((base + state * self.width) * self.rare + code, base + target * self.width)
                for state, own in enumerate(automaton.next)
                for code, target in own.items()
                if code >= self.width
            ]
            self.roots.append(base)
            base += len(automaton.next) * self.width
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)
        arcs.sort()
        self.keys = np.array([k for k, _ in arcs], np.int64)
        self.targets = np.array([t for _, t in arcs], np.int64)
        self.arcs = dict(arcs)
        self.weight = [math.log2(len(kept[lang]) + 2) for lang in self.languages]

    @staticmethod
    def _reduced(points: np.ndarray) -> np.ndarray:
        points = np.where(_letters()[points], points, 0)
        keep = points != 0
        keep[1:] |= points[:-1] != 0
        return points[keep]

    def _table(self, automaton: SuffixAutomaton, base: int) -> np.ndarray:
        """Entry of (state, code): four times the row of the next state, plus how many
        phrases end: the one so far, if it cannot go on, and a letter that the reference lacks."""
        fresh = np.full(self.width, 4 * base + 1, np.int64)
        for code, state in automaton.next[0].items():
            if code < self.width:
                fresh[code] = 4 * (base + state * self.width)
        table = np.tile(fresh, (len(automaton.next), 1))
        table[1:] += 1
        for state, arcs in enumerate(automaton.next):
            for code, target in arcs.items():
                if code < self.width:
                    table[state, code] = 4 * (base + target * self.width)
        return table.ravel().astype(np.int32 if 4 * (base + table.size) < 1 << 31 else np.int64)

    def _searched(self, keys: np.ndarray) -> np.ndarray:
        """Where rare arcs lead; -1 where there is none."""
        if not len(self.keys):
            return np.full(keys.shape, -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.targets[at], -1)

    def _entries(self, state: np.ndarray, codes: np.ndarray, roots: np.ndarray) -> np.ndarray:
        """Entries of (languages, texts) states and the texts' codes."""
        rare = codes >= self.width
        if not rare.any():
            return self.table[state + codes]
        entry = self.table[state + np.where(rare, OTHER, codes)].astype(np.int64)
        own, wanted = state[:, rare].astype(np.int64), codes[rare]
        on = self._searched(own * self.rare + wanted)
        anew = self._searched(roots.astype(np.int64) * self.rare + wanted)
        # a phrase that goes on; else one ends and another begins, unless the reference lacks the letter
        begun = np.where(anew >= 0, 4 * anew, 4 * roots + 1) + (own != roots)
        entry[:, rare] = np.where(on >= 0, 4 * on, begun)
        return entry

    def _alone(self, language: int, state: int, codes: list[int]) -> tuple[int, int]:
        """(phrases that end, state) of one text from a state on."""
        root, ended = self.roots[language], 0
        item, width, rare, arcs = self.table.item, self.width, self.rare, self.arcs
        for code in codes:
            if code < width:
                entry = item(state + code)
                ended += entry & 3
                state = entry >> 2
            else:
                following = arcs.get(state * rare + code)
                if following is None:
                    ended += state != root
                    following = arcs.get(root * rare + code)
                    if following is None:
                        ended, following = ended + 1, root
                state = following
        return ended, state

    def codes(self, text: str) -> np.ndarray:
        codes = self.code[_points(text)]
        keep = codes != SPACE
        keep[1:] |= codes[:-1] != SPACE
        return codes[keep]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """(languages, texts): number of phrases."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        sizes = np.array([len(texts[i]) for i in order])
        flat = np.concatenate([texts[i] for i in order]) if order else np.zeros(0, np.int32)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if order else sizes
        roots = np.array(self.roots, np.int64)[:, None]
        state = np.repeat(roots, len(order), axis=1)
        count = np.zeros(state.shape, np.int64)
        alive = len(order)
        # ends[t]: how many texts are longer than t
        longest = int(sizes[0]) if order else 0
        alive_at = len(order) - np.searchsorted(sizes[::-1], np.arange(longest), side="right")
        for t in range(longest):
            if alive_at[t] != alive:
                alive = int(alive_at[t])
                state, held = np.ascontiguousarray(state[:, :alive]), state[:, alive:]
                count[:, alive : alive + held.shape[1]] += held != roots
            if alive <= FEW:
                for text in range(alive):
                    codes = flat[starts[text] + t : starts[text] + sizes[text]].tolist()
                    for language in range(len(roots)):
                        ended, state[language, text] = self._alone(language, int(state[language, text]), codes)
                        count[language, text] += ended
                break
            entry = self._entries(state, flat[starts[:alive] + t], roots)
            count[:, :alive] += entry & 3
            state = entry >> 2
        count[:, :alive] += state != roots
        found = np.empty_like(count)
        found[:, order] = count
        return found

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, score, and how many letters its phrases have on average (0 without letters)."""
        langs, scores, fits = [], [], []
        for at in range(0, len(texts), LANES):
            for found, part in zip((langs, scores, fits), self._predict(texts[at : at + LANES])):
                found += part
        return langs, scores, fits

    def _predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        codes = [self.codes(t) if t else np.zeros(0, np.int32) for t in texts]
        phrases = self.phrases(codes)
        cost = phrases * np.array(self.weight)[:, None]
        langs, scores, fits = [], [], []
        for i, own in enumerate(codes):
            if not self.languages or not (own != SPACE).any():
                langs.append(UNDETERMINED)
                scores.append(0.0)
                fits.append(0.0)
                continue
            ranked = np.argsort(cost[:, i], kind="stable")
            best = cost[ranked[0], i]
            second = cost[ranked[1], i] if len(ranked) > 1 else math.inf
            langs.append(self.languages[ranked[0]])
            scores.append(1.0 if math.isinf(second) else float(second / (best + second)))
            fits.append(float((own != SPACE).sum() / phrases[ranked[0], i]))
        return langs, scores, fits


@lru_cache(maxsize=2)
def _parser(references: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(dict(references))


def learn(
    docs: DataFrame,
    *,
    where: Column | None = None,
    rows_per_language: int = 32,
    chars_per_row: int = 1024,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> dict[str, str]:
    """Reference text per language, from rows with a label and a text that meet ``where``.

    At most ``rows_per_language`` rows of each label reach the driver: their
    ids are chosen first, each task handing on that many per label at most.
    """
    labelled = docs.where(F.col(lang_column).isNotNull() & (F.length(text_column) > 0))
    if where is not None:
        labelled = labelled.where(where)
    place = Window.partitionBy("__lang").orderBy("__hash", "__id")
    chosen = (
        labelled.select(
            F.col(lang_column).cast("string").alias("__lang"),
            F.xxhash64(id_column).alias("__hash"),
            F.col(id_column).alias("__id"),
        )
        .withColumn("__place", F.row_number().over(place))
        .where(F.col("__place") <= rows_per_language)
        .select("__lang", "__id")
        .distinct()
    )
    rows = (
        labelled.select(
            F.col(id_column).alias("__id"),
            F.col(lang_column).cast("string").alias("__lang"),
            F.substring(text_column, 1, chars_per_row).alias("__text"),
        )
        .join(F.broadcast(chosen), ["__id", "__lang"], "left_semi")  # rows_per_language of each label
        .withColumn("__place", F.row_number().over(Window.partitionBy("__lang").orderBy("__id", "__text")))
        .where(F.col("__place") <= rows_per_language)
        .orderBy("__lang", "__id", "__text")
        .collect()
    )
    references: dict[str, str] = {}
    for row in rows:
        references[row["__lang"]] = references.get(row["__lang"], "") + " " + row["__text"]
    return references


def identify(
    docs: DataFrame,
    references: dict[str, str],
    *,
    text_column: str = "text",
    lang_column: str = "lang_pred",
    score_column: str = "score",
    fit_column: str | None = None,
) -> DataFrame:
    """``docs`` with the predicted language and a score.

    ``fit_column``, if given, is how many letters a phrase of that language has on
    average: about six for text like its reference, one for a script that no reference has.

    The score is the runner-up's cost over the sum of both: 0.5 when two
    languages tie (the first by name is taken), 1 with a single language.  A
    NULL text or one without a letter is "und" with score 0, and so is every
    text if there is no reference.  Columns of these names are replaced; all
    others, and repeated rows, are passed on.  Whole texts are parsed; a very long
    one takes some tenths of a microsecond per character and language.  An empty table gives no rows.
    """
    results = [(lang_column, "string"), (score_column, "double")] + [(fit_column, "double")] * (fit_column is not None)
    kept = [c for c in docs.columns if c not in dict(results)]
    frozen = tuple(sorted(references.items()))
    at = kept.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(frozen)
        for batch in batches:
            found = parser.predict(batch.column(at).to_pylist())
            arrays = [pa.array(values, kind) for values, kind in zip(found, (pa.string(), pa.float64(), pa.float64()))]
            names = [name for name, _ in results]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays[: len(names)]], names=[*batch.schema.names, *names])

    schema = docs.select(kept).schema
    for name, kind in results:
        schema = schema.add(name, kind)
    return docs.select(kept).mapInArrow(run, schema)
