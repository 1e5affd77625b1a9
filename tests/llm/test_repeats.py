import re

import pytest
from pyspark.sql import functions as F

from paysieve.llm import repeats
from tests.llm.helpers import awkward_rows, table

PASSAGE = "Alpha beta gamma delta epsilon zeta eta. One two three four five six seven! Kilo lima mike november oscar papa."
SHORT = " ".join(f"Word{chr(97 + i // 26)}{chr(97 + i % 26)} {chr(97 + i % 26)}!" for i in range(35))  # 70 words, no sentence of three


def cut(text):
    """(start, end, plain, line, paragraph) of the sentences, from the lines of the text."""
    found, line, paragraph, breaks = [], 0, 0, 0
    for m in re.finditer(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+", text or ""):
        plain = repeats.normalised(m[0])
        if plain:
            if found and breaks:
                line += 1
                paragraph += breaks > 1
            found.append((m.start(), m.end(), plain, line, paragraph))
            breaks = 0
        breaks += m[0].count("\n")
    return found


def expected(rows, least):
    last = 1 << 63
    every = []
    for number, (doc, text, *_) in enumerate(rows):
        own = cut(text)
        for place, (start, end, plain, _, _) in enumerate(own):
            every.append((doc, number, "sentence", place, start, end, plain))
        for kind, at, inner in (("line", 3, None), ("paragraph", 4, 3)):
            for key in sorted({s[at] for s in own}):
                members = [s for s in own if s[at] == key]
                size = len(members) if inner is None else len({s[inner] for s in members})
                plain = " ".join(s[2] for s in members)
                if size > 1 and len(plain.split(" ")) >= least:
                    every.append((doc, number, kind, -1, members[0][0], members[-1][1], plain))
    ranked = sorted(every, key=lambda u: (last if u[0] is None else u[0], u[4]))
    first, seen = {}, set()
    for u in ranked:
        first.setdefault((u[2], u[6]), u[0])
    out, runs = [], {}
    for u in sorted(every, key=lambda u: (u[1], u[4])):
        doc, number, kind, place, start, end, plain = u
        again = (number, kind, plain) in seen
        seen.add((number, kind, plain))
        keeper = first[kind, plain]
        if again or (last if doc is None else doc) > (last if keeper is None else keeper):
            row = (doc, kind, start, end - start, len(plain.split(" ")), keeper)
            if kind != "sentence":
                out.append(row)
            else:
                runs.setdefault(number, []).append((place, row))
    for own in runs.values():
        run = []
        for i, (place, row) in enumerate(own):
            run.append(row)
            if i + 1 == len(own) or own[i + 1][0] != place + 1:
                if sum(r[4] for r in run) >= least:
                    out += run
                run = []
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [3, 20])
def test_removals_match_brute_force(spark, least):
    rows = [r for r in awkward_rows() if r[0] != 3]  # rows of one id are one document: looked at below
    rows += [
        (500, "start of it " + PASSAGE + " the end", None, None, None),
        (501, "other words here\n" + PASSAGE.upper() + "\n" + PASSAGE, None, None, None),
        (502, PASSAGE, None, None, None),
        (503, "own line\n" + SHORT + "\nanother own line", None, None, None),
        (504, "different\n" + SHORT + "\n\nlast words", None, None, None),
        (505, "para one line\npara two line.\n\n" + PASSAGE.replace("! ", "!\n"), None, None, None),
        (506, "para one line\npara two line\n \nother " + PASSAGE.replace("! ", "\n"), None, None, None),
    ]
    rows = [r for r in rows if r[0] is not None]
    found = repeats.removals(table(spark, rows, extra=True), least_words=least)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows, least)


def test_a_passage_inside_lines_is_cut_and_the_first_stays(spark):
    rows = [(2, "some prefix\n" + PASSAGE + " and on", None, None, None), (1, PASSAGE + " First place.", None, None, None)]
    docs = table(spark, rows).withColumn("start", F.lit(1))
    removed = repeats.removals(docs)
    clean = {r.doc_id: r.text for r in repeats.without_repeats(docs, removed).collect()}
    assert clean[1] == rows[1][1] and clean[2] == "some prefix\n and on"
    assert {(r.doc_id, r.kept_in) for r in removed.collect()} == {(2, 1)}


def test_a_line_of_short_sentences_goes(spark):
    rows = [(i, f"this is only in {chr(97 + i)} and nowhere else\n{SHORT}\nthe end of {chr(97 + i)}", None, None, None) for i in range(3)]
    docs = table(spark, rows)
    removed = repeats.removals(docs)
    assert {r.kind for r in removed.collect()} == {"sentence", "line"}
    clean = {r.doc_id: r.text for r in repeats.without_repeats(docs, removed).collect()}
    assert clean[0] == rows[0][1]
    assert all(clean[i] == f"this is only in {chr(97 + i)} and nowhere else\nthe end of {chr(97 + i)}" for i in (1, 2))


def test_a_paragraph_goes_whole(spark):
    paragraph = "first line of it with words\nsecond line of it\nthird line, and there are more than twenty words in all of these lines"
    rows = [(i, f"own {chr(97 + i)}\n\n{paragraph}\n\nrest {chr(97 + i)}", None, None, None) for i in range(2)]
    removed = repeats.removals(table(spark, rows)).collect()
    assert {r.kind for r in removed} == {"sentence", "paragraph"} and {r.doc_id for r in removed} == {1}


def test_single_repeated_sentences_are_left_alone(spark):
    rows = [(i, f"Thanks for reading this text. Only here {chr(97 + i)} are these words. See you next time, then.", None, None, None) for i in range(9)]
    assert repeats.removals(table(spark, rows)).count() == 0


def test_rows_of_one_id_are_one_document(spark):
    docs = table(spark, [(1, PASSAGE, None, None, None), (1, PASSAGE, None, None, None), (2, PASSAGE, None, None, None), (None, PASSAGE, None, None, None), (None, "x", None, None, None)])
    found = sorted((r.doc_id or 0, r.start, r.kept_in) for r in repeats.removals(docs).where("kind = 'sentence'").collect())
    assert [f[0] for f in found] == [0, 0, 0, 2, 2, 2] and {f[2] for f in found} == {1}


def test_clean_and_empty_tables(spark):
    assert repeats.removals(table(spark, [])).count() == 0
    assert repeats.removals(table(spark, [(1, PASSAGE, None, None, None), (2, "Short. Short.", None, None, None)])).count() == 0


def test_a_very_common_line(spark):
    rows = [(i, f"word{chr(97 + i % 26)} {i // 26} is only here\n" + PASSAGE, None, None, None) for i in range(3000)]
    found = repeats.removals(table(spark, rows).repartition(16))
    lines = found.where("kind = 'line'")
    assert lines.count() == 2999 and lines.where("kept_in <> 0").isEmpty()
