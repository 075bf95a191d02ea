"""Line dedup of the pipeline where one text is copied very often."""

import llm_brute as brute
import corpus_pipeline

from tally.llm.line_frequency import drop_frequent_lines
from tally.llm.ngram_join import copied_rows


def copied():
    rows = [(i, "site head\nsame text\nof many rows", "en", "hot") for i in range(30)]
    rows += [(i, f"site head\nown {i}\nmore of {i}", "en", "hot") for i in range(30, 60)]
    rows += [(i, f"site head{' ' * (i - 60)}", "en", "hot") for i in range(60, 64)]
    return rows + [(70, None, "en", "hot"), (71, "", "en", None), (None, " \n", "en", "hot")]


def test_a_copied_text_is_not_boilerplate(documents):
    rows = copied()
    docs = documents(rows).repartition(5)
    once = {(r[3], r[1] or ""): r for r in rows}
    texts = {key: t for key, (t, _, _) in zip(once, brute.frequent_lines(list(once.values())))}
    found = drop_frequent_lines(docs, copied=copied_rows(docs)).collect()
    got = {(r.doc_id, r.text) for r in found}
    assert got == {(d, None if t is None else texts[s, t]) for d, t, _, s in rows} and len(found) == len(rows)
    assert (3, "same text\nof many rows") in got and (31, "own 31\nmore of 31") in got


def test_line_dedup_keeps_copies_and_leaves_no_empty_rows(spark, documents):
    found = corpus_pipeline.line_dedup(spark, documents(copied()), "").collect()
    kept = {r.doc_id: r.text for r in found}
    assert {d for d in kept if d is not None} == {*range(60), 70, 71} and kept[None] == " \n"
    assert all(kept[i] == "same text\nof many rows" for i in range(30))
    assert all(r.n_chars == len(r.text) for r in found if r.text is not None)
