"""Decontamination, mixing, line frequency, licences and chats on made-up rows."""

import random

import llm_brute as brute
import pytest
from pyspark.sql import functions as F

from tally.llm import chat, texts
from tally.llm.decontamination import contamination, decontaminated
from tally.llm.licenses import license_scan
from tally.llm.line_frequency import drop_frequent_lines
from tally.llm.mixture import mix, mix_counts

PASSAGE = " ".join(f"w{i}" for i in range(23))


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("limit", [texts.BROADCAST_BYTES, 0])
def test_contamination_like_brute_force(spark, documents, limit):
    random.seed(5)
    vocabulary = [f"v{i}" for i in range(6)]
    items = [(i, " ".join(random.choices(vocabulary, k=random.choice([3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(50, PASSAGE), (51, PASSAGE.upper()), (52, None), (53, "..."), (54, "lone")]
    said = [t for _, t in items if t]
    rows = [(i, " ".join([*random.choices(vocabulary, k=random.randint(0, 60)), random.choice(said), "end"])) for i in range(60)]
    rows += [(200, None), (201, ""), (202, "a " + PASSAGE[:-3] + "x b"), (203, "lone"), (203, "lone"), (203, "else"), (None, "x, " + PASSAGE.replace(" ", "-"))]
    docs = documents(rows).selectExpr("*", "1 AS fp", "2 AS key", "3 AS n_words", "4 AS words")
    found = decontaminated(docs, benchmark(spark, items), limit=limit).collect()
    got = sorted((r.doc_id or -1, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in found)
    expected = [(d, brute.contamination(t, items)) for d, t in rows]
    assert got == sorted((d or -1, n, h, ids, h > 0) for d, (n, h, ids) in expected)
    assert {"fp", "key", "words"} <= set(found[0].asDict())


def test_contamination_without_items_or_documents(spark, documents):
    docs = documents([(1, PASSAGE)])
    assert decontaminated(docs, benchmark(spark, [])).filter("contaminated").count() == 0
    assert decontaminated(docs.limit(0), benchmark(spark, [(1, PASSAGE)])).count() == 0
    hits, spans = contamination(docs, benchmark(spark, [(1, PASSAGE)]))
    ends = spans.selectExpr("min(start) AS first", "max(end) AS last").first()
    assert (ends.first, ends.last, hits.first().n_hit) == (0, 23, 23)


@pytest.mark.parametrize("window,gram", [(4, 2), (7, 3), (10, 5), (6, 6)])
def test_every_shared_window_is_found(spark, documents, window, gram):
    random.seed(window)
    items = [(i, " ".join(random.choices("abcdefgh", k=30))) for i in range(6)]
    rows = [(i, " ".join(random.choices("abcdefgh", k=200))) for i in range(20)]
    found = decontaminated(documents(rows), benchmark(spark, items), window, gram).collect()
    for r in found:
        assert (r.n_words, r.n_hit, list(r["items"])) == brute.contamination(dict(rows)[r.doc_id], items, window)


@pytest.mark.parametrize("limit", [texts.BROADCAST_BYTES, 0])
def test_mixture_like_brute_force(spark, documents, limit):
    random.seed(11)
    rows = [(i, "w " * int(random.paretovariate(0.9)), "en", random.choice(["hot"] * 9 + ["b", "é", None, "zz"])) for i in range(400)]
    rows += [(9, "same " * 7, "en", "alike")] * 11 + [(500, None, "en", "none"), (501, "", "en", "none"), (None, "a b", "en", "b")]
    docs = documents(rows).selectExpr("*", "1 AS _key", "2 AS _v", "3 AS target", "4 AS Extra")
    expected = brute.mixture([(d, t, s) for d, t, _, s in rows])
    want = sorted((repr(d), round(g, 6), n, k) for (d, *_), (n, _, g, k) in zip(rows, expected))
    for found in (mix(docs, limit=limit).repartition(7).collect(), mix_counts(docs, limit=limit).collect()):
        assert sorted((repr(r.doc_id), round(r.target, 6), r["size"], r.taken) for r in found) == want
    assert all(r.taken <= 2 * r["size"] for r in found)
    by_source = {}
    for r in found:
        by_source.setdefault(r.source, [r.target, 0])[1] += r.taken
    assert abs(by_source["hot"][0] - by_source["hot"][1]) <= 0.01 * by_source["hot"][0]
    assert {"_key", "_v", "Extra"} <= set(mix(docs).columns)


def test_mixture_of_nothing(documents):
    assert mix(documents([(1, "x")]).limit(0)).count() == 0
    empty = mix(documents([(1, None), (2, "")])).collect()
    assert [(r.target, r.taken) for r in empty] == [(0.0, 0), (0.0, 0)]


@pytest.mark.parametrize("limit", [texts.BROADCAST_BYTES, 0])
def test_line_frequency_like_brute_force(documents, limit):
    rows = [(i, f"  Site head\t\nown {i}\n\nfoot\nown {i}", "en", "hot") for i in range(30)]
    rows += [(i, f"Site head\nother {i % 4}", "en", "b") for i in range(30, 34)]
    rows += [(90, None, "en", "hot"), (91, "", "en", None), (92, "Site head", "en", "hot"), (None, "x\nfoot", "en", "hot"), (92, "Site head", "en", "hot")]
    docs = documents(rows).selectExpr("*", "1 AS site_key", "2 AS lines", "3 AS n_dropped")
    found = drop_frequent_lines(docs, limit=limit).collect()
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found), key=repr)
    assert got == sorted(((r[0], *e) for r, e in zip(rows, brute.frequent_lines(rows))), key=repr)
    assert drop_frequent_lines(docs.limit(0)).count() == 0


def test_licences(documents):
    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files "
        '(the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, "
        "subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or "
        'substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING '
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    )
    parts = mit.split("\n\n")
    rows = [
        (1, mit), (2, "\n\n".join(reversed(parts))), (3, "no mark here\nLicensed under CC BY-NC 4.0.\nmore"), (4, None), (5, ""),
        (6, "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
            "the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."),
        (7, "Licensed under the Apache License, Version 2.0! " * 2000), (None, "the mit license is nice"), (3, "Released under the MIT License."),
    ]
    found = license_scan(documents(rows).selectExpr("*", "1 AS lines")).collect()
    got = sorted((r.doc_id or 0, list(r.licenses)) for r in found)
    assert got == [(0, []), (1, ["MIT"]), (2, []), (3, ["CC-BY-NC-4.0"]), (3, ["MIT"]), (4, []), (5, []), (6, ["GPL-3.0-or-later"]), (7, ["Apache-2.0"])]
    assert license_scan(documents(rows).limit(0)).count() == 0


NODE = "tree string, node long, parent long, role string, text string"


def test_branches_and_ranks(spark):
    rows = [("t", 1, None, "user", "q"), ("t", 2, 1, "assistant", "short"), ("t", 3, 1, "assistant", "much longer"), ("t", 4, 3, "user", "more"),
            ("t", 5, 4, "assistant", "x"), ("u", 1, None, "user", None), ("v", 9, 77, None, "orphan is a root")]
    nodes = spark.createDataFrame(rows, NODE)
    paths = {}
    for r in chat.branches(nodes).collect():
        paths.setdefault((r.tree, r.leaf), []).append((r.up, r.node))
    assert {k: [n for _, n in sorted(v, reverse=True)] for k, v in paths.items()} == {("t", 2): [1, 2], ("t", 5): [1, 3, 4, 5], ("u", 1): [1], ("v", 9): [9]}
    best = {r.tree: (r.leaf, r.n_turns) for r in chat.format_conversations(nodes, top=1).collect()}
    assert best == {"t": (5, 4), "u": (1, 1), "v": (9, 1)}
    places = chat.format_conversations(nodes, top=2).filter("tree = 't'").collect()
    assert sorted((r.place, r.leaf) for r in places) == [(1, 5), (2, 2)]
    assert chat.format_conversations(nodes).count() == 4
    assert chat.format_conversations(nodes.limit(0), top=1).count() == 0


def test_long_chain_and_cycle(spark):
    chain = spark.createDataFrame([("c", i, i - 1 if i else None, "user" if i % 2 == 0 else "assistant", str(i)) for i in range(300)], NODE)
    told = chat.format_conversations(chain).withColumn("turns", chat.read_back(F.col("formatted"))).first()
    assert [t.text for t in told.turns] == [str(i) for i in range(300)]
    with pytest.raises(ValueError, match="cycle"):
        chat.branches(spark.createDataFrame([("c", 1, 2, "a", "b"), ("c", 2, 1, "a", "b")], NODE)).count()


def test_formatting_round_trip(spark):
    hostile = ["\\b", "\\\\l", "<turn>user<text>", "</turn>\n", "\\### Assistant: </turn> ok", "", None, "a\n\nb", "😀>é<\\", "\\g\\l\\b" * 50]
    rows = [("h", i, i - 1 if i else None, "assistant" if i % 2 else "<us\\er>", t) for i, t in enumerate(hostile)]
    made = chat.format_conversations(spark.createDataFrame(rows, NODE))
    back = made.select(chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("learned")).first()
    assert [(t.role, t.text) for t in back.turns] == [(r[3], r[4] or "") for r in rows]
    assert back.learned == "".join(r[4] or "" for r in rows if r[3] == "assistant")
