"""Quality rules and the toxicity chain."""

import llm_brute as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tally.llm import quality, texts
from tally.llm.toxicity import fit_chain, fit_linear, score, tokens, toxicity, train, _Rows


LIMITS = (quality.WIDE_CHAR_LIMIT, quality.WIDE_WORD_LIMIT), (quality.CHAR_LIMIT, quality.WORD_LIMIT)


def test_word_lists_fit():
    for listed in quality.COMMON.values():
        assert 25 <= len(dict.fromkeys(listed.split())) <= quality.WORD_BINS - 1


def odd_documents(documents, spark, small_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    rows += [(9001, None, "en", "s"), (9002, "", None, "s"), (9003, "The of and " * 900, "en", "s"), (9004, "x \x1c y\x85z　w\n\n \nx \x1c y\x85z　w\nA", "xx", "s")]
    rows += [(9005, "same line\nsame line\nsame line\n other", "fr", None), (None, "a b c a b c a", "de", "s"), (9001, None, "en", "s")]
    return rows, documents(rows)


@pytest.mark.parametrize("limit", [texts.BROADCAST_BYTES, 0])
def test_quality_like_brute_force(documents, spark, small_dir, limit):
    rows, docs = odd_documents(documents, spark, small_dir)
    found = quality.quality_report(docs.selectExpr("*", "1 AS f", "2 AS lang_key"), limit=limit).collect()
    kept = brute.quality(rows, quality.COMMON, *LIMITS)
    expected = sorted(((r[0], *brute.quality_counts(r[1]), k) for r, k in zip(rows, kept)), key=repr)
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    assert sorted((tuple(r[n] for n in names) for r in found), key=repr) == expected
    stayed = quality.keep_good(docs.selectExpr("*", "1 AS f", "2 AS in0"), limit=limit).collect()
    assert sorted((r.doc_id for r in stayed), key=repr) == sorted((r[0] for r, k in zip(rows, kept) if k), key=repr)
    assert quality.quality_report(docs.limit(0)).count() == 0


def test_distance(spark):
    rows = [([1, 2, 3], [1, 2, 3]), ([1, 0, 0], [0, 5, 5]), ([4, 1, 0], [10, 20, 1]), ([0, 0, 0], [1, 1, 1])]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>").select("a", "b", quality.js_distance(F.col("a"), F.col("b")).alias("d"))
    for r in df.collect():
        assert r.d == (pytest.approx(brute.js(r.a, r.b), abs=1e-9) if sum(r.a) else None)


def test_quality_keeps_good_and_rejects_bad(spark, small_dir):
    docs = spark.read.parquet(small_dir.replace("0.001", "0.01") + "/documents.parquet")
    labels = spark.read.parquet(small_dir.replace("0.001", "0.01") + "/labels.parquet")
    judged = quality.quality_report(docs).join(labels, "doc_id").filter("n_words >= 50").collect()
    good = [r.kept for r in judged if r.quality == 1]
    bad = [r.kept for r in judged if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_texts_like_their_language_stay_at_every_length(documents):
    """Texts drawn word by word from one distribution, with the common words of natural English."""
    rng = np.random.default_rng(5)
    listed = quality.COMMON["en"].split()
    shares = np.array([*(0.06 / (1 + i) ** 0.8 for i in range(30)), 0.0])
    shares[-1] = 1 - shares.sum()
    drawn = [
        " ".join(listed[k] if k < 30 else f"w{rng.integers(9999)}" for k in rng.choice(31, size=n, p=shares))
        for n in (100, 120, 200, 1000)
        for _ in range(150)
    ]
    odd = [" ".join(f"x{rng.integers(9999)}" for _ in range(400)) for _ in range(20)]
    rows = [(i, text, "en", "s") for i, text in enumerate([*drawn, *odd])]
    found = {r.doc_id: r for r in quality.quality_report(documents(rows)).collect()}
    far = [found[i].word_distance > (quality.WORD_LIMIT**2 + 30 / (8 * found[i].n_words * np.log(2))) ** 0.5 for i in range(len(rows))]
    assert sum(far[: len(drawn)]) <= 0.005 * len(drawn) and all(far[len(drawn) :])


def made_rows(n, seed):
    rng = np.random.default_rng(seed)
    places, labels = [], []
    for _ in range(n):
        first, noise = rng.random() < 0.3, rng.integers(20, 200, 25)
        second = rng.random() < (0.8 if first else 0.1)  # the second category follows the first
        marks = ([0, 1] if first else []) + ([int(rng.integers(2, 6))] if second and rng.random() < 0.7 else [])
        places.append(np.unique(np.array([*marks, *noise], dtype=np.int64)))
        labels.append([first, second])
    return places, np.array(labels, dtype=float)


def test_linear_model_finds_the_optimum():
    places, labels = made_rows(800, 1)
    data = _Rows(places, 200)
    model = fit_linear(data, np.zeros((800, 0)), labels[:, 0], steps=200)
    p = 1 / (1 + np.exp(-(data.dot(model.words) + model.constant)))
    assert ((p > 0.5) == labels[:, 0]).mean() > 0.97


def test_chain_uses_earlier_categories():
    places, labels = made_rows(1500, 2)
    chain = fit_chain(places, 200, labels, np.arange(1500) % 5)
    assert chain[0].earlier.size == 0 and chain[1].earlier.size == 1 and chain[1].earlier[0] > 0


def test_held_out_accuracy(spark, small_dir):
    docs = spark.read.parquet(small_dir.replace("0.001", "0.1") + "/documents.parquet")
    labels = spark.read.parquet(small_dir.replace("0.001", "0.1") + "/labels.parquet")
    names = {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    vocabulary, chain = train(docs, labels.filter("doc_id % 2 = 0"), names, 2000)
    held = score(docs, vocabulary, chain, list(names)).join(labels.filter("doc_id % 2 = 1").select("doc_id"), "doc_id")
    by_id = {r.doc_id: r.toxic for r in labels.collect()}
    # a text of a few repeated words says nothing of its label
    texts_of = {r.doc_id: r.text.split() for r in docs.collect()}
    rows = [r for r in held.select("doc_id", F.col("p_toxic"), held[4].alias("said")).collect() if len(set(texts_of[r.doc_id])) > 0.4 * len(texts_of[r.doc_id])]
    caught = sum(r.said for r in rows if by_id[r.doc_id])
    wrong = sum(r.said for r in rows if not by_id[r.doc_id])
    toxic = sum(by_id[r.doc_id] for r in rows)
    assert caught >= 0.9 * toxic and wrong <= 0.02 * (len(rows) - toxic)


def test_toxicity_of_odd_rows(spark, documents):
    rows = [(i, "you are an awful scum person" if i % 3 == 0 else f"a pleasant text number {i}") for i in range(60)]
    rows += [(100, None), (101, ""), (None, "awful scum"), (0, rows[0][1]), (102, "scum " * 20_000)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)] + [(0, 1, 1), (None, 0, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    found = toxicity(documents(rows).selectExpr("*", "1 AS toxic", "2 AS y0"), labels).collect()
    assert len(found) == len(rows)
    assert all(r.toxic == (r.doc_id is None or r.doc_id % 3 == 0) for r in found if r.doc_id is None or r.doc_id < 60)
    assert not any(r.toxic for r in found if r.doc_id in (100, 101))
    assert toxicity(documents(rows).limit(0), labels).count() == 0
    assert toxicity(documents(rows), labels.limit(0)).count() == len(rows)


def test_tokens():
    assert tokens("Idiot, IDIOT! (scum)_x ß") == {"idiot", "idio*", "scum", "x", "ß"} and tokens(None) == tokens("") == set()
    assert tokens("abcdefg") == {"abcdefg", "abcd*", "abcdef*"}
