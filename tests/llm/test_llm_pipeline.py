"""The pipeline against its stages done plainly, one after another."""

import llm_brute as brute
import corpus_pipeline

from tally.llm import quality


LIMITS = (quality.WIDE_CHAR_LIMIT, quality.WIDE_WORD_LIMIT), (quality.CHAR_LIMIT, quality.WORD_LIMIT)


def plain_run(docs, items):
    docs = [d for d, k in zip(docs, brute.quality(docs, quality.COMMON, *LIMITS)) if k]
    return plain_rest(docs, items)


def plain_rest(docs, items):
    """The stages after the first."""
    docs = [(d[0], t, *d[2:]) for d, (t, _, _) in zip(docs, brute.frequent_lines(docs, near_once=True))]
    classes = brute.near_classes([d[:2] for d in docs])
    docs = [d for d, (c, _) in zip(docs, classes) if c == d[0] or not brute.words(d[1])]
    docs = [d for d in docs if not brute.contamination(d[1], items)[1]]
    mixed = brute.mixture([(d[0], d[1], d[3]) for d in docs])
    return sorted((d[0], d[1], d[2], d[3], len(d[1]), t // n, t) for d, (n, _, _, t) in zip(docs, mixed) if n and t)


def test_run_like_plain_stages(spark, small_dir):
    found = corpus_pipeline.run(spark, small_dir)
    assert found.columns == [*corpus_pipeline.COLUMNS, "copies", "taken"]
    docs = [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(tuple(r) for r in found.collect()) == plain_run(docs, items)


def test_stages_return_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][2] == "n-gram Jaccard join" and len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, small_dir).dtypes == docs.dtypes


def test_stages_of_an_empty_table(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small_dir).count() == 0


def shared(site, copies, others):
    """Near copies of a page of 20 lines that own their first and last line, among unlike pages."""
    middle = "\n".join(f"shared line {site} {k} says this {k * 7} and that {k * 11} of it" for k in range(20))
    rows = [f"{site} own first line {i}\n{middle}\n{site} own last line {i}" for i in range(copies)]
    own = lambda i: "\n".join(f"page {site} {i} line {k} with words {i * k} {i + k} of its own" for k in range(9))
    return rows + [f"head of {site}\n{own(i)}" for i in range(others)]


def test_one_of_many_near_copies_keeps_its_whole_text(spark, documents, tmp_path):
    texts = [(t, "hot") for t in shared("hot", 30, 120)] + [(t, "cold") for t in shared("cold", 90, 30)]
    rows = [(i, t, "en", s) for i, (t, s) in enumerate(texts)]
    rows += [(500 + i, texts[0][0], "en", "hot") for i in range(40)]  # and exact copies of one of them
    rows += [(600, None, "en", "hot"), (601, "", "en", None), (None, texts[40][0], "en", "hot"), (0, texts[0][0], "en", "hot")]
    cleaned = corpus_pipeline.line_dedup(spark, documents(rows), "")
    got = {(r.doc_id, r.source): r.text for r in cleaned.collect()}
    for (doc, text, _, source), (t, _, _) in zip(rows, brute.frequent_lines(rows, near_once=True)):
        assert got[doc, source] == t
    assert got[3, "hot"] == texts[3][0]  # whole
    assert got[35, "hot"] == texts[35][0].removeprefix("head of hot\n")  # true boilerplate still goes
    left = corpus_pipeline.near_duplicates(spark, cleaned, "").collect()
    near = [r.text for r in left if r.text and "shared line hot" in r.text]
    assert near == [texts[0][0]] and sum("shared line cold" in (r.text or "") for r in left) == 1
