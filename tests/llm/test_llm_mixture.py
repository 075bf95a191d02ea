import random
from collections import Counter

import llm_brute as brute
import pytest

from tally.llm.mixture import mix_counts


def rows(seed=3, n=60):
    rng = random.Random(seed)
    out = [(i, "w " * rng.choice([3, 5, 8, 13, 40, 90]), rng.choice("abbbc")) for i in range(n)]
    return out + [(90, "w " * 700, "b"), (91, None, "a"), (92, "", None)]


def test_slopes_spend_what_is_left():
    for left in (1.0, 40.0, 500.0, 1500.0):
        sizes = [3, 5, 5, 8, 13, 700, 900, 0]
        c = brute.slope(sizes, left)
        assert sum(min(1, c * n) * n for n in sizes) == pytest.approx(left)


def test_inclusion_follows_the_chances():
    """How often documents are taken beyond their certain copies, over many seeds."""
    docs = rows()
    taken, trials = Counter(), 600
    for seed in range(trials):
        for i, (size, total, target, words) in enumerate(brute.mixture(docs, seed=f"s{seed}")):
            if size:
                taken[i] += words // size - target // total
    sizes = [len(brute.words(t)) for _, t, _ in docs]
    mixed = brute.mixture(docs)
    for source in "abc":
        own = [i for i, r in enumerate(docs) if r[2] == source and sizes[i]]
        total, target = mixed[own[0]][1:3]
        c = brute.slope([sizes[i] for i in own], target - target // total * total)
        for size in {sizes[i] for i in own}:
            alike = [i for i in own if sizes[i] == size]
            found = sum(taken[i] for i in alike) / len(alike) / trials
            assert found == pytest.approx(min(1, c * size), abs=0.12)  # the cut falls within a document


@pytest.mark.parametrize("seed", ["mixture-1", "other"])
def test_mix_like_brute_force(spark, seed):
    docs = rows() + [rows()[4]] * 30 + [(95, "x " * 7, None)] * 2
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 AS _c", "2 AS size").repartition(3)
    found = sorted((r.doc_id, r.source or "", r.size, r.taken) for r in mix_counts(df, seed=seed).collect())
    expected = brute.mixture(docs, seed=seed)
    assert found == sorted((d, s or "", size, taken) for (d, _, s), (size, _, _, taken) in zip(docs, expected))


def test_sources_come_near_their_targets(spark):
    df = spark.createDataFrame(rows(8, 400), "doc_id long, text string, source string")
    by_source = mix_counts(df).groupBy("source", "target", "source_size").sum("taken").collect()
    for r in by_source:
        assert abs(r["sum(taken)"] - r.target) <= 45 and r["sum(taken)"] <= 2 * r.source_size
