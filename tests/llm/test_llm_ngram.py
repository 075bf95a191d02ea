import random

import llm_brute as brute
import numpy as np
import pytest

from tally.llm.ngram_join import connected, drop_near_duplicates, gram_set, ngram_classes, prefix_length, signature, _permutations


def varied(base, k, rng):
    found = base.split()
    for _ in range(k):
        found[rng.randrange(len(found))] = f"new{rng.randrange(10**6)}"
    return " ".join(found)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = []
    for b in range(6):
        base = " ".join(f"b{b}x{rng.randrange(400)}" for _ in range(180))
        for _ in range(14):
            out.append(varied(base, rng.choice([0, 0, 1, 2, 3, 4, 5]), rng))
    out += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    out += ["a b c", "a b c", "a b", "", None, None, "The " * 400, "The " * 300, "  a   b c\n"]
    made = list(enumerate(out))
    return made + [(None, out[0]), (3, out[3]), (3, "another text under this id " * 3)]


@pytest.mark.parametrize("settings", [{}, {"limit": 0, "block_classes": 5}, {"block_grams": 300}])
def test_classes_like_brute_force(documents, rows, settings):
    docs = documents(rows).selectExpr("*", "1 AS class", "2 AS key", "3 AS class_id")
    found = sorted(((r.doc_id, r.class_id, r.n_links) for r in ngram_classes(docs, **settings).collect()), key=repr)
    expected = [(d, c if brute.words(t) else d, n) for (d, t), (c, n) in zip(rows, brute.near_classes(rows))]
    assert found == sorted(expected, key=repr)


def test_one_of_each_class_stays(documents, rows):
    kept = drop_near_duplicates(documents(rows)).collect()
    groups = {}
    for (d, t), (c, n) in zip(rows, brute.near_classes(rows)):
        groups.setdefault(("alone", d, t) if not brute.words(t) else c, []).append(d)
    assert len(kept) == len(groups) + sum(1 for k, v in groups.items() if isinstance(k, tuple) for _ in v[1:])
    assert drop_near_duplicates(documents(rows).limit(0)).count() == 0


def test_alike_rows_only(documents):
    same = [(5, "one two three four five six seven")] * 9
    assert drop_near_duplicates(documents(same)).count() == 1
    assert {(r.class_id, r.n_links) for r in ngram_classes(documents(same)).collect()} == {(5, 8)}


def test_prefix_keeps_the_recall():
    length = prefix_length(0.8, 24, 8, 0.9999)
    assert 1 - (1 - 0.8**length) ** 24 >= 0.9999 > 1 - (1 - 0.8 ** (length + 1)) ** 24
    with pytest.raises(ValueError):
        prefix_length(0.1, 2, 4, 0.999)


def test_signatures_estimate_similarity():
    a, b = _permutations(400)
    x, y = gram_set(" ".join(f"w{i}" for i in range(500))), gram_set(" ".join(f"w{i}" for i in range(60, 560)))
    true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert abs(np.mean(signature(x, a, b) == signature(y, a, b)) - true) < 0.08


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    assert {(r.node, r.component) for r in connected(edges, "test").collect()} == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}
