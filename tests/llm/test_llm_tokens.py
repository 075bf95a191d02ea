import functools
import random

import public_tokenizers
import pytest
import sentencepiece

from tally.llm.token_counts import MARK, Transducer, compiled, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "e", "th", "in", " ", "  ", "   ", "\n", "\t", "é", "ß", "中", "😀", "<s>", "</s>", "1", "99", "==", "ing", "\x00", "\xa0", "▁", "Qu", ".", "ﬁ"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_like_the_library(spark, small_dir, library):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    expected = {r.doc_id: len(library.encode(r.text)) for r in docs.collect()}
    for chunk in (32_768, 97):
        found = token_counts(docs, MODEL, chunk).collect()
        assert {r.doc_id: r.n_tokens for r in found} == expected and len(found) == len(expected)


def test_random_texts_in_any_cut(library):
    random.seed(7)
    transducer = compiled(MODEL)
    for _ in range(3000):
        text = "".join(random.choices(PARTS, k=random.randint(1, 30)))
        plain = " " + text.replace(MARK, " ")
        size = random.randint(1, 9)
        maps = [transducer.chunk_map(plain[i : i + size]) for i in range(0, len(plain), size)]
        while len(maps) > 1:  # any order of combining neighbours gives the same map
            i = random.randrange(len(maps) - 1)
            maps[i : i + 2] = [transducer.compose(maps[i], maps[i + 1])]
        assert transducer.count(plain) == transducer.apply(maps[0]) == len(library.encode(text))


def test_texts_without_spaces_have_small_maps(library):
    transducer = compiled(MODEL)
    rng = random.Random(11)
    several = sorted(transducer.alone)[:400]
    assert len(several) > 100
    for letters in (several, ["中", "文", "\U00020000", "語"], ["a", "b", "\n", "th"], ["é", "x", several[0]]):
        for _ in range(50):
            text = "".join(rng.choices(letters, k=200))
            plain = " " + text
            maps = [transducer.chunk_map(plain[i : i + 40]) for i in range(0, len(plain), 40)]
            assert sum(len(head) for head, _, _ in maps[1:]) < 160
            while len(maps) > 1:
                maps = [functools.reduce(transducer.compose, maps[i : i + 2]) for i in range(0, len(maps), 2)]
            assert transducer.apply(maps[0]) == len(library.encode(text))


def test_rounds_of_composition(spark, documents, library):
    base64 = "".join(random.Random(4).choices("ABCDEFGHabcdefgh0123456789+/", k=3000))
    rows = [(1, "word " * 700), (2, base64), (3, "中文語" * 500), (4, base64[:33]), (4, base64[:64]), (5, "a\n" * 999), (5, "a\n" * 999)]
    found = sorted((r.doc_id, r.n_tokens) for r in token_counts(documents(rows), MODEL, 32).collect())
    assert found == sorted((d, len(library.encode(t))) for d, t in rows)


def test_odd_rows(spark, documents, library):
    long = "".join(random.Random(3).choices(PARTS, k=4000))
    rows = [(1, None), (2, ""), (3, " "), (4, "same text"), (4, "same text"), (4, "other"), (None, "x" * 500), (5, long), (5, long)]
    docs = documents(rows).selectExpr("*", "1 AS n_tokens", "2 AS text_hash", "3 AS chunk")
    found = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in token_counts(docs, MODEL, 50).collect())
    assert found == sorted((d or -1, len((t or "").encode()), len(library.encode(t or ""))) for d, t in rows)
    assert token_counts(docs.limit(0), MODEL).count() == 0


def test_forgetting_changes_nothing(monkeypatch, library):
    from tally.llm import token_counts as module

    for name in ("REMEMBERED_WORDS", "KNOWN_STATES", "KNOWN_PAIRS"):
        monkeypatch.setattr(module, name, 20)
    transducer = Transducer(module.sentencepiece_vocabulary(MODEL))
    text = "Some ordinary words, then others; and 12 numbers after.\nA line  with   gaps"
    assert [transducer.count(" " + text) for _ in range(3)] == [len(library.encode(text))] * 3
