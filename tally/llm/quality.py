"""Quality rules: base counts, and the divergence of a text's histograms from its language's.

Two histograms describe a text: its characters by class, and its words by common word of its
language (one bin for all others).  Both are compared with the language's reference, the same
histogram over the documents of that language, by Jensen-Shannon distance (base 2, so 0 to 1).
A histogram is judged only if the text is long enough to fill it and the reference rests on
enough text; a document is rejected if a judged distance exceeds its limit.  A short text is far from
its language by chance alone: n words that are drawn from the reference itself have an expected
squared distance of about (bins - 1) / (8 n ln 2).  The limit for words allows for that; for the few
character classes it is small where judging starts, and the limit is the same for every length.

The reference is made twice: over all documents, and again over those that the base rules and
wide limits against the first one leave, so that the junk of a language does not move its own
yardstick.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.llm.texts import BROADCAST_BYTES, rows, words, written
from tally.operators import join_dim

LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
CHARS_JUDGED = 200  # characters a text needs for the comparison of character classes
WORDS_JUDGED = 100  # words it needs for the comparison of common words
REFERENCE_WORDS = 1000  # words a language needs for a reference
# The limits of words are for long texts; see word_limit_at.
WIDE_CHAR_LIMIT, WIDE_WORD_LIMIT = 0.25, 0.25  # against the first reference
CHAR_LIMIT, WORD_LIMIT = 0.20, 0.20  # against the second

# Common words by language.
COMMON: dict[str, str] = {
    "en": "the of and to in a is that for it was on are as with be by this at from or an which not have but they you his her",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur se ne ce il sont la avec son mais comme",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más pero sus le ha me si sin",
}
WORD_BINS = 31  # 30 common words and one for the rest

#: Character classes: lower, upper, digit, space, sentence mark, other ASCII, beyond ASCII.
CLASSES = 7

_SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\x0b\x0c\r"
_MARKS = ".,;:!?'\"()-"


def _class_table() -> np.ndarray:
    kinds = np.full(256, 5, dtype=np.uint8)
    kinds[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz"]] = 0
    kinds[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 1
    kinds[[ord(c) for c in "0123456789"]] = 2
    kinds[[ord(c) for c in _SPACE]] = 3
    kinds[[ord(c) for c in _MARKS]] = 4
    kinds[0x80:0xC0] = CLASSES  # bytes that only continue a character
    kinds[0xC0:] = 6
    return kinds


_CLASS_OF_BYTE = _class_table()


def _forms(listed: str) -> dict[str, int]:
    """Written forms of the common words: as they are or capitalised, perhaps before a mark."""
    return {
        form + mark: i
        for i, word in enumerate(dict.fromkeys(listed.split()))
        for form in (word, word[0].upper() + word[1:])
        for mark in ("", *".,;:!?")
    }


def char_classes(text: str) -> list[int]:
    counts = np.bincount(_CLASS_OF_BYTE[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)], minlength=CLASSES + 1)
    return counts[:CLASSES].tolist()


def repeated_words(found: list[str]) -> int:
    """Words inside 3-word windows that occur twice or more in the text."""
    windows = list(zip(found, found[1:], found[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times, covered = Counter(windows), bytearray(len(found))
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered[i : i + 3] = b"\x01\x01\x01"
    return sum(covered)


def repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(_SPACE)]
    return len(lines) - len(set(lines))


_COUNTS = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField(name, T.ArrayType(T.LongType())) for name in ("char_counts", "word_counts")]
)
_ARROW_COUNTS = pa.struct(
    [(f.name, pa.list_(pa.int64()) if isinstance(f.dataType, T.ArrayType) else pa.int64()) for f in _COUNTS]
)


def _described(text: str | None, known: Mapping[str, int] | None) -> tuple:
    text = text or ""
    found = words(text)
    bins = [0] * WORD_BINS
    if known is not None:
        for place, times in Counter(map(known.get, found)).items():
            bins[WORD_BINS - 1 if place is None else place] = times
    symbols = sum(map(text.count, _SYMBOLS))
    return len(found), sum(map(len, found)), symbols, repeated_lines(text), repeated_words(found), char_classes(text), bins


def described(
    docs: DataFrame, common: Mapping[str, str] | None = None, text: str = "text", lang: str = "lang", drop: Sequence[str] = ()
) -> DataFrame:
    """``docs`` with ``f``, the base counts and both histograms of a text, less the columns in ``drop``.

    ``text`` and ``lang`` name the columns; the language picks the common words.  A null text counts
    as empty.
    """
    forms = {name: _forms(listed) for name, listed in (COMMON if common is None else common).items()}
    kept = [f for f in docs.schema if f.name not in drop]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [_described(said, forms.get(language)) for said, language in rows(batch, text, lang)]
            parts = [pa.array(column, field.type) for column, field in zip(zip(*counts), _ARROW_COUNTS)]
            if counts:
                whole = pa.StructArray.from_arrays(parts, fields=list(_ARROW_COUNTS))
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), whole], [*(f.name for f in kept), "f"])

    return docs.mapInArrow(describe, T.StructType([*kept, T.StructField("f", _COUNTS)]))


def references(described_docs: DataFrame) -> DataFrame:
    """(lang_key, ref_chars, ref_words, ref_n): summed histograms of all documents, a row a language."""
    sums = [F.sum(F.get("f.char_counts", F.lit(i))).alias(f"c{i}") for i in range(CLASSES)]
    sums += [F.sum(F.get("f.word_counts", F.lit(i))).alias(f"w{i}") for i in range(WORD_BINS)]
    summed = described_docs.groupBy("lang_key").agg(F.sum("f.n_words").alias("ref_n"), *sums)
    return summed.select(
        "lang_key",
        F.array(*[F.col(f"c{i}") for i in range(CLASSES)]).alias("ref_chars"),
        F.array(*[F.col(f"w{i}") for i in range(WORD_BINS)]).alias("ref_words"),
        "ref_n",
    )


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x).cast("double")


def js_distance(own: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two count arrays; null if one of them is empty."""

    def part(p: Column, q: Column) -> Column:  # p log2(p / m), 0 for p = 0
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    total, other = F.nullif(_total(own), F.lit(0.0)), F.nullif(_total(reference), F.lit(0.0))
    both = F.zip_with(own, reference, lambda a, b: F.struct((a / total).alias("p"), (b / other).alias("q")))
    summed = F.aggregate(both, F.lit(0.0), lambda s, x: s + part(x["p"], x["q"]) + part(x["q"], x["p"]))
    return F.when(total.isNotNull() & other.isNotNull(), F.sqrt(F.greatest(summed / 2, F.lit(0.0))))


def word_limit_at(limit: float, n_words: Column) -> Column:
    """The limit for a text of ``n_words``: ``limit`` and the distance to expect by chance, as squares added up."""
    return F.sqrt(F.lit(limit * limit) + F.lit((WORD_BINS - 1) / (8 * math.log(2))) / n_words)


def lang_key(lang: Column) -> Column:
    return F.when(lang.isNull(), F.lit("none")).otherwise(F.concat(F.lit("l:"), lang))


def verdicts(
    described_docs: DataFrame,
    refs: DataFrame,
    char_limit: float = CHAR_LIMIT,
    word_limit: float = WORD_LIMIT,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Adds char_distance, word_distance (null where not judged), base_failed and kept."""
    joined = join_dim(described_docs, refs, "lang_key", "left", limit=limit)
    enough = F.col("ref_n") >= REFERENCE_WORDS
    chars = F.when(enough & (_total(F.col("f.char_counts")) >= CHARS_JUDGED), js_distance(F.col("f.char_counts"), F.col("ref_chars")))
    said = F.when(enough & (F.col("f.n_words") >= WORDS_JUDGED), js_distance(F.col("f.word_counts"), F.col("ref_words")))
    failed = (F.col("f.n_words") < LEAST_WORDS) | (100 * F.col("f.n_repeat_words") > MOST_REPEATED * F.col("f.n_words"))
    far = F.coalesce(F.col("char_distance") > char_limit, F.lit(False)) | F.coalesce(
        F.col("word_distance") > word_limit_at(word_limit, F.nullif("f.n_words", F.lit(0))), F.lit(False)
    )
    return (
        joined.withColumn("char_distance", chars)
        .withColumn("word_distance", said)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & ~far)
        .drop("ref_chars", "ref_words", "ref_n")
    )


def clean_references(counted: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The references over what the first ones leave; a language of which nothing is left has none."""
    first = verdicts(counted, references(counted), WIDE_CHAR_LIMIT, WIDE_WORD_LIMIT, limit)
    return written(references(first.filter("kept")), "quality-references")


def quality_report(docs: DataFrame, common: Mapping[str, str] | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """One row a document: doc_id, the base counts, both distances, base_failed and kept.

    Texts are read once; what is kept for the references and the verdicts is a few counts a
    document.  Null texts have no words and fail; a null lang is a language of its own, judged by
    characters only.  Repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text", lang_key(F.col("lang")).alias("lang_key"))
    counted = written(described(texts, common, drop=["text", "lang"]), "quality-counts")
    judged = verdicts(counted, clean_references(counted, limit), limit=limit)
    return judged.select(
        "doc_id", "f.n_words", "f.word_chars", "f.n_symbols", "f.n_dup_lines", "f.n_repeat_words",
        "base_failed", "kept", "char_distance", "word_distance",
    )


def keep_good(docs: DataFrame, common: Mapping[str, str] | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns.

    The references come from a first pass over all documents, the verdicts from a second.
    """
    held = {f"in{i}": c for i, c in enumerate(docs.columns)}  # so that no name of the input can clash
    texts = docs.select("lang", "text", lang_key(docs["lang"]).alias("lang_key"))
    refs = clean_references(written(described(texts, common, drop=["text", "lang"]), "quality-counts"), limit)
    named = {c: n for n, c in held.items()}
    whole = docs.select(*[docs[c].alias(n) for n, c in held.items()], lang_key(docs["lang"]).alias("lang_key"))
    judged = verdicts(described(whole, common, named["text"], named["lang"]), refs, limit=limit)
    return judged.filter("kept").select(*[F.col(n).alias(c) for n, c in held.items()])
