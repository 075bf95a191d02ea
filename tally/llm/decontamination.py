"""Benchmark decontamination by winnowing, with built-in functions only.

Of every ``window - gram + 1`` consecutive grams of a text the one with the least hash is kept.
Two texts that share ``window`` words share all grams inside them, hence also the kept one: no
shared span of that length can be missed.  Kept hashes of documents are joined to those of the
benchmark; every match is then compared word by word and extended to both sides, so a hash can
cost a comparison but never a wrong hit.

Items shorter than a window are one span as a whole.  Winnowing promises nothing for them, so all
grams of exactly their lengths are looked up; this costs time only if such items exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.texts import BROADCAST_BYTES, written
from tally.operators import join_dim

WINDOW = 10
GRAM = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[\p{Alnum}\P{ASCII}]+"  # the rest of the characters; far faster than a negated class


def folded_words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; a null text has none.

    ``lower`` means the same for plain ASCII and is far cheaper than a character map, which is left
    for the words that need it.
    """

    def plain(value: Column) -> Column:
        return F.octet_length(value) == F.char_length(value)

    text = F.coalesce(text, F.lit(""))
    folded = F.transform(
        F.split(text, BETWEEN), lambda w: F.when(plain(w), F.lower(w)).otherwise(F.translate(w, _UPPER, _LOWER))
    )
    return F.array_remove(F.when(plain(text), F.split(F.lower(text), BETWEEN)).otherwise(folded), "")


def _hash_at(words: Column, i: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(words, i + j) for j in range(length)])


def _grams(words: str, length: int) -> Column:
    """Hashes of all grams of a length, by position."""
    positions = F.sequence(F.lit(0), F.size(words) - length)
    return F.when(F.size(words) >= length, F.transform(positions, lambda i: _hash_at(F.col(words), i, length)))


def _kept(grams: str, reach: int) -> Column:
    """The distinct least hashes of all runs of ``reach`` grams."""
    runs = F.sequence(F.lit(0), F.size(grams) - reach)
    least = F.transform(runs, lambda i: F.least(*[F.get(F.col(grams), i + j) for j in range(reach)]) if reach > 1 else F.get(F.col(grams), i))
    return F.when(F.size(grams) >= reach, F.array_distinct(least))


def _none() -> Column:
    return F.array().cast("array<bigint>")


def _index(benchmark: DataFrame, window: int, gram: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """(fp, gram, before, after, need, body) of the benchmark; (body, item_id); lengths below a window."""
    items = written(
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), folded_words(F.col("text")).alias("words"))
        .filter(F.size("words") > 0)
        .withColumn("body", F.md5(F.array_join("words", " "))),
        "benchmark-items",
    )
    bodies = items.groupBy("body").agg(F.first("words").alias("words"))  # copies of an item are looked up once
    near = window - gram
    long = bodies.filter(F.size("words") >= window).withColumn("grams", _grams("words", gram))
    kept = long.select("body", F.explode(_kept("grams", near + 1)).alias("fp"))
    places = long.select("body", "words", F.posexplode("grams").alias("at", "fp")).join(kept, ["body", "fp"], "left_semi")
    at = F.col("at")
    index = places.select(
        "fp", F.slice("words", at + 1, gram).alias("gram"),
        F.slice("words", F.greatest(at + 1 - near, F.lit(1)), F.least(at, F.lit(near))).alias("before"),
        F.slice("words", at + 1 + gram, near).alias("after"), F.lit(window).alias("need"), "body",
    )
    lengths = sorted(r[0] for r in items.select(F.size("words")).filter(F.size("words") < window).distinct().collect())
    none = F.array().cast("array<string>")
    for length in lengths:  # below ``window``, so there are few
        whole = bodies.filter(F.size("words") == length)
        fp = _hash_at(F.col("words"), F.lit(0), length)
        index = index.unionByName(
            whole.select(fp.alias("fp"), F.col("words").alias("gram"), none.alias("before"), none.alias("after"), F.lit(length).alias("need"), "body")
        )
    return index.distinct(), items.select("body", "item_id").distinct(), lengths


def _agreeing(words: str, other: Column, at) -> Column:
    """How many words of ``other`` agree with the document, from the first on; ``at(i)``: place of the i-th."""
    same = F.transform(other, lambda w, i: F.coalesce(F.get(F.col(words), at(i)) == w, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(other)).cast("int")


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, limit: int = BROADCAST_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(hits, spans) of the documents with shared windows, one row a distinct (doc_id, text).

    Both have ``key`` (see :func:`document_key`).  ``hits``: n_hit, n_items, items (sorted ids);
    ``spans``: body (md5 of the item's words), start and end, word positions that agree.
    Null texts have no words; ids may be null or repeated.  An empty side gives no rows.
    """
    index, items, lengths = _index(benchmark, window, gram)
    index = written(index, "benchmark-index")
    texts = docs.select(document_key(docs).alias("key"), F.col("text"))
    parsed = texts.select("key", folded_words(F.col("text")).alias("words")).withColumn("grams", _grams("words", gram))
    prints = F.coalesce(_kept("grams", window - gram + 1), _none())
    if lengths:
        prints = F.array_distinct(F.concat(prints, *[F.coalesce(_grams("words", n), _none()) for n in lengths]))
    kept = parsed.select("key", F.explode(prints).alias("fp"))
    found = join_dim(kept, index.select("fp").distinct(), "fp", "left_semi", spread_by=["key"], limit=limit)
    found = written(found.groupBy("key").agg(F.collect_set("fp").alias("fps")), "benchmark-matches")

    # words again, of the documents with a match only
    matched = join_dim(texts, found, "key", limit=limit).dropDuplicates(["key"])
    opened = matched.select("key", folded_words(F.col("text")).alias("words"), F.explode("fps").alias("fp"))
    pairs = join_dim(opened, index, "fp", spread_by=["key"], limit=limit)
    alike = F.filter(
        F.sequence(F.lit(0), F.size("words") - F.size("gram")),
        lambda i: (F.get("words", i) == F.get("gram", F.lit(0))) & (F.slice("words", i + 1, F.size("gram")) == F.col("gram")),
    )
    placed = pairs.select("key", "words", "gram", "before", "after", "need", "body", F.explode(alike).alias("at"))
    size = F.size("gram")
    left = _agreeing("words", F.reverse("before"), lambda i: F.col("at") - 1 - i)
    right = _agreeing("words", F.col("after"), lambda i: F.col("at") + size + i)
    spans = (
        placed.select("key", "body", "need", (F.col("at") - left).alias("start"), (F.col("at") + size + right).alias("end"))
        .filter(F.col("end") - F.col("start") >= F.col("need"))
        .select("key", "body", "start", "end")
        .distinct()
    )
    spans = written(spans, "benchmark-spans")
    ranges = spans.select("key", "start", "end").distinct().groupBy("key")
    covered = F.aggregate(
        F.sort_array("ranges"),
        F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda s, r: F.struct(
            F.greatest(s["upto"], r["end"]).alias("upto"),
            (s["n"] + F.greatest(r["end"] - F.greatest(s["upto"], r["start"]), F.lit(0))).alias("n"),
        ),
        lambda s: s["n"],
    )
    words_hit = ranges.agg(F.collect_list(F.struct("start", "end")).alias("ranges")).select("key", covered.alias("n_hit"))
    named = spans.select("key", "body").distinct().join(items, "body").groupBy("key")
    named = named.agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("items"))
    return words_hit.join(named, "key"), spans


def document_key(docs: DataFrame) -> Column:
    """Names a row by its content, so rows alike share what was found for them."""
    text = F.coalesce(docs["text"], F.lit(""))
    return F.concat_ws(":", F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.xxhash64(text), F.octet_length(text))


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_hit``, ``n_items``, ``items`` and ``contaminated``.

    A word is hit if it lies in an occurrence of ``window`` consecutive words of an item (of the
    whole item, if shorter).  Columns named like the added ones are replaced, others kept.
    """
    made = ["n_words", "n_hit", "n_items", "items", "contaminated"]
    columns = [c for c in docs.columns if c not in made]
    held = {f"in{i}": c for i, c in enumerate(columns)}  # so that no name of the input can clash
    hits = written(contamination(docs, benchmark, window, gram, limit)[0], "benchmark-hits")
    rows = docs.select(
        *[docs[c].alias(n) for n, c in held.items()],
        document_key(docs).alias("key"),
        F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"),
    )
    return join_dim(rows, hits, "key", "left", limit=limit).select(
        *[F.col(n).alias(c) for n, c in held.items()],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
