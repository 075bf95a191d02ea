"""Jaccard join on word 5-grams: MinHash LSH forest for candidates, exact sets for the answer.

1. Texts with the same set of grams are one class (a digest of the set names it); only classes go on.
2. A class gets ``trees`` signatures of ``depth`` minimum hashes.  In an LSH forest a signature is
   a path in a prefix trie, and a match is a shared prefix.  Prefixes start at full length and are
   shortened until a pair at the threshold shares one in some tree with the wanted recall:
   1 - (1 - s^k)^trees >= recall.  Longer prefixes would lose links, shorter ones only add work.
3. Classes that share a prefix are linked to the least class there (one row a class and tree, never
   pairs), and connected components of these links bring together all that must be compared.
4. In a component every pair of classes is compared exactly, by counting shared grams through
   an inverted index.  A component is dealt in blocks of bounded size; a task compares two blocks.
   No pair is written out: a task returns per class the number of linked documents and one class
   of the connected group it found it in.
5. Connected components of the verified links are the near-duplicate classes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.texts import BROADCAST_BYTES, record_batch, rows, words, written
from tally.operators import join_dim

GRAM = 5
THRESHOLD = 0.8
TREES = 24
DEPTH = 8
RECALL = 0.9999
BLOCK_CLASSES = 512
BLOCK_GRAMS = 400_000
REMEMBERED_WORDS = 150_000
NO_ID = -(2**63)  # stands for a null doc_id where rows are told apart

_M = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the gram hash


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = found
        return found


_HASHES = _WordHashes()


def gram_set(text: str | None, gram: int = GRAM) -> np.ndarray:
    """Sorted 64-bit hashes of the word grams; a text of fewer words is one gram, of none empty."""
    found = words(text) if text else []
    if not found:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    size = min(gram, len(values))
    last = len(values) - size + 1
    mixed = np.full(last, np.uint64(size), np.uint64)
    for i in range(size):  # order matters: each word is mixed into what came before
        mixed = (mixed ^ values[i : i + last]) * _M
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold is met with the wanted recall."""
    for length in range(depth, 0, -1):
        if 1 - (1 - threshold**length) ** trees >= recall:
            return length
    raise ValueError("no prefix reaches the recall; use more trees")


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20240521)
    return random.integers(1, 2**63, count, dtype=np.uint64) | np.uint64(1), random.integers(0, 2**63, count, dtype=np.uint64)


def signature(grams: np.ndarray, a: np.ndarray, b: np.ndarray, piece: int = 512) -> np.ndarray:
    """Minimum of each hash function over the set, worked through in pieces that stay in cache."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(grams), piece):
        part = grams[start : start + piece]
        np.minimum(least, (part[None, :] * a[:, None] + b[:, None]).min(axis=1), out=least)
    return least


def _prefix_keys(least: np.ndarray, trees: int, depth: int, length: int) -> list[int]:
    """A 64-bit name of the prefix of each tree's signature."""
    by_tree = least.reshape(trees, depth)[:, :length]
    return [xxhash.xxh64_intdigest(by_tree[t].tobytes(), seed=t) - 2**63 for t in range(trees)]


_CLASSED = pa.schema(
    [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("class", pa.binary()), ("grams", pa.int32())]
    + [("keys", pa.list_(pa.int64()))]
)


def _classify(gram: int, trees: int, depth: int, length: int):
    def classified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _permutations(trees * depth)
        # prefixes are never longer than ``length``, so deeper hashes need no computing
        used = (np.arange(trees)[:, None] * depth + np.arange(length)).ravel()
        for batch in batches:
            found = []
            for doc, text_hash, text in rows(batch, "doc_id", "text_hash", "text"):
                grams = gram_set(text, gram)
                digest = _digest(grams)
                keys = None
                if len(grams):
                    keys = _prefix_keys(signature(grams, a[used], b[used]), trees, length, length)
                found.append((doc, text_hash, digest, len(grams), keys))
            yield record_batch(_CLASSED, found)

    return classified


def connected(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) of undirected (a, b): the least node each can reach.

    In a round every node takes its least neighbour as its parent, parents are followed to their
    roots by doubling, and the edges are moved to the roots, where most of them fall together.  All
    of it is written down; nothing is collected but whether something is left.
    """
    def tidy(pairs: DataFrame) -> DataFrame:
        apart = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b")
        return written(apart.distinct(), f"{name}-edges")

    rest, rounds = tidy(edges), []
    nodes = written(rest.select(F.explode(F.array("a", "b")).alias("node")).distinct(), f"{name}-nodes")
    while not rest.isEmpty():
        both = rest.select("a", "b").union(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        root = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root"))
        root = written(root, f"{name}-roots")
        while True:
            above = root.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            jumped = written(root.join(above, "root").select("node", F.col("higher").alias("root"), (F.col("higher") != F.col("root")).alias("moved")), f"{name}-roots")
            root = jumped.drop("moved")
            if jumped.filter("moved").isEmpty():
                break
        rounds.append(root)
        moved = rest.join(root.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
        moved = moved.join(root.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
        rest = tidy(moved.select(F.col("x").alias("a"), F.col("y").alias("b")))
    found = nodes.withColumn("component", F.col("node"))
    for root in rounds:
        onward = root.select(F.col("node").alias("component"), "root")
        found = found.join(onward, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return found


def _grouped(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[tuple]]:
    """Runs of rows with the same first three values, across batches."""
    held: list[tuple] = []
    for batch in batches:
        columns = [batch.column(n) for n in names]
        plain = [c.to_pylist() for c in columns[:-1]]
        sets = columns[-1]
        for i, row in enumerate(zip(*plain)):
            grams = sets[i].values.to_numpy(zero_copy_only=False).view(np.uint64).copy()
            if held and held[0][:3] != row[:3]:
                yield held
                held = []
            held.append((*row, grams))
    if held:
        yield held


def linked_within(sets: list[np.ndarray], left: list[int], right: list[int], threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each of ``left``: those of ``right`` at least ``threshold`` similar to it.

    Shared grams are counted through an inverted index of the right side.
    """
    sizes = np.array([len(sets[r]) for r in right], dtype=np.int64)
    grams = np.concatenate([sets[r] for r in right]) if right else np.zeros(0, np.uint64)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], np.repeat(np.arange(len(right)), sizes)[order]
    for i in left:
        own = sets[i]
        low, high = np.searchsorted(grams, own, "left"), np.searchsorted(grams, own, "right")
        counts = high - low
        total = int(counts.sum())
        if not total:
            yield i, np.zeros(0, np.int64)
            continue
        at = np.repeat(low - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(total)
        shared = np.bincount(owner[at], minlength=len(right))
        yield i, np.flatnonzero(shared >= threshold * (len(own) + sizes - shared) - 1e-9)


_LINKED = pa.schema([("class", pa.binary()), ("root", pa.binary()), ("linked", pa.int64())])


def _compare(threshold: float):
    names = ("component", "first", "second", "block", "class", "copies", "grams")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, names):
            _, first, second = group[0][:3]
            classes, copies = [g[4] for g in group], np.array([g[5] for g in group])
            sets = [g[6] for g in group]
            left = [i for i, g in enumerate(group) if g[3] == first]
            right = left if first == second else [i for i, g in enumerate(group) if g[3] == second]
            places = np.array(right, dtype=np.int64)
            linked, label = np.zeros(len(group), np.int64), np.arange(len(group))
            for i, hits in linked_within(sets, left, right, threshold):
                others = places[hits]
                others = others[others != i]
                linked[i] += copies[others].sum()
                if first != second:
                    linked[others] += copies[i]
                joined = np.unique(np.append(label[others], label[i]))
                if len(joined) > 1:
                    label[np.isin(label, joined)] = joined[0]
            found = [(classes[i], classes[label[i]], int(linked[i])) for i in np.flatnonzero(linked)]
            if found:
                yield record_batch(_LINKED, found)

    return compared


def _with_grams(gram: int):
    schema = pa.schema([("class", pa.binary()), ("grams", pa.list_(pa.int64()))])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, size = [], 0
            for name, text in rows(batch, "class", "text"):
                grams = gram_set(text, gram)
                if _digest(grams) == name:  # not another row with this id and hash
                    found.append((name, grams.view(np.int64)))
                    size += len(grams)
                if size > 1_000_000:
                    yield record_batch(schema, found)
                    found, size = [], 0
            yield record_batch(schema, found)

    return added


def ngram_groups(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    gram: int = GRAM,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
    block_classes: int = BLOCK_CLASSES,
    block_grams: int = BLOCK_GRAMS,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """(doc_id, text_hash, class_id, n_links, has_grams, stays, keeper) of every row of (doc_id, text).

    ``n_links``: other rows with a Jaccard similarity of at least ``threshold`` on word grams, copies
    included.  ``class_id``: least doc_id of all rows connected by such links, the row's own if it
    has none.  ``stays``: true for the rows (equal in id and text) that stand for their class, ``keeper``: the
    (id, text_hash) of these rows, which names the class.

    Texts of fewer words than a gram are one gram, so they match whole texts only; null and empty
    texts have no gram and match nothing.  Rows alike count as copies of each other, also under one
    doc_id; a null doc_id takes part and is least only among nulls.  Other columns are ignored.
    """
    length = prefix_length(threshold, trees, depth, recall)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("text_hash"), "text")
    ddl = "doc_id long, text_hash long, class binary, grams int, keys array<long>"
    classed = written(base.mapInArrow(_classify(gram, trees, depth, length), ddl), "ngram-classes")

    some = classed.filter("grams > 0")
    sample = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text_hash")
    classes = some.groupBy("class").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("least_doc"), F.max("grams").alias("grams"),
        F.min(sample).alias("sample"), F.first("keys").alias("keys"),
    )
    classes = written(classes, "ngram-class-sizes")  # copies are one row from here on
    prefixes = classes.select("class", F.posexplode("keys").alias("tree", "key"))
    heads = prefixes.groupBy("tree", "key").agg(F.min("class").alias("a"), F.max("class").alias("other"))
    heads = written(heads.filter("a < other").drop("other"), "ngram-heads")
    met = join_dim(prefixes, heads, ["tree", "key"], limit=limit)
    edges = met.filter("class != a").select("a", F.col("class").alias("b")).distinct()
    together = written(connected(edges, "ngram-candidates"), "ngram-together")

    sized = together.join(classes, together["node"] == classes["class"]).select("class", "component", "copies", "grams")
    blocks = sized.groupBy("component").agg(F.count("*").alias("n"), F.sum("grams").alias("total"))
    cut = F.ceil(F.greatest(F.col("n") / block_classes, F.col("total") / block_grams)).cast("int")
    dealt = join_dim(sized, blocks.select("component", cut.alias("blocks")), "component", limit=limit)
    dealt = written(dealt.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")), "ngram-dealt")

    # whole texts of the classes to compare, by one row of each
    wanted = dealt.select("class").join(classes.select("class", "sample.*"), "class")
    named = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), _text_hash().alias("text_hash"), "text")
    texts = join_dim(named, wanted, ["id", "text_hash"], limit=limit).select("class", "text")
    sets = texts.mapInArrow(_with_grams(gram), "class binary, grams array<long>").dropDuplicates(["class"])
    with_sets = dealt.drop("grams").join(sets, "class")
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = with_sets.withColumn("partner", partner).select(
        "component", F.least("block", "partner").alias("first"), F.greatest("block", "partner").alias("second"),
        "block", "class", "copies", "grams",
    )
    keys = ["component", "first", "second"]
    met = spread.repartition(*keys).sortWithinPartitions(*keys)
    links = met.mapInArrow(_compare(threshold), "class binary, root binary, linked long")
    links = written(links, "ngram-links")

    joined = connected(links.filter("class != root").select(F.col("root").alias("a"), F.col("class").alias("b")).distinct(), "ngram-links")
    linked = links.groupBy("class").agg(F.sum("linked").alias("linked"))
    named = (
        classes.join(linked, "class", "left")
        .join(joined.withColumnRenamed("node", "class"), "class", "left")
        .select(
            "class", "copies", "least_doc", "sample",
            F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("component", "class").alias("component"),
        )
    )
    least = named.groupBy("component").agg(F.min("least_doc").alias("class_id"), F.min("sample").alias("keeper"))
    result = named.join(least, "component").select(
        "class", "class_id", "keeper", (F.col("linked") + F.col("copies") - 1).alias("n_links")
    )
    result = written(result, "ngram-result")
    rows_of = classed.select("doc_id", "text_hash", "class", "grams")
    has_grams = F.col("grams") > 0
    itself = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text_hash")
    return join_dim(rows_of, result, "class", "left", spread_by=["doc_id"], limit=limit).select(
        "doc_id",
        "text_hash",
        F.when(has_grams, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        has_grams.alias("has_grams"),
        F.when(has_grams, itself == F.col("keeper")).otherwise(True).alias("stays"),
        F.when(has_grams, F.col("keeper")).otherwise(itself).alias("keeper"),
    )


def ngram_classes(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, class_id, n_links) of every row; see :func:`ngram_groups`."""
    return ngram_groups(docs, **settings).select("doc_id", "class_id", "n_links")


def copied_rows(docs: DataFrame, **settings) -> DataFrame:
    """(id, text_hash, keeper) of the rows that have copies or near copies, each once; see :func:`row_names`."""
    groups = ngram_groups(docs, **settings).filter("has_grams AND n_links > 0")
    return written(groups.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text_hash", "keeper").distinct(), "ngram-copied")


def row_names(docs: DataFrame) -> list[Column]:
    """``id`` and ``text_hash``, by which rows are told apart here."""
    return [F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("id"), _text_hash().alias("text_hash")]


def drop_near_duplicates(docs: DataFrame, limit: int = BROADCAST_BYTES, **settings) -> DataFrame:
    """The rows of ``docs`` less all but one row of each near-duplicate class.

    Rows without words all stay.  Only ids and hashes are compared; texts are not shuffled unless
    the list of rows to drop is too large to broadcast.
    """
    held = {f"in{i}": c for i, c in enumerate(docs.columns)}  # so that no name of the input can clash
    key = [F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("id"), _text_hash().alias("text_hash")]
    named = docs.select(*[docs[c].alias(n) for n, c in held.items()], *key)
    groups = ngram_groups(docs, limit=limit, **settings)
    groups = written(groups.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text_hash", "has_grams", "stays"), "ngram-stays")
    on = ["id", "text_hash"]
    gone = groups.filter(~F.col("stays")).select(*on).distinct()
    kept = join_dim(named, gone, on, "left_anti", limit=limit)
    again = groups.filter(F.col("stays") & F.col("has_grams")).groupBy(*on).count().filter("count > 1").select(*on)
    again = written(again, "ngram-repeated")
    if not again.isEmpty():  # the row that stays is itself repeated
        once = join_dim(kept, again, on, "left_semi", limit=limit).dropDuplicates(on)
        kept = join_dim(kept, again, on, "left_anti", limit=limit).unionByName(once)
    return kept.select(*[F.col(n).alias(c) for n, c in held.items()])
