"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words.  A document is first taken as often as its source's
target covers the whole source; those copies are certain.  What is left of the target, L words, is a
fixed-size sample with unequal chances: the inclusion chance of a document is in proportion to its size,

    p = min(1, c * size),    c such that the chances times the sizes add up to L

so long documents, which carry most of a source's words, are the surest, and those with p = 1 are
certain.  Each document has a fixed random number u and the rank key

    Q = (u / (1 - u)) / (p / (1 - p))

Documents are taken in the order of Q, certain ones first, until the words left are used up.  The gap that
remains, less than one document, is closed by the document beyond the cut whose size is nearest to it, if
that brings the source nearer to its target.

Nothing is sorted as a whole: Q / (1 + Q) lies in (0, 1), so two rounds of counting on a grid
leave one cell a source with about a 2**-24 part of its documents, and only that cell is ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.texts import BROADCAST_BYTES, GAP, written
from tally.operators import join_dim, rank_all

GRID = 4096


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """Adds ``target`` to (_key, source, source_size), one row a source.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` times
    all words.  No target exceeds ``most`` times its source; the excess goes to the others by
    weight, until none is above.  Each round is one aggregation that returns two numbers.
    """
    order = [F.col("source").asc_nulls_last()]
    place = rank_all(sizes, order, "_place", bound=sizes)
    weigh = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("_place") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = written(place.withColumn("_weight", weigh).drop("_place"), "mix-weights")
    cap = F.col("source_size") * F.lit(float(most))
    goal = share * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    level = None
    while True:
        over = F.lit(False) if level is None else cap < F.lit(level) * F.col("_weight")
        capped, free = weighed.agg(F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("_weight")))).first()
        found = (goal - (capped or 0.0)) / free if free else None
        if found is None or found == level:
            break
        level = found
    shared = F.lit(0.0 if level is None else level) * F.col("_weight")
    return weighed.withColumn("target", F.least(cap, shared)).drop("_weight")


def _key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("none")).otherwise(F.concat(F.lit("s:"), source))


def _measures(docs: DataFrame, seed: str) -> list[Column]:
    """What the sample needs of a row; all of it is a function of the row's content."""
    text = F.coalesce(docs["text"], F.lit(""))
    text_hash = F.md5(text)
    identity = F.coalesce(docs["doc_id"].cast("string"), F.lit(""))
    drawn = F.substring(F.md5(F.concat_ws(":", F.lit(seed), identity, text_hash)), 1, 13)
    return [
        _key(docs["source"]).alias("_key"),
        identity.alias("_id"),
        text_hash.alias("_hash"),
        F.size(F.array_remove(F.split(text, GAP), "")).cast("long").alias("_size"),
        ((F.conv(drawn, 16, 10).cast("double") + 0.5) / float(2**52)).alias("_u"),
    ]


def _rank_key() -> Column:
    """Q / (1 + Q) of a row, from 0 for certain ones to 1 for those without a chance."""
    p = F.col("_c") * F.col("_size")
    q = (F.col("_u") / (1.0 - F.col("_u"))) / (p / (1.0 - p))
    return F.when(F.col("_c") > 0, F.when(p >= 1.0, 0.0).when(p > 0, q / (1.0 + q)).otherwise(1.0))


def _with_chances(narrow: DataFrame, plan: DataFrame, limit: int) -> DataFrame:
    """``plan`` with ``_c``: the chance a word of size, where ``_left`` words of a source are to be sampled.

    Sizes are few, however many rows have them.  If the sizes above one are certain, c is what is left of L
    over the squares of the others; the largest size that is not certain then is where the chances begin.
    """
    sizes = narrow.filter("_size > 0").groupBy("_key", "_size").agg(F.count("*").alias("_rows"))
    sizes = join_dim(sizes, plan.filter("_left > 0").select("_key", "_left"), "_key", limit=limit)
    exact = F.col("_size").cast("decimal(38,0)") * F.col("_rows")
    falling = Window.partitionBy("_key").orderBy(F.col("_size").desc())
    above = F.sum(exact.cast("decimal(38,0)")).over(falling.rowsBetween(Window.unboundedPreceding, -1))
    squares = F.sum((exact * F.col("_size")).cast("decimal(38,0)")).over(falling.rowsBetween(0, Window.unboundedFollowing))
    c = (F.col("_left") - F.coalesce(above, F.lit(0)).cast("double")) / squares.cast("double")
    fits = sizes.withColumn("_c", c).filter(F.col("_c") * F.col("_size") <= 1.0)
    found = fits.groupBy("_key").agg(F.max_by("_c", "_size").alias("_c"))
    return plan.join(found, "_key", "left").withColumn("_c", F.coalesce("_c", F.lit(0.0)))


def _crossing(sums: DataFrame, order: Sequence[str], words: Column, start: str) -> DataFrame:
    """The row of each source in whose words the words left run out; ``_before``: words before it."""
    sofar = Window.partitionBy("_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = sums.withColumn("_upto", F.col(start) + F.sum(words).over(sofar))
    return running.filter((F.col("_upto") > F.col("_left")) & (F.col("_upto") - words <= F.col("_left"))).withColumn(
        "_before", F.col("_upto") - words
    )


def _cuts(narrow: DataFrame, plan: DataFrame, limit: int) -> DataFrame:
    """Where the sample of each source ends: the cut, the rows taken at it, and the closing row."""
    at = ["_v", "_id", "_hash"]
    pool = (
        join_dim(narrow, plan.filter("_c > 0"), "_key", limit=limit)
        .withColumn("_v", _rank_key())
        .withColumn("_a", F.floor(F.col("_v") * GRID))
        .withColumn("_b", F.floor((F.col("_v") * GRID - F.col("_a")) * GRID))
    )
    words = F.col("_words")
    sums = pool.groupBy("_key", "_left", "_a").agg(F.sum("_size").alias("_words")).withColumn("_zero", F.lit(0))
    coarse = _crossing(sums, ["_a"], words, "_zero").select("_key", "_a", F.col("_before").alias("_from"))
    inside = join_dim(pool, coarse, ["_key", "_a"], limit=limit)
    sums = inside.groupBy("_key", "_left", "_a", "_from", "_b").agg(F.sum("_size").alias("_words"))
    fine = _crossing(sums, ["_b"], words, "_from").select("_key", "_a", "_b", F.col("_before").alias("_from"))
    inside = join_dim(pool, fine, ["_key", "_a", "_b"], limit=limit)
    alike = inside.groupBy("_key", "_left", "_from", *at, "_size").agg(F.count("*").alias("_rows"))
    words = F.col("_size") * F.col("_rows")
    fit = F.floor((F.col("_left") - F.col("_before")) / F.col("_size")).cast("long")
    cut = (
        _crossing(alike, at, words, "_from")
        .withColumn("_fit", fit)
        .withColumn("_gap", F.col("_left") - F.col("_before") - F.col("_fit") * F.col("_size"))
        .select("_key", F.struct(*at).alias("_cut"), "_rows", "_fit", "_gap")
    )
    cut = written(cut, "mix-cuts")
    beyond = join_dim(pool, cut, "_key", limit=limit).filter(F.struct(*at) >= F.col("_cut"))
    nearest = beyond.groupBy("_key").agg(F.min(F.struct(F.abs(F.col("_size") - F.col("_gap")).alias("miss"), *at)).alias("_n"))
    return (
        cut.join(nearest, "_key", "left")
        .withColumn("_close", F.when(F.col("_n.miss") < F.col("_gap"), F.struct(*[F.col(f"_n.{c}").alias(c) for c in at])))
        .select("_key", "_cut", "_fit", "_close")
    )


def _planned(
    docs: DataFrame, weights: Sequence[int], share: float, most: float, seed: str, limit: int
) -> tuple[DataFrame, DataFrame]:
    """(rows, decisions): the measured rows without their texts; one row a source."""
    narrow = written(
        docs.select(docs["doc_id"].alias("doc_id"), docs["source"].alias("source"), *_measures(docs, seed)), "mix-rows"
    )
    sizes = narrow.groupBy("_key").agg(F.min("source").alias("source"), F.sum("_size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most).drop("source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = (
        targets.withColumn("_whole", F.floor(ratio).cast("long"))
        .withColumn("_left", F.col("target") - F.col("_whole") * F.col("source_size"))
    )
    plan = written(_with_chances(narrow, plan, limit), "mix-plan")
    cuts = _cuts(narrow.drop("source", "doc_id"), plan, limit)
    return narrow, written(plan.join(cuts, "_key", "left"), "mix-decisions")


def _taken(rows: DataFrame, narrow: DataFrame, plan: DataFrame, limit: int) -> DataFrame:
    """Measured ``rows`` with the result columns; every row decides for itself."""
    rows = join_dim(rows, plan, "_key", "left", spread_by=["_id", "_hash"], limit=limit).withColumn("_v", _rank_key())
    own = F.struct("_v", "_id", "_hash")
    at_cut, closes = F.coalesce(own == F.col("_cut"), F.lit(False)), F.coalesce(own == F.col("_close"), F.lit(False))
    # of the rows alike that the sample ends in, this many are taken
    due = F.when(at_cut, F.col("_fit")).otherwise(0) + closes.cast("long")
    rows = rows.withColumn("_due", F.when(at_cut | closes, due))
    special = F.col("_due").isNotNull()
    before = F.coalesce(own < F.col("_cut"), F.lit(False)).cast("long")
    extra = F.when(special, F.least(F.col("_due"), F.lit(1).cast("long"))).otherwise(before)
    plain = rows.withColumn("_extra", extra)
    if _repeated(narrow, plan, limit):
        turn = F.row_number().over(Window.partitionBy("_key", "_id", "_hash").orderBy(F.lit(1)))
        several = rows.filter(special).withColumn("_extra", (turn <= F.col("_due")).cast("long"))
        plain = plain.filter(~special).unionByName(several)
    copies = F.coalesce(F.col("_whole") + F.col("_extra"), F.lit(0)).cast("long")
    return plain.withColumns(
        {
            "size": F.col("_size"),
            "source_size": F.col("source_size").cast("long"),
            "target": F.col("target").cast("double"),
            "copies": copies,
            "taken": copies * F.col("_size"),
        }
    )


MADE = ["size", "source_size", "target", "copies", "taken"]


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mixture-1",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The rows of (doc_id, text, source, ...) with ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    ``size`` counts the words of the text (null: 0), ``copies`` is how often the mix takes the
    row (0 to ``most``), ``taken`` their words.  Draws depend on ``seed``, doc_id and text only,
    so reruns agree whatever the partitioning.  Repeated rows share a draw; where the sample ends
    within a group of them, the right number is taken.  Null doc_id and null source are values
    like others.  An empty source has target 0; an empty table gives no rows.  Columns of the
    input named like a result column are replaced.
    """
    held = {f"in{i}": c for i, c in enumerate(c for c in docs.columns if c not in MADE)}  # no name can clash
    narrow, plan = _planned(docs, weights, share, most, seed, limit)
    rows = docs.select(*[docs[c].alias(n) for n, c in held.items()], *_measures(docs, seed))
    return _taken(rows, narrow, plan, limit).select(*[F.col(n).alias(c) for n, c in held.items()], *MADE)


def mix_counts(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mixture-1",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """:func:`mix` without the texts: doc_id, source and the result columns; texts are read once."""
    narrow, plan = _planned(docs, weights, share, most, seed, limit)
    return _taken(narrow, narrow, plan, limit).select("doc_id", "source", *MADE)


def _repeated(narrow: DataFrame, plan: DataFrame, limit: int) -> bool:
    """Whether a cut or a closing row stands for several rows alike."""
    ends = plan.select("_key", F.explode(F.array("_cut", "_close")).alias("_end")).filter("_end is not null")
    ends = ends.select("_key", F.col("_end._id").alias("_id"), F.col("_end._hash").alias("_hash")).distinct()
    found = join_dim(narrow.select("_key", "_id", "_hash"), ends, ["_key", "_id", "_hash"], limit=limit)
    return not found.groupBy("_key", "_id", "_hash").count().filter("count > 1").isEmpty()
