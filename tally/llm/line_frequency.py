"""Removal of lines that stand on too large a part of their site's pages.

A line's frequency is the number of pages of its site with that line, divided by the pages of the
site.  Lines above ``ratio`` are boilerplate and go from every page of that site; the same line
elsewhere is not touched.

What is shuffled is a 128-bit name of each distinct line of a page, counted before the shuffle; a
site with a third of all pages is a few counters per task.  At most (distinct lines a page) /
``ratio`` lines of a site can exceed the ratio, so the lists that go back to the pages are short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.ngram_join import row_names
from tally.llm.texts import BROADCAST_BYTES, written
from tally.operators import join_dim

RATIO = 0.1
LEAST_PAGES = 5
WHITE = " \t\r\x0b\x0c"


def _bare(line: Column) -> Column:
    return F.trim(line, F.lit(WHITE))


def _name(line: Column) -> Column:
    """128 bits of two independent hashes; what counts as the same line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _site(site: Column) -> Column:
    return F.when(site.isNull(), F.lit("none")).otherwise(F.concat(F.lit("s:"), site.cast("string")))


def line_frequencies(docs: DataFrame, site: str = "source", copied: DataFrame | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(site_key, name, pages, total): in how many of a site's pages each line occurs.

    With ``copied``, (id, text_hash, keeper) of :func:`tally.llm.ngram_join.copied_rows`, the rows of a site with one
    keeper are one page that holds the lines of them all.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.transform(F.split(text, "\n"), _bare), lambda line: line != "")
    names = F.array_distinct(F.transform(lines, _name)).alias("names")
    pages = docs.select(_site(F.col(site)).alias("site_key"), names, *(row_names(docs) if copied is not None else []))
    if copied is None:
        several, alone = pages.limit(0).withColumn("keeper", F.lit(0)), pages
    else:
        pages = join_dim(pages, copied, ["id", "text_hash"], "left", limit=limit).select("site_key", "names", "keeper")
        pages = written(pages, "pages-of-lines")
        several, alone = pages.filter("keeper IS NOT NULL"), pages.filter("keeper IS NULL").drop("keeper")
    once = several.select("site_key", "keeper", F.explode("names").alias("name")).distinct().select("site_key", "name")
    counted = (
        alone.select("site_key", F.explode("names").alias("name"))
        .unionByName(once)
        .groupBy("site_key", "name")
        .agg(F.count("*").alias("pages"))
    )
    totals = alone.select("site_key").unionByName(several.select("site_key", "keeper").distinct().select("site_key"))
    return join_dim(counted, totals.groupBy("site_key").agg(F.count("*").alias("total")), "site_key")


def drop_frequent_lines(
    docs: DataFrame,
    site: str = "source",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    limit: int = BROADCAST_BYTES,
    copied: DataFrame | None = None,
) -> DataFrame:
    """The rows of ``docs`` with ``text`` cleaned, ``n_lines`` and ``n_dropped``.

    A line goes if it is on more than ``ratio`` of its site's pages and on ``least_pages`` or more.
    Lines are compared without the white space around them; lines without text are neither counted
    nor dropped.  A null site is one site.  A null text stays null and counts as a page.  A text
    all of whose lines go becomes empty; the row stays.  Repeated rows are pages of their own, unless ``copied``
    names copies and near copies, which then are one page a site, so that a text is not boilerplate because it was
    copied.  Columns named like the two counts are replaced, others kept.
    """
    made = ["n_lines", "n_dropped"]
    columns = [c for c in docs.columns if c not in made]
    held = {f"in{i}": c for i, c in enumerate(columns)}  # so that no name of the input can clash
    frequent = (
        line_frequencies(docs, site, copied, limit)
        .filter((F.col("pages") > F.col("total") * F.lit(float(ratio))) & (F.col("pages") >= least_pages))
        .groupBy("site_key")
        .agg(F.collect_list("name").alias("frequent"))
    )
    frequent = written(frequent, "frequent-lines")
    pages = docs.select(
        *[F.col(f"`{c}`").alias(n) for n, c in held.items()],
        _site(F.col(site)).alias("site_key"),
        F.split(docs["text"], "\n").alias("lines"),
    )
    marked = join_dim(pages, frequent, "site_key", "left", limit=limit)
    drop = lambda line: F.array_contains("frequent", _name(_bare(line)))
    judged = marked.select(
        *held,
        F.size(F.filter(F.coalesce("lines", F.array().cast("array<string>")), lambda line: _bare(line) != "")).alias("n_lines"),
        F.size(F.coalesce("lines", F.array().cast("array<string>"))).alias("all_lines"),
        F.when(F.col("frequent").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda line: ~drop(line))).alias("kept"),
    )
    cleaned = F.when(F.col("kept").isNotNull(), F.array_join("kept", "\n"))
    return judged.select(
        *[(cleaned if c == "text" else F.col(n)).alias(c) for n, c in held.items()],
        F.col("n_lines").cast("long").alias("n_lines"),
        (F.col("all_lines") - F.coalesce(F.size("kept"), F.lit(0))).cast("long").alias("n_dropped"),
    )
