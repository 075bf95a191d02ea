"""Every text query with SQL against that SQL; the others at least run over whole tables."""

import duckdb
import pandas as pd
import pytest

from tally.llm.queries import ORACLES, QUERIES


def plain(frame: pd.DataFrame) -> list[tuple]:
    def value(v):  # pandas makes doubles of integers beside nulls
        if pd.isna(v) or isinstance(v, (str, bool)):
            return None if pd.isna(v) else v
        v = v.item() if hasattr(v, "item") else v
        return int(v) if isinstance(v, float) and v.is_integer() else v

    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(value, row)) for row in frame.itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, small_dir, duck, name):
    found = plain(QUERIES[name](spark, small_dir).toPandas())
    expected = plain(duck.execute(ORACLES[name]).df())
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        assert a == pytest.approx(b) if any(isinstance(x, float) for x in a) else a == b


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    """Tables with nulls, empty and repeated rows, ties and a source that holds most rows."""
    folder = tmp_path_factory.mktemp("odd")
    passage = "one two three four five six seven eight nine ten eleven"
    docs = [(i, f"word{i % 7} common line\n{'pad ' * (i % 5)}end {i % 3}", "en", "hot", 9) for i in range(40)]
    docs += [(7, docs[7][1], "en", "hot", 9)] * 3
    docs += [(100, None, None, None, None), (None, "", "de", "s", 0), (None, "null id", "de", None, 7), (101, "x", "fr", "é", 1)]
    docs += [(102, f"A {passage.upper()} b", "en", "z", 1), (103, "Released under the MIT License. " + "tail " * 3000, "en", "z", 1)]
    docs += [(104, "prefix short item suffix", "en", "z", 1), (105, "İstanbul ﬁ ß — 中文 \x1c x\x85y", "xx", "z", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    items = [(1, passage), (2, passage), (3, "short item"), (4, ""), (5, None), (None, "x")]
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{folder}/benchmark.parquet")
    turns = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (1, 2, "assistant", "b </turn>\n<turn>"), (None, 0, "assistant", "\\b\\l")]
    turns += [(2, i, "assistant" if i % 2 else "user", f"t{i} \\g <x>") for i in range(67)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{folder}/conversations.parquet")
    vectors = [(i, [((i * 7 + j * 3) % 11 - 5) / 8 for j in range(64)], 0) for i in range(60)] + [(4, [0.5] * 64, 1)] * 30
    vectors += [(100, None, 0), (200, [0.1] * 63, 0), (300, [None] * 64, 0), (None, [0.3] * 64, 0), (400, [0.5] * 64, 0), (400, [0.5] * 64, 0)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql_on_odd_rows(spark, odd_dir, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{odd_dir}/{table}.parquet/*.parquet'")
    found, expected = plain(QUERIES[name](spark, odd_dir).toPandas()), plain(con.execute(ORACLES[name]).df())
    assert found == expected


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_of_empty_tables(spark, small_dir, tmp_path, name):
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        spark.read.parquet(f"{small_dir}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == (1 if name.startswith("op10_") else 0)
