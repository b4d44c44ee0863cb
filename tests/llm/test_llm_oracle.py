"""The registered queries against their SQL, on the smallest tables and on odd ones."""

import pytest

from gableboard.llm import oracle, queries

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings benchmark conversations".split()


def compared(spark, name, folder, files):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{files.format(t)}'")
    df = queries.queries()[name](spark, folder)
    got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    cursor = db.execute(oracle.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert got == sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in cursor.fetchall()), key=repr)
    return got


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert compared(spark, name, SF, SF + "/{}.parquet")


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Nulls, empty texts, repeats, short items, long texts."""
    folder = str(tmp_path_factory.mktemp("odd"))
    words = [f"w{i}" for i in range(60)]
    texts = [None, "", " \t\n", "One", "one", "a b c d e f", "A  b\tc d e\nf", " ".join(words), " ".join(words[:57]), " ".join(words[3:]), " ".join(words[20:45]),
             "x, y; z!", "é漢 😀 w1.w2", " ".join(words * 200), "x y z x y z x y z"]
    docs = [(i, t, "en", 1) for i, t in enumerate(texts * 2)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, n long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    items = [(1, " ".join(words[5:30])), (2, "x y z"), (3, None), (4, ""), (5, "W20 " + " ".join(words[21:33])), (10, "É漢"), (11, "nothing of it")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    turns = [(1, 0, "user", "a#b<c\\\\d"), (1, 1, "user", None), (1, None, None, "x"), (1, 2, "assistant", "</turn>\n### user:\n"), (1, 2, "assistant", "é😀"),
             (2, 0, "a:b\n#", "t"), (2, 0, "a:b\n#", "t"), (3, 5, "assistant", "")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    spark.createDataFrame([(1, [0.5])], "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.mark.parametrize("name", ["op3_jaccard_join", "op6_decontamination", "op10_chat_format"])
def test_odd_tables(spark, odd, name):
    assert compared(spark, name, odd, odd + "/{}.parquet/*.parquet")
