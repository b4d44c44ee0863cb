"""Phrase mining against counting all phrases, through the registered query and its SQL."""

import random
import re
from collections import Counter, defaultdict

import pytest

from gableboard.llm import oracle, phrase_mining, queries

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, size int, phrase string, n long, shard int"


def counted(rows):
    f = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, 5):
                for i in range(len(w) - size + 1):
                    f["und" if lang is None else lang][tuple(w[i:i + size])] += 1
    return f


def brute(rows, least=30, per_lang=2000):
    out = []
    for lang, f in counted(rows).items():
        big = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in big.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in big.items()):
                continue
            score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        n = sum(a for p, a in f.items() if len(p) == 1)
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:per_lang], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    words = ["The", "the", "of", "and", "straße", "漢字", "\x00nul", "a-b", "x'y", "😀", *[f"w{i}" for i in range(30)]]
    out = []
    for _ in range(700):
        text = "".join(r.choice(words[:r.choice([4, 10, 40])]) + r.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ","]) for _ in range(r.randint(0, 30)))
        out.append((text, r.choice(["en", "en", "de", None, ""])))
    out += [("same old copy of a text. Same old copy", "en")] * 200
    late = [("only late words here", "en")] * 31
    return [*out, *late, (None, "en"), ("", None), (" \t\n", "en"), ("a b c " * 20000, "de"), ("ab" * 50000, "de")]


def table(spark, rows, folder):
    made = spark.createDataFrame([(i, t, lang, 1, "clash", 1, 1) for i, (t, lang) in enumerate(rows)], SCHEMA)
    made.repartition(7).write.parquet(f"{folder}/documents.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_query_equals_brute_force_and_sql(spark, rows, tmp_path):
    table(spark, rows, tmp_path)
    got = queries.op12_phrase_mining(spark, str(tmp_path))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = sorted(tuple(r) for r in got.collect())
    assert got == brute(rows)
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(db.execute(oracle.oracle_sql()["op12_phrase_mining"]).fetchall()) == got


@pytest.mark.parametrize("shards, bits", [(1, 1 << 24), (2, 1 << 15), (5, 1 << 24)])
def test_frequencies_whatever_the_shards_and_bits(spark, rows, tmp_path, shards, bits):
    found = phrase_mining.frequencies(table(spark, rows, tmp_path), shards, 12, bits, 3000)
    got = {(r.lang, r.phrase): r.n for r in found.collect() if r["size"]}
    assert got == {(lang, " ".join(p)): a for lang, f in counted(rows).items() for p, a in f.items() if a >= 12}
    top = phrase_mining.collocations(found, 3)
    assert sorted(tuple(r) for r in top.collect()) == brute(rows, 12, 3)


def test_products_past_64_bits(spark):
    n = 2 ** 62
    rows = [("en", 0, "", n), ("en", 1, "a", n), ("en", 1, "b", n - 3), ("en", 2, "a b", n - 5)]
    found = spark.createDataFrame(rows, "lang string, size int, phrase string, n long")
    assert [tuple(r) for r in phrase_mining.collocations(found).collect()] == [
        ("en", 1, "a b", n - 5, n, n - 3, n, 2000000 * (n - 5) // (2 * n - 3))]


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert phrase_mining.collocations(phrase_mining.frequencies(none)).collect() == []
