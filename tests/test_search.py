"""Search by postings against comparing all names; published tables."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gableboard.operators import index, search_index
from gableboard.sources import tables


@pytest.fixture(scope="module")
def sources(spark):
    rng = random.Random(3)
    syllables = ["an", "Na", "ÉL", "ro", "x%", "_y", "ß", "o\\'", " ", "Kim"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(0, 5)))
    made = {}
    for k, name in enumerate(("sales", "profiles", "listings")):
        rows = [(f"{name}{i}", rng.choice([None, "", word(), word()]), rng.choice([None, "", word(), "Same Office"]), i) for i in range(120)]
        made[name] = spark.createDataFrame(rows, "id string, name string, office string, figure int")
    return made


@pytest.fixture(scope="module")
def folder(spark, sources, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("search"))
    search_index.build(search_index.records({k: (v, "id") for k, v in sources.items()}), path)
    return path


@pytest.mark.parametrize("query", ["a", "na", "NA", "kim", "x%_", "same off", "él", "ß", "nanan", " ", "  ", "zzz", "o\\'"])
def test_postings_find_what_comparing_finds(spark, sources, folder, query):
    want = index.search(sources, query, limit=None).collect()
    got = search_index.search(spark, folder, query, limit=None).collect()
    assert [(r.key, r.name, r.office, r.sources) for r in got] == [(r.key, r.name, r.office, r.sources) for r in want]
    all_rows = {s: {r.id: r for r in df.collect()} for s, df in sources.items()}
    for r in got:
        assert set(r.found) == set(r.sources.split(","))
        for s, body in r.found.items():
            record = json.loads(body)
            match = [x for x in all_rows[s].values() if (x.name or "").lower() == r.key
                     and (query.lower() in (x.name or "").lower() or query.lower() in (x.office or "").lower())]
            assert record["id"] == max(match, key=lambda x: (x.name is not None, x.name or "", x.office is not None, x.office or "", x.id)).id


def test_search_reads_postings_of_its_grams(spark, folder):
    text = search_index.hits(spark, folder, "kimro")._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in text and "In(gram, [imr,kim,mro])" in text
    assert "PartitionFilters: [isnotnull(bucket" in text or "dynamicpruning" in text


def test_postings_are_dealt_before_repeated_ones_go(spark, sources, folder):
    want = set()
    for df in sources.values():
        for r in df.collect():
            key = (r.name or "").lower()
            want |= {(key, x[i:i + k]) for x in (key, (r.office or "").lower()) for k in (2, 3) for i in range(len(x) - k + 1)}
    got = [(r.key, r.gram) for r in spark.read.parquet(f"{folder}/postings").select("key", "gram").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    # No aggregate holds the grams of all names of a task.
    stored = spark.read.schema("office string, key string, bucket int").parquet(f"{folder}/records")
    text = search_index.postings(stored)._jdf.queryExecution().executedPlan().toString()
    dealt = text[:text.index("Generate")]
    assert "rangepartitioning" in dealt and "Aggregate" not in dealt


def listing(i, **more):
    return {"detail_url": f"u{i}", "status": "Closed", "sale_price": i, **more}


def stored(spark, rows):
    return spark.createDataFrame(rows, "detail_url string, status string, sale_price long, extra string")


def test_publish_reads_back_and_replaces_parts(spark, tmp_path):
    path = str(tmp_path / "listings")
    assert tables.publish(stored(spark, [listing(i) for i in range(50)]), "listings", path) == 50
    got = tables.published(spark, "listings", path)
    assert got.schema == tables.SCHEMAS["listings"] and {r.detail_url: r.sale_price for r in got.collect()} == {f"u{i}": i for i in range(50)}
    # Rows that fall into one part replace that part only.
    part = F.pmod(F.xxhash64("detail_url"), F.lit(tables.PARTS))
    of = {r.detail_url: r.part for r in got.select("detail_url", part.alias("part")).collect()}
    mine = [i for i in range(50) if of[f"u{i}"] == of["u0"]]
    tables.publish(stored(spark, [listing(i, sale_price=-1) for i in mine]), "listings", path)
    got = {r.detail_url: r.sale_price for r in tables.published(spark, "listings", path).collect()}
    assert got == {f"u{i}": -1 if i in mine else i for i in range(50)}


@pytest.mark.parametrize("rows, least", [
    ([listing(1), listing(1)], 1), ([listing(1), {"detail_url": None, "status": "x", "sale_price": 1}], 1), ([], 1), ([listing(1)], 2)])
def test_failed_checks_leave_the_table(spark, tmp_path, rows, least):
    path = str(tmp_path / "listings")
    tables.publish(stored(spark, [listing(i) for i in range(9)]), "listings", path)
    with pytest.raises(tables.Refused):
        tables.publish(stored(spark, rows), "listings", path, least=least)
    assert tables.published(spark, "listings", path).count() == 9


def test_published_files_of_an_older_layout(spark, tmp_path):
    path = str(tmp_path / "listings")
    stored(spark, [listing(1)]).select("detail_url", "sale_price", F.lit(0).alias("part")).write.partitionBy("part").parquet(path)
    got = tables.published(spark, "listings", path).collect()
    assert [(r.detail_url, r.sale_price, r.status) for r in got] == [("u1", 1, None)]
