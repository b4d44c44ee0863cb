import random

import pytest
from pyspark.sql import functions as F

from gableboard.operators import fuzzy


def ratio(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return 200.0 * row[-1] / (len(a) + len(b)) if a or b else 100.0


def sequential(table, threshold):
    """The greedy passes on a list of (name, office) rows."""
    table, merged = list(table), {}
    while True:
        counts = {}
        for r in table:
            counts[r] = counts.get(r, 0) + 1
        order = sorted(counts, key=lambda r: (-counts[r], r[0], r[1] is not None, r[1] or ""))
        away = {}
        for i, (name, office) in enumerate(order):
            if name in away:
                continue
            for other, place in order[i + 1:]:
                if other not in away and place == office and ratio(name, other) >= threshold:
                    away[other] = name
        if not away:
            return merged

        def end(n):
            while n in away:
                n = away[n]
            return n
        table = [(end(n), o) for n, o in table]
        merged = {k: end(v) for k, v in merged.items()} | {k: end(k) for k in away}


def random_table(seed, n):
    rng = random.Random(seed)
    base = ["annalee", "annalea", "anna lee", "anelee", "bobby", "bobbie", "boby", "ann lea"]
    return [(rng.choice(base), rng.choice(["x", "y", None])) for _ in range(n)]


@pytest.mark.parametrize("seed, threshold", [(1, 80), (2, 85), (3, 70)])
def test_merge_equals_the_sequential_passes(spark, seed, threshold):
    data = random_table(seed, 25)
    df = spark.createDataFrame(data, "listing_agent string, listing_office string")
    got = {r.old_name: r.merged_into for r in fuzzy.merge_names(df, threshold).collect()}
    assert got == sequential(data, threshold)


@pytest.mark.parametrize("threshold", [60, 80, 90, 97])
def test_edges_equal_all_pairs(spark, threshold):
    rng = random.Random(threshold)
    names = {"".join(rng.choice("abc ") for _ in range(rng.randint(1, 12))) for _ in range(60)}
    names |= {n[:i] + rng.choice("abc") + n[i + 1:] for n in list(names) for i in [rng.randrange(len(n))]}
    df = spark.createDataFrame([(n, None) for n in names], "listing_agent string, listing_office string")
    got = {frozenset((r.a, r.b)) for r in fuzzy.edges(fuzzy.name_counts(df), threshold).collect()}
    want = {frozenset((a, b)) for a in names for b in names if a < b and ratio(a, b) >= threshold}
    assert got == want


def test_apply_renames(spark):
    df = spark.createDataFrame([("b", "o"), ("c", "o"), (None, "o")], "listing_agent string, listing_office string")
    renames = spark.createDataFrame([("b", "a")], "old_name string, merged_into string")
    assert sorted(str(r.listing_agent) for r in fuzzy.apply_renames(df, renames).collect()) == ["None", "a", "c"]
    assert fuzzy.merge_names(df.filter(F.lit(False))).count() == 0


def office_of(n, seed=1):
    """Names of one office: few given names and many family names, with misspelt copies."""
    rng = random.Random(seed)
    syllables = ["ka", "lo", "min", "ter", "sen", "bar", "dow", "hill", "ar", "eth"]
    names = {f"{rng.choice(['anna', 'james', 'mary'])} {''.join(rng.choice(syllables) for _ in range(3))}" for _ in range(n)}
    for name in sorted(names)[::4]:
        i = rng.randrange(len(name))
        names.add(name[:i] + rng.choice("xyz") + name[i + 1:])
    return sorted(names)


def test_candidates_of_a_hot_office(spark):
    names = office_of(400)
    counts = fuzzy.name_counts(spark.createDataFrame([(n, "one") for n in names], "listing_agent string, listing_office string"))
    met = [frozenset((r.l_name, r.r_name)) for r in fuzzy.candidates(counts, within=False).collect()]
    near = [frozenset((r.l_name, r.r_name)) for r in fuzzy.candidates(counts).collect()]
    assert len(set(met)) == len(met) and len(set(near)) == len(near)  # each pair once, without a distinct
    found = {frozenset((r.a, r.b)) for r in fuzzy.edges(counts).collect()}
    assert found == {frozenset((a, b)) for a in names for b in names if a < b and ratio(a, b) >= 90}
    assert found <= set(near) <= set(met)
    # All pairs would be over a hundred a result; what leaves the join is at most three.
    assert len(near) <= 3 * len(found) < len(met) < len(names) * (len(names) - 1) / 4
    text = fuzzy.candidates(counts)._jdf.queryExecution().executedPlan().toString()
    assert text.count("SortMergeJoin") == 1 and text.rindex("HashAggregate") > text.index("SortMergeJoin")


def test_chain_and_cross_office_rename(spark):
    # "bobbi" leads at x, then goes to "bobby" at y, and takes "bobbie" along; "bobbie" goes at z, too.
    data = [("bobby", "y")] * 5 + [("bobbi", "x")] * 6 + [("bobbie", "x")] * 2 + [("bobbi", "y")] + [("bobbie", "z")]
    df = spark.createDataFrame(data, "listing_agent string, listing_office string")
    got = {r.old_name: r.merged_into for r in fuzzy.merge_names(df, 80).collect()}
    assert got == sequential(data, 80) == {"bobbi": "bobby", "bobbie": "bobby"}
