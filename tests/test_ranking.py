"""The distributed ranking equals brute force, with groups cut into many pieces and hot groups and values."""

import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from lakemart.operators import ranking, skew
from lakemart.operators.upsert import customer_history

CUT = {"pieces": 23}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(1500):
        group = "hot" if i % 3 == 0 else f"g{rng.randrange(20)}"
        # A third of the values are one value; some are null.
        value = 0 if i % 3 == 1 else (None if rng.random() < 0.02 else rng.randrange(-400, 400))
        out.append((i, group, value))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id long, g string, v int")


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("limits", [{}, CUT])
def test_positions(df, rows, by, limits):
    got = {(r.g if by else None, r.v): (r.rows_here, r.rows_below, r.rows_total)
           for r in ranking.value_positions(df, by, "v", **limits).collect()}
    low = -10_000
    groups = {}
    for _, g, v in rows:
        groups.setdefault(g if by else None, []).append(low if v is None else v)
    want = {(g, None if v == low else v): (vs.count(v), sum(x < v for x in vs), len(vs))
            for g, vs in groups.items() for v in set(vs)}
    assert got == want


def test_pieces_are_really_cut(df):
    counts = df.groupBy("g", "v").count()
    df.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = ranking.split_groups(counts, ["g"], "v", **CUT)
    finally:
        df.sparkSession.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranges = cut.groupBy("g", "_piece").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    hot = sorted((r._piece, r.low, r.high) for r in ranges.filter("g = 'hot' and low is not null").collect())
    assert len(hot) > 3 and all(a[2] < b[1] for a, b in zip(hot, hot[1:]))


def test_median(df, rows):
    got = {r.g: r.m for r in ranking.exact_median(df, ["g"], "v", "m", **CUT).collect()}
    groups = {}
    for _, g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert got == {g: float(statistics.median(vs)) for g, vs in groups.items()}


def test_percent_ranks_match_the_window(spark, df):
    df.createOrReplaceTempView("ranked")
    want = {tuple(r) for r in spark.sql(
        "select id, percent_rank() over (partition by g order by v nulls first) from ranked").collect()}
    got = {(r.id, r.p) for r in ranking.percent_ranks(df, ["g"], "v", "p", **CUT).collect()}
    assert got == want


@pytest.mark.parametrize("n", [1, 4, 5, 7])
@pytest.mark.parametrize("limits", [{}, CUT])
def test_ntile(df, rows, n, limits):
    got = {r.id: r.t for r in ranking.ntile_by_value(df, "id", "v", n, "t", **limits).collect()}

    def order(row):
        tie = int(hashlib.md5(str(row[0]).encode()).hexdigest()[:15], 16)
        return (row[2] is not None, row[2] or 0, tie)

    ranked = sorted(rows, key=order)
    size, extra = divmod(len(ranked), n)
    want, at = {}, 0
    for tile in range(1, n + 1):
        for row in ranked[at:at + size + (tile <= extra)]:
            want[row[0]] = tile
        at += size + (tile <= extra)
    assert got == want


def test_ntile_with_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, 9)], "id long, v int")
    assert sorted(r.t for r in ranking.ntile_by_value(df, "id", "v", 5, "t").collect()) == [1, 2, 3]


def test_ntile_ties_together(spark):
    df = spark.createDataFrame([(i, 1) for i in range(8)] + [(8, 2), (9, 3)], "id long, v int")
    got = {r.id: r.t for r in ranking.ntile_by_value(df, "id", "v", 5, "t", ties="together").collect()}
    assert got == {**{i: 1 for i in range(8)}, 8: 5, 9: 5}


def test_quantile(spark, df, rows):
    known = sorted(v for _, _, v in rows if v is not None)
    for q in (0.1, 0.5, 0.9):
        got = spark.range(1).select(ranking.quantile_value(df, "v", q, **CUT)).first()[0]
        assert got == next(v for v in known if sum(x <= v for x in known) >= q * len(known))


def test_salted_join_and_aggregate(spark):
    big = spark.createDataFrame([("hot" if i % 3 == 0 else f"k{i % 50}" if i % 7 else None, i) for i in range(600)],
                                "k string, v int")
    small = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), (None, 4)], "k string, w int")
    for how in ("inner", "left"):
        want = sorted(map(str, big.join(small, "k", how).collect()))
        got = sorted(map(str, skew.salted_join(big, small, ["k"], how, share=0.1, salts=8).collect()))
        assert got == want
    assert [r.k for r in skew.hot_keys(big.filter("k is not null"), ["k"], 0.1).collect()] == ["hot"]
    assert skew.hot_keys(big, ["k"], 0.001).count() <= 1000
    with pytest.raises(ValueError):
        skew.salted_join(big, small, ["k"], "full")
    got = skew.salted_aggregate(big, ["k"], {"s": F.sum("v"), "n": F.count("v")}, {"s": F.sum("s"), "n": F.sum("n")}, 8)
    want = big.groupBy("k").agg(F.sum("v").alias("s"), F.count("v").alias("n"))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


@pytest.mark.parametrize("limits", [{}, CUT])
def test_history(spark, limits):
    rng = random.Random(9)
    rows = [("hot" if i % 3 == 0 else f"p{i % 40}", i // 2, rng.choice(["a", "a", "b"])) for i in range(400)]
    df = spark.createDataFrame(rows, "person string, at int, city string")
    got = sorted((r.person, r["at"], -1 if r.valid_to is None else r.valid_to, r.city, r.is_current)
                 for r in customer_history(df, "person", "at", ["city"], **limits).collect())
    latest = {}
    for p, t, c in rows:
        latest[(p, t)] = max(c, latest.get((p, t), ""))
    want = []
    for person in {p for p, _ in latest}:
        steps = sorted((t, c) for (p, t), c in latest.items() if p == person)
        changes = [s for i, s in enumerate(steps) if i == 0 or s[1] != steps[i - 1][1]]
        for i, (t, c) in enumerate(changes):
            last = i + 1 == len(changes)
            want.append((person, t, -1 if last else changes[i + 1][0], c, last))
    assert got == sorted(want)
