import random
import unicodedata
from fractions import Fraction

import numpy as np
import pytest

from pyspark.sql import functions as F

from granary.llm import near_duplicates as near
from granary.llm import repeated_lines as rep

SCHEMA = "rec_id long, text string, url string, source string, id long, h1 string"


def test_repeated_lines_against_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(160):
        lines = [rng.choice(["Read MORE »", "read more", "  Read, more 5", "All rights reserved", f"line {rng.random()}", "", "---", "ප්‍රකාශ"]) for _ in range(rng.randrange(7))]
        rows.append((i * 37 - 900, "\n".join(lines), rng.choice(["http://www.A.test/x", "a.test:80/y", "https://b.test", None, ""]), rng.choice(["s", "t", None]), 1, "x"))
    rows += [(70_001, None, None, None, 1, "x"), (None, "read more", "a.test", "s", 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)

    def site(u, s):
        return {"http://www.A.test/x": "a.test", "a.test:80/y": "a.test", "https://b.test": "b.test"}.get(u, s)

    def key(x):
        return "".join(c for c in x.lower() if unicodedata.category(c)[0] in "LM")

    at = [(r[0], n, site(r[2], r[3]), key(x)) for r in rows if r[1] is not None and r[0] is not None for n, x in enumerate(r[1].split("\n"), 1) if key(x)]
    count = {}
    for i, _, s, k in at:
        count.setdefault((s, k), set()).add(i)
    want = sorted((i, n) for i, n, s, k in at if len(count[s, k]) >= 10)
    for small in (0, 1000):
        found = rep.repeated_places(df, small_lines=small)
        assert sorted((r.rec_id, r.line_no) for r in found.collect()) == want and want
    clean = {r.rec_id: r for r in rep.remove_lines(df, found).collect() if r.rec_id is not None}
    gone = set(want)
    for r in rows:
        if r[0] is None:
            continue
        kept = None if r[1] is None else "\n".join(x for n, x in enumerate(r[1].split("\n"), 1) if (r[0], n) not in gone)
        assert clean[r[0]].text == kept and clean[r[0]].removed_lines == sum(1 for g in gone if g[0] == r[0])
    assert rep.repeated_places(df.where("false")).count() == 0


SPLIT = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
         "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.files.maxPartitionBytes": "20KB", "spark.sql.files.openCostInBytes": "1KB"}


@pytest.fixture
def split_early(spark):
    old = {k: spark.conf.get(k) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_hot_line_is_split(spark, split_early):
    """A line that half of all records carry: the lookup is by line and word, so no partition of it is large, and
    the join of its words with the decision is one that can be split."""
    df = spark.range(30_000).selectExpr("id as rec_id", "case when id % 2 = 0 then 'All rights\n' || 'only ' || id else 'alone x' || id end as text", "'a.test' as url", "'s' as source").withColumn("text", F.translate("text", "0123456789", "abcdefghij")).repartition(8)
    places = rep.line_places(df, "rec_id", F.col("text"), F.col("url"))
    words = rep.line_bitmaps(places)
    assert words.groupBy("h1", "h2").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] == -(-30_000 // 64)
    found = rep.repeated_places(df, small_lines=0)
    assert found.count() == 15_000
    found.collect()
    sizes = [r.n for r in found.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]


def brute(texts, t=Fraction(4, 5)):
    sets = {}
    for i, x in texts:
        w = " ".join(unicodedata.normalize("NFKC", x or "").split()).split(" ")
        if w != [""] and i is not None:
            sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])
    return sorted((a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]))


def texts(seed, n=40):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = [rng.choice("abcdefg") + str(rng.randrange(12)) for _ in range(rng.choice([1, 4, 5, 9, 30, 60, 120]))]
        for _ in range(rng.randrange(1, 5)):
            v = list(w)
            for _ in range(rng.randrange(4)):
                p = rng.randrange(len(v))
                v[p : p + 1] = rng.choice([[], ["q"], [v[p], "r"]]) if len(v) > 1 else v[p : p + 1]
            out.append("  ".join(v) + rng.choice(["", "\n", "　"]))
    return [(i * 3, x) for i, x in enumerate(out)] + [(9001, None), (9002, ""), (9003, "  "), (None, "a b c"), (9004, "ﬁ x"), (9005, "fi x"), (9006, "w " * 30_000), (9007, "w " * 29_999), (9004, "ﬁ x")]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_against_brute_force(spark, seed):
    rows = texts(seed)
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "rec_id long, text string, c1 int, n int").repartition(3)
    found = near.near_duplicates(df)
    want = brute(rows)
    assert sorted((r.rec_id_a, r.rec_id_b) for r in found.pairs().collect()) == want and len(want) > 20
    root = {i: i for p in want for i in p}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in want:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    for r in near.groups(found).collect():
        assert r.group_id == (top(r.id) if r.id in root else r.id)


def test_chain_of_links(spark):
    w = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(w[i:] + [f"x{j}" for j in range(i)])) for i in range(0, 24, 3)]
    found = near.near_duplicates(spark.createDataFrame(rows, "rec_id long, text string"))
    g = {r.id: r.group_id for r in near.groups(found).collect()}
    assert set(g.values()) == {0} and len(g) == 8


def test_no_texts(spark):
    df = spark.createDataFrame([(1, None)], "rec_id long, text string")
    found = near.near_duplicates(df)
    assert found.pairs().count() == 0 and near.groups(found).count() == 0


def test_long_lists_leave_occurrences_to_count():
    n = np.array([1, 2, 5, 40, 100, 1000])
    for longest in (1, 100, 10**9):
        k = near.long_lists(n, longest)
        assert (k >= 0).all() and (k < near.need(n)).all()
    assert near.long_lists(np.array([1000]), 10**9)[0] < near.long_lists(np.array([1000]), 10)[0] < 800


def test_probing_stops_only_below_the_threshold():
    rng = np.random.default_rng(3)
    for _ in range(300):
        x, y = (np.unique(rng.integers(0, 160, 120).astype(np.uint64)) for _ in range(2))
        cut = int(rng.integers(0, 160))
        half = lambda v: (v[v < cut], v[v >= cut])
        both, hits = len(np.intersect1d(x, y)), len(np.intersect1d(half(x)[0], half(y)[0]))
        least = int(rng.integers(1, 120))
        got = near.probe_long(hits, half(x), half(y), least)
        assert got == both or (got == -1 and both < least)


@pytest.mark.parametrize("mu", [0.0, 0.004, 0.05, 1.0])
def test_any_division_gives_the_same_pairs(spark, mu):
    rows = texts(5, 25)
    df = spark.createDataFrame(rows, "rec_id long, text string")
    assert sorted((r.rec_id_a, r.rec_id_b) for r in near.near_duplicates(df, mu=mu).pairs().collect()) == brute(rows)


def test_hot_list_is_split(spark, split_early):
    """A token that half of all sets have on a short list: the merge is split."""
    rows = spark.range(4000).selectExpr("case when id % 2 = 0 then -1L else id end as token", "id as rep", "cast(10 + id % 3 as int) as n", "cast(id % 2 as int) as pos").repartition(16)
    merged = near.merge_short(rows, 2000)
    assert len(merged.collect()) >= 0 and "skew=true" in merged._jdf.queryExecution().executedPlan().toString()


def test_groups_with_a_heavy_center(spark, monkeypatch):
    from granary.operators import skew

    monkeypatch.setattr(skew, "HEAVY_ROWS", 20)
    monkeypatch.setattr(skew, "HEAVY_KEYS", 10)
    links = spark.createDataFrame([(5, i, 0.9) for i in range(6, 106)] + [(200, 201, 0.9)], "a long, b long, similarity double")
    members = spark.createDataFrame([(i, i, i, i) for i in [*range(5, 106), 200, 201, 300]], "id long, c1 long, c2 long, rep long")
    got = {r.id: (r.group_id, r.links) for r in near.groups(near.NearDuplicates(members, links)).collect()}
    assert all(got[i] == (5, 1 if i > 5 else 100) for i in range(5, 106)) and got[201] == (200, 1) and got[300] == (300, 0)
