import random
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from granary.operators import dedup


def greedy(members):
    """Sequential version: drop what shares a bucket with a kept one before it."""
    by, kept, gone = {}, {}, set()
    for o, b in members:
        by.setdefault(o, set()).add(b)
    used = set()
    for o in sorted(by):
        if by[o] & used:
            gone.add(o)
        else:
            kept[o] = 1
            used |= by[o]
    return gone


def test_greedy_equals_sequential(spark):
    rng = random.Random(3)
    for _ in range(4):
        members = [(o, rng.randrange(25)) for o in range(40) for _ in range(rng.randrange(4))]
        df = spark.createDataFrame(members or [(0, 0)], "ord long, bucket long")
        assert {r.ord for r in dedup.greedy_first(df).collect()} == greedy(members)


def test_greedy_chain_and_empty(spark):
    chain = spark.createDataFrame([(1, 1), (2, 1), (2, 2), (3, 2)], "ord long, bucket long")
    assert {r.ord for r in dedup.greedy_first(chain).collect()} == {2}
    assert dedup.greedy_first(chain.where("false")).count() == 0


def test_exact_first_wins(spark):
    df = spark.createDataFrame([(1, "A  b"), (2, "A b"), (3, "a b"), (4, None), (5, None), (6, ""), (7, " ")], "id long, text string")
    assert sorted(r.id for r in dedup.exact_first(df, "id").collect()) == [1, 3, 4, 6]


def test_gate(spark):
    df = spark.createDataFrame([(1, "x" * 199), (2, "x" * 200), (3, " " * 150 + "x" * 100 + "　" * 50), (4, None), (5, "")], "id long, text string")
    assert [r.id for r in dedup.min_chars_gate(df).collect()] == [2]


def brute(texts, t=Fraction(4, 5)):
    sets = {i: frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) for i, x in texts if (w := (x or "").split())}
    return {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b])}


def variants(n, seed):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefghij") + str(rng.randrange(30)) for _ in range(rng.choice([3, 8, 30, 80]))] for _ in range(n)]
    out = []
    for w in base:
        out.append(" ".join(w))
        for _ in range(rng.randrange(4)):
            v = list(w)
            for _ in range(rng.randrange(4)):
                v[rng.randrange(len(v))] = "zz" + str(rng.randrange(9))
            out.append(" ".join(v))
    return list(enumerate(out + ["", None, "one two", "one two"]))


def test_jaccard_pairs_against_brute_force(spark):
    texts = variants(25, 1)
    df = spark.createDataFrame(texts, "id long, text string")
    got = {(r.a, r.b) for r in dedup.jaccard_pairs(df, "id").collect()}
    assert got == brute(texts) and got


def test_lsh_layout_and_minhash(spark):
    assert dedup.lsh_layout(0.8) == (9, 13)
    df = spark.createDataFrame([(1, [1, 2, 3]), (2, [3, 2, 1]), (3, [])], "id long, items array<long>")
    s = {r.id: r.sig for r in df.select("id", dedup.minhash(F.col("items")).alias("sig")).collect()}
    assert s[1] == s[2] and len(s[1]) == 128 and set(s[3]) == {2**32 - 1}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 10)), max_size=40))
def test_sequential_greedy_is_a_maximal_independent_set(members):
    gone = greedy(members)
    by = {}
    for o, b in members:
        by.setdefault(o, set()).add(b)
    kept = [o for o in by if o not in gone]
    assert all(not (by[a] & by[b]) for a in kept for b in kept if a < b)
    assert all(any(k < g and by[k] & by[g] for k in kept) for g in gone)
