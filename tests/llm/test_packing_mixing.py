import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from granary.llm import mixing, packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_pack_sizes(sizes):
    n = np.array(sizes, np.int64)
    seq = packing.pack_sizes(n, 64)
    used = np.bincount(seq, weights=n) if len(n) else np.zeros(0)
    assert (used <= 64).all()
    # A new sequence is opened only where nothing fits, or as one of those open from the start.
    k = len(np.unique(seq))
    assert k <= max(1, int(0.5 * n.sum() / 64)) + 2 * n.sum() / 64 + 1


def test_pack_sizes_picks_the_least_cost():
    n = np.array([30, 20, 10, 10], np.int64)
    assert packing.pack_sizes(n, 40, open_share=0).tolist() == [0, 1, 1, 1] or packing.pack_sizes(n, 40, open_share=0).tolist() == [0, 1, 1, 0]
    cost, room, got = {}, {}, packing.pack_sizes(np.array([50, 40, 30, 30, 20, 10], np.int64), 100, open_share=0)
    for w, s in zip([50, 40, 30, 30, 20, 10], got):
        fits = [x for x in room if room[x] >= w]
        assert (s in fits and cost[s] == min(cost[x] for x in fits)) or (not fits and s not in room)
        room[s] = room.get(s, 100) - w
        cost[s] = cost.get(s, 0) + w + w * w / 4096


def test_pack_covers_every_token_once(spark):
    rows = [(i, n, "x") for i, n in enumerate([0, 1, 7, 8, 9, 16, 17, 40, 3, 3, 5])] + [(None, 4, "x"), (2, 7, "x")]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, group_no string")
    caps = spark.createDataFrame([("a", 8), ("b", 100), ("bad", 0), (None, 16)], "pack_name string, seq_len int")
    got = packing.pack(df, caps, group_items=4).toPandas()
    for cap in (8, 16, 100):
        g = got[got.seq_len == cap]
        assert g.n_tokens.sum() == sum(r[1] for r in rows if r[0] is not None)
        seqs = g.groupby(["group_no", "seq_no"])
        assert (seqs.n_tokens.sum() <= cap).all() and (seqs.n_tokens.sum() == seqs.seq_tokens.first()).all()
        for i, n, _ in rows:
            p = g[g.doc_id == i].sort_values("first_token") if i is not None else None
            if p is not None and i != 2 and n:
                assert p.first_token.tolist() == np.cumsum([0, *p.n_tokens[:-1]]).tolist() and (n <= cap) == (len(p) == 1) and p.n_tokens.sum() == n
    assert packing.pack(df.where("false"), caps).count() == 0


def test_pack_documents_and_report(spark, sf):
    from granary.session import read_table

    p = packing.pack_documents(read_table(spark, sf, "documents"), read_table(spark, sf, "pack_sizes"))
    for r in packing.report(p).collect():
        assert r.least_sequences <= r.sequences <= 1.02 * r.least_sequences + 1


def brute_mix(rows, targets, total, order):
    out = {}
    for s, (share, cap) in targets.items():
        docs = [(i, n) for i, src, n in order if src == s]
        size = sum(n for _, n in docs)
        left = int(share * total)
        for e in range(1, cap + 1):
            for i, n in docs:
                if left > 0:
                    out[i, e] = min(n, left)
                    left -= n
            if not size:
                break
    return out


def test_mix_against_brute_force(spark):
    """Ids and cuts are equal whatever the number of ranges."""
    rows = [(i, "ab"[i % 2] if i % 7 else "c", 1 + i * 13 % 17) for i in range(60)]
    sized = spark.createDataFrame([(i, s, n) for i, s, n in rows], "id long, src string, n long")
    targets = spark.createDataFrame([("A ", 0.5, 1), ("b", 0.1, 3), ("C", 0.3, 4), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    keys = {r.id: r.k for r in sized.select("id", mixing.random_key(F.col("id")).alias("k")).collect()}
    assert min(keys.values()) >= 0
    order = sorted(rows, key=lambda r: (keys[r[0]], r[0]))
    for total in (150, 400):
        want = brute_mix(rows, {"a": (0.5, 1), "b": (0.1, 3), "c": (0.3, 4)}, total, order)
        for bucket_rows in (3, 20, 1000):
            got = {(r.id, r.epoch): r.tokens for r in mixing.mix(sized, targets, total, bucket_rows=bucket_rows).collect()}
            assert got == want
    for s, (share, cap) in {"a": (0.5, 1), "b": (0.1, 3), "c": (0.3, 4)}.items():
        ids = {i for i, x, _ in rows if x == s}
        have = sum(n for _, x, n in rows if x == s)
        assert sum(t for (i, _), t in got.items() if i in ids) == min(int(share * total), cap * have)
        assert max([e for (i, e) in got if i in ids], default=0) <= cap
    sh = {r.source: r for r in mixing.shares(mixing.mix(sized, targets, total), sized, targets, total).collect()}
    assert sh["none"].tokens == 0 and not sh["none"].reached and sh["none"].repeats is None
    assert sum(r.actual_share for r in sh.values()) == pytest.approx(1)


def test_shortfalls_are_shared_out(spark):
    """What one source cannot give goes to the others by their shares; where all are at their caps the mix is smaller."""
    sized = spark.createDataFrame([(i, s, 10) for i, s in enumerate("a" * 10 + "b" * 10 + "c")], "id long, src string, n long")
    targets = spark.createDataFrame([("a", 0.4, 4), ("b", 0.2, 4), ("c", 0.3, 2), ("none", 0.1, 9)], "source string, target_share double, max_repeats int")
    got = {r.source: r for r in mixing.shares(mixing.mix(sized, targets, 200, fill=True), sized, targets, 200, fill=True).collect()}
    assert got["c"].tokens == 20 and got["none"].tokens == 0 and got["a"].tokens == 120 and got["b"].tokens == 60
    got = {r.source: r.tokens for r in mixing.shares(mixing.mix(sized, targets, 5000, fill=True), sized, targets, 5000, fill=True).collect()}
    assert got == {"a": 400, "b": 400, "c": 20, "none": 0}


def test_mix_edges(spark):
    docs = spark.createDataFrame([(1, "a b c", " SRC"), (2, None, "src"), (3, "", "src"), (None, "x", "src"), (1, "a b c", "src")], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("Src", 1.0, 2)], "source string, target_share double, max_repeats int")
    sized = mixing.sized_sources(docs)
    assert mixing.mix(sized, targets).agg(F.sum("tokens")).first()[0] == sized.agg(F.sum("n")).first()[0]
    assert mixing.mix(sized.where("false"), targets).count() == 0
    assert mixing.shares(mixing.mix(sized.where("false"), targets), sized.where("false"), targets).first().actual_share is None
