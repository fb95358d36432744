import time
import os
import gzip
import json

import pytest
import zstandard
from pyspark.sql import functions as F

from granary.functions.tokenizers import tokenizer
from granary.operators import corpus, dimensions, embeddings, sequences, vocab
from granary.operators.prefix import running_count, running_sum
from granary.plans import pipeline
from granary.sources import readers, sinks
from granary.streaming import ingest

LINES = ["{bad", "{'text':'x'}", '{"ts":NaN}', '{"text":"t"} junk', "[1,2]", '"bare"', "null", '{"text":null,"u":0}', '{"text":"a","text":"b"}', "", "  ", ' {"text":"p","ts":5} ', '{"u":"x"}']


def test_json_readers(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(LINES)] + [(99, None)], "i int, line string")
    got = {r.i: (r.text, r.url, r.timestamp) for r in readers.drop_bad(df).collect()}
    assert got == {7: ("", "", ""), 8: ("b", "", ""), 11: ("p", "", "5"), 12: ("", "x", "")}
    raw = {r.i: r.text for r in readers.keep_raw(df).collect()}
    assert raw[0] == "{bad" and raw[3] == '{"text":"t"} junk' and raw[5] == "bare" and raw[6] == "None" and raw[4] == "[1, 2]" and 9 not in raw and 99 not in raw


def test_build_and_stages(spark, tmp_path):
    long = "word " * 60
    (tmp_path / "culturax_si").mkdir()
    spark.createDataFrame([(long + "one", "u1"), ("short", None)], "text string, url string").coalesce(1).write.parquet(str(tmp_path / "culturax_si/x"))
    h = tmp_path / "hplt_si"
    h.mkdir()
    rows = [json.dumps({"text": long + "one", "u": "u2"}), "{bad", json.dumps({"text": long + "two", "ts": "t"})]
    with gzip.open(h / "a.jsonl.gz", "wt") as f:
        f.write("\n".join(rows))
    (h / "b.jsonl.zst").write_bytes(zstandard.ZstdCompressor().compress((json.dumps({"text": long + "three"}) + "\n").encode()))
    files = {k: readers.resolve_files(spark, k, "si", str(tmp_path)) for k in readers.PRIORITY}
    assert len(files["hplt"]) == 2 and not files["madlad"]
    out = str(tmp_path / "out")
    rows_df = pipeline.read_sources(spark, files)
    stats = []
    stage = pipeline.Stage("corpus", out, lambda: stats.extend(pipeline.build_corpus(rows_df, out).collect()))
    assert pipeline.run_stages([stage]) == ["corpus"] and pipeline.run_stages([stage]) == []
    assert {(r.corpus, r.n_in, r.kept) for r in stats} == {("culturax", 2, 1), ("hplt", 3 - 1 + 1, 2)}
    got = spark.read.parquet(out)
    assert got.columns == list(readers.CORPUS) and got.where("url = 'u1'").count() == 1
    with pytest.raises(ValueError):
        pipeline.read_sources(spark, {})
    with pytest.raises(ValueError):
        pipeline.run_stages([pipeline.Stage("a", str(tmp_path / "no"), lambda: None, ["a"])])


def test_build_near_duplicates_are_exact(spark, tmp_path):
    """At a similarity of 0.85 three in ten pairs share no band; all later ones must go, and none below 0.8."""
    rows = []
    for i in range(20):
        words = [f"w{i}x{k}" for k in range(100)]
        rows += [("s", 0, 0, 3 * i, " ".join(words)), ("s", 0, 0, 3 * i + 1, " ".join(words[:92])[:-1] + "y " + " ".join(f"n{i}x{k}" for k in range(3))), ("s", 0, 0, 3 * i + 2, " ".join(words[:70]) + " " + " ".join(f"m{i}x{k}" for k in range(30)))]
    df = spark.createDataFrame(rows, "source string, file int, block int, row int, text string").withColumns({"src_prio": F.lit(0), "url": F.lit(None).cast("string"), "timestamp": F.lit(None).cast("string")})
    pipeline.build_corpus(df, str(tmp_path / "o"), near=True)
    got = {r.text for r in spark.read.parquet(str(tmp_path / "o")).select("text").collect()}
    assert got == {r[4] for r in rows if r[3] % 3 != 1}


def test_files(spark, tmp_path):
    for n in ("x/si/a.parquet", "x/si_b.parquet", "x/p_si_q.parquet", "x/other.parquet"):
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_text("")
    f = readers.find_files(spark, f"file://{tmp_path}", ["*.parquet"])
    assert f == readers.find_files(spark, str(tmp_path), ["*.parquet"]) and readers.find_files(spark, f"{tmp_path}/none", ["*"]) == []
    assert len(f) == 4 and f == sorted(f)
    assert len(readers.language_files(f, "si")) == 3
    assert readers.language_files(f, "zz") == [] and readers.language_files(f, "zz", strict=False) == f


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_running_sum(spark, parts):
    rows = [(i % 3, i, (i * 7) % 5) for i in range(60)]
    df = spark.createDataFrame(rows, "g int, i int, v int").repartition(parts)
    got = {(r.g, r.i): r.b for r in running_sum(df, [F.col("i")], F.col("v"), "b", ["g"]).collect()}
    for g, i, _ in rows:
        assert got[g, i] == sum(v for h, j, v in rows if h == g and j < i)
    assert sorted((r.i, r.position) for r in running_count(df, [F.col("i")]).collect()) == [(i, i + 1) for i in range(60)]
    assert running_sum(df.where("false"), [F.col("i")], F.col("v")).count() == 0


def test_byte_cap_keeps_the_crossing_row(spark):
    df = spark.createDataFrame([(i, 10) for i in range(5)], "i int, n int")
    assert sorted(r.i for r in corpus.byte_cap(df, [F.col("i")], F.col("n"), 25).collect()) == [0, 1, 2]


def test_lines(spark):
    df = spark.createDataFrame([(1, "1234567\n 12345678 \r\nabc defgh"), (2, ""), (3, None)], "id int, text string")
    assert [(r.id, r.line_no, r.line) for r in corpus.lines(df, "id").collect()] == [(1, 1, "12345678"), (1, 2, "abc defgh")]


@pytest.mark.parametrize("parts", [1, 5])
def test_pack_sequences_against_python(spark, parts):
    texts = [(i, i % 2, "the quick brown fox " * (1 + 5 * (i % 4))) for i in range(12)] + [(12, 0, None), (13, 1, "")]
    df = spark.createDataFrame(texts, "i int, g int, text string").repartition(parts)
    tk = tokenizer()
    got = sorted((r.g, r.seq_no, tuple(r.input_ids)) for r in sequences.pack_sequences(df, [F.col("i")], ["g"], 16).collect())
    want = []
    for g in (0, 1):
        flat = [t for i, h, x in sorted(texts, key=lambda r: r[0]) if h == g and x for t in [*tk.encode(x), tk.eos]]
        want += [(g, k, tuple(flat[16 * k : 16 * k + 16])) for k in range(len(flat) // 16)]
    assert got == want


def test_replay_mix_emits_all_once(spark):
    a, b = spark.range(200).toDF("id"), spark.range(20).toDF("id")
    rows = sequences.replay_mix(a, b, [F.col("id")], 0.1).orderBy("mix_key").collect()
    assert len(rows) == 220 and 2 <= sum(r.stream for r in rows[:60]) <= 10
    assert sequences.replay_mix(a, b, [F.col("id")], 0.0).count() == 200


def test_vocab(spark, tmp_path):
    pieces = ["<unk>", "<0x41>", "<a>", "", "▁x", "▁word", "word", "zqxv", "▁zqxv", "zqxv", "the"]
    p = tmp_path / "v.vocab"
    p.write_text("\n".join(f"{x}\t-1" for x in pieces) + "\n", encoding="utf-8")
    v = readers.read_vocab(spark, str(p))
    assert [r.piece for r in vocab.plain_pieces(v).orderBy("piece_rank").collect()] == pieces[4:]
    new = vocab.select_new_tokens(v, 10).orderBy("new_rank").collect()
    assert [(r.new_rank, r.surface) for r in new] == [(0, "zqxv"), (1, " zqxv")]
    assert [r.token_id for r in vocab.assign_token_ids(vocab.select_new_tokens(v, 1), 100).collect()] == [100]


def test_fertility_is_a_ratio_of_sums(spark):
    df = spark.createDataFrame([("ab", 1), ("abcd", 4), (None, 9), ("", 7)], "text string, n int")
    assert vocab.fertility(df, F.col("n")).first().fertility == pytest.approx(5 / 6)
    f = vocab.fertility(df.where("false"), F.col("n")).first().fertility
    assert f != f


def test_embeddings(spark):
    e = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 6.0])], "vec_id long, embedding array<float>")
    ids = spark.createDataFrame([("a", [0, 0, 1]), ("b", [7]), ("c", []), ("d", [1, 9])], "k string, ids array<long>")
    got = {r.k: r["mean"] for r in embeddings.mean_init(ids, e, "k").collect()}
    assert got["a"] == pytest.approx([5 / 3, 10 / 3]) and got["b"] == got["c"] == [2.0, 4.0] and got["d"] == [3.0, 6.0]
    new = spark.createDataFrame([(1, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert {r.vec_id: r.embedding for r in embeddings.apply_init(e, new).collect()} == {0: [1.0, 2.0], 1: [0.0, 0.0]}


def test_dimensions(spark):
    df = spark.createDataFrame([("x/Qwen-Gemma",), ("gemma-3",), ("other",), (None,)], "m string")
    assert [r.f for r in df.select(dimensions.model_family(F.col("m")).alias("f")).collect()] == ["qwen", "gemma", "qwen", "qwen"]
    lit = F.lit
    card = dimensions.model_card(df.limit(1), lit("me/c"), lit("tamil"), lit("ta"), lit("a/b"), lit("mit"), lit("Note."), ("d1", "d2"), lit(1200), lit(0.4), lit(0.25)).first().card
    assert "Tamil" in card and "1,200" in card and "0.400 before the new tokens, 0.250 after" in card and "- d1\n- d2\n" in card and card.endswith("as the base model. Note.\n") and "# c\n" in card
    none = lit(None).cast("double")
    card = dimensions.model_card(df.limit(1), lit("c"), lit("tamil"), lit("ta"), lit("a/b"), lit("mit"), lit(""), (), none.cast("long"), none, lit(0.25)).first().card
    assert "several thousand" in card and "Tokens by character" not in card
    rows = dimensions.parse_dimension("# codes\nTamil:\n  culturax: ta  # two letters\n  hplt: 'tam_Taml'\n\nnepali:\n  culturax: ne\n")
    assert rows == {"tamil": {"culturax": "ta", "hplt": "tam_Taml"}, "nepali": {"culturax": "ne"}} and dimensions.parse_dimension('{"Tamil": {"a": 1}}') == {"tamil": {"a": "1"}}
    assert dimensions.dimension_row(rows, "TAMIL")["culturax"] == "ta"
    with pytest.raises(KeyError):
        dimensions.dimension_row(rows, "xx")
    with pytest.raises(ValueError):
        dimensions.parse_dimension("  a: b\n")


def test_shards(spark, tmp_path):
    df = spark.range(25).withColumn("text", F.lit("x"))
    sinks.write_shards(df, str(tmp_path / "s"), [F.col("id")], 10)
    name = F.col("_metadata.file_name")
    got = spark.read.parquet(str(tmp_path / "s")).groupBy(name.alias("f")).agg(F.count("*").alias("n"), F.min("id").alias("a")).orderBy("f").collect()
    assert [(r.n, r.a) for r in got] == [(10, 0), (10, 10), (5, 20)]
    sinks.write_shards(df.where("false"), str(tmp_path / "e"), [F.col("id")], 10)
    assert spark.read.parquet(str(tmp_path / "e")).count() == 0


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    t = "word " * 60
    (tmp_path / "in/a.jsonl").write_text("\n".join([json.dumps({"text": t}), json.dumps({"text": t + " "}), "{bad", json.dumps({"text": "short"}), json.dumps({"text": t + "x"})]))
    q = ingest.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_stream_drops_no_late_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    t = "word " * 60
    args = (spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"))
    for name, days, texts in (("a", 100, [t]), ("b", 0, [t + "new"]), ("c", 90, [t + "late", t]), ("d", -60, [t + "new", t + "last"])):
        (tmp_path / f"in/{name}.jsonl").write_text("\n".join(json.dumps({"text": x}) for x in texts))
        at = time.time() - days * 86400
        os.utime(tmp_path / f"in/{name}.jsonl", (at, at))
        ingest.ingest(*args).awaitTermination(120)
    assert sorted(r.text for r in spark.read.parquet(args[2]).select("text").collect()) == sorted([t, t + "new", t + "late", t + "last"])
