import json

import pytest
from pyspark.sql import functions as F

from granary.operators import dedup, skew
from granary.operators.sketch import count_table, id_filter, keep_ids, log_codes, table_bits
from granary.sources import files


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_join_back_with_a_heavy_key(spark, monkeypatch, how):
    rows = spark.range(3000).selectExpr("case when id < 1500 then 'hot' else cast(id % 40 as string) end as k", "id as v")
    agg = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("v").alias("m")).where("n > 10")
    plain = sorted(map(tuple, rows.join(agg.drop("n"), "k", how).collect()))
    monkeypatch.setattr(skew, "HEAVY_ROWS", 500)
    monkeypatch.setattr(skew, "HEAVY_KEYS", 10)
    got = skew.join_back(rows, agg, "k", 3000, how=how)
    assert sorted(map(tuple, got.collect())) == plain and "Union" in got._jdf.queryExecution().toString()


def test_greedy_with_a_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr(skew, "HEAVY_ROWS", 20)
    monkeypatch.setattr(skew, "HEAVY_KEYS", 10)
    monkeypatch.setattr(dedup, "HEAVY_ROWS", 20)
    members = [(i, 0) for i in range(100)] + [(i, i % 7 + 1) for i in range(100, 140)] + [(0, 3)]
    df = spark.createDataFrame(members, "ord long, bucket long")
    from test_dedup import greedy

    assert {r.ord for r in dedup.greedy_first(df).collect()} == greedy(members)


def test_tables_and_filters(spark):
    import numpy as np

    from granary.functions.wordruns import mix

    df = spark.range(1000).selectExpr("id % 100 as x").repartition(70)
    got = count_table(df, lambda b: mix(mix(b.column(0).to_numpy().astype(np.uint64) + np.uint64(1))), 18)
    assert got.sum() == 1000 and (got > 0).sum() <= 100 and got.max() >= 10
    assert count_table(df.where("false"), lambda b: np.zeros(b.num_rows, np.uint64), 16).sum() == 0
    many = spark.range(200_000).selectExpr("id * 0 as x").coalesce(1)
    assert count_table(many, lambda b: np.zeros(b.num_rows, np.uint64), 16)[0] == 65_535
    assert table_bits(0) == 16 and table_bits(10**12) == 25 and log_codes(np.array([0, 1, 10])).tolist() == [0, 8, 28]
    ids = spark.range(0, 500, 5)
    kept = [r.id for r in keep_ids(spark.range(2000), id_filter(ids, 100)).collect()]
    assert set(range(0, 500, 5)) <= set(kept) and len(kept) < 200
    assert id_filter(ids, 10**9) is None and keep_ids(ids, None) is ids


def test_hot_item_is_split(spark):
    """Half of all sets share an item; where it is on the short lists the join must be one that can be split."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    try:
        for k, v in zip(old, ("-1", "2KB", "2KB", "false", "16", "2")):
            spark.conf.set(k, v)
        rows = spark.range(4000).selectExpr("case when id % 2 = 0 then -1L else id end as token", "id", "cast(10 + id % 3 as int) as n", "cast(id % 5 as int) as pos").repartition(16)
        j = dedup._meeting(rows, 4, 5)
        got = j.collect()
        at = {r.id: (r.n, r.pos) for r in rows.where("token = -1").collect()}
        fits = lambda x, y: (at[x][0], x) < (at[y][0], y) and 5 * at[x][0] >= 4 * at[y][0] and 9 * min(at[x][0] - at[x][1], at[y][0] - at[y][1]) >= 4 * (at[x][0] + at[y][0])
        assert len(got) == sum(fits(x, y) for x in at for y in at)
        assert "skew=true" in j._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_files(spark, tmp_path):
    p = f"file://{tmp_path}/a/b/meta.json"
    assert files.read_text(spark, p) is None and not files.exists(spark, p)
    files.write_text(spark, p, json.dumps({"x": "සිංහල"}, ensure_ascii=False))
    assert json.loads(files.read_text(spark, str(tmp_path / "a/b/meta.json"))) == {"x": "සිංහල"}
    (tmp_path / "home/datasets--Some--Corpus/snap").mkdir(parents=True)
    (tmp_path / "home/datasets--Some--Corpus/snap/si_1.parquet").write_text("")
    from granary.sources import readers

    got = readers.resolve_files(spark, "culturax", "si", str(tmp_path / "raw"), None, "x/corpus", [str(tmp_path / "home"), str(tmp_path / "none")])
    assert [x.rsplit("/", 1)[-1] for x in got] == ["si_1.parquet"]
    files.remove(spark, str(tmp_path / "a"))
    assert not files.exists(spark, p)


def test_json_that_looks_right(spark):
    """Lines that a lenient parser takes, and what takes the slow way, against Python's parser."""
    from granary.sources import readers

    lines = ['{"text":"a"}', '{"text":"a"} x', '{"text":"a"}],[{}', '{"text":"a"}}{"b":{}', '{"text":"a"},{"text":"b"}', '{"text":"a","text":"b"}', '{"text":1.50,"u":true,"ts":[1,"x"]}', '{"text":{"k":"é"}}',
             '{"text":"\\u00e9\\n","u":null}', "{}", "[]", "[{}]", "0", "false", "1e5", '"x"', '{"text":"tab\there"}', '{"TEXT":"x"}', '{"text":NaN}', '{"a":{"text":"in"}}', '{"text":""}', '{"text":"a",}', '{"ts":"' + "x" * 100_000 + '"}', "[" * 2000 + "]" * 2000]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)] + [(99, None)], "i int, line string")
    got = {r.i: tuple(r.j) for r in df.select("i", readers.parse_json(F.col("line")).alias("j")).collect()}
    for i, x in enumerate(lines):
        assert got[i] == readers._parse(x), x[:60]
    assert got[99][0] == "bad"


def test_command_line(spark, tmp_path, sf, capsys):
    """Build with a configuration, sampled lines, expansion, packing and card, end to end."""
    from granary.__main__ import main
    from granary.session import read_table

    d, out = read_table(spark, sf, "documents"), tmp_path
    d.select("text", "url", "timestamp", "source").coalesce(2).write.parquet(str(out / "raw/culturax_si"))
    read_table(spark, sf, "hplt_lines").select("line").coalesce(1).write.text(str(out / "h"))
    (out / "raw/hplt_sin_Sinh").mkdir()
    next((out / "h").glob("*.txt")).rename(out / "raw/hplt_sin_Sinh/a.jsonl")
    (out / "c.yaml").write_text("sinhala:\n  culturax: si\n  hplt: sin_Sinh\n  madlad: si\n  madlad_split: clean\n")
    main(["build", "--language", "Sinhala", "--config", str(out / "c.yaml"), "--data-raw", str(out / "raw"), "--out", str(out / "corpus"), "--near-dedup", "--shard-docs", "50"])
    said = capsys.readouterr()
    assert "no files of madlad" in said.err and "rows a second" in said.err and {x.split()[0] for x in said.out.splitlines()} == {"culturax", "hplt"}
    sizes = [r.n for r in spark.read.parquet(str(out / "corpus")).groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count("*").alias("n")).orderBy("f").collect()]
    assert set(sizes[:-1]) == {50} and 0 < sizes[-1] <= 50
    main(["lines", "--data", str(out / "corpus"), "--out", str(out / "lines"), "--max-lines", "40"])
    assert spark.read.text(str(out / "lines")).count() == 40
    read_table(spark, sf, "spm_vocab").orderBy("piece_rank").select(F.concat_ws("\t", "piece", "score")).coalesce(1).write.text(str(out / "v"))
    next((out / "v").glob("*.txt")).rename(out / "si.vocab")
    read_table(spark, sf, "embeddings").withColumn("out", F.col("embedding")).write.parquet(str(out / "m"))
    main(["expand", "--lang-spm", str(out / "si.model"), "--out", str(out / "x"), "--matrix", str(out / "m"), "--output-column", "out", "--sample", str(out / "corpus"), "--max-new", "300"])
    meta = json.loads(capsys.readouterr().out)
    assert meta == json.loads((out / "x/meta.json").read_text()) and meta["added"] == 300 and meta["new_vocab"] == 50_557 and meta["tied_embeddings"] is False
    assert 0 < meta["fertility_tokens_per_char_after"] < meta["fertility_tokens_per_char_before"]
    import tokenizers

    tk = tokenizers.Tokenizer.from_file(str(out / "x/tokenizer.json"))
    rows = spark.read.parquet(str(out / "x/new_rows")).collect()
    assert len(rows) == 300 and all(tk.token_to_id(r.surface) == r.token_id and len(r.input) == len(r.output) == 64 for r in rows)
    main(["pack", "--data", str(out / "corpus"), "--out", str(out / "p"), "--seq-len", "256", "--world", "2", "--replay-data", str(out / "corpus")])
    p = spark.read.parquet(str(out / "p"))
    assert {r["rank"] for r in p.select("rank").distinct().collect()} == {0, 1} and p.where("size(input_ids) <> 256").count() == 0
    from granary.functions.tokenizers import token_count

    both = 2 * spark.read.parquet(str(out / "corpus")).agg(F.sum(token_count(F.col("text")) + 1)).first()[0]
    assert both - 2 * 256 < 256 * p.count() <= both
    main(["card", "--repo-id", "me/x", "--base", "a/b", "--lang", "sinhala", "--code", "si", "--license", "mit", "--out", str(out / "card.md"), "--expansion", str(out / "x")])
    assert "300 tokens" in (out / "card.md").read_text() and "Tokens by character" in (out / "card.md").read_text()
