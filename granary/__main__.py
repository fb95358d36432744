"""Command line: ``python -m granary build|lines|expand|pack|card``."""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import Observation
from pyspark.sql import functions as F

from granary.operators import corpus, dimensions, sequences
from granary.operators.vocab import vocab_path
from granary.plans import expand, pipeline
from granary.session import build_session
from granary.sources import files as files_
from granary.sources import readers, sinks


def _parser() -> argparse.ArgumentParser:
    # Names and defaults of options that other tools of this kind have, too.
    p = argparse.ArgumentParser(prog="granary")
    sub = p.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="merge, gate and deduplicate corpora")
    b.add_argument("--language", help="row of the configuration")
    b.add_argument("--config", help="lookup file: codes of each corpus and the split by language")
    b.add_argument("--code", help="language code in the paths of all corpora, instead of a configuration")
    b.add_argument("--data-raw", default=".")
    b.add_argument("--cache", action="append", default=[], help="cache folder to search for data sets; may be repeated")
    for k in readers.PRIORITY:
        b.add_argument(f"--{k}-dir")
        b.add_argument(f"--{k}-dataset", help="name of the data set in a cache")
    b.add_argument("--out", required=True)
    b.add_argument("--near-dedup", action="store_true")
    b.add_argument("--near-lsh", action="store_true", help="near duplicates by shared bands, without verification")
    b.add_argument("--near-threshold", type=float, default=0.8)
    b.add_argument("--min-chars", type=int, default=200)
    b.add_argument("--shard-docs", type=int, default=200_000)
    b.add_argument("--split", help="split of the third corpus; else that of the configuration, else clean")
    n = sub.add_parser("lines", help="sampled lines that a vocabulary can be trained on elsewhere")
    n.add_argument("--data", required=True)
    n.add_argument("--out", required=True)
    n.add_argument("--max-gb", type=float, default=4.0)
    n.add_argument("--max-sentence-length", type=int, default=16_384)
    n.add_argument("--max-lines", type=int, default=10_000_000)
    e = sub.add_parser("expand", help="grow a vocabulary by the pieces of another")
    e.add_argument("--lang-spm", required=True, help="model or vocabulary file")
    e.add_argument("--out", required=True)
    e.add_argument("--matrix", help="table vec_id, embedding")
    e.add_argument("--output-column", help="column of the matrix table with an output matrix of its own")
    e.add_argument("--sample", help="corpus to measure tokens by character on")
    e.add_argument("--sample-docs", type=int, default=2_000)
    e.add_argument("--max-new", type=int, default=16_000)
    k = sub.add_parser("pack", help="token sequences of a corpus")
    k.add_argument("--data", required=True)
    k.add_argument("--out", required=True)
    k.add_argument("--seq-len", type=int, default=4096)
    k.add_argument("--replay-data")
    k.add_argument("--replay-ratio", type=float, default=0.05)
    k.add_argument("--world", type=int, default=1)
    k.add_argument("--workers", type=int, default=1)
    c = sub.add_parser("card", help="model card")
    for o in ("--repo-id", "--base", "--lang", "--out"):
        c.add_argument(o, required=True)
    c.add_argument("--code", required=True)
    c.add_argument("--license", required=True)
    c.add_argument("--notice", default="")
    c.add_argument("--dataset", action="append", default=[])
    c.add_argument("--expansion", help="folder of expand")
    return p


def _log(*x: object) -> None:
    print(*x, file=sys.stderr)


def build(spark, a: argparse.Namespace) -> list:
    if a.config:
        row = dimensions.dimension_row(dimensions.parse_dimension(files_.read_text(spark, a.config) or ""), a.language or "")
    elif a.code:
        row = {k: a.code for k in readers.PRIORITY}
    else:
        raise SystemExit("either --code or --language with --config")
    split = a.split or row.get("madlad_split") or "clean"
    found = {
        c: readers.resolve_files(spark, c, row[c], a.data_raw, getattr(a, f"{c}_dir"), getattr(a, f"{c}_dataset"), a.cache, by_language=c != "hplt") for c in readers.PRIORITY
    }
    found["madlad"] = readers.split_files(found["madlad"], split) if found["madlad"] else []
    for k in pipeline.missing_sources(found):
        _log(f"warning: no files of {k}; the corpus will be incomplete")
    rows, seen, stats, began = pipeline.read_sources(spark, found, split), Observation("build"), [], time.time()
    stage = pipeline.Stage("corpus", a.out, lambda: stats.extend(pipeline.build_corpus(rows, a.out, a.min_chars, a.near_dedup, a.near_threshold, a.shard_docs, a.near_lsh, seen).collect()))
    if pipeline.run_stages([stage]):
        n = seen.get["n_in"]
        _log(f"{n} rows, {seen.get['n_gated'] or 0} past the gate, {n / max(time.time() - began, 1e-9):.0f} rows a second")
    for r in stats:
        print(r.corpus, r.n_in, r.kept)
    return stats


def _stream(spark, path: str, world: int, workers: int):
    """Texts with the rank and worker that read their file: its place in the sorted list decides."""
    found = files_.find_files(spark, path, ["*.parquet"])
    at = spark.createDataFrame([(f, i) for i, f in enumerate(found)], "name string, at long")
    rows = spark.read.parquet(*found).select("text", F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/").alias("name"), F.col("_metadata.row_index").alias("row"))
    return sequences.shard_files(rows.join(at, "name"), F.col("at"), world, workers).drop("name")


def pack(spark, a: argparse.Namespace) -> None:
    by = ["rank", "worker"]
    rows, order = _stream(spark, a.data, a.world, a.workers), [F.col("at"), F.col("row")]
    if a.replay_data and a.replay_ratio > 0:
        rows = sequences.replay_mix(rows, _stream(spark, a.replay_data, a.world, a.workers), order, a.replay_ratio, by)
        order = [F.col("mix_key"), F.col("stream"), *order]
    sequences.pack_sequences(rows, order, by, a.seq_len).write.mode("overwrite").parquet(a.out)


def main(argv: list[str] | None = None) -> None:
    a = _parser().parse_args(argv)
    spark = build_session()
    if a.command == "build":
        build(spark, a)
    elif a.command == "lines":
        rows = spark.read.parquet(a.data).select("text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        corpus.training_lines(rows, ["file", "row"], max_bytes=int(a.max_gb * 1_000_000_000), max_line_bytes=a.max_sentence_length, max_lines=a.max_lines).select("line").write.mode("overwrite").option("compression", "gzip").text(a.out)
    elif a.command == "expand":
        pieces = readers.read_vocab(spark, vocab_path(a.lang_spm))
        sample = spark.read.parquet(a.sample).where("text <> ''").orderBy(F.col("_metadata.file_path"), F.col("_metadata.row_index")).select("text").limit(a.sample_docs) if a.sample else None
        meta = expand.expand(spark, pieces, a.out, spark.read.parquet(a.matrix) if a.matrix else None, a.output_column, sample, a.max_new)
        print(json.dumps(meta.first().asDict(), ensure_ascii=False, indent=1))
    elif a.command == "pack":
        pack(spark, a)
    else:
        meta = sinks.read_meta(spark, f"{a.expansion.rstrip('/')}/meta.json") if a.expansion else {}
        row = spark.createDataFrame([(a.repo_id, a.lang, a.code, a.base, a.license, a.notice, meta.get("added"), meta.get("fertility_tokens_per_char_before"), meta.get("fertility_tokens_per_char_after"))],
                                    "repo string, lang string, code string, base string, license string, notice string, added long, before double, after double")
        c = F.col
        card = dimensions.model_card(row, c("repo"), c("lang"), c("code"), c("base"), c("license"), c("notice"), tuple(a.dataset), c("added"), c("before"), c("after")).first().card
        files_.write_text(spark, a.out, card)


if __name__ == "__main__":
    main()
