"""The corpus build as stages that are skipped when their output is complete."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from fractions import Fraction

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from granary.functions.text import strip, text_hash
from granary.operators import corpus, dedup
from granary.operators.prefix import running_count
from granary.session import materialize
from granary.sources import files as files_
from granary.sources import readers, sinks


@dataclass
class Stage:
    """A named step with an output folder; ``needs`` are names of stages whose markers must be there."""

    name: str
    output: str
    run: Callable[[], None]
    needs: list[str] = field(default_factory=list)

    @property
    def done(self) -> bool:
        return files_.exists(SparkSession.active(), f"{self.output.rstrip('/')}/_SUCCESS")


def run_stages(stages: list[Stage]) -> list[str]:
    """Run what is not done, in the order of needs; gives the names of the stages that ran. An unknown or
    circular need, or one that left no marker, is an error."""
    by = {s.name: s for s in stages}
    ran: list[str] = []
    state: dict[str, int] = {}

    def visit(name: str) -> None:
        if name not in by:
            raise KeyError(f"no stage {name}")
        if state.get(name) == 2:
            return
        if state.get(name) == 1:
            raise ValueError(f"stage {name} needs itself")
        state[name] = 1
        for n in by[name].needs:
            visit(n)
        if not by[name].done:
            by[name].run()
            if not by[name].done:
                raise RuntimeError(f"stage {name} left no marker")
            ran.append(name)
        state[name] = 2

    for s in stages:
        visit(s.name)
    return ran


def missing_sources(files: dict[str, list[str]]) -> list[str]:
    """Corpora without any file, in the order of their priority; all of them missing is an error."""
    out = [k for k in readers.PRIORITY if not files.get(k)]
    if len(out) == len(readers.PRIORITY):
        raise ValueError("no source has any file")
    return out


def read_sources(spark: SparkSession, files: dict[str, list[str]], split: str = "clean") -> DataFrame:
    """Union of the corpora that have files, in the order of their priority; none at all is an error."""
    missing_sources(files)
    read = {
        "culturax": lambda f: readers.read_culturax(spark, f),
        "hplt": lambda f: readers.read_hplt(spark, f),
        "madlad": lambda f: readers.read_madlad(spark, f, split),
    }
    out = None
    for k in readers.PRIORITY:
        if files.get(k):
            part = read[k](files[k])
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


ORDER = ("src_prio", "file", "block", "row")


def build_corpus(rows: DataFrame, path: str, min_chars: int = 200, near: bool = False, threshold: float = 0.8, shard_docs: int = 200_000, near_lsh: bool = False, seen: Observation | None = None) -> DataFrame:
    """Gate, exact and (if asked) near deduplication of rows with the order columns src_prio, file, block, row;
    near duplicates are those of a true similarity of ``threshold`` or more, or with ``near_lsh`` those that share a band;
    writes shards of exactly ``shard_docs`` rows (text, url, timestamp, source) and gives rows in and kept by corpus.
    First seen wins. The rows are parsed and hashed once, into a table, so that their order keys cannot change; all is
    decided on order and hash, and texts are shuffled to join the decision and into their shards. ``seen``
    counts rows and gated rows as they pass."""
    order = [F.col(c) for c in ORDER]
    ok = F.length(strip(F.col("text"))) >= F.lit(max(1, min_chars))
    marked = rows.select(*order, *readers.CORPUS, F.coalesce(ok, F.lit(False)).alias("ok"), text_hash(F.col("text")).alias("h"))
    if seen is not None:
        marked = marked.observe(seen, F.count("*").alias("n_in"), F.sum(F.col("ok").cast("long")).alias("n_gated"))
    marked = materialize(marked, "rows")
    first = marked.where("ok").groupBy("h").agg(F.min(F.struct(*order)).alias("x")).select("x.*")
    at = materialize(running_count(first, order), "exact")
    texts = marked.select(*order, *readers.CORPUS)
    kept = texts.join(at, list(ORDER))
    if near:
        kept = materialize(kept.select(*ORDER, *readers.CORPUS, F.col("position").alias("place")), "kept")
        left = dedup.near_dedup_lsh(kept, "place", "text", threshold) if near_lsh else dedup.near_dedup_verified(kept, "place", "text", Fraction(str(threshold)))
        at = materialize(running_count(left.select(*order, "place"), [F.col("place")]), "left")
        kept = kept.join(at.select("place", "position"), "place")
    sinks.write_numbered(kept, path, at.count(), "position", shard_docs, readers.CORPUS)
    name = F.element_at(F.create_map(*[F.lit(x) for k, v in readers.PRIORITY.items() for x in (v, k)]), F.col("src_prio"))
    return corpus.source_stats(marked, at, "src_prio").select(name.alias("corpus"), "n_in", "kept")
