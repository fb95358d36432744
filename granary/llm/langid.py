"""Language of records and of the parts of mixed ones, with a confidence."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.analysis import Analysis, calibrate, languages, nonprose
from granary.llm.langmodel import MAX_SAMPLES, LanguageModels, WordTable

BATCH = 1000


def fit(samples: DataFrame, max_samples: int = MAX_SAMPLES) -> Broadcast:
    """Models and calibration from labelled passages (columns sample_id, lang, text), at most ``max_samples`` of them,
    chosen by the hash of their id; broadcast, as their size is bounded by that sample."""
    rows = samples.where("lang is not null and text is not null").orderBy(F.xxhash64("sample_id"), "sample_id").select("lang", "text").limit(max_samples).collect()
    pairs = [(r.lang, r.text) for r in rows]
    return samples.sparkSession.sparkContext.broadcast((LanguageModels(pairs), calibrate(pairs)))


def label_code(label: Column, languages_: DataFrame) -> Column:
    """Code of the language a label names; null if it names none of ``languages_`` (a few rows, collected).
    Names and codes of any column are understood, in any case, with blanks or a region added."""
    names: dict[str, str] = {}
    for r in languages_.collect():
        for v in (r.language, r.culturax, r.hplt, r.madlad):
            if v:
                names.setdefault(v.strip().lower().replace("_", "-"), r.culturax)
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv]) if names else F.create_map().cast("map<string,string>")
    clean = F.translate(F.lower(F.regexp_replace(label, r"\s+", "")), "_", "-")
    return F.coalesce(F.try_element_at(table, clean), F.try_element_at(table, F.regexp_extract(clean, "^[^-]*", 0)))


def analyse(df: DataFrame, models: Broadcast, id_col: str = "rec_id", text_col: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """One row for each text that is not blank: id, ``kind`` (what is not prose, null for prose), ``lang`` and
    ``confidence`` of the whole, and ``segments`` (seg_no, lang, confidence, n_sentences).

    Null, empty and blank texts and null ids give no row. A text without letters, or in a language the models do not
    know, has lang null, confidence 0 and no segment.
    Repeated rows give repeated rows. ``extra`` are string columns to carry along."""
    extra = extra or {}
    seg = pa.list_(pa.struct([("seg_no", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64()), ("n_sentences", pa.int32())]))
    n_extra, names = len(extra), [*extra, "kind", "lang", "confidence", "segments"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cal = models.value
        words = WordTable(m)
        for b in batches:
            for lo in range(0, b.num_rows, BATCH):
                part = b.slice(lo, BATCH)
                texts = part.column(1).to_pylist()
                a = Analysis(texts, words)
                kinds, langs, confs, segs = [], [], [], []
                for d in range(len(texts)):
                    kinds.append(nonprose(a, d)[0])
                    s, k, c = languages(a, d, m, cal)
                    langs.append(None if k is None else m.langs[k])
                    confs.append(c)
                    segs.append([{"seg_no": i + 1, "lang": m.langs[x[0]], "confidence": x[1], "n_sentences": int(x[3])} for i, x in enumerate(s)])
                own = [part.column(2 + i) for i in range(n_extra)]
                yield pa.RecordBatch.from_arrays([part.column(0), *own, pa.array(kinds, pa.string()), pa.array(langs, pa.string()), pa.array(confs, pa.float64()), pa.array(segs, seg)], [id_col, *names])

    schema = f"{id_col} long, " + "".join(f"{c} string, " for c in extra) + "kind string, lang string, confidence double, segments array<struct<seg_no:int,lang:string,confidence:double,n_sentences:int>>"
    rows = df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("__text"), *[c.cast("string").alias(k) for k, c in extra.items()])
    return rows.where(F.col(id_col).isNotNull() & F.col("__text").isNotNull() & F.col("__text").rlike(r"[^\s\p{Z}]")).mapInArrow(run, schema)


def wrong_labels(df: DataFrame, models: Broadcast, languages_: DataFrame, id_col: str = "rec_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """One row (id, seg_no, lang, confidence) for each segment of each prose text whose label names no
    language or another one than the text has, or that has several segments."""
    named = F.coalesce(label_code(F.col(label_col), languages_), F.lit(""))
    rows = analyse(df, models, id_col, text_col, {"label": named})
    wrong = rows.where("kind is null and size(segments) > 0 and (size(segments) > 1 or label <> lang)")
    return wrong.select(id_col, F.explode("segments").alias("s")).select(id_col, F.col("s.seg_no").alias("seg_no"), F.col("s.lang").alias("lang"), F.col("s.confidence").alias("confidence"))
