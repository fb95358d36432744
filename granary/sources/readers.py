"""Readers of the three kinds of corpus, with one schema and an order key.

Every reader gives text, url, timestamp, source (never null) and the order columns ``src_prio``, ``file``, ``block``
and ``row``: first seen means least in that order."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.text import strip
from granary.sources.files import find_files, find_folders

CORPUS = ("text", "url", "timestamp", "source")
# The corpora in the order in which they are read, and the names of their files.
PRIORITY = {"culturax": 0, "hplt": 1, "madlad": 2}
LINE_FILES = ["*.jsonl", "*.jsonl.gz", "*.jsonl.zst"]
PATTERNS = {"culturax": ["*.parquet"], "hplt": LINE_FILES, "madlad": LINE_FILES}
JSON_ROW = "kind string, text string, u string, ts string"


def cached_files(spark: SparkSession, dataset: str, patterns: list[str], homes: list[str]) -> list[str]:
    """Files of all snapshots of a data set below cache folders; its name may be in any letter case."""
    name = dataset.rsplit("/", 1)[-1].lower()
    found: set[str] = set()
    for home in homes:
        for folder in find_folders(spark, home, "datasets--*"):
            if name in folder.rsplit("/", 1)[-1].lower():
                found.update(find_files(spark, folder, patterns))
    return sorted(found)


def is_of_language(path: Column, code: Column) -> Column:
    """A path belongs to a language code that is one of its folders, starts its name or stands in it between underlines."""
    name = F.substring_index(path, "/", -1)
    return F.contains(path, F.concat(F.lit("/"), code, F.lit("/"))) | F.startswith(name, F.concat(code, F.lit("_"))) | F.contains(name, F.concat(F.lit("_"), code, F.lit("_")))


def language_files(files: list[str], code: str, strict: bool = True) -> list[str]:
    """Files of one language. ``strict``: none rather than all where no path names it."""
    def of(f: str) -> bool:
        name = f.rsplit("/", 1)[-1]
        return f"/{code}/" in f or name.startswith(code + "_") or f"_{code}_" in name

    kept = [f for f in files if of(f)]
    return kept if kept or strict else list(files)


def resolve_files(spark: SparkSession, kind: str, code: str, raw: str, override: str | None = None, dataset: str | None = None, homes: list[str] | None = None, by_language: bool = True) -> list[str]:
    """Files of a corpus: the folder named by ``override``, else ``<raw>/<kind>_<code>``, else the cache."""
    patterns = PATTERNS[kind]
    if override:
        files = find_files(spark, override, patterns)
    else:
        files = find_files(spark, f"{raw.rstrip('/')}/{kind}_{code}", patterns)
        if not files and dataset:
            return language_files(cached_files(spark, dataset, patterns, homes or []), code, strict=False)
    return language_files(files, code, strict=False) if by_language else files


def split_files(files: list[str], split: str) -> list[str]:
    """Files whose name holds the split; all of them where none does."""
    return [f for f in files if split in f.rsplit("/", 1)[-1]] or list(files)


def _parse(line: str) -> tuple[str, str | None, str | None, str | None]:
    def no_constant(_: str) -> None:
        raise ValueError

    def plain(v: object) -> str:
        return "" if not v else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) if isinstance(v, (dict, list, bool)) else str(v)

    try:
        v = json.loads(line, parse_constant=no_constant)
    except (ValueError, RecursionError):
        return "bad", None, None, None
    if not isinstance(v, dict):
        # The text form of the language the corpus tools are written in: None, True, [1, 2].
        return "other", str(v), None, None
    return "object", plain(v.get("text")), plain(v.get("u")), plain(v.get("ts"))


def parse_json(line: Column) -> Column:
    """Strict JSON of a line: kind ("object", "other", "bad") and the strings text, u and ts. What is missing, null,
    zero, false or empty is the empty string; another value than an object has its text form as text; a null line is bad.

    An object whose three fields are strings, null or missing never leaves the JVM. Its parser ignores what
    follows a value, so the line is parsed inside brackets and inside an object: what ends one early breaks the
    other. All other lines go to Python in Arrow batches, for its rules on numbers, nested values and repeated keys."""
    row = T._parse_datatype_string(JSON_ROW)

    @F.pandas_udf(row)
    def slow(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_parse(x) if x is not None else (None,) * 4 for x in s], columns=["kind", "text", "u", "ts"])

    listed = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    boxed = F.try_parse_json(F.concat(F.lit('{"v":'), line, F.lit("}")))
    one = boxed.isNotNull() & F.startswith(F.schema_of_variant(listed), F.lit("ARRAY<OBJECT<")) & F.try_variant_get(listed, "$[1]", "variant").isNull()
    fields = {}
    for k in ("text", "u", "ts"):
        part = F.try_variant_get(listed, f"$[0].{k}", "variant")
        one = one & F.coalesce(F.schema_of_variant(part), F.lit("VOID")).isin("STRING", "VOID")
        fields[k] = F.coalesce(F.try_variant_get(listed, f"$[0].{k}", "string"), F.lit(""))
    fast = F.coalesce(one, F.lit(False))
    own = F.struct(F.lit("object").alias("kind"), *[v.alias(k) for k, v in fields.items()])
    rest = slow(F.when(~fast, line))
    bad = F.struct(F.lit("bad").alias("kind"), *[F.lit(None).cast("string").alias(k) for k in fields])
    return F.when(line.isNull(), bad).when(fast, own).otherwise(rest)


def json_lines(df: DataFrame, line_col: str = "line") -> DataFrame:
    """Rows whose line is not blank, with the line stripped."""
    return df.withColumn(line_col, strip(F.col(line_col))).where(F.col(line_col) != "")


def drop_bad(df: DataFrame, line_col: str = "line") -> DataFrame:
    """JSON objects as corpus rows; malformed lines and other JSON values are left out. Other columns are kept."""
    keep = [c for c in df.columns if c not in (*CORPUS, line_col)]
    parsed = json_lines(df, line_col).withColumn("__j", parse_json(F.col(line_col))).where("__j.kind = 'object'")
    return parsed.select(*keep, F.col("__j.text").alias("text"), F.col("__j.u").alias("url"), F.col("__j.ts").alias("timestamp"), F.lit("hplt3.0").alias("source"))


def keep_raw(df: DataFrame, line_col: str = "line", split: str = "clean") -> DataFrame:
    """The text of JSON objects, other JSON values as text, and malformed lines as they are. Other columns are kept."""
    keep = [c for c in df.columns if c not in (*CORPUS, line_col)]
    parsed = json_lines(df, line_col).withColumn("__j", parse_json(F.col(line_col)))
    text = F.when(F.col("__j.kind") == "bad", F.col(line_col)).otherwise(F.col("__j.text"))
    return parsed.select(*keep, text.alias("text"), F.lit("").alias("url"), F.lit("").alias("timestamp"), F.lit(f"madlad400:{split}").alias("source"))


def corpus_columns(df: DataFrame, prefix: str = "culturax:") -> DataFrame:
    """The four corpus columns of a table that may lack some; missing and null values are empty. Other columns are kept."""
    have = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("") for c in CORPUS}
    have["source"] = F.concat(F.lit(prefix), have["source"])
    return df.select(*[c for c in df.columns if c not in CORPUS], *[have[c].alias(c) for c in CORPUS])


def _ordered(df: DataFrame, kind: str, block: Column, row: Column) -> DataFrame:
    return df.withColumns({"src_prio": F.lit(PRIORITY[kind]), "file": F.col("_metadata.file_path"), "block": block, "row": row})


def read_culturax(spark: SparkSession, files: list[str]) -> DataFrame:
    df = spark.read.option("mergeSchema", "true").parquet(*files)
    return corpus_columns(_ordered(df, "culturax", F.lit(0).cast("long"), F.col("_metadata.row_index")))


def _lines(spark: SparkSession, files: list[str], kind: str) -> DataFrame:
    """Lines with their order: increasing ids order the lines of one block of a file, and blocks have their start."""
    df = _ordered(spark.read.text(files), kind, F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return df.withColumnRenamed("value", "line")


def read_hplt(spark: SparkSession, files: list[str]) -> DataFrame:
    return drop_bad(_lines(spark, files, "hplt"))


def read_madlad(spark: SparkSession, files: list[str], split: str = "clean") -> DataFrame:
    return keep_raw(_lines(spark, files, "madlad"), split=split)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """(piece_rank, piece) of a vocabulary file: the part of each line before the first tab."""
    df = spark.read.option("wholetext", "true").text(path).select(F.posexplode(F.split("value", "\n")).alias("piece_rank", "v"))
    return df.select("piece_rank", F.split_part("v", F.lit("\t"), F.lit(1)).alias("piece"))
