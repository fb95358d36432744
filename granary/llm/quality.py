"""Statistics that tell prose from lists, tables and junk."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.analysis import LINE_RULES, MARKER, Analysis, languages, nonprose
from granary.llm.langid import BATCH
from granary.llm.langmodel import WordTable

TERMINAL = re.compile(r"[.!?।॥…][\"'”’»)\]]*\s*$")
SHORT_LINE = 30
# Thresholds of the published rule sets (Gopher for the first nine, FineWeb for the next five); the last
# ones split what the definition of a case says, more than half of all characters, by what the lines are.
RULES = (
    ("few_words", lambda s: s["n_words"] < 50),
    ("many_words", lambda s: s["n_words"] > 100_000),
    ("mean_word_length", lambda s: (s["mean_word_length"] < 3) | (s["mean_word_length"] > 10)),
    ("hash_ratio", lambda s: s["hash_ratio"] > 0.1),
    ("ellipsis_ratio", lambda s: s["ellipsis_ratio"] > 0.1),
    ("bullet_lines", lambda s: s["bullet_lines"] > 0.9),
    ("ellipsis_lines", lambda s: s["ellipsis_lines"] > 0.3),
    ("alphabetic_words", lambda s: s["alphabetic_words"] < 0.8),
    ("common_words", lambda s: s["n_common"] < 2),
    ("line_ends", lambda s: s["terminal_lines"] <= 0.12),
    ("short_lines", lambda s: s["short_lines"] >= 0.67),
    ("duplicate_line_chars", lambda s: s["duplicate_line_chars"] >= 0.01),
    ("newline_ratio", lambda s: s["newline_ratio"] > 0.3),
    ("not_prose", lambda s: s["prose_share"] < 0.5),
)
COUNTS = ("n_chars", "n_lines", "n_words", "n_tokens", "n_common")
FIELDS = (*COUNTS, "mean_word_length", "hash_ratio", "ellipsis_ratio", "punctuation_ratio", "bullet_lines", "ellipsis_lines", "terminal_lines", "short_lines", "alphabetic_words", "common_share", "duplicate_line_chars", "newline_ratio", "prose_share")


def text_quality(df: DataFrame, models: Broadcast, id_col: str = "rec_id", text_col: str = "text") -> DataFrame:
    """Statistics of each text that is not blank, ``reasons``: the rules it fails, ``line_rules``: the share of its
    characters on lines that fail each line rule, and ``kind`` ("list", "table", "junk"; null for prose).

    Counts are taken for all lines of a batch at once. Lines are those that are not blank, tokens what blanks
    separate, words runs of letters. Common words are the most frequent of the text's language (of any language for a
    text in none). ``kind`` follows from the statistics: a text fails "not_prose" where more than half of its
    characters stand on lines that fail a line rule, and is of the kind of the rules that most of these fail. Null, empty
    and blank texts and null ids give no row; repeated rows give repeated rows; ratios of a text without words are 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cal = models.value
        words = WordTable(m)
        for b in batches:
            for lo in range(0, b.num_rows, BATCH):
                part = b.slice(lo, BATCH)
                texts = part.column(1).to_pylist()
                a = Analysis(texts, words)
                n, rows = len(texts), len(a.lines)
                per = lambda x: np.bincount(a.line_doc, weights=x, minlength=n)
                line = lambda f: np.fromiter((f(x) for x in a.lines), float, rows)
                size, blank = line(len), line(lambda x: x.count(" "))
                tokens = [x.split() for x in a.lines]
                n_tokens = per(np.fromiter(map(len, tokens), float, rows))
                alphabetic = per(np.fromiter((sum([w[0].isalpha() or any(map(str.isalpha, w)) for w in t]) for t in tokens), float, rows))
                n_lines, n_words, letters = per(np.ones(rows)), per(a.line_n), per(a.line_letters)
                again, seen = np.zeros(rows), set()
                for i, key in enumerate(zip(a.line_doc.tolist(), map(str.strip, a.lines))):
                    again[i] = key in seen
                    seen.add(key)
                safe = lambda x, y: np.divide(x, y, out=np.zeros(n), where=y > 0)
                kinds, prose, shares, lang = [], [], [], []
                for d in range(n):
                    k, c = nonprose(a, d)
                    kinds.append(k)
                    total = max(1, sum(c.values()))
                    prose.append(c.get("prose", 0) / total)
                    shares.append([(r, c[r] / total) for r in LINE_RULES if r in c])
                    of = languages(a, d, m, cal)[1]
                    lang.append(-1 if of is None else of)
                lang = np.array(lang)
                by_lang = np.stack([per(a.line_common[:, j]) for j in range(len(m.langs))], 1) if len(m.langs) else np.zeros((n, 1))
                common = np.where(lang >= 0, by_lang[np.arange(n), np.maximum(lang, 0)], by_lang.max(1))
                n_chars = np.fromiter(map(len, texts), float, n)
                s = {
                    "n_chars": n_chars, "n_lines": n_lines, "n_words": n_words, "n_tokens": n_tokens, "n_common": common,
                    "mean_word_length": safe(letters, n_words),
                    "hash_ratio": safe(per(line(lambda x: x.count("#"))), n_tokens),
                    "ellipsis_ratio": safe(per(line(lambda x: x.count("…") + x.count("..."))), n_tokens),
                    "punctuation_ratio": safe(per(np.maximum(0, size - blank - a.line_letters)), per(size - blank)),
                    "bullet_lines": safe(per(line(lambda x: bool(MARKER.match(x)))), n_lines),
                    "ellipsis_lines": safe(per(line(lambda x: x.rstrip().endswith(("…", "...")))), n_lines),
                    "terminal_lines": safe(per(line(lambda x: bool(TERMINAL.search(x)))), n_lines),
                    "short_lines": safe(per((size < SHORT_LINE).astype(float)), n_lines),
                    "alphabetic_words": safe(alphabetic, n_tokens), "common_share": safe(common, n_words),
                    "duplicate_line_chars": safe(per(again * size), per(size)),
                    "newline_ratio": safe(np.fromiter((t.count("\n") for t in texts), float, n), n_tokens),
                    "prose_share": np.array(prose),
                }
                failed = [(name, rule(s)) for name, rule in RULES]
                reasons = [[name for name, bad in failed if bad[d]] for d in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(s[f].astype(np.int64) if f in COUNTS else s[f]) for f in FIELDS], pa.array(reasons, pa.list_(pa.string())), pa.array(shares, pa.map_(pa.string(), pa.float64())), pa.array(kinds, pa.string())],
                    [id_col, *FIELDS, "reasons", "line_rules", "kind"],
                )

    schema = f"{id_col} long, " + ", ".join(f"{f} {'long' if f in COUNTS else 'double'}" for f in FIELDS) + ", reasons array<string>, line_rules map<string,double>, kind string"
    rows = df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("__text"))
    return rows.where(F.col(id_col).isNotNull() & F.col("__text").isNotNull() & F.col("__text").rlike(r"[^\s\p{Z}]")).mapInArrow(run, schema)


def not_prose(df: DataFrame, models: Broadcast, id_col: str = "rec_id", text_col: str = "text") -> DataFrame:
    """(id, kind, reasons, line_rules) of the texts that fail the rule "not_prose"; the kind comes with it."""
    rows = text_quality(df, models, id_col, text_col)
    return rows.where(F.array_contains("reasons", "not_prose") & F.col("kind").isNotNull()).select(id_col, "kind", "reasons", "line_rules")
