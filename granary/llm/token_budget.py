"""Tokens of texts estimated by regression, summed by source, language and domain."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions import tokenizers as tok
from granary.functions.text import site
from granary.llm.analysis import Analysis, languages
from granary.llm.langid import BATCH
from granary.llm.langmodel import WordTable
from granary.session import materialize

# Texts of each language that are tokenized, and the share of them whose bias corrects the estimates.
SAMPLE = 900
HOLDOUT_SHARE = 1 / 3
PRIOR = 0.02
PRIOR_ROWS = 10.0
RIDGE = 1e-3
FEATURES = ("odd_words", "odd_letters", "runs", "capitals", "bytes", "words", "blanks", "digits", "punctuation", "latin", "extended_latin", "marks", "letters_2", "letters_3", "other", "one")


def _classes() -> np.ndarray:
    """Class of each character of the basic plane: index into the features from blanks to other."""
    out = np.full(65536, 8, np.uint8)
    for c in range(65536):
        k = unicodedata.category(chr(c))
        if k[0] == "Z" or k == "Cc":
            out[c] = 0
        elif k[0] == "N":
            out[c] = 1
        elif k[0] in "PS":
            out[c] = 2
        elif k[0] == "M":
            out[c] = 5
        elif k[0] == "L":
            out[c] = 3 if c < 128 else 4 if c < 0x250 else 6 if c < 0x800 else 7
    return out


_table: list[np.ndarray] = []
# Blank, digit, sign or mark, letter.
_GROUPS = np.array([0, 1, 2, 3, 3, 2, 3, 3, 2])


def features(texts: list[str]) -> np.ndarray:
    """One row for each text, a column for each of FEATURES but the first two. Runs are stretches of letters, of digits,
    or of what is neither nor blank: public tokenizers do not go beyond them."""
    if not _table:
        _table.append(_classes())
    raw = [t.encode("utf-32-le", "surrogatepass") for t in texts]
    points = np.frombuffer(b"".join(raw), np.uint32)
    kinds = np.where(points < 65536, _table[0][np.minimum(points, 65535)], 8)
    doc = np.repeat(np.arange(len(texts)), np.fromiter((len(r) // 4 for r in raw), np.int64, len(raw)))
    counts = np.bincount(doc * 9 + kinds, minlength=9 * len(texts)).reshape(-1, 9).astype(float)
    group = _GROUPS[kinds]
    new = np.ones(len(points), bool)
    new[1:] = (group[1:] != group[:-1]) | (doc[1:] != doc[:-1])
    runs = np.bincount(doc, weights=new & (group > 0), minlength=len(texts))
    capitals = np.bincount(doc, weights=(points >= 65) & (points <= 90), minlength=len(texts))
    width = np.bincount(doc, weights=1.0 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000), minlength=len(texts))
    words = np.fromiter((len(t.split()) for t in texts), float, len(texts))
    return np.column_stack([runs, capitals, width, words, counts, np.ones(len(texts))])


def odd_words(a: Analysis, words: WordTable) -> np.ndarray:
    """Words that no sample of any language holds, and their letters, by text: the first two of FEATURES."""
    odd = words.known[a.ids].max(1, initial=0) == 0
    doc = a.line_doc[np.repeat(a.sent_line, a.sent_n)]
    n = len(a.texts)
    return np.column_stack([np.bincount(doc, weights=odd, minlength=n), np.bincount(doc, weights=odd * (words.size[a.ids] - 1), minlength=n)])


class TokenModel:
    """Weights for all texts together, and for each language what differs from them, by ridge regression; each with
    the factor that corrects the bias found on its holdout. Difference and factor are drawn towards those of all by as
    much as PRIOR_ROWS texts would, so a language with few texts is close to the common weights."""

    def __init__(self, x: np.ndarray, y: np.ndarray, lang: list[str | None], held: np.ndarray):
        # Rows are scaled by the root of their size, as errors grow with it.
        s = 1 / np.sqrt(np.maximum(1, x[:, FEATURES.index("bytes")]))
        a, target = x * s[:, None], y * s
        scale = np.maximum(1e-9, np.sqrt((a[~held] ** 2).mean(0))) if (~held).any() else np.ones(len(FEATURES))
        a = a / scale
        of = np.array([k or "" for k in lang])

        def solve(rows: np.ndarray, base: np.ndarray, strength: float) -> np.ndarray:
            b = a[rows]
            return base + np.linalg.solve(b.T @ b + strength * np.eye(b.shape[1]), b.T @ (target[rows] - b @ base))

        common = solve(~held, np.zeros(len(FEATURES)), RIDGE * max(1, (~held).sum()))
        self.weights: dict[str | None, np.ndarray] = {}
        whole = 1.0
        for k in [None, *sorted(set(of) - {""})]:
            mine = np.ones(len(y), bool) if k is None else of == k
            w = common if k is None else solve(mine & ~held, common, PRIOR)
            test = mine & held
            guess = np.maximum(0, x[test] @ (w / scale))
            extra = PRIOR_ROWS * guess.mean() if len(guess) else 0.0
            factor = (y[test].sum() + whole * extra) / (guess.sum() + extra) if guess.sum() > 0 else whole
            if k is None:
                whole = factor
            self.weights[k] = w / scale * factor

    def estimate(self, x: np.ndarray, lang: list[str | None]) -> np.ndarray:
        w = np.array([self.weights.get(k, self.weights[None]) if k is not None else self.weights[None] for k in lang]).reshape(len(x), len(FEATURES))
        return np.maximum(0, (x * w).sum(1)) if len(x) else np.zeros(0)


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & (F.length(text_col) > 0))


def _languages(a: Analysis, models: tuple) -> list[str | None]:
    m, limits = models
    found = [languages(a, d, m, limits)[1] for d in range(len(a.texts))]
    return [None if k is None else m.langs[k] for k in found]


def measured(df: DataFrame, models: Broadcast, id_col: str = "rec_id", text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """id, the string columns ``keep``, lang (null without a language) and x, the features, of each text, as a table: the
    one pass over all texts that both the fit and the estimates need. Null and empty texts and null ids give no row."""
    keep = keep or {}
    own = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTable(models.value[0])
        for b in batches:
            for lo in range(0, b.num_rows, BATCH):
                part = b.slice(lo, BATCH)
                texts = part.column(1).to_pylist()
                a = Analysis(texts, words)
                x = np.column_stack([odd_words(a, words), features(texts)]).astype(np.float32)
                x = pa.ListArray.from_arrays(np.arange(len(texts) + 1, dtype=np.int32) * len(FEATURES), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), *[part.column(2 + i) for i in range(len(own))], pa.array(_languages(a, models.value), pa.string()), x], [id_col, *own, "lang", "x"])

    schema = f"{id_col} long, " + "".join(f"{c} string, " for c in keep) + "lang string, x array<float>"
    rows = _texts(df, id_col, text_col).select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("__text"), *[c.cast("string").alias(k) for k, c in keep.items()])
    return materialize(rows.mapInArrow(run, schema), "features")


def _matrix(b: pa.RecordBatch, i: int) -> np.ndarray:
    return b.column(i).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, len(FEATURES))


def fit(df: DataFrame, table: DataFrame, id_col: str = "rec_id", text_col: str = "text", sample: int = SAMPLE, name: str = tok.DEFAULT_NAME, folder: str = tok.DEFAULT_DIR) -> Broadcast:
    """Fit on the texts of at most ``sample`` records of each language of ``table``, chosen by the hash of their id, so
    that rare languages are as well known as common ones; a third of them is the holdout. Each task sends no more than
    that many for a language, and only their numbers come to the driver."""
    shuffled = F.xxhash64(F.col(id_col), F.lit(17))
    ranked = table.select(F.col(id_col).alias("__id"), "lang", "x", F.row_number().over(Window.partitionBy("lang").orderBy(shuffled, id_col)).alias("__k"))
    held = (F.pmod(F.xxhash64(F.col("__id"), F.lit(29)), F.lit(1_000_000)) < int(HOLDOUT_SHARE * 1_000_000)).alias("held")
    chosen = materialize(ranked.where(F.col("__k") <= sample).select("__id", "lang", "x", held), "sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk = tok.tokenizer(name, folder)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([tk.count(t) for t in b.column(0).to_pylist()], pa.int64()), *b.columns[1:]], ["y", "lang", "held", "x"])

    # At most ``sample`` rows for each language of the models.
    texts = _texts(df, id_col, text_col).select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(chosen), "__id")
    rows = texts.select("__text", "lang", "held", "x").mapInArrow(run, "y long, lang string, held boolean, x array<float>").collect()
    x = np.array([r.x for r in rows], float).reshape(-1, len(FEATURES))
    model = TokenModel(x, np.array([r.y for r in rows], float), [r.lang for r in rows], np.array([r.held for r in rows], bool))
    return df.sparkSession.sparkContext.broadcast(model)


def estimates(table: DataFrame, token_model: Broadcast) -> DataFrame:
    """The columns of ``table`` but the features, and est_tokens."""
    names = [c for c in table.columns if c != "x"]
    at = names.index("lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            est = token_model.value.estimate(_matrix(b, b.num_columns - 1), b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(est)], [*names, "est_tokens"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.select(*names).schema)
    return table.select(*names, "x").mapInArrow(run, fields + ", est_tokens double")


def budget(df: DataFrame, models: Broadcast, id_col: str = "rec_id", text_col: str = "text", url_col: str = "url", source_col: str = "source") -> DataFrame:
    """source, lang, domain, n_records, est_tokens. The domain is the host of the url; records without one
    have the empty domain, records without a language "und"; a null source stays null."""
    table = measured(df, models, id_col, text_col, {"source": F.col(source_col), "domain": site(F.col(url_col), F.lit(""))})
    e = estimates(table, fit(df, table, id_col, text_col))
    return e.groupBy("source", F.coalesce("lang", F.lit("und")).alias("lang"), "domain").agg(F.count("*").alias("n_records"), F.round(F.sum("est_tokens")).cast("long").alias("est_tokens"))


def errors(df: DataFrame, models: Broadcast, id_col: str = "rec_id", text_col: str = "text", name: str = tok.DEFAULT_NAME, folder: str = tok.DEFAULT_DIR) -> DataFrame:
    """By language: records, true and estimated tokens, and the mean absolute error by true tokens, over all records."""
    table = measured(df, models, id_col, text_col)
    e = estimates(table, fit(df, table, id_col, text_col, name=name, folder=folder)).withColumnRenamed(id_col, "__id")
    true = _texts(df, id_col, text_col).select(F.col(id_col).cast("long").alias("__id"), tok.token_count(F.col(text_col), name, folder).alias("n_tokens"))
    e = e.join(true, "__id")
    return e.groupBy(F.coalesce("lang", F.lit("und")).alias("lang")).agg(
        F.count("*").alias("n_records"), F.sum("n_tokens").alias("n_tokens"), F.round(F.sum("est_tokens")).cast("long").alias("est_tokens"),
        F.try_divide(F.sum(F.abs(F.col("n_tokens") - F.col("est_tokens"))), F.sum("n_tokens")).alias("error"))
