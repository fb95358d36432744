"""Small lookup tables, task grids and texts made from them."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: model families in the order in which a name is tried.
FAMILIES = ("qwen", "gemma", "llama")


def lookup(df: DataFrame, dim: DataFrame, key: Column, dim_key: str, value: str, out: str, default: Column) -> DataFrame:
    """``df`` with the value of a dimension, or a default where the key is not in it. Spark broadcasts the
    dimension if its size is below the threshold of the session."""
    d = dim.select(F.col(dim_key).alias("__k"), F.col(value).alias("__v"))
    return df.join(d, key == F.col("__k"), "left").withColumn(out, F.coalesce("__v", default)).drop("__k", "__v")


def task_grid(rows: DataFrame, cols: DataFrame, row_index: Column, col_index: Column, n_cols: int) -> DataFrame:
    """All combinations of two small lists with the number of each, row after row."""
    return rows.crossJoin(cols).withColumn("task_id", (row_index * n_cols + col_index).cast("long"))


def model_family(name: Column, families: tuple[str, ...] = FAMILIES) -> Column:
    """The first family whose name is part of the model's, in any letter case; the first of all otherwise."""
    low = F.lower(name)
    out = None
    for f in families:
        out = F.when(F.contains(low, F.lit(f)), f) if out is None else out.when(F.contains(low, F.lit(f)), f)
    return out.otherwise(families[0])


def capitalized(c: Column) -> Column:
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def model_card(df: DataFrame, repo: Column, lang: Column, code: Column, base: Column, license_: Column, notice: Column, datasets: tuple[str, ...], added: Column, before: Column, after: Column) -> DataFrame:
    """``card``: a model card for each row, with head matter, data, method, limits and licence. The sentence on tokens
    by character stands only where both numbers are known and not 0; without ``added`` the number is not given.
    A null in one of the other columns makes the card null."""
    name = capitalized(lang)
    head = F.concat(
        F.lit("---\nlanguage:\n- "), code, F.lit("\nlicense: "), license_, F.lit("\nbase_model: "), base,
        F.lit("\nlibrary_name: transformers\ntags:\n- continued-pretraining\n- vocabulary-expansion\n- "), F.lower(lang),
        F.lit("\n- multilingual\ndatasets:\n" + "".join(f"- {d}\n" for d in datasets) + "pipeline_tag: text-generation\n---\n\n"))
    grown = F.concat(F.lit("# "), F.substring_index(repo, "/", -1), F.lit("\n\n"), base, F.lit(" trained further on texts in "), name, F.lit(", with "), F.coalesce(F.format_number(added, 0), F.lit("several thousand")), F.lit(" tokens of that language added to its vocabulary.\n\n"))
    known = before.isNotNull() & after.isNotNull() & (before != 0) & (after != 0)
    gain = F.when(known, F.concat(F.format_string("Tokens by character: %.3f before the new tokens, %.3f after.", before.cast("double"), after.cast("double")), F.lit("\n\n"))).otherwise(F.lit(""))
    body = F.concat(
        F.lit("## Data\n\nTexts in "), name, F.lit(" from " + ", ".join(datasets) + ", merged; equal and nearly equal texts came in once.\n\n## Method\n\n"),
        F.lit("Pieces of a vocabulary of the corpus that the base tokenizer splits were added to it. Each new embedding began as the mean of the pieces it was split into.\n\n## Use and limits\n\nA base model without instruction tuning for text in "), name,
        F.lit(". It carries the errors and the slant of web text.\n\n## Licence\n\n"), license_, F.lit(", as the base model. "), notice, F.lit("\n"))
    return df.withColumn("card", F.concat(head, grown, gain, body))


def parse_dimension(text: str) -> dict[str, dict[str, str]]:
    """Rows of a small lookup file by name, in lower case: JSON, or lines ``name:`` followed by indented ``key: value``
    ones. Quotes around values, comments and blank lines are left out; a line before any name is an error."""
    if text.lstrip().startswith("{"):
        return {k.lower(): {a: str(b) for a, b in v.items()} for k, v in json.loads(text).items()}
    out: dict[str, dict[str, str]] = {}
    row: dict[str, str] | None = None
    for line in text.splitlines():
        body = re.sub(r"(?:^|\s)#.*$", "", line).rstrip()
        if not body:
            continue
        key, sep, value = body.strip().partition(":")
        value = value.strip().strip("'\"")
        if body[0] not in " \t" and sep and not value:
            row = out.setdefault(key.strip("'\"").lower(), {})
        elif row is None or not sep:
            raise ValueError(f"not a lookup file: {line!r}")
        else:
            row[key.strip()] = value
    return out


def dimension_row(rows: dict[str, dict[str, str]], name: str) -> dict[str, str]:
    """The row of a name, in any letter case; an unknown one is an error that lists the known ones."""
    if name.lower() not in rows:
        raise KeyError(f"no {name}; known: {', '.join(sorted(rows))}")
    return rows[name.lower()]
