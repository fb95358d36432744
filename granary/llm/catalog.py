"""Queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import garbled, langid, mixing, packing, quality, sql, token_budget
from granary.llm import near_duplicates as near
from granary.llm import repeated_lines as rep
from granary.session import read_table


def _models(spark: SparkSession, sf: str):
    return langid.fit(read_table(spark, sf, "lang_samples"))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    df, langs = read_table(spark, sf, "data_pipeline"), read_table(spark, sf, "languages")
    return langid.wrong_labels(df, _models(spark, sf), langs).select("rec_id", F.col("seg_no"), "lang")


def p1_languages(spark: SparkSession, sf: str) -> DataFrame:
    return langid.analyse(read_table(spark, sf, "data_pipeline"), _models(spark, sf))


def p2_budget(spark: SparkSession, sf: str) -> DataFrame:
    return token_budget.budget(read_table(spark, sf, "data_pipeline"), _models(spark, sf))


def p2_errors(spark: SparkSession, sf: str) -> DataFrame:
    return token_budget.errors(read_table(spark, sf, "data_pipeline"), _models(spark, sf))


def p2_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records of the budget by source and domain, without their languages and tokens."""
    return p2_budget(spark, sf).groupBy("source", "domain").agg(F.sum("n_records").alias("n_records"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return quality.not_prose(read_table(spark, sf, "data_pipeline"), _models(spark, sf)).select("rec_id", "kind")


def p3_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """The cases with the published rules and the line rules they fail."""
    return quality.not_prose(read_table(spark, sf, "data_pipeline"), _models(spark, sf))


def p3_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return quality.text_quality(read_table(spark, sf, "data_pipeline"), _models(spark, sf))


def p3_figures(spark: SparkSession, sf: str) -> DataFrame:
    """The statistics that SQL can follow."""
    s = p3_statistics(spark, sf)
    return s.select("rec_id", "n_chars", "n_lines", "n_tokens", *[F.round(c, 9).alias(c) for c in ("hash_ratio", "ellipsis_ratio", "ellipsis_lines", "terminal_lines", "short_lines", "bullet_lines", "newline_ratio")])


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return rep.repeated_places(read_table(spark, sf, "data_pipeline"))


def p4_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    df = read_table(spark, sf, "data_pipeline")
    return rep.remove_lines(df, rep.repeated_places(df)).select("rec_id", "text", "removed_lines")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return near.near_duplicates(read_table(spark, sf, "data_pipeline")).pairs()


def p5_groups(spark: SparkSession, sf: str) -> DataFrame:
    return near.groups(near.near_duplicates(read_table(spark, sf, "data_pipeline"))).withColumnRenamed("id", "rec_id")


def p6_packed(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf, "documents"), read_table(spark, sf, "pack_sizes"))


def p6_report(spark: SparkSession, sf: str) -> DataFrame:
    return packing.report(p6_packed(spark, sf))


def p6_words(spark: SparkSession, sf: str) -> DataFrame:
    """Packing by words, which SQL can count, and whether every word has its place and no sequence is overfull."""
    sized = _word_sizes(spark, sf).select(F.col("id").alias("doc_id"), F.col("n").alias("n_tokens"))
    return packing.checked(packing.pack(sized, read_table(spark, sf, "pack_sizes")))


def p7_mix(spark: SparkSession, sf: str) -> DataFrame:
    sized = mixing.sized_sources(read_table(spark, sf, "documents"))
    return mixing.mix(sized, read_table(spark, sf, "mix_targets")).withColumnRenamed("id", "doc_id")


def p7_shares(spark: SparkSession, sf: str) -> DataFrame:
    sized, targets = mixing.sized_sources(read_table(spark, sf, "documents")), read_table(spark, sf, "mix_targets")
    return mixing.shares(mixing.mix(sized, targets), sized, targets)


def p7_shares_filled(spark: SparkSession, sf: str) -> DataFrame:
    """The shares where what a source cannot reach goes to the others."""
    sized, targets = mixing.sized_sources(read_table(spark, sf, "documents")), read_table(spark, sf, "mix_targets")
    return mixing.shares(mixing.mix(sized, targets, fill=True), sized, targets, fill=True)


def _word_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes in words, which SQL can count."""
    return mixing.sized_sources(read_table(spark, sf, "documents"), size=F.size(F.split(F.trim(F.regexp_replace("text", r"[ \t\n\r]+", " ")), " ")))


def p7_mix_words(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_word_sizes(spark, sf), read_table(spark, sf, "mix_targets"), key=mixing.md5_key(F.col("id"))).withColumnRenamed("id", "doc_id")


def p7_shares_words(spark: SparkSession, sf: str) -> DataFrame:
    sized, targets = _word_sizes(spark, sf), read_table(spark, sf, "mix_targets")
    out = mixing.shares(mixing.mix(sized, targets, key=mixing.md5_key(F.col("id"))), sized, targets)
    return out.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    found = garbled.find_garbled(read_table(spark, sf, "documents"), garbled.fit(read_table(spark, sf, "lang_samples")))
    return found.documents().withColumnRenamed("id", "doc_id")


def p8_restored(spark: SparkSession, sf: str) -> DataFrame:
    df, model = read_table(spark, sf, "documents"), garbled.fit(read_table(spark, sf, "lang_samples"))
    return garbled.restore(df, garbled.find_garbled(df, model), model)


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_languages, p2_budget, p2_errors, p2_records, p3_found, p3_reasons, p3_statistics, p3_figures, p4_found, p4_cleaned, p5_found, p5_groups, p6_packed, p6_report, p6_words, p7_mix, p7_shares, p7_shares_filled, p7_mix_words, p7_shares_words, p8_found, p8_restored)}


def oracle_sql() -> dict[str, str]:
    from granary.plans.catalog import normal_sql, white_space

    normal = normal_sql("(SELECT rec_id AS doc_id, text FROM data_pipeline WHERE text IS NOT NULL)")
    return {
        "p4_found": sql.P4_FOUND, "p4_cleaned": sql.P4_CLEANED, "p5_found": sql.p5_found(normal), "p5_groups": sql.p5_groups(normal),
        "p2_records": sql.P2_RECORDS, "p3_figures": sql.p3_figures(white_space()), "p6_words": sql.P6_WORDS, "p7_mix_words": sql.P7_MIX, "p7_shares_words": sql.P7_SHARES,
    }
