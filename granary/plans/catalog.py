"""Queries of the core and the SQL each is checked with."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import tokenizers as tok
from granary.functions.text import WS, last_url_segment, normalize_text, shingles, site, text_hash, words
from granary.operators import corpus, dedup, dimensions, embeddings, sequences, vocab
from granary.plans import expand
from granary.sources import readers
from granary.sources.readers import corpus_columns
from granary.session import read_table

ID = "doc_id"
MAX_BYTES = 500_000
SHARD_DOCS = 250
SEQ_LEN = 512
RANKS = 3
_queries: dict = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _queries[f.__name__] = f
        if sql is not None:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    out = {}
    for k, v in _sql.items():
        v = v.replace("{PAIRS}", _PAIRS).replace("{WALK}", _WALK).replace("{SETS}", _FIRST_P + ", " + _RUNS.replace("{src}", "f"))
        if "{MINHASH}" in v:
            v = v.replace("{MINHASH}", _minhash_sql()).replace("{BANDS}", _bands_sql())
        if "{N}" in v:
            v = v.replace("{N}", _normal("documents"))
        if "{P}" in v:
            v = v.replace("{P}", _normal("(SELECT rec_id AS doc_id, text FROM data_pipeline WHERE text IS NOT NULL)"))
        out[k] = v.replace("{WS}", _ws())
    return out


def _ws() -> str:
    """The white space class in the notation of the other engine."""
    import re

    return re.sub(r"\\u([0-9a-f]{4})", r"\\x{\1}", re.sub(r"\\x([0-9a-f]{2})", r"\\x{\1}", WS))


def white_space() -> str:
    """``_ws`` for other catalogs."""
    return _ws()


@functools.lru_cache(maxsize=2)
def _normal(source: str) -> str:
    """SQL of a table n(doc_id, n) of normalised texts. That engine lacks NFKC, so characters are replaced by
    their compatibility form, listed by rule, before canonical composition."""
    forms = []
    for c in range(0x80, 0x10000):
        ch = chr(c)
        if 0xD800 <= c <= 0xDFFF:
            continue
        k = unicodedata.normalize("NFKC", ch)
        if k != unicodedata.normalize("NFC", ch):
            forms.append(f"({c},'{k.replace(chr(39), chr(39) * 2)}')")
    table = f"(VALUES {','.join(forms)}) f(c, r)"
    return f"""plain AS (SELECT doc_id, text AS x FROM {source} WHERE NOT regexp_matches(text, '[^\\x00-\\x7f]')),
    ch AS (SELECT doc_id, unnest(string_split(text, '')) AS ch, unnest(range(len(string_split(text, '')))) AS i FROM {source} WHERE regexp_matches(text, '[^\\x00-\\x7f]')),
    form AS (SELECT chr(c) AS c, r FROM {table}),
    folded AS (SELECT doc_id, nfc_normalize(string_agg(coalesce(r, ch), '' ORDER BY i)) AS x FROM ch LEFT JOIN form ON ch = c GROUP BY doc_id),
    n AS (SELECT doc_id, trim(regexp_replace(x, '{_ws()}+', ' ', 'g'), ' ') AS n FROM (SELECT * FROM plain UNION ALL SELECT * FROM folded))"""


def normal_sql(source: str) -> str:
    """``_normal`` with the white space class filled in, for other catalogs."""
    return _normal(source).replace("{WS}", _ws())


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents")


def _n_words() -> Column:
    return F.size(words(normalize_text(F.col("text"))))


# Text functions.


@query("WITH {N} SELECT doc_id, n AS norm FROM n")
def normalize_text_q(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select(ID, normalize_text(F.col("text")).alias("norm"))


@query("WITH {N} SELECT doc_id, sha1(n) AS h FROM n")
def text_hash_q(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select(ID, text_hash(F.col("text")).alias("h"))


@query("WITH {N} SELECT doc_id, CASE WHEN n = '' THEN 0 ELSE len(string_split(n, ' ')) END AS n_words FROM n")
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select(ID, _n_words().cast("long").alias("n_words"))


_RUNS = """w AS (SELECT doc_id, unnest(string_split(n, ' ')) AS w, unnest(range(len(string_split(n, ' ')))) AS i, len(string_split(n, ' ')) AS k FROM {src} WHERE n <> ''),
r AS (SELECT doc_id, i, k, w || ' ' || lead(w, 1) OVER d || ' ' || lead(w, 2) OVER d || ' ' || lead(w, 3) OVER d || ' ' || lead(w, 4) OVER d AS s FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
s AS MATERIALIZED (SELECT DISTINCT doc_id, s FROM r WHERE s IS NOT NULL UNION ALL SELECT doc_id, n AS s FROM {src} WHERE n <> '' AND len(string_split(n, ' ')) < 5)"""


@query("WITH {N}, " + _RUNS.replace("{src}", "n") + " SELECT doc_id, coalesce(c, 0) AS n_shingles FROM documents LEFT JOIN (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id) USING (doc_id)")
def shingle_count(spark: SparkSession, sf: str) -> DataFrame:
    n = _docs(spark, sf).select(ID, normalize_text(F.col("text")).alias("norm"))
    return n.select(ID, F.size(shingles(F.col("norm"))).cast("long").alias("n_shingles"))


@query("SELECT doc_id, length(text) AS n, n_chars = length(text) AS same FROM documents")
def char_len(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select(ID, F.length("text").cast("long").alias("n"), (F.col("n_chars") == F.length("text")).alias("same"))


@query("SELECT doc_id, strlen(text) AS n_bytes FROM documents")
def byte_len(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select(ID, F.octet_length("text").cast("long").alias("n_bytes"))


@query("SELECT doc_id, list_last(string_split(regexp_replace(url, '[?#].*$', ''), '/')) AS segment FROM documents WHERE url IS NOT NULL")
def basename_q(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).where("url is not null").select(ID, last_url_segment(F.col("url")).alias("segment"))


@query("""SELECT rec_id, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(regexp_extract(
regexp_replace(regexp_replace(lower(url), '^\\s+', ''), '^(?:[a-z][a-z0-9+.-]*:)?//', ''), '^[^/?#\\\\\\s]*'), '^.*@', ''), ':[0-9]*$', ''), '^(www|m)\\.', ''), ''), source) AS site FROM data_pipeline""")
def site_of(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "data_pipeline").select("rec_id", site(F.col("url"), F.col("source")).alias("site"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint").getField("k").alias("k"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t FROM events")
def ts_to_string(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"))


@query()
def token_count_q(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select(ID, tok.token_count(F.col("text")).alias("n_tokens"))


# Sources.


@query("""SELECT line_id, language FROM hplt_lines l JOIN languages g ON contains(path, '/' || hplt || '/')
OR starts_with(list_last(string_split(path, '/')), hplt || '_') OR contains(list_last(string_split(path, '/')), '_' || hplt || '_')""")
def lang_path_filter(spark: SparkSession, sf: str) -> DataFrame:
    g = read_table(spark, sf, "languages")
    code = F.coalesce(*[F.when(readers.is_of_language(F.col("path"), F.lit(r.hplt)), F.lit(r.language)) for r in g.collect()])
    return read_table(spark, sf, "hplt_lines").select("line_id", code.alias("language")).where("language is not null")


@query("SELECT line_id, regexp_replace(line, '^{WS}+|{WS}+$', '', 'g') AS line FROM hplt_lines WHERE regexp_replace(line, '^{WS}+|{WS}+$', '', 'g') <> ''")
def jsonl_lines(spark: SparkSession, sf: str) -> DataFrame:
    return readers.json_lines(read_table(spark, sf, "hplt_lines")).select("line_id", "line")


_JSON = """l AS (SELECT line_id, regexp_replace(line, '^{WS}+|{WS}+$', '', 'g') AS s FROM hplt_lines),
j AS (SELECT line_id, s, json_valid(s) AS ok, CASE WHEN json_valid(s) THEN json_type(s::JSON) END AS kind FROM l WHERE s <> '')"""


@query(f"""WITH {_JSON} SELECT line_id, coalesce(json_extract_string(s, '$.text'), '') AS text, coalesce(json_extract_string(s, '$.u'), '') AS url,
coalesce(json_extract_string(s, '$.ts'), '') AS timestamp, 'hplt3.0' AS source FROM j WHERE ok AND kind = 'OBJECT'""")
def scan_jsonl_drop_bad(spark: SparkSession, sf: str) -> DataFrame:
    return readers.drop_bad(read_table(spark, sf, "hplt_lines").drop("path"))


@query(f"""WITH {_JSON} SELECT line_id, CASE WHEN NOT ok THEN s WHEN kind = 'OBJECT' THEN coalesce(json_extract_string(s, '$.text'), '')
WHEN kind = 'NULL' THEN 'None' WHEN kind = 'BOOLEAN' THEN CASE WHEN s = 'true' THEN 'True' ELSE 'False' END ELSE s::JSON->>'$' END AS text, '' AS url, '' AS timestamp, 'madlad400:clean' AS source FROM j""")
def scan_jsonl_keep_raw(spark: SparkSession, sf: str) -> DataFrame:
    return readers.keep_raw(read_table(spark, sf, "hplt_lines").drop("path"))


@query("SELECT doc_id, coalesce(text, '') AS text, coalesce(url, '') AS url, coalesce(timestamp, '') AS timestamp, 'culturax:' || coalesce(source, '') AS source FROM documents")
def scan_parquet_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_columns(_docs(spark, sf)).select(ID, *readers.CORPUS)


@query("SELECT rec_id, text FROM data_pipeline WHERE text <> ''")
def scan_text_nonempty(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "data_pipeline").where("text <> ''").select("rec_id", "text")


@query("SELECT rec_id, text FROM data_pipeline WHERE text <> '' ORDER BY rec_id LIMIT 200")
def head_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The limit is what this operator is for."""
    return read_table(spark, sf, "data_pipeline").where("text <> ''").orderBy("rec_id").limit(200).select("rec_id", "text")


@query("SELECT doc_id, 'culturax:' || source AS label FROM documents")
def source_label(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select(ID, F.concat(F.lit("culturax:"), "source").alias("label"))


def _virtual(spark: SparkSession, sf: str) -> DataFrame:
    """Three corpora cut from one table by id, merged in order."""
    d = _docs(spark, sf)
    return corpus.merge([corpus_columns(d.where(F.col(ID) % 3 == i).withColumn("source", F.lit(str(i))), "corpus") for i in range(3)])


@query("SELECT doc_id, CAST(doc_id % 3 AS INTEGER) AS src_prio, 'corpus' || (doc_id % 3) AS source, length(text) AS n FROM documents")
def merge_sources(spark: SparkSession, sf: str) -> DataFrame:
    return _virtual(spark, sf).select(ID, "src_prio", "source", F.length("text").cast("long").alias("n"))


@query("""WITH {N}, g AS (SELECT doc_id, n, doc_id % 3 AS p FROM n JOIN documents USING (doc_id) WHERE length(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g')) >= 200),
k AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY p, doc_id) AS r FROM g)
SELECT 'corpus' || p AS source, n_in, kept FROM (SELECT doc_id % 3 AS p, count(*) AS n_in FROM documents GROUP BY 1)
JOIN (SELECT p, count(*) FILTER (r = 1) AS kept FROM k GROUP BY p) USING (p)""")
def source_stats(spark: SparkSession, sf: str) -> DataFrame:
    """First seen means first by corpus, then by id."""
    m = _virtual(spark, sf)
    g = dedup.min_chars_gate(m).select(ID, "src_prio", "source", text_hash(F.col("text")).alias("h"))
    return corpus.source_stats(m, dedup.first_by_key(g, "h", F.struct("src_prio", ID)))


# Gate, duplicates.


@query("SELECT doc_id FROM documents WHERE length(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g')) >= 200")
def min_chars_gate(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.min_chars_gate(_docs(spark, sf)).select(ID)


_FIRST = """{N}, g AS (SELECT doc_id, n FROM n JOIN documents USING (doc_id) WHERE length(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g')) >= 200),
f AS (SELECT n, min(doc_id) AS doc_id FROM g GROUP BY n)"""


@query(f"WITH {_FIRST} SELECT doc_id FROM f")
def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.exact_first(dedup.min_chars_gate(_docs(spark, sf)), ID).select(ID)


_FIRST_P = """{P}, g AS (SELECT doc_id, n FROM n JOIN data_pipeline ON doc_id = rec_id WHERE length(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g')) >= 200),
f AS (SELECT n, min(doc_id) AS doc_id FROM g GROUP BY n)"""
_PAIRS = _FIRST_P + ", " + _RUNS.replace("{src}", "f") + """,
c AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
p AS MATERIALIZED (SELECT a, b, o / (ca.c + cb.c - o) AS j FROM o JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b WHERE 5 * o >= 4 * (ca.c + cb.c - o))"""


def _survivors(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.exact_first(dedup.min_chars_gate(read_table(spark, sf, "data_pipeline")), "rec_id")


@query(f"WITH {_PAIRS} SELECT a, b, round(j, 6) AS jaccard FROM p")
def jaccard_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.jaccard_pairs(_survivors(spark, sf), "rec_id").select("a", "b", F.round("jaccard", 6).alias("jaccard"))


@query("WITH RECURSIVE {PAIRS}, {WALK}")
def near_dedup_verified(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.near_dedup_verified(_survivors(spark, sf), "rec_id").select("rec_id")


# MinHash over the first 60 bits of the MD5 of each run, in arithmetic modulo 2**64 that SQL has, too.


def _minhash_sql() -> str:
    mul, add = dedup.lane_constants()
    lanes = ",".join(f"({i},{int(m)}::HUGEINT,{int(c)}::HUGEINT)" for i, (m, c) in enumerate(zip(mul, add)))
    return f"""x AS MATERIALIZED (SELECT doc_id, ('0x' || left(md5(s), 15))::BIGINT::HUGEINT AS h FROM s),
k(lane, m, c) AS (VALUES {lanes}),
lanes AS MATERIALIZED (SELECT doc_id, lane, CAST(min((h * m + c) % 18446744073709551616) // 4294967296 AS BIGINT) AS v FROM x CROSS JOIN k GROUP BY doc_id, lane)"""


def _bands_sql() -> str:
    b, r = dedup.lsh_layout(0.8)
    return f"""b AS MATERIALIZED (SELECT doc_id, CAST(lane // {r} AS INTEGER) AS band, string_agg(v::VARCHAR, ',' ORDER BY lane) AS bucket FROM lanes WHERE lane < {b * r} GROUP BY ALL),
m AS MATERIALIZED (SELECT band, bucket, count(*) AS n, min(doc_id) AS first_id FROM b GROUP BY ALL HAVING count(*) > 1)"""


def _signatures(spark: SparkSession, sf: str) -> DataFrame:
    d = _survivors(spark, sf)
    return dedup.signatures(d, "rec_id", items=dedup.md5_shingles(d, "rec_id"))


@query("WITH {SETS}, {MINHASH} SELECT doc_id AS rec_id, string_agg(v::VARCHAR, ' ' ORDER BY lane) AS sig FROM lanes GROUP BY doc_id")
def minhash_sig(spark: SparkSession, sf: str) -> DataFrame:
    return _signatures(spark, sf).select(F.col("id").alias("rec_id"), F.array_join(F.col("sig").cast("array<string>"), " ").alias("sig"))


@query("WITH {SETS}, {MINHASH}, {BANDS} SELECT doc_id AS rec_id, band, first_id, n FROM b JOIN m USING (band, bucket)")
def lsh_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Members of the buckets with several of them."""
    return dedup.lsh_candidates(_signatures(spark, sf)).withColumnRenamed("id", "rec_id")


_WALK = """todo AS (SELECT b, row_number() OVER (ORDER BY b) AS k, least FROM (SELECT b, list(a) AS least FROM p GROUP BY b)),
walk(k, gone) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL
SELECT walk.k + 1, CASE WHEN len(list_filter(todo.least, lambda x: NOT list_contains(walk.gone, x))) > 0 THEN list_append(walk.gone, todo.b) ELSE walk.gone END FROM walk JOIN todo ON todo.k = walk.k + 1)
SELECT doc_id AS rec_id FROM f WHERE doc_id NOT IN (SELECT unnest(gone) FROM (SELECT gone FROM walk ORDER BY k DESC LIMIT 1))"""


@query("WITH RECURSIVE {SETS}, {MINHASH}, {BANDS}, p AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM b x JOIN b y USING (band, bucket) WHERE x.doc_id < y.doc_id), " + _WALK)
def near_dedup_lsh(spark: SparkSession, sf: str) -> DataFrame:
    d = _survivors(spark, sf)
    return dedup.near_dedup_lsh(d, "rec_id", items=dedup.md5_shingles(d, "rec_id")).select("rec_id")


@query(f"""WITH {_FIRST}, k AS (SELECT source, count(*) AS n_kept, sum(length(text)) AS kept_chars FROM f JOIN documents USING (doc_id) GROUP BY source),
h AS (SELECT source, count(*) AS n_gated FROM g JOIN documents USING (doc_id) GROUP BY source)
SELECT source, n_in, coalesce(n_gated, 0) AS n_gated, coalesce(n_kept, 0) AS n_kept, CAST(coalesce(kept_chars, 0) AS BIGINT) AS kept_chars
FROM (SELECT source, count(*) AS n_in FROM documents GROUP BY source) LEFT JOIN h USING (source) LEFT JOIN k USING (source)""")
def corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.corpus_stats(_docs(spark, sf))


# Lines, order, shards.


@query("""SELECT doc_id, i AS line_no, line FROM (SELECT doc_id, unnest(range(len(l))) AS i, regexp_replace(unnest(l), '^{WS}+|{WS}+$', '', 'g') AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)) WHERE length(line) >= 8""")
def line_explode(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.lines(_docs(spark, sf), ID).withColumn("line_no", F.col("line_no").cast("long"))


@query("SELECT doc_id, strlen(text) AS n_bytes FROM documents WHERE strlen(text) <= 16384")
def line_len_cap(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).where(F.octet_length("text") <= 16384).select(ID, F.octet_length("text").cast("long").alias("n_bytes"))


@query(f"""SELECT doc_id, b AS bytes_before FROM (SELECT doc_id, coalesce(CAST(sum(strlen(text)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS b
FROM documents) WHERE b < {MAX_BYTES}""")
def byte_cap(spark: SparkSession, sf: str) -> DataFrame:
    """The cap is what this operator is for."""
    d = _docs(spark, sf).select(ID, F.octet_length("text").alias("n"))
    return corpus.byte_cap(d, [F.col(ID)], F.col("n"), MAX_BYTES).select(ID, "bytes_before")


TRAIN_BYTES, TRAIN_LINES = 1_500_000, 5_000


@query(f"""WITH l AS (SELECT doc_id, i AS line_no, line FROM (SELECT doc_id, unnest(range(len(l))) AS i, regexp_replace(unnest(l), '^{{WS}}+|{{WS}}+$', '', 'g') AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)) WHERE length(line) >= 8),
c AS (SELECT *, coalesce(sum(strlen(line)) OVER (ORDER BY doc_id, line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM l)
SELECT doc_id, line_no, line FROM c WHERE b < {TRAIN_BYTES} AND strlen(line) <= 2048 ORDER BY md5('0:' || doc_id || ':' || line_no), doc_id, line_no LIMIT {TRAIN_LINES}""")
def training_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines for training a vocabulary: the caps are what this operator is for."""
    out = corpus.training_lines(_docs(spark, sf), [ID], max_bytes=TRAIN_BYTES, max_line_bytes=2048, max_lines=TRAIN_LINES)
    return out.withColumn("line_no", F.col("line_no").cast("long"))


@query("WITH {N} SELECT word, count(*) AS n FROM (SELECT unnest(string_split(n, ' ')) AS word FROM n WHERE n <> '') GROUP BY word")
def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.word_counts(_docs(spark, sf))


@query(f"SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // {SHARD_DOCS} AS shard FROM documents")
def shard_assignment(spark: SparkSession, sf: str) -> DataFrame:
    from granary.operators.prefix import running_count

    return running_count(_docs(spark, sf).select(ID), [F.col(ID)]).select(ID, F.expr(f"(position - 1) div {SHARD_DOCS}").alias("shard"))


@query("SELECT doc_id, CAST(doc_id % 3 AS INTEGER) AS rank, CAST((doc_id // 3) % 2 AS INTEGER) AS worker FROM documents")
def shard_files(spark: SparkSession, sf: str) -> DataFrame:
    return sequences.shard_files(_docs(spark, sf).select(ID), F.col(ID), RANKS, 2)


# Vocabulary.

_PIECES = "p AS (SELECT piece_rank, piece, replace(piece, '▁', ' ') AS surface FROM spm_vocab WHERE piece <> '' AND piece NOT IN ('<unk>','<s>','</s>','<pad>') AND NOT (starts_with(piece, '<') AND ends_with(piece, '>')))"


@query(f"WITH {_PIECES} SELECT piece_rank, piece FROM p")
def vocab_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return vocab.plain_pieces(read_table(spark, sf, "spm_vocab")).select("piece_rank", "piece")


@query("SELECT piece_rank, replace(piece, '▁', ' ') AS surface FROM spm_vocab")
def piece_surface(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "spm_vocab").select("piece_rank", vocab.surface(F.col("piece")).alias("surface"))


@query(f"WITH {_PIECES} SELECT piece_rank, surface FROM p WHERE surface NOT IN (SELECT surface FROM p WHERE piece_rank % 5 = 0)")
def vocab_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    """Every fifth piece plays the base vocabulary."""
    p = vocab.plain_pieces(read_table(spark, sf, "spm_vocab"))
    return vocab.vocab_anti_join(p, p.where("piece_rank % 5 = 0")).select("piece_rank", "surface")


@query()
def select_new_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return vocab.select_new_tokens(read_table(spark, sf, "spm_vocab"), 16_000)


_NEW = _PIECES + """, base AS (SELECT surface FROM p WHERE piece_rank % 5 = 0),
new AS (SELECT surface, piece_rank, row_number() OVER (ORDER BY piece_rank) - 1 AS new_rank FROM (SELECT surface, min(piece_rank) AS piece_rank FROM p WHERE surface NOT IN (SELECT surface FROM base) GROUP BY surface))"""


def _table_tokens(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """New tokens where every fifth piece plays the base vocabulary, and the size of that."""
    p = vocab.plain_pieces(read_table(spark, sf, "spm_vocab"))
    base = p.where("piece_rank % 5 = 0")
    n = base.count()
    return vocab.assign_token_ids(vocab.first_ranked(vocab.vocab_anti_join(p, base), 16_000), n), n


@query(f"WITH {_NEW} SELECT new_rank, piece_rank, surface, new_rank + (SELECT count(*) FROM base) AS token_id FROM new")
def assign_token_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _table_tokens(spark, sf)[0].select(F.col("new_rank").cast("long").alias("new_rank"), "piece_rank", "surface", F.col("token_id").cast("long").alias("token_id"))


@query(f"""WITH {{N}}, {_NEW}, t AS (SELECT sum(CASE WHEN n = '' THEN 0 ELSE len(string_split(n, ' ')) END) / sum(length(text)) AS w, sum(strlen(text)) / sum(length(text)) AS b FROM documents JOIN n USING (doc_id))
SELECT 'table' AS model, (SELECT count(*) FROM base) AS base_vocab, (SELECT count(*) FROM new) AS added, (SELECT count(*) FROM base) + (SELECT count(*) FROM new) AS new_vocab, true AS tied_embeddings,
round(b, 9) AS fertility_tokens_per_char_before, round(w, 9) AS fertility_tokens_per_char_after FROM t""")
def expansion_meta(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata of an expansion; bytes play the tokens before and words those after."""
    new, n = _table_tokens(spark, sf)
    before, after = expand.sample_fertility(_docs(spark, sf), [F.octet_length("text"), _n_words()])
    return vocab.expansion_meta(spark, "table", n, new.count(), True, round(before, 9), round(after, 9))


@query()
def expand_vocab(spark: SparkSession, sf: str) -> DataFrame:
    """The whole step under a public tokenizer: metadata with tokens by character before and after."""
    return expand.expand(spark, read_table(spark, sf, "spm_vocab").select("piece_rank", "piece"), None, sample=_docs(spark, sf))


@query(f"""WITH {_NEW}, v AS (SELECT count(*) AS v FROM embeddings), b AS (SELECT count(*) AS n FROM base),
ids AS (SELECT new_rank + n AS token_id, unnest([new_rank % v, (7 * new_rank + 3) % v, v + 1]) AS vec_id FROM new, v, b),
e AS (SELECT vec_id, generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings)
SELECT token_id, CAST(dim AS INTEGER) AS dim, round(avg(x), 6) AS input, round(avg(-2 * x), 6) AS output FROM ids JOIN e USING (vec_id) GROUP BY ALL""")
def new_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of new tokens for an input matrix and an output matrix of its own."""
    e = read_table(spark, sf, "embeddings")
    v, r = e.count(), F.col("new_rank")
    ids = _table_tokens(spark, sf)[0].select(F.col("token_id").cast("long").alias("token_id"), F.array(r % v, (7 * r + 3) % v, F.lit(v + 1)).cast("array<bigint>").alias("ids"))
    rows = embeddings.new_rows(ids, e.withColumn("out", F.transform("embedding", lambda x: -2 * x)), output="out")
    x = rows.select("token_id", F.posexplode(F.arrays_zip("input", "output")).alias("d", "x"))
    return x.select("token_id", (F.col("d") + 1).alias("dim"), F.round("x.input", 6).alias("input"), F.round("x.output", 6).alias("output"))


@query()
def fertility(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens by character of each language before and after the new tokens."""
    new = vocab.select_new_tokens(read_table(spark, sf, "spm_vocab"), 16_000, name="byte_bpe_50k.json")
    after = vocab.extended_token_count(F.col("text"), [r.surface for r in new.orderBy("new_rank").collect()])
    d = _docs(spark, sf).select(F.coalesce("lang", F.lit("")).alias("lang"), "text", after.alias("after"), tok.token_count(F.col("text"), "byte_bpe_50k.tiktoken").alias("before"))
    g = d.groupBy("lang").agg(F.sum("before").alias("before"), F.sum("after").alias("after"), F.sum(F.length("text")).alias("n_chars"))
    return g.select("lang", (F.col("before") / F.col("n_chars")).alias("fertility_before"), (F.col("after") / F.col("n_chars")).alias("fertility_after"))


@query("""WITH {N} SELECT coalesce(lang, '') AS lang, CAST(sum(w) AS BIGINT) AS n_tokens, CAST(sum(length(text)) AS BIGINT) AS n_chars, round(sum(w) / sum(length(text)), 9) AS fertility
FROM (SELECT lang, text, CASE WHEN n = '' THEN 0 ELSE len(string_split(n, ' ')) END AS w FROM documents JOIN n USING (doc_id)) GROUP BY 1""")
def ws_fertility(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf).withColumn("lang", F.coalesce("lang", F.lit("")))
    return vocab.fertility(d, _n_words(), by=["lang"]).withColumn("fertility", F.round("fertility", 9))


# Embeddings. Ids are arithmetic, so that SQL can follow; every tenth document has none that is in the matrix.

_IDS = """v AS (SELECT count(*) AS v FROM embeddings),
ids AS (SELECT doc_id, unnest(CASE WHEN doc_id % 10 = 0 THEN [v + doc_id] ELSE [doc_id % v, (7 * doc_id + 3) % v, (doc_id * doc_id) % v, v + 1] END) AS vec_id FROM documents, v),
e AS (SELECT vec_id, generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
a AS (SELECT dim, avg(x) AS m FROM e GROUP BY dim)"""


def _ids(spark: SparkSession, sf: str) -> DataFrame:
    v = read_table(spark, sf, "embeddings").agg(F.count("*").alias("v"))
    i = F.col(ID)
    own = F.array(i % F.col("v"), (7 * i + 3) % F.col("v"), (i * i) % F.col("v"), F.col("v") + 1)
    return _docs(spark, sf).select(ID).crossJoin(F.broadcast(v)).select(ID, F.when(i % 10 == 0, F.array(F.col("v") + i)).otherwise(own).alias("ids"))


@query(f"WITH {_IDS} SELECT CAST(dim AS INTEGER) AS dim, round(m, 6) AS value FROM a")
def global_mean_vec(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.unnest(embeddings.global_mean(read_table(spark, sf, "embeddings")).withColumn("k", F.lit(0)), "k").select("dim", "value")


@query(f"""WITH {_IDS}, own AS (SELECT doc_id, dim, avg(x) AS m FROM ids JOIN e USING (vec_id) GROUP BY doc_id, dim)
SELECT doc_id, CAST(a.dim AS INTEGER) AS dim, round(coalesce(own.m, a.m), 6) AS value FROM documents CROSS JOIN a LEFT JOIN own USING (doc_id, dim)""")
def mean_init(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.unnest(embeddings.mean_init(_ids(spark, sf), read_table(spark, sf, "embeddings"), ID), ID)


@query("""SELECT vec_id, label, CAST(d AS INTEGER) AS dim, round(CASE WHEN vec_id % 4 = 0 THEN -x ELSE x END, 6) AS value
FROM (SELECT vec_id, label, generate_subscripts(embedding, 1) AS d, unnest(embedding)::DOUBLE AS x FROM embeddings)""")
def apply_init(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "embeddings")
    new = e.where("vec_id % 4 = 0").select("vec_id", F.transform("embedding", lambda x: -x).alias("embedding"))
    out = embeddings.apply_init(e, new)
    return out.select("vec_id", "label", F.posexplode("embedding").alias("p", "x")).select("vec_id", "label", (F.col("p") + 1).alias("dim"), F.round(F.col("x").cast("double"), 6).alias("value"))


# Token streams.

_TOKENS = "t AS (SELECT doc_id, doc_id % 3 AS rank, CASE WHEN n = '' THEN 0 ELSE len(string_split(n, ' ')) END AS w FROM n)"


def _sized(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select(ID, (F.col(ID) % RANKS).alias("rank"), _n_words().cast("long").alias("w"))


@query(f"""WITH {{N}}, {_TOKENS} SELECT doc_id, rank, coalesce(CAST(sum(w + 1) OVER (PARTITION BY rank ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS first_position FROM t""")
def pack_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return sequences.pack_offsets(_sized(spark, sf), [F.col(ID)], F.col("w"), ["rank"]).select(ID, "rank", "first_position")


@query(f"WITH {{N}}, {_TOKENS} SELECT rank, CAST(sum(w + 1) // {SEQ_LEN} AS BIGINT) AS n_sequences, CAST(sum(w + 1) % {SEQ_LEN} AS BIGINT) AS n_left FROM t GROUP BY rank")
def pack_chunk_counts(spark: SparkSession, sf: str) -> DataFrame:
    return sequences.chunk_counts(_sized(spark, sf), F.col("w"), ["rank"], SEQ_LEN)


@query()
def pack_sequences(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf).select(ID, (F.col(ID) % RANKS).alias("rank"), "text")
    return sequences.pack_sequences(d, [F.col(ID)], ["rank"], SEQ_LEN)


_WORD_IDS = """u AS (SELECT doc_id, doc_id % 3 AS rank, (doc_id // 3) % 2 AS worker, CASE WHEN n = '' THEN [] ELSE list_transform(string_split(n, ' '), lambda w: ('0x' || left(md5(w), 7))::INTEGER) END AS ids FROM n),
o AS (SELECT rank, worker, row_number() OVER (PARTITION BY rank, worker ORDER BY doc_id, i) - 1 AS k, v FROM (SELECT doc_id, rank, worker, unnest(list_append(ids, -1)) AS v, unnest(range(len(ids) + 1)) AS i FROM u)),
q AS (SELECT rank, worker, k // 128 AS seq_no, string_agg(v::VARCHAR, ' ' ORDER BY k) AS ids FROM o GROUP BY ALL HAVING count(*) = 128)"""


def _word_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """Sequences of 128 hashed words, with -1 at the end of a text, for each rank and worker."""
    d = sequences.shard_files(_docs(spark, sf).select(ID, words(normalize_text(F.col("text"))).alias("w")), F.col(ID), RANKS, 2)
    ids = F.transform("w", lambda w: F.conv(F.left(F.md5(F.encode(w, "utf-8")), F.lit(7)), 16, 10).cast("int"))
    return sequences.pack_ids(d.select(ID, F.col("rank").cast("long").alias("rank"), F.col("worker").cast("long").alias("worker"), ids.alias("ids")), [F.col(ID)], ["rank", "worker"], 128, F.col("ids"), -1)


@query(f"WITH {{N}}, {_WORD_IDS} SELECT rank, worker, seq_no, ids AS input_ids, ids AS labels FROM q")
def pack_word_sequences(spark: SparkSession, sf: str) -> DataFrame:
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), " ").alias(c)
    return _word_sequences(spark, sf).select("rank", "worker", "seq_no", text("input_ids"), text("labels"))


@query(f"""WITH {{N}}, {_WORD_IDS} SELECT rank, worker, seq_no // 4 AS batch_no, string_agg(ids, ';' ORDER BY seq_no) AS input_ids, string_agg(ids, ';' ORDER BY seq_no) AS labels, CAST(count(*) * 128 AS BIGINT) AS mask
FROM q WHERE seq_no // 4 < 10 GROUP BY ALL""")
def collate(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of four sequences with labels and a mask of ones, of the first ten steps: that cap is a feature."""
    b = sequences.first_steps(sequences.batches(_word_sequences(spark, sf), 4, ["rank", "worker"]), 10)
    text = lambda c: F.array_join(F.transform(c, lambda r: F.array_join(r.cast("array<string>"), " ")), ";").alias(c)
    ones = F.aggregate(F.flatten("attention_mask"), F.lit(0).cast("long"), lambda a, x: a + x)
    return b.select("rank", "worker", "batch_no", text("input_ids"), text("labels"), ones.alias("mask"))


@query("""WITH r AS (SELECT doc_id AS id, 0 AS stream, 0.95::DOUBLE AS w, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM documents
UNION ALL SELECT rec_id, 1, 0.05::DOUBLE, row_number() OVER (ORDER BY rec_id) - 1 FROM data_pipeline)
SELECT id, stream, round((k + (('0x' || left(md5(stream || ':' || k), 6))::BIGINT % 1000) / 1000.0::DOUBLE) / w, 6) AS mix_key FROM r""")
def replay_mix(spark: SparkSession, sf: str) -> DataFrame:
    d, r = _docs(spark, sf).select(F.col(ID).alias("id")), read_table(spark, sf, "data_pipeline").select(F.col("rec_id").alias("id"))
    shift = F.conv(F.left(F.md5(F.concat_ws(":", "__stream", "__at")), F.lit(6)), 16, 10).cast("long") % 1000
    return sequences.replay_mix(d, r, [F.col("id")], 0.05, shift=shift).withColumn("mix_key", F.round("mix_key", 6))


# Dimensions.


@query("""SELECT rec_id, coalesce((SELECT min(culturax) FROM languages WHERE language = lower(trim(lang)) OR culturax = lower(trim(lang))), lower(trim(lang))) AS code FROM data_pipeline""")
def dim_lookup(spark: SparkSession, sf: str) -> DataFrame:
    g = read_table(spark, sf, "languages")
    names = g.select(F.col("language").alias("name"), "culturax").union(g.select("culturax", "culturax")).groupBy("name").agg(F.min("culturax").alias("code_of"))
    key = F.lower(F.trim("lang"))
    return dimensions.lookup(read_table(spark, sf, "data_pipeline"), names, key, "name", "code_of", "code", key).select("rec_id", "code")


@query("SELECT r_name, n_name, CAST(r_regionkey * 25 + n_nationkey AS BIGINT) AS task_id FROM region CROSS JOIN nation")
def task_grid(spark: SparkSession, sf: str) -> DataFrame:
    g = dimensions.task_grid(read_table(spark, sf, "region"), read_table(spark, sf, "nation"), F.col("r_regionkey"), F.col("n_nationkey"), 25)
    return g.select("r_name", "n_name", "task_id")


@query("""SELECT p_partkey, CASE WHEN contains(lower(p_name), 'gold') THEN 'gold' WHEN contains(lower(p_name), 'red') THEN 'red' WHEN contains(lower(p_name), 'blue') THEN 'blue' ELSE 'gold' END AS family FROM part""")
def model_family(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "part").select("p_partkey", dimensions.model_family(F.col("p_name"), ("gold", "red", "blue")).alias("family"))


_CARD = """'---' || chr(10) || 'language:' || chr(10) || '- ' || culturax || chr(10) || 'license: mit' || chr(10) || 'base_model: models/base-1b' || chr(10) || 'library_name: transformers' || chr(10) || 'tags:' || chr(10) || '- continued-pretraining' || chr(10)
|| '- vocabulary-expansion' || chr(10) || '- ' || lower(language) || chr(10) || '- multilingual' || chr(10) || 'datasets:' || chr(10) || '- a' || chr(10) || '- b' || chr(10) || 'pipeline_tag: text-generation' || chr(10) || '---' || chr(10) || chr(10)
|| '# ' || madlad || chr(10) || chr(10) || 'models/base-1b trained further on texts in ' || name || ', with 12,345 tokens of that language added to its vocabulary.' || chr(10) || chr(10)
|| CASE WHEN length(language) > 5 THEN 'Tokens by character: 0.250 before the new tokens, 0.125 after.' || chr(10) || chr(10) ELSE '' END
|| '## Data' || chr(10) || chr(10) || 'Texts in ' || name || ' from a, b, merged; equal and nearly equal texts came in once.' || chr(10) || chr(10) || '## Method' || chr(10) || chr(10)
|| 'Pieces of a vocabulary of the corpus that the base tokenizer splits were added to it. Each new embedding began as the mean of the pieces it was split into.' || chr(10) || chr(10)
|| '## Use and limits' || chr(10) || chr(10) || 'A base model without instruction tuning for text in ' || name || '. It carries the errors and the slant of web text.' || chr(10) || chr(10) || '## Licence' || chr(10) || chr(10) || 'mit, as the base model. Note.' || chr(10)"""


@query(f"SELECT language, {_CARD} AS card FROM (SELECT *, upper(left(language, 1)) || lower(substr(language, 2)) AS name FROM languages WHERE language IS NOT NULL)")
def model_card(spark: SparkSession, sf: str) -> DataFrame:
    """Only names of more than five letters come with figures."""
    g = read_table(spark, sf, "languages").where("language is not null")
    lit, before = F.lit, F.when(F.length("language") > 5, 0.25)
    return dimensions.model_card(g, F.concat(lit("me/"), "madlad"), F.col("language"), F.col("culturax"), lit("models/base-1b"), lit("mit"), lit("Note."), ("a", "b"), lit(12_345), before, before / 2).select("language", "card")


for _old, _new in (("normalize_text_q", "normalize_text"), ("text_hash_q", "text_hash"), ("basename_q", "basename"), ("token_count_q", "token_count")):
    _queries[_new] = _queries.pop(_old)
    if _old in _sql:
        _sql[_new] = _sql.pop(_old)
