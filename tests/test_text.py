import hashlib
import unicodedata

from pyspark.sql import functions as F

from granary.functions import text as t
from granary.functions.tokenizers import tokenizer

ODD = ["ﬁn  Ａ", "a 　\u0085 \u001c\u000bb", "", "   ", None, "👩‍🌾 x", "Ⅳ ½ ABC", "x" * 50_000]


def normal(x):
    return None if x is None else " ".join(unicodedata.normalize("NFKC", x).split())


def test_normalize_hash_and_words(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ODD)], "i int, x string")
    got = {r.i: r for r in df.select("i", t.normalize_text(F.col("x")).alias("n"), t.text_hash(F.col("x")).alias("h"), F.length(t.strip(F.col("x"))).alias("s")).collect()}
    for i, x in enumerate(ODD):
        assert got[i].n == normal(x)
        assert got[i].h == (None if x is None else hashlib.sha1(normal(x).encode()).hexdigest())
        assert got[i].s == (None if x is None else len(x.strip()))


def test_shingles_against_python(spark):
    texts = ["a b c d e f a b c d e", "a b c", "", "one", "a a a a a a a"]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    for r in df.select("x", t.shingles(F.col("x")).alias("s")).collect():
        w = r.x.split()
        want = {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({" ".join(w)} if w else set())
        assert set(r.s) == want and len(r.s) == len(want)


def test_site(spark):
    rows = [("HTTP://WWW.Ab.example:8080/x", "a", "ab.example"), ("m.ab.example/x?y", "a", "ab.example"), ("//ab.example", "a", "ab.example"), (None, "src", "src"), ("", "src", "src"), ("https://u:p@ab.example#t", "s", "ab.example"), ("   ", None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, u string, s string, w string")
    for r in df.select("*", t.site(F.col("u"), F.col("s")).alias("g")).collect():
        assert r.g == r.w, r


def test_line_key(spark):
    df = spark.createDataFrame([("  Read MORE » 12", "readmore"), ("ප්‍රකාශ 1", "ප්රකාශ"), ("12 - 3", "")], "x string, w string")
    for r in df.select("w", t.line_key(F.col("x")).alias("g")).collect():
        assert r.g == r.w


def test_chunked_count_is_exact():
    tk = tokenizer()
    for x in ["a  b\n\n c   ", "  lead", "it's  12,5 %", "ஆனால் அந்த\tஅரசு \n", "", " ", "a b", "x" * 3000]:
        assert tk.count(x) == len(tk.encode(x))
