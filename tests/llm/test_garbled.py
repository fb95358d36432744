import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from granary.llm import garbled
from granary.session import read_table


@pytest.fixture(scope="module")
def model(spark, sf):
    return garbled.fit(read_table(spark, sf, "lang_samples"))


SOUND = ["São ÃO SÃO BRITO «ja» ¿Qué? Ñandú CAFÉ ÂNGELA Ærø Łeba Дом 東山 ɔː ─── │ ├── Ⅳ 😀 👩‍🌾 ™ £ × ½ °C €5 señor", "â la carte pâté naïve Ä Ж", "&eacute; %C3%A9 caf&#233;", "Dit is vir my ’n “goeie” dag – sê hy, môre", "plain text"]


def page(x, codec):
    return "".join(bytes([b]).decode(codec, "ignore") or chr(b) for b in x.encode("utf-8"))


@pytest.mark.parametrize("codec", ["cp1252", "latin-1", "cp1250", "cp1251", "cp437", "cp850", "koi8-r", "mac-roman"])
def test_utf8_read_in_a_code_page(spark, sf, model, codec):
    texts = [r.text for r in read_table(spark, sf, "lang_samples").where("lang in ('si', 'ne', 'ta')").orderBy("sample_id").limit(120).collect()][::6]
    rows = [(i, "good start here\n" + page(t, codec), "s", "x") for i, t in enumerate(texts)] + [(1000 + i, t, "s", "x") for i, t in enumerate([*SOUND, *texts])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, unit string")
    found = garbled.find_garbled(df, model)
    assert {r.id for r in found.documents().collect()} == set(range(len(texts)))
    back = {r.doc_id: r.text for r in garbled.restore(df, found, model).collect()}
    right = sum(back[i] == "good start here\n" + t for i, t in enumerate(texts))
    assert right >= 0.9 * len(texts)


def test_single_bytes_swapped_and_double(spark, model):
    af = "Sy wil hê dat ons die môre sien en die reën ’n keer kry, sê hy. Hulle is vroeë mense."
    rows = [
        (1, af.encode("cp1252").decode("cp437"), "s"), (2, af.encode("cp1252").decode("mac-roman"), "s"), (3, page(page(af, "cp1252"), "cp1252"), "t"), (4, af, "s"),
        (5, "Sy wil h� dat ons", "s"), (6, af.encode("utf-16-le").decode("utf-16-be"), "u"), (7, af.encode("utf-8").decode("gbk", "ignore"), "u"), (8, None, "s"), (9, "", None), (None, "Ã©Ã©", "s"), (10, "cafÃ© cafÃ©", None), (10, "cafÃ© cafÃ©", None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = garbled.find_garbled(df, model)
    assert {r.id for r in found.documents().collect()} == {1, 2, 3, 5, 6, 7, 10}
    back = {r.doc_id: r.text for r in garbled.restore(df, found, model).collect()}
    assert back[3] == af and back[10] == "café café" and "hê dat" in back[1] and "môre" in back[2] and "sê hy" in back[6]
    assert garbled.find_garbled(df.where("false"), model).documents().count() == 0


def test_very_long_text(spark, model):
    df = spark.createDataFrame([(1, "අපේ පොත " * 60_000), (2, page("අපේ පොත " * 20_000, "latin-1"))], "doc_id long, text string").withColumn("source", F.lit("s"))
    assert [r.id for r in garbled.find_garbled(df, model).documents().collect()] == [2]


def test_em_follows_the_bigrams(model):
    """An unknown symbol that stands where one letter stands in the samples gets that letter."""
    m = model.value
    target = "ෙ"
    pairs = [("@u", 0, a, int(1000 * m.p[m.at[a], m.at[target]])) for a in m.chars] + [("@u", 1, b, int(1000 * m.p[m.at[target], m.at[b]])) for b in m.chars]
    out = garbled.decipher(pd.DataFrame([p for p in pairs if p[3]], columns=["unit", "side", "other", "n"]), m)
    assert out.letter.tolist() == [target]


@pytest.mark.parametrize("codec", ["cp874", "iso8859-11", "cp1255", "cp1256", "mac-greek", "cp864"])
def test_utf8_read_in_a_page_of_another_script(spark, sf, model, codec):
    texts = [r.text for r in read_table(spark, sf, "lang_samples").where("lang in ('si', 'mr', 'ta')").orderBy("sample_id").limit(120).collect()][::10]
    sound = [*SOUND, "ประเทศไทย รถ เทป เคน เกม สวัสดีครับ", "שלום עולם", "مرحبا بالعالم آپ کے لئے", "Ελλάδα καλημέρα", "București Iași Mureș", *texts]
    rows = [(i, page(t, codec), "s") for i, t in enumerate(texts)] + [(1000 + i, t, "s") for i, t in enumerate(sound)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = garbled.find_garbled(df, model)
    assert {r.id for r in found.documents().collect()} == set(range(len(texts)))
    back = {r.doc_id: r.text for r in garbled.restore(df, found, model).collect()}
    assert sum(back[i] == t for i, t in enumerate(texts)) >= 0.7 * len(texts)


def test_symbol_that_no_page_explains(spark, model):
    """One letter became a symbol of another script: found where its letter is sure, and not in a sound word."""
    texts = ["Hulle sê die môre is mooi en wêreld", "Die hele wêreld sê dit is reg", "Ons lê en slaap, die perd hê honger", "Sy het gesê dat die wêreld mooi is", "Die skêr lê op die tafel"]
    rows = [(i, t.replace("ê", "Ꭰ"), "s") for i, t in enumerate(texts * 4)] + [(100, "ᎠᎡ is Cherokee", "s"), (101, "Die skêr lê op die tafel", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = garbled.find_garbled(df, model)
    assert {r.id for r in found.documents().collect()} == set(range(20))
    assert {r.letter for r in found.units.collect()} == {"ê"}


@pytest.mark.parametrize("codec", ["gbk", "gb18030", "big5", "cp932", "euc-kr", "cp949"])
def test_utf8_read_in_a_double_byte_page(spark, sf, model, codec):
    """Units are of several letters; bytes that the page lost leave the rest of the run as it was."""
    texts = [r.text for r in read_table(spark, sf, "lang_samples").where("lang in ('si', 'ta', 'mr', 'ne', 'hi')").orderBy("sample_id").limit(200).collect()][::20]
    rows = [(i, t.encode("utf-8").decode(codec, "ignore"), "s") for i, t in enumerate(texts)] + [(1000 + i, t, "s") for i, t in enumerate([*SOUND, "ﾃｽﾄ", "한국어 문장입니다 서울", *texts])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = garbled.find_garbled(df, model)
    assert {r.id for r in found.documents().collect()} == set(range(len(texts)))
    back = {r.doc_id: r.text for r in garbled.restore(df, found, model).collect()}
    brahmic = lambda t: sum(0x900 <= ord(c) <= 0xDFF for c in t)
    assert all(brahmic(back[i]) > brahmic(rows[i][1]) for i in range(len(texts)))
    if codec == "gb18030":
        assert sum(map(brahmic, (back[i] for i in range(len(texts))))) > 0.75 * sum(map(brahmic, texts))


def test_several_letters_of_a_double_byte_unit(model):
    unit = "මනුලොඩ".encode("utf-8").decode("gbk")
    out = garbled.decipher(pd.DataFrame([(unit, 0, " ", 3), (unit, 1, " ", 3)], columns=["unit", "side", "other", "n"]), model.value)
    assert out.letter.tolist() == ["මනුලොඩ"]


def permuted(texts, seed, alphabet):
    """Bytes of UTF-8 above 127 as characters of an alphabet in random order: a page that nobody knows."""
    rng = random.Random(seed)
    chars = list(alphabet)
    rng.shuffle(chars)
    return ["".join(chr(b) if b < 128 else chars[b - 128] for b in t.encode("utf-8")) for t in texts]


ALPHABETS = {"latin": [chr(c) for c in range(0x80, 0x100)], "armenian and georgian": [chr(c) for c in [*range(0x531, 0x557), *range(0x561, 0x588), *range(0x10A0, 0x10F5)]][:128], "runes": [chr(c) for c in range(0x13A0, 0x1420)]}


@pytest.fixture(scope="module")
def pages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang in ('si', 'ta', 'mr') and n_chars < 2500").orderBy("doc_id").select("doc_id", "lang", "text").collect()
    brahmic = lambda t: sum(0x900 <= ord(c) <= 0xDFF for c in t)
    return {lang: [r.text for r in docs if r.lang == lang and brahmic(r.text) > 0.6 * len(r.text) and not any(0x80 <= ord(c) < 0x900 for c in r.text)][:24] for lang in ("si", "ta", "mr")}


@pytest.mark.parametrize("name", list(ALPHABETS))
def test_unknown_permutation_of_bytes(spark, sf, model, pages, name):
    """One random page for each source and language: found and restored by what EM learns alone."""
    rows, want = [], {}
    for k, (lang, texts) in enumerate(pages.items()):
        for i, (g, t) in enumerate(zip(permuted(texts, k, ALPHABETS[name]), texts)):
            rows.append((1000 * k + i, g, f"source {k}"))
            want[1000 * k + i] = t
    sound = [*SOUND, "ประเทศไทย รถ เทป เคน เกม สวัสดีครับ", "Привет мир, как дела? Правительство объявило о новом законе.", "Ελλάδα καλημέρα", "東京は日本の首都です", "مرحبا بالعالم آپ کے لئے", "Հայաստան Երևան", *[t for x in pages.values() for t in x[:4]]]
    rows += [(90_000 + i, t, f"source {i % 3}") for i, t in enumerate(sound)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = garbled.find_garbled(df, model)
    ids = {r.id for r in found.documents().collect()}
    assert not {i for i in ids if i >= 90_000} and len(ids) >= 0.95 * len(want)
    back = {r.doc_id: r.text for r in garbled.restore(df, found, model).collect()}
    # What is left as it was are signs that no sample has, such as dashes.
    assert sum(back.get(i) == t for i, t in want.items()) >= 0.85 * len(want)
    blind = garbled.restore(df, garbled.find_garbled(df, model, unknown_rounds=0), model).collect()
    assert sum(r.text == want[r.doc_id] for r in blind) <= 0.05 * len(want)


def test_one_symbol_for_each_letter(spark, model, pages):
    """A cipher of single characters, as of an old font."""
    letters = sorted({c for t in pages["si"] for c in t if c > "\x7f"})
    key = {ord(c): chr(0x13A0 + 3 * i % 85) if i < 85 else c for i, c in enumerate(letters)}
    df = spark.createDataFrame([(i, t.translate(key), "s") for i, t in enumerate(pages["si"])] + [(900, "ᎣᏏᏲ ᏣᎳᎩ ᎦᏬᏂᎯᏍᏗ", "t")], "doc_id long, text string, source string")
    found = garbled.find_garbled(df, model)
    assert {r.id for r in found.documents().collect()} >= set(range(len(pages["si"]))) and 900 not in {r.id for r in found.documents().collect()}
    back = {r.doc_id: r.text for r in garbled.restore(df, found, model).collect()}
    right = sum(a == b for i, t in enumerate(pages["si"]) for a, b in zip(back[i], t))
    assert right >= 0.97 * sum(map(len, pages["si"]))


def test_every_passage_counts(spark):
    """The passage that any choice of 20,000 by hash leaves out is the only one of its script."""
    text = "பள்ளி மாணவர்கள் காலையில் நூலகம் சென்று புத்தகங்கள் படித்தனர்"
    ids = spark.range(20_001).withColumnRenamed("id", "sample_id")
    last = ids.orderBy(F.xxhash64("sample_id").desc(), F.desc("sample_id")).first().sample_id
    own = F.col("sample_id") == last
    m = garbled.fit(ids.select("sample_id", F.when(own, "ta").otherwise("en").alias("lang"), F.when(own, text).otherwise("the school is open").alias("text")))
    assert m.value.words["ta"].joint.sum() == pytest.approx(1) and ("ப", "ள") in m.value.seen
    assert m.value.p[m.value.at["t"], m.value.at["h"]] == pytest.approx(20_000.02 / (20_000 + 0.02 * len(m.value.chars)), rel=1e-5)
    df = spark.createDataFrame([(1, page(text, "cp1252"), "s"), (2, text, "s")], "doc_id long, text string, source string")
    found = garbled.find_garbled(df, m)
    assert [r.id for r in found.documents().collect()] == [1]
    assert [r.text for r in garbled.restore(df, found, m).collect()] == [text]


def test_limits_follow_all_held_out_passages(spark, sf, model):
    """Counts and limits of one pass over each passage, however the table is split; copies do not hold out each other."""
    samples = read_table(spark, sf, "lang_samples")
    passages = [(r.lang, r.fold, r.text) for r in samples.select("lang", F.expr("pmod(xxhash64(text), 5)").alias("fold"), "text").collect()]
    for lang, m in model.value.words.items():
        own = [(fold, garbled.cipher.RUN.findall(t)) for at, fold, t in passages if at == lang]
        count = lambda rows: garbled.Counter(p for ws in rows for w in ws for p in garbled.cipher._pairs(w))
        assert m.joint.tolist() == garbled.cipher.WordModel(count(ws for _, ws in own)).joint.tolist()
        rest, means = [garbled.cipher.WordModel(count(ws for fold, ws in own if fold != k)) for k in range(5)], []
        for fold, ws in own:
            r = rest[fold]
            s = [r.cond[r.at[a], r.at[b]] if a in r.at and b in r.at else -20.72326583694641 for w in ws for a, b in garbled.cipher._pairs(w)]
            means += [sum(s) / len(s)] if len(s) > 20 else []
        assert m.limit == pytest.approx(1.1 * min(means))
    split = garbled.fit(samples.repartition(7)).value
    assert split.p.tolist() == model.value.p.tolist() and {k: w.limit for k, w in split.words.items()} == {k: w.limit for k, w in model.value.words.items()}
    twice = garbled.fit(samples.union(samples)).value
    assert set(twice.words) == set(model.value.words) and all(twice.words[k].limit == pytest.approx(w.limit, rel=0.1) for k, w in model.value.words.items())
