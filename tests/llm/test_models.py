import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import langid, quality, token_budget
from granary.llm.analysis import Analysis, calibrate, languages, nonprose, reliability
from granary.llm.langmodel import LanguageModels, WordTable
from granary.session import read_table

LANGS = ["af", "en", "hi", "mr", "ne", "nl", "si", "ta"]


@pytest.fixture(scope="module")
def samples(spark, sf):
    return [(r.lang, r.text) for r in read_table(spark, sf, "lang_samples").orderBy("sample_id").collect()]


@pytest.fixture(scope="module")
def models(spark, sf):
    return langid.fit(read_table(spark, sf, "lang_samples"))


def test_probabilities_sum_to_at_most_one(samples):
    m = LanguageModels(samples)
    chars = sorted({c for _, t in samples for c in t.lower() if c.isalpha()})[:400]
    # The distribution after the word start: score of one letter includes the word end, so it is below 1 in sum.
    p = np.exp(m.score(chars)).sum(0)
    assert (p > 0).all() and (p <= 1).all()


def test_scores_do_not_depend_on_company(samples):
    m = LanguageModels(samples)
    alone = np.vstack([m.score([w]) for w in ("skool", "පොත", "xqz", "")])
    assert np.allclose(alone, m.score(["skool", "පොත", "xqz", ""]), atol=1e-4)


def test_held_out_accuracy(samples):
    fit, held = [x for i, x in enumerate(samples) if i % 4], [x for i, x in enumerate(samples) if i % 4 == 0]
    m, reject = LanguageModels(fit), calibrate(fit)
    a = Analysis([t for _, t in held], WordTable(m))
    right = sum(m.langs[languages(a, d, m, reject)[1]] == lang for d, (lang, _) in enumerate(held))
    assert right >= 0.98 * len(held)


def test_mixed_text(samples, models):
    m, reject = models.value
    by = {lang: [t for x, t in samples if x == lang] for lang in LANGS}
    for a_, b_ in (("af", "nl"), ("ne", "hi"), ("si", "en")):
        text = " ".join(by[a_][:4]) + "\nWiFi.\n" + " ".join(by[b_][4:8])
        a = Analysis([text], WordTable(m))
        assert [m.langs[s[0]] for s in languages(a, 0, m, reject)[0]] == [a_, b_]


def test_labels(spark, sf):
    rows = [("si", "si"), (" Sinhala ", "si"), ("sin_Sinh", "si"), ("en-GB", "en"), ("AF_za", "af"), ("mul", None), ("", None), (None, None), ("nld_Latn", "nl")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, l string, w string")
    for r in df.select("w", "l", langid.label_code(F.col("l"), read_table(spark, sf, "languages")).alias("g")).collect():
        assert r.g == r.w, r


def test_wrong_labels_edges(spark, sf, models, samples):
    en, si = [" ".join([t for x, t in samples if x == lang][:4]) for lang in ("en", "si")]
    rows = [(1, en, "en", "k"), (2, en, "si", "k"), (3, en, None, "k"), (4, f"{en}\n{si}", "en", "k"), (5, None, None, "k"), (6, "", None, "k"), (7, " \n　", None, "k"), (8, "12 34 .", "xx", "k"), (None, en, None, "k"), (2, en, "si", "k")]
    df = spark.createDataFrame(rows, "rec_id long, text string, lang string, kind string")
    got = sorted((r.rec_id, r.seg_no, r.lang) for r in langid.wrong_labels(df, models, read_table(spark, sf, "languages")).collect())
    assert got == [(2, 1, "en"), (2, 1, "en"), (3, 1, "en"), (4, 1, "en"), (4, 2, "si")]
    assert langid.wrong_labels(df.where("false"), models, read_table(spark, sf, "languages")).count() == 0


def kinds(texts, models):
    a = Analysis(texts, WordTable(models.value[0]))
    return [nonprose(a, d)[0] for d in range(len(texts))]


def test_kinds(models, samples):
    en = " ".join([t for x, t in samples if x == "en"][:3])
    items = [f"{w} {v}" for w, v in zip("Bora Lumo Kevi Tasa Povu Gidi Meho Wani Sufa Rado Hipe Zuke".split(), "Dane Gofi Wise Batu Lepo Nuga Rihe Sovi Taku Vemo Yida Zaro".split())]
    cases = [
        ("\n".join(f"* {x}" for x in items), "list"), ("\n".join(f"{i:02} – {x}" for i, x in enumerate(items)), "list"), (", ".join(items), "list"),
        ("\n".join(f"{x} – Rs. 70,165.95" for x in items), "list"), ("\n".join(f"{x} http://a.test/{i}" for i, x in enumerate(items)), "list"),
        ("\n".join(f"{x}\t{i}\t12:30" for i, x in enumerate(items)), "table"), ("\n".join(["| a | b | c |", "|---|---|---|", *[f"| {x} | {i} | 5% |" for i, x in enumerate(items)]]), "table"),
        ("\n".join(f'"{x}",{i},"9"' for i, x in enumerate(items)), "table"), ("\n".join(f"{x}    {i}   4.5" for i, x in enumerate(items)), "table"),
        ("### *** ^^^^ ///\n!!!! ???? ####", "junk"), ("123 4567 89\n99 1 22345", "junk"), ("xqzt bvnm wrtp kkjh zzxc qwrt plmn vbhg " * 6, "junk"), ("Tb Kevo Da 695387, " * 12, "junk"),
        ('<div class="x" id=q></div>' * 6, "junk"), ("டை" * 40, "junk"),
        (en, None), ("\n".join(f"({i}) {s}." for i, s in enumerate(en.split(". "))), None), ("\n".join(f"– {s}." for s in en.split(". ")), None),
    ]
    got = kinds([t for t, _ in cases], models)
    assert [(t[:30], k) for t, k in zip([t for t, _ in cases], got)] == [(t[:30], k) for t, k in cases]


def test_quality_edges(spark, models):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "§"), (5, "a " * 200_000), (None, "x"), (6, "word"), (6, "word")]
    df = spark.createDataFrame(rows, "rec_id long, text string").withColumn("kind", F.lit("clash"))
    got = quality.text_quality(df, models).collect()
    assert sorted(r.rec_id for r in got) == [4, 5, 6, 6]
    by = {r.rec_id: r for r in got}
    assert "many_words" in by[5].reasons and "few_words" in by[6].reasons and by[4].n_words == 0 and by[4].mean_word_length == 0
    assert quality.text_quality(df.where("false"), models).count() == 0


FOREIGN = {
    "fr": "Le gouvernement a annoncé hier une nouvelle loi pour protéger les petites entreprises du pays. Elle entrera en vigueur au printemps.", "de": "Die Regierung hat gestern ein neues Gesetz angekündigt, das kleine Unternehmen schützen soll.",
    "hr": "Vlada je jučer najavila novi zakon koji bi trebao zaštititi mala poduzeća u zemlji.", "ru": "Правительство вчера объявило о новом законе для защиты малого бизнеса в стране.", "bn": "সরকার গতকাল একটি নতুন আইন ঘোষণা করেছে যা ছোট ব্যবসা রক্ষা করবে",
    "es": "El gobierno anunció ayer una nueva ley para proteger a las pequeñas empresas del país.", "sw": "Serikali ilitangaza jana sheria mpya ya kulinda biashara ndogo nchini kote",
}


def test_other_languages_are_rejected(samples, models):
    m, cal = models.value
    a = Analysis([*FOREIGN.values(), *[t for _, t in samples]], WordTable(m))
    for d in range(len(FOREIGN)):
        assert languages(a, d, m, cal) == ([], None, 0.0)
    assert all(languages(a, len(FOREIGN) + d, m, cal)[1] == m.langs.index(lang) for d, (lang, _) in enumerate(samples))


def test_own_texts_pass_the_limits_held_out(samples):
    fit, held = [x for i, x in enumerate(samples) if i % 4], [x for i, x in enumerate(samples) if i % 4 == 0]
    m, cal = LanguageModels(fit), calibrate(fit)
    a = Analysis([t for _, t in held], WordTable(m))
    assert sum(languages(a, d, m, cal)[1] is None for d in range(len(held))) <= 0.02 * len(held)


def test_confidence_is_reliable(samples):
    """Held-out pieces: the share that is right is no more than a little below the mean confidence in any bin."""
    bins = reliability(samples)
    assert len(bins) >= 5
    for _, n, p, right in bins:
        assert n < 100 or right > p - 0.08
    assert bins[-1][3] > 0.99


def test_every_case_has_its_reasons(spark, sf, models):
    df = read_table(spark, sf, "data_pipeline")
    cases = quality.not_prose(df, models).collect()
    assert cases and {r.kind for r in cases} <= {"list", "table", "junk"}
    for r in cases:
        assert "not_prose" in r.reasons and sum(r.line_rules.values()) > 0.5
    other = quality.text_quality(df, models).where("kind is null").collect()
    assert all("not_prose" not in r.reasons and sum(r.line_rules.values()) <= 0.5 for r in other)


def test_published_figures(spark, models):
    text = "# one # two\n* item...\nA full line of words ends here with a stop.\nA full line of words ends here with a stop.\n\n12 -- the of"
    r = quality.text_quality(spark.createDataFrame([(1, text)], "rec_id long, text string"), models).first()
    assert (r.n_lines, r.n_tokens) == (5, 30) and r.hash_ratio == pytest.approx(2 / 30) and r.ellipsis_ratio == pytest.approx(1 / 30)
    assert r.alphabetic_words == pytest.approx(25 / 30) and r.newline_ratio == pytest.approx(5 / 30) and r.bullet_lines == pytest.approx(2 / 5) and r.terminal_lines == pytest.approx(3 / 5)
    assert r.duplicate_line_chars == pytest.approx(43 / sum(map(len, text.split("\n")))) and r.n_common >= 4 and "duplicate_line_chars" in r.reasons and "few_words" in r.reasons


def test_features():
    x = token_budget.features(["ab 1,é", "", "අ්"])
    f = dict(zip(token_budget.FEATURES[2:], x[0]))
    assert f["bytes"] == 7 and f["words"] == 2 and f["latin"] == 2 and f["digits"] == 1 and f["punctuation"] == 1 and f["extended_latin"] == 1 and f["blanks"] == 1
    assert f["runs"] == 4 and f["capitals"] == 0
    assert x[1].tolist() == [0] * 13 + [1] and x[2][token_budget.FEATURES.index("marks") - 2] == 1


def test_token_budget(spark, sf, models):
    df = read_table(spark, sf, "data_pipeline")
    e = token_budget.errors(df, models).collect()
    n, est = sum(r.n_tokens for r in e), sum(r.est_tokens for r in e)
    assert abs(est - n) < 0.05 * n
    b = token_budget.budget(df, models)
    assert b.columns == ["source", "lang", "domain", "n_records", "est_tokens"]
    assert b.agg(F.sum("n_records")).first()[0] == df.where("length(text) > 0").count()
    odd = spark.createDataFrame([(1, None, None, None), (2, "", "", ""), (3, "...", None, None), (4, "the road to the market is open", "http://WWW.a.test/", "s"), (4, "the road to the market is open", "http://WWW.a.test/", "s")], "rec_id long, text string, url string, source string")
    got = {(r.source, r.lang, r.domain): r.n_records for r in token_budget.budget(odd.withColumns({"domain": F.lit("clash"), "x": F.lit(1), "lang": F.lit("zz")}), models).collect()}
    assert got[None, "und", ""] == 1 and sum(got.values()) == 3 and got["s", "en", "a.test"] == 2
    assert token_budget.budget(odd.where("false"), models).count() == 0


def test_sample_is_bounded_by_language(spark, models, samples):
    """No language gives more than the bound; one with few texts stays near the weights of all."""
    en, si = ([t for x, t in samples if x == k] for k in ("en", "si"))
    rows = [(i, en[i % len(en)]) for i in range(300)] + [(1000 + i, si[i]) for i in range(30)]
    df = spark.createDataFrame(rows, "rec_id long, text string")
    table = token_budget.measured(df, models)
    m = token_budget.fit(df, table, sample=100).value
    assert set(m.weights) == {None, "en", "si"}
    x = np.vstack([np.column_stack([np.zeros((5, 2)), token_budget.features(en[:5])])])
    lone = token_budget.TokenModel(x, np.full(5, 40.0), ["en"] * 5, np.array([False, False, False, False, True]))
    assert np.allclose(lone.estimate(x, ["en"] * 5), 40, rtol=0.2) and np.allclose(lone.estimate(x, ["xx"] * 5), lone.estimate(x, [None] * 5))
    assert len(token_budget.TokenModel(np.zeros((0, len(token_budget.FEATURES))), np.zeros(0), [], np.zeros(0, bool)).estimate(np.zeros((0, len(token_budget.FEATURES))), [])) == 0


def test_short_lines_are_judged_without_the_prose_of_the_record(models, samples):
    en = [t for x, t in samples if x == "en"]
    made_up = "\n".join(f"{p}qz tbvn wr{p}p kkjh zzxc" for p in "abcdefghijklmnopqrst")
    assert kinds([f"{en[0]}\n{made_up}", "Xqz tbvn wrtp kkjh zzxc", "டை" * 30], models) == ["junk"] * 3
    short = "\n".join(" ".join(en[1].split()[i : i + 4]) for i in range(0, 12, 4))
    assert kinds([f"{en[0]}\n{short}", short], models) == [None, None]


def test_tables_with_pipes_without_frame_and_long_cells(models, samples):
    en = [t for x, t in samples if x == "en"][:6]
    names = "Bora Lumo Kevi Tasa Povu Gidi".split()
    cases = [
        "\n".join(f"{n} | {i} | 4.5" for i, n in enumerate(names)), "\n".join(f"{a} | {b} | {c}" for a, b, c in zip(names, names[1:], names[2:])),
        "\n".join(f"{i}\t12:30\t{t}" for i, t in enumerate(en)), "\n".join(f"| {i} | 12:30 | {t} |" for i, t in enumerate(en)), "\n".join(f"{i} | 12:30 | {t}" for i, t in enumerate(en[:2])),
    ]
    assert kinds(cases, models) == ["table"] * 5
    names = "Bora Lumo Kevi Tasa Povu Gidi Dane Gofi Wise Batu Lepo Nuga".split()
    assert kinds([" | ".join(names[:6]) + "\n" + " | ".join(names[6:]), "\n".join(en)], models) == ["list", None]
