"""Text that was decoded with the wrong encoding: found and restored as a substitution cipher."""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import cipher
from granary.llm.mixing import source_key
from granary.session import materialize

BATCH = 500
ROUNDS = 6
EDGE = "\n"
# Code pages that text is known to be misread in, and those it is written in.
SINGLE = ("cp1252", "latin-1", "cp1250", "cp1251", "cp1253", "cp1254", "cp1257", "cp437", "cp850", "cp852", "cp866", "koi8-r", "koi8-u", "mac-roman", "mac-latin2", "mac-cyrillic", "iso8859-2", "iso8859-5", "iso8859-9", "iso8859-15")
# Further pages; what they explain must also fit its neighbours, for their letters are those of sound words.
WIDE = ("cp874", "iso8859-11", "cp1255", "cp1256", "cp1258", "iso8859-3", "iso8859-4", "iso8859-6", "iso8859-7", "iso8859-8", "iso8859-10", "iso8859-13", "iso8859-14", "iso8859-16", "mac-greek", "mac-turkish", "mac-iceland", "mac-croatian", "mac-romanian", "cp720", "cp737", "cp775", "cp855", "cp856", "cp857", "cp858", "cp860", "cp861", "cp862", "cp863", "cp864", "cp865", "cp869", "cp1006", "cp1125", "koi8-t", "kz1048", "ptcp154", "hp-roman8")
# Limits for a symbol that no page explains: certainty of its letter, and different places in the source.
SURE_LETTER = 0.99
MIN_PLACES = 3
WRITTEN = ("cp1252", "mac-roman", "cp850", "cp437")
DOUBLE = ("gbk", "gb18030", "big5", "cp932", "euc-kr", "cp949")
BRAHMIC = "ऀ-෿"
FOREIGN = f"[^\x00-\x7f{BRAHMIC}\u200c\u200d]+"
# Joiners within a run are bytes of some page.
RUN = re.compile(f"{FOREIGN}(?:[\u200c\u200d]+{FOREIGN})*[\u200c\u200d]?")
TYPOGRAPHY = "‘’“”‚„–—…•€«»‌‍ "
SIGNS = "‘’“”–—€"
OPENING, CLOSING, DASHES = "‘“", "’”", "–—"


@functools.lru_cache(maxsize=None)
def _bytes_of(codec: str) -> dict[str, int]:
    """Byte of each character of a single-byte code page; bytes it leaves open stand for control characters."""
    out = {}
    for b in range(128, 256):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)
        out.setdefault(c, b)
    return out


def _sound(c: str) -> bool:
    """Characters that a wrongly decoded text can have been: scripts of the languages, Latin letters, typography."""
    o = ord(c)
    return 0x900 <= o <= 0xDFF or (0xA0 <= o <= 0x17F) or c in TYPOGRAPHY or 0x2010 <= o <= 0x2044 or 0x20A0 <= o <= 0x20BF


def _lost(c: str) -> bool:
    """Letters the replacement character may stand for; those of other scripts leave several of them."""
    return "\xc0" <= c < "\u0180" or c in SIGNS


def _length(b: int) -> int:
    return 2 if 0xC2 <= b <= 0xDF else 3 if 0xE0 <= b <= 0xEF else 4 if 0xF0 <= b <= 0xF4 else 0


@functools.lru_cache(maxsize=200_000)
def _utf8_units(run: str, codec: str) -> tuple[tuple[int, int, str], ...]:
    """(start, end, text) of the stretches of ``run`` whose bytes in ``codec`` are characters in UTF-8."""
    table = _bytes_of(codec)
    b = [table.get(c, -1) for c in run]
    out, i = [], 0
    while i < len(b):
        n = _length(b[i]) if b[i] >= 0 else 0
        if n and i + n <= len(b) and all(0x80 <= x <= 0xBF for x in b[i + 1 : i + n]):
            try:
                out.append((i, i + n, bytes(b[i : i + n]).decode("utf-8")))
                i += n
                continue
            except UnicodeDecodeError:
                pass
        i += 1
    return tuple(out)


def _decoded_units(run: str, depth: int = 3) -> list[tuple[int, int, str]]:
    """Units of a run that are bytes of UTF-8 read in some code page, by the page that explains most."""
    best: list[tuple[int, int, str]] = []
    score = 0
    for codec in SINGLE:
        units = [list(u) for u in _utf8_units(run, codec)]
        if not units:
            continue
        if depth > 1 and any(not (0x900 <= ord(u[2]) <= 0xDFF) for u in units):
            # Decoded once more where the result is itself garbled.
            flat = "".join(u[2] for u in units)
            again, merged, at = _decoded_units(flat, depth - 1), [], 0
            for s, e, t in again:
                merged += [tuple(u) for u in units[at:s]]
                merged.append((units[s][0], units[e - 1][1], t))
                at = e
            units = merged + [tuple(u) for u in units[at:]]
        good = [tuple(u) for u in units if all(map(_sound, u[2]))]
        n = sum(e - s for s, e, _ in good)
        if n > score:
            best, score = good, n
    if not best and run != (up := run[0].upper() + run[1:]) and len(up) == len(run):
        return _decoded_units(up, 1)
    return best


@functools.lru_cache(maxsize=200_000)
def _double_spans(run: str, codec: str) -> tuple[int, tuple[tuple[int, int, str], ...]]:
    """Bytes explained, and the shortest stretches of a run that begin and end with both a character of a
    double-byte page and a letter of UTF-8. Bytes of a letter that was lost in part are U+FFFD in the text of
    a stretch whose character they share, and else no part of one."""
    b, char = bytearray(), []
    for k, c in enumerate(run):
        try:
            x = c.encode(codec)
        except UnicodeError:
            x = b"\xff"
        b += x
        char += [k] * len(x)
    n = len(b)
    char.append(len(run))
    letters, i = [], 0
    while i < n:
        size = _length(b[i]) or (b[i] < 128)
        try:
            c = bytes(b[i : i + size]).decode("utf-8") if size and i + size <= n else ""
        except UnicodeDecodeError:
            c = ""
        if c and (_sound(c) or c < "\x80"):
            letters.append((i, i + size, c))
            i += size
        else:
            i += 1
    out: list[tuple[int, int, str]] = []
    at, text, end = -1, "", 0
    for k, (s, e, c) in enumerate(letters):
        if at < 0:
            at, text = char[s], "\ufffd" * bool(s and char[s - 1] == char[s])
        elif end < s:
            text += "\ufffd"
        text, end = text + c, e
        shared = char[e - 1] == char[e]
        if not shared or k + 1 == len(letters) or char[letters[k + 1][0]] != char[e - 1]:
            if any(x >= "\x80" and x != "\ufffd" for x in text):
                out.append((at, char[e - 1] + 1, text + "\ufffd" * shared))
            at = -1
    return sum(e - s for s, e, _ in letters), tuple(out)


def _double_units(text: str, start: int, end: int) -> list[tuple[int, int, str]]:
    """Units of a run read in a double-byte code page, by the page that explains most, half of the bytes at least."""
    run, best, score = text[start:end], (), 0
    for codec in DOUBLE:
        n, spans = _double_spans(run, codec)
        if n > score and spans and 2 * n >= len(run.encode(codec, "replace")):
            best, score = spans, n
    return [(start + s, start + e, t) for s, e, t in best]


def _swapped(c: str) -> str:
    o = ord(c)
    return chr((o & 255) << 8 | o >> 8) if o < 0x10000 and c not in "\u200c\u200d" else c


def _latin(turned: list[str]) -> bool:
    """Are swapped bytes a piece of Latin text? At least three characters, most of them ASCII letters, all of them sound."""
    plain = sum(c < "\x7f" and c.isalpha() for c in turned)
    return len(turned) > 2 and 2 * plain > len(turned) and all(" " <= c < "\x7f" or c == "\n" or _sound(c) for c in turned)


@functools.lru_cache(maxsize=100_000)
def single_letters(c: str) -> tuple[str, ...]:
    """Letters that one wrongly read byte may have been."""
    out = []
    for read in SINGLE:
        b = _bytes_of(read).get(c)
        if b is None:
            continue
        for written in WRITTEN:
            if written == read:
                continue
            try:
                x = bytes([b]).decode(written)
            except UnicodeDecodeError:
                continue
            if x != c and (x.isalpha() or x in SIGNS) and _sound(x) and x not in out:
                out.append(x)
    return tuple(out)


class Bigrams:
    """Smoothed character bigrams of all languages together; scripts keep them apart."""

    def __init__(self, pairs: Counter, words: dict[str, cipher.WordModel]):
        """pairs: neighbours in all passages with an edge before and after each; words: models of the languages."""
        self.words = words
        self.chars = sorted({c for p in pairs for c in p} | set(TYPOGRAPHY) | {EDGE, " "})
        self.at = {c: i for i, c in enumerate(self.chars)}
        n = len(self.chars)
        m = np.full((n, n), 0.02, np.float64)
        for (a, b), v in pairs.items():
            m[self.at[a], self.at[b]] += v
        self.p = (m / m.sum(1, keepdims=True)).astype(np.float32)
        self.seen = set(pairs)
        self.prior = (m.sum(0) / m.sum()).astype(np.float32)
        self.sound = {c for p in pairs for c in p}
        self.scripts = {ord(c) >> 7 for c in self.sound if 0x900 <= ord(c) <= 0xDFF}

    def fits(self, left: str, x: str, right: str) -> bool:
        """Can x stand between two characters? Letters need both pairs to be known."""
        gap_l, gap_r = left in " \n\t(", right in " \n\t.,;:!?)"
        if x in OPENING and gap_l and right.isalnum() and (x != "’"):
            return True
        if x in CLOSING and (left.isalnum() or left in ".,!?") and (gap_r or (x == "’" and right.isalpha())):
            return True
        if x in DASHES:
            return gap_l and right in " \n\t"
        if x == "€":
            return gap_l and right.isdigit()
        if (left, x) in self.seen and (x, right) in self.seen and not (gap_l and gap_r):
            return True
        if not ("a" <= left <= "z"):
            return False
        return gap_r and x.islower() and (x, " ") in self.seen or x == "é" and (gap_r or "a" <= right <= "z")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, fold, a, b, n), summed by task: neighbours in texts (no lang and fold) and in the words of a language and
    fold; by language alone, twice the characters of its words less all but blanks."""
    names = ["lang", "fold", "a", "b", "n"]
    kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.int64()]
    sums: dict[tuple[str | None, int | None], Counter] = {}

    def rows() -> pa.RecordBatch:
        out = [(*of, *(k or (None, None)), v) for of, c in sums.items() for k, v in c.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    for b in batches:
        for lang, fold, t in zip(*(b.column(k).to_pylist() for k in range(3))):
            s, line = EDGE + t.replace("\n", EDGE) + EDGE, cipher.word_line(t)
            sums.setdefault((None, None), Counter()).update(zip(s, s[1:]))
            sums.setdefault((lang, fold), Counter()).update(zip(line, line[1:]))
            sums.setdefault((lang, None), Counter())[None] += 2 * (len(line) - line.count(" ")) - len(t.replace(" ", ""))
        if sum(map(len, sums.values())) > 500_000:
            yield rows()
            sums.clear()
    if sums:
        yield rows()


def _least(rest: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if least := cipher.least_mean(zip(*(b.column(k).to_pylist() for k in range(3))), rest.value):
                yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.string()), pa.array(list(least.values()), pa.float64())], ["lang", "mean"])

    return run


def fit(samples: DataFrame) -> Broadcast:
    """Bigrams of all passages (columns lang, text), broadcast. Pairs are summed and passages judged in the executors: the
    alphabets bound what comes to the driver, not the passages. Equal passages are held out together.

    Languages whose texts are mostly ASCII have no model of words, as they leave too few symbols of a cipher."""
    context = samples.sparkSession.sparkContext
    rows = samples.where("text is not null").select(F.coalesce("lang", F.lit("")).alias("lang"), F.pmod(F.xxhash64("text"), F.lit(cipher.FOLDS)).cast("int").alias("fold"), "text")
    pairs: Counter = Counter()
    by: dict[str, list[Counter]] = {}
    foreign = set()
    for r in rows.mapInArrow(_counted, "lang string, fold int, a string, b string, n long").groupBy("lang", "fold", "a", "b").agg(F.sum("n").alias("n")).collect():
        if r.lang is None:
            pairs[r.a, r.b] = r.n
        elif r.fold is not None:
            by.setdefault(r.lang, [Counter() for _ in range(cipher.FOLDS)])[r.fold][r.a, r.b] = r.n
        elif r.n > 0:
            foreign.add(r.lang)
    words, rest = cipher.word_models({k: v for k, v in by.items() if k in foreign})
    if words:
        held = context.broadcast(rest)
        for r in rows.where(F.col("lang").isin(list(words))).mapInArrow(_least(held), "lang string, mean double").groupBy("lang").agg(F.min("mean").alias("mean")).collect():
            words[r.lang].limit = 1.1 * r.mean
        held.unpersist()
    return context.broadcast(Bigrams(pairs, words))


def _wide_units(text: str, start: int, end: int, model: Bigrams) -> list[tuple[int, int, str]]:
    """Units of a run by the further pages, where they explain at least half of it and most letters fit their neighbours."""
    run, best, score = text[start:end], [], 0
    for codec in WIDE:
        units = [u for u in _utf8_units(run, codec) if _sound(u[2])]
        n = sum(e - s for s, e, _ in units)
        if n <= score or 2 * n < len(run):
            continue
        before = {e: t for _, e, t in units} | {0: text[start - 1] if start else EDGE}
        after = {s: t for s, _, t in units} | {len(run): text[end] if end < len(text) else EDGE}
        if 2 * sum(model.fits(before.get(s, "�"), t, after.get(e, "�")) for s, e, t in units) > len(units):
            best, score = [(start + s, start + e, t) for s, e, t in units], n
    return best


@functools.lru_cache(maxsize=100_000)
def _other_script(c: str) -> bool:
    return c.isalpha() and not unicodedata.name(c, "LATIN").startswith(("LATIN", "FEMININE", "MASCULINE", "MODIFIER", "MICRO"))


def _in_word(left: str, right: str) -> bool:
    """Between letters, or at the end of a word in small letters."""
    return "a" <= left.lower() <= "z" and "a" <= right <= "z" or "a" <= left <= "z" and (not right or right in " \n\t.,;:!?)")


def cipher_units(text: str, model: Bigrams) -> list[tuple[int, int, str, tuple[str, ...], bool]]:
    """(start, end, unit, letters it can be by a code page, several characters?) of what is foreign in a text.

    A unit is the characters that one letter became. Characters that the samples or typography know are units
    only as part of a longer one."""
    out = []
    for m in RUN.finditer(text):
        run, at = m.group(), m.start()
        if all(c in model.sound or c in TYPOGRAPHY for c in run) and len(run) < 2:
            continue
        # Bytes of sound words can make letters of scripts that no sample has.
        units = [(at + s, at + e, t) for s, e, t in _decoded_units(run) if all(ord(c) >> 7 in model.scripts for c in t if 0x900 <= ord(c) <= 0xDFF)] if len(run) > 1 else []
        if not units:
            turned = [_swapped(c) for c in run]
            double = _double_units(text, at, m.end()) if any("\u3400" <= c <= "\u9fff" or "\uac00" <= c <= "\ud7a3" or "\ue000" <= c <= "\uf8ff" or "\uff61" <= c <= "\uff9f" for c in run) else []
            # Half-width kana of sound words can be Latin letters, too.
            double = [(s, e, t) for s, e, t in double if not all("\uff61" <= c <= "\uff9f" for c in text[s:e]) or any(0x900 <= ord(c) <= 0xDFF for c in t) or model.fits(text[s - 1] if s else EDGE, t, text[e] if e < len(text) else EDGE)]
            if sum(e - s for s, e, _ in double) > sum(0x900 <= ord(c) <= 0xDFF for c in turned):
                units = double
            elif any(0x900 <= ord(c) <= 0xDFF for c in turned) or _latin(turned):
                units = [(at + i, at + i + 1, c) for i, c in enumerate(turned) if 0x900 <= ord(c) <= 0xDFF or c < "\x7f" or (_sound(c) and run[i] not in model.sound)]
            else:
                units = [u for i, c in enumerate(run) if "\u3400" <= c <= "\u9fff" or "\uac00" <= c <= "\ud7a3" or "\ue000" <= c <= "\uf8ff" for u in _double_units(text, at + i, at + i + 1)]
        if len(run) > 1 and (n := sum(e - s for s, e, _ in units)) < len(run):
            wide = _wide_units(text, at, m.end(), model)
            units = wide if sum(e - s for s, e, _ in wide) > n else units
        if not units and 1 < len(run) < 4 and all(map(_other_script, run)) and _in_word(text[at - 1 : at], text[m.end() : m.end() + 1]):
            out.append((at, m.end(), run, (), False))
            continue
        covered = at
        for s, e, t in [*units, (m.end(), m.end(), "")]:
            for i in range(covered, s):
                c = text[i]
                if c == "�":
                    out.append((i, i + 1, c, tuple(x for x in model.chars if _lost(x)), False))
                elif c not in model.sound and c not in " ":
                    out.append((i, i + 1, c, single_letters(c), False))
            if e > s:
                out.append((s, e, text[s:e], (t,), True))
            covered = e
    return out


def _scan(model_b: Broadcast):
    """Rows kind "pair" (src, unit, side, next character or unit, count), summed by task; of runs that no page explains
    such pairs of symbols, with 10 and the width of the symbols as side, and "word" with the runs of a document; "doc"
    (id, src, unit, letters that fit in some place of the document), "exact" if the whole unit is explained by a page, or for a unit that no page explains "place"
    with the pairs of neighbours it has inside words of the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, pairs = model_b.value, Counter()
        names = ["kind", "id", "src", "unit", "side", "other", "n", "letters"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.list_(pa.string())]

        def rows(cols: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        for b in batches:
            out: list[list] = [[] for _ in names]
            for i, src, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                units = cipher_units(text, model)
                if not units:
                    continue
                # Runs that no page explains hold many units of one character; other documents have no cipher to learn from.
                odd = []
                if sum(not u[4] for u in units) >= cipher.LEAST_SYMBOLS:
                    covered = {k for u in units if u[4] for k in range(u[0], u[1])}
                    for m in cipher.RUN.finditer(text):
                        if any(c not in model.sound and c not in TYPOGRAPHY for c in m.group()) and 2 * sum(k in covered for k in range(*m.span())) < m.end() - m.start():
                            odd.append(m)
                if odd:
                    runs = [m.group() for m in odd]
                    lead = cipher.lead_of(runs)
                    of: dict[int, list[list[str]]] = {}
                    for r in runs:
                        width, marks = cipher.symbols(r, lead)
                        of.setdefault(width, []).append(marks)
                    for width, words in of.items():
                        for w in words:
                            for a, b2 in cipher._pairs(w):
                                pairs[src, a, 10 + width, b2] += 1
                        for c, v in zip(out, ("word", i, src, None, 10 + width, None, None, ["\x00".join(w) for w in words])):
                            c.append(v)
                # What a page makes a whole unit of is known; only its outer letters matter to the others.
                ends = {u[1]: u[3][0][-1] if u[4] else u[2] for u in units}
                starts = {u[0]: u[3][0][0] if u[4] else u[2] for u in units}
                found: dict[str, set[str]] = {}
                places: dict[str, set[str]] = {}
                exact = {u for _, _, u, _, several in units if several}
                for s, e, u, letters, several in units:
                    left = text[s - 1] if s else EDGE
                    right = text[e] if e < len(text) else EDGE
                    if not several:
                        pairs[src, u, 0, ends.get(s, left)] += 1
                        pairs[src, u, 1, starts.get(e, right)] += 1
                    ok = found.setdefault(u, set())
                    if several or u == "�":
                        ok.update(letters)
                    elif not letters:
                        if _in_word(left, right) and all(map(_other_script, u)):
                            places.setdefault(u, set()).add(left + right)
                    else:
                        ok.update(x for x in letters if x not in ok and model.fits(left, x, right))
                for u, ok in found.items():
                    if ok:
                        for c, v in zip(out, ("exact" if u in exact else "doc", i, src, u, None, None, None, sorted(ok))):
                            c.append(v)
                for u, ok in places.items():
                    for c, v in zip(out, ("place", i, src, u, None, None, None, sorted(ok))):
                        c.append(v)
            if out[0]:
                yield rows(out)
            if len(pairs) > 500_000:
                yield rows([list(c) for c in zip(*(("pair", None, k[0], k[1], k[2], k[3], v, None) for k, v in pairs.items()))])
                pairs.clear()
        if pairs:
            yield rows([list(c) for c in zip(*(("pair", None, k[0], k[1], k[2], k[3], v, None) for k, v in pairs.items()))])

    return run


def decipher(pairs: pd.DataFrame, model: Bigrams, rounds: int = ROUNDS) -> pd.DataFrame:
    """Letters of the units of one source by expectation-maximization against the bigrams.

    pairs: unit, side (0: what stands before, 1: after), other (a character or a unit), n. Every unit has a
    distribution over letters: those that some code page makes of it, or all but ASCII where there are none. Each round weighs the letters by the pairs with known
    neighbours and with the expected letters of unknown ones. Result: unit, letter (the likeliest), p."""
    units = sorted(set(pairs["unit"]))
    rounds = max(rounds, 0)
    # What a page makes several letters of is known; only its outer letters matter to the others.
    whole = {u: x[0] for u in units if len(x := _letters(u)) == 1 and len(x[0]) > 1}
    units = [u for u in units if u not in whole]
    edge = np.where(pairs["side"] == 0, -1, 0)
    other = [whole[x][k] if x in whole else x for x, k in zip(pairs["other"], edge)]
    pairs = pairs.assign(other=other)[~pairs["unit"].isin(whole)]
    settled = pd.DataFrame({"unit": list(whole), "letter": list(whole.values()), "p": 1.0})
    if not units:
        return settled
    at = {u: i for i, u in enumerate(units)}
    chars = list(model.chars)
    extra = sorted({x for u in units for x in _letters(u) if x not in model.at and len(x) == 1})
    n_old, n = len(chars), len(chars) + len(extra)
    chars += extra
    p = np.full((n, n), 1 / n, np.float32)
    p[:n_old, :n_old] = model.p
    p[:n_old, n_old:] = model.p.min()
    logp = np.log(p)
    index = {c: i for i, c in enumerate(chars)}
    prior = np.concatenate([model.prior, np.full(len(extra), model.prior.min(), np.float32)])
    prior = prior / prior.sum()
    start = np.zeros((len(units), n), np.float32)
    foreign = [j for j, x in enumerate(chars) if x >= "\x80"]
    for u, i in at.items():
        known = [index[x] for x in _letters(u) if x in index]
        if u == "�":
            known = [j for j, x in enumerate(chars) if _lost(x)]
        if known:
            start[i, known] = prior[known] + prior[known].mean()
        else:
            start[i, foreign] = prior[foreign]
    logs = np.where(start > 0, np.log(np.maximum(start, 1e-12)), -1e9).astype(np.float32)
    u = pairs["unit"].map(at).to_numpy()
    side, w = pairs["side"].to_numpy(), pairs["n"].to_numpy(np.float32)
    other_u = pairs["other"].map(lambda x: at.get(x, -1)).to_numpy()
    other_c = pairs["other"].map(lambda x: index.get(x, -1)).to_numpy()
    fixed = np.zeros_like(logs)
    native = (other_u < 0) & (other_c >= 0)
    for s, m in ((0, logp), (1, logp.T)):
        k = native & (side == s)
        np.add.at(fixed, u[k], w[k, None] * m[other_c[k]])
    q = start / start.sum(1, keepdims=True)
    for _ in range(rounds):
        score = logs + fixed
        for s, m in ((0, p), (1, p.T)):
            k = np.nonzero((other_u >= 0) & (side == s))[0]
            if len(k):
                expected = np.log(np.maximum(q @ m, 1e-12))
                for lo in range(0, len(k), 20_000):
                    r = k[lo : lo + 20_000]
                    np.add.at(score, u[r], w[r, None] * expected[other_u[r]])
        score -= score.max(1, keepdims=True)
        new = np.exp(np.maximum(score, -60))
        new /= new.sum(1, keepdims=True)
        if np.abs(new - q).max() < 1e-3:
            q = new
            break
        q = new
    best = q.argmax(1)
    return pd.concat([pd.DataFrame({"unit": units, "letter": [chars[i] for i in best], "p": q.max(1).astype(float)}), settled], ignore_index=True)


@functools.lru_cache(maxsize=100_000)
def _letters(unit: str) -> tuple[str, ...]:
    """Letters a unit can be by the code pages."""
    if len(unit) > 1:
        d = _decoded_units(unit)
        t = d[0][2] if len(d) == 1 and d[0][:2] == (0, len(unit)) else "".join(x[2] for x in _double_units(unit, 0, len(unit)))
        return (t,) if t else tuple(dict.fromkeys(x[0][2] for c in WIDE if (x := _utf8_units(unit, c)) and x[0][:2] == (0, len(unit)) and _sound(x[0][2])))
    t = _swapped(unit)
    if 0x900 <= ord(t) <= 0xDFF or (ord(unit) > 0xFFF and (" " <= t < "\x7f" or t == "\n" or _sound(t))):
        return (t,)
    d = _double_units(unit, 0, 1)
    return (d[0][2],) if d else single_letters(unit)


class Garbled:
    """``mapping``: src, unit, letter, p. ``units``: id, src, unit, letter of the units that were wrongly decoded. ``keys``: id, width,
    symbol, letter of the unknown ciphers of documents."""

    def __init__(self, mapping: DataFrame, units: DataFrame, keys: DataFrame):
        self.mapping, self.units, self.keys = mapping, units, keys

    def documents(self) -> DataFrame:
        return self.units.select("id").union(self.keys.select("id")).distinct()


def _unknown(scanned: DataFrame, model: Broadcast, rounds: int) -> DataFrame:
    """(id, width, lang, key) of documents that the key learned for their source and width turns into a language."""
    pairs = scanned.where("kind = 'pair' and side > 10").groupBy("src", "side", F.col("unit").alias("u"), F.col("other").alias("v")).agg(F.sum("n").alias("n"))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        key = cipher.learn(pdf, model.value.words, rounds)
        if not len(key):
            return pd.DataFrame(columns=["src", "side", "lang", "symbols", "letters"], dtype=object)
        return pd.DataFrame({"src": [pdf["src"].iloc[0]], "side": [pdf["side"].iloc[0]], "lang": [key["lang"].iloc[0]], "symbols": [key["symbol"].tolist()], "letters": [key["letter"].tolist()]})

    # One row for each source with a key; the group of a source is bounded by the square of its symbols.
    keys = materialize(pairs.groupBy("src", "side").applyInPandas(learn, "src string, side int, lang string, symbols array<string>, letters array<string>"), "unknown-keys")
    words = scanned.where("kind = 'word'").select("id", "src", "side", F.col("letters").alias("words")).join(keys, ["src", "side"])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value.words
        for b in batches:
            keep = []
            for i, (words, lang, marks, letters) in enumerate(zip(*(b.column(k).to_pylist() for k in range(2, 6)))):
                if cipher.judge([w.split("\x00") for w in words], dict(zip(marks, letters)), m[lang]):
                    keep.append(i)
            k = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(j).take(k) for j in (0, 1, 4, 5)], ["id", "side", "symbols", "letters"])

    found = words.select("id", "side", "words", "lang", "symbols", "letters").mapInArrow(judged, "id long, side int, symbols array<string>, letters array<string>")
    return materialize(found, "unknown")


def find_garbled(df: DataFrame, model: Broadcast, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", rounds: int = ROUNDS, unknown_rounds: int = cipher.ROUNDS) -> Garbled:
    """Code-page swaps as substitution ciphers, one key for each source.

    Foreign characters are grouped into units, the cipher's symbols. How often each stands next to which
    character is summed over all documents of a source, and expectation-maximization against the language bigrams learns
    from these sums. There are two kinds of key.

    Swaps of unknown pages: runs that no page explains are words of symbols (single characters, or threes that share a
    lead, as bytes of UTF-8 do). The key of a source is the likeliest one under the bigrams of any language; it
    counts if its letters are sure and what comes out is as likely as held-out passages; so must each document be.

    Known pages: a document is garbled if the letter learned for one of its
    units is one that a code page makes of the unit and that fits the place: the exact check. A symbol of another
    script inside words that no page explains counts if its letter is sure, and fits several different places,
    most of those it has in the source. The replacement character always counts.

    Null ids, null texts and texts of ASCII only take no part; a null source is the empty one; a repeated id is one document.
    Sums by source and symbol are bounded by the characters there are, not by the rows."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), source_key(F.col(source_col)).alias("src"), F.col(text_col).alias("t"))
    rows = rows.where("id is not null and t is not null").where(F.col("t").rlike(r"[^\x00-\x7f]"))
    schema = "kind string, id long, src string, unit string, side int, other string, n long, letters array<string>"
    scanned = materialize(rows.mapInArrow(_scan(model), schema), "cipher")
    keys = _unknown(scanned, model, unknown_rounds)
    pairs = scanned.where("kind = 'pair' and side < 10").groupBy("src", "unit", "side", "other").agg(F.sum("n").alias("n"))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        return decipher(pdf, model.value, rounds).assign(src=pdf["src"].iloc[0])[["src", "unit", "letter", "p"]]

    mapping = materialize(pairs.groupBy("src").applyInPandas(learn, "src string, unit string, letter string, p double"), "cipher-key")
    exact = scanned.where("kind = 'exact'").select("id", "src", "unit", F.col("letters")[0].alias("letter"))
    docs = scanned.where("kind = 'doc'").select("id", "src", "unit", "letters")
    # The key has no proven bound, so it is not broadcast.
    hit = docs.join(mapping.hint("merge"), ["src", "unit"]).where(F.array_contains("letters", F.col("letter")))
    hit = hit.select("id", "src", "unit", "letter").union(exact)
    places = scanned.where("kind = 'place'").select("id", "src", "unit", "letters")
    seen = places.select("src", "unit", F.explode("letters").alias("place")).distinct()

    def fitting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            yield b.filter(pa.array([m.fits(p[0], x, p[1]) for x, p in zip(b.column(2).to_pylist(), b.column(3).to_pylist())], pa.bool_()))

    sure = mapping.where(F.col("p") >= SURE_LETTER).hint("merge")
    placed = seen.join(sure, ["src", "unit"]).select("src", "unit", "letter", "place")
    fit_n = placed.mapInArrow(fitting, "src string, unit string, letter string, place string").groupBy("src", "unit", "letter").agg(F.count("*").alias("fit"))
    all_n = seen.groupBy("src", "unit").agg(F.count("*").alias("n"))
    learned = fit_n.join(all_n.hint("merge"), ["src", "unit"]).where((2 * F.col("fit") > F.col("n")) & (F.col("fit") >= MIN_PLACES))
    hit = hit.select("id", "src", "unit", "letter").union(places.join(learned.hint("merge"), ["src", "unit"]).select("id", "src", "unit", "letter"))
    return Garbled(mapping, hit.distinct(), keys)


def restore(df: DataFrame, found: Garbled, model: Broadcast, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, restored text and number of units replaced, for each garbled document. Units become private
    characters and are put back with ``translate``; what has no letter stays as it is, and the
    replacement character gets its likeliest letter. Where the key of an unknown cipher fits a document, it goes first."""
    units = found.units.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("unit", "letter"))).alias("key"))
    unknown = found.keys.groupBy("id").agg(F.map_from_entries(F.collect_set(F.struct("side", F.struct("symbols", "letters")))).alias("widths"))
    keys = units.join(unknown, "id", "full_outer")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).join(keys, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            ids, texts, counts = b.column(0).to_pylist(), [], []
            for t, key, widths in zip(*(b.column(k).to_pylist() for k in (1, 2, 3))):
                n = 0
                if widths:
                    t, n = cipher.decode(t, {side - 10: dict(zip(x["symbols"], x["letters"])) for side, x in dict(widths).items()})
                key = dict(key or ())
                code = {u: chr(0xF0000 + i) for i, u in enumerate(key)}
                parts, at = [], 0
                for s, e, u, _, _ in cipher_units(t, m) if key else ():
                    if u in code:
                        parts += [t[at:s], code[u]]
                        at, n = e, n + 1
                texts.append(("".join(parts) + t[at:]).translate({ord(code[u]): x for u, x in key.items()}))
                counts.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], [id_col, text_col, "n_restored"])

    return rows.select("id", "t", "key", "widths").mapInArrow(run, f"{id_col} long, {text_col} string, n_restored long")
