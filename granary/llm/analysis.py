"""One pass over texts: lines, sentences and words, what is prose and what is not, and the language of each part."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np

from granary.llm.langmodel import WORD, LanguageModels, WordTable, segment_sum

SENTENCE_END = re.compile(r"(?<=[.!?।॥…|])[\"'”’»)\]]*\s+")
MIN_WORDS = 5
SWITCH_COST = 5.0
MARKER = re.compile(r"^\s*(?:[*·•+»◦‣▪●○■□–—-]+|#\s?\d+|§\s*\d+|[(\[]?\d{1,4}\s*[.)\]:–-]+)\s+")
TAIL = re.compile(r"\s*(?:[-–—:=|]+\s*)?(?:(?:[A-Z]{1,3}\.?|[$€£¥₹]|රු|ரூ)\.?\s?\d[\d.,]*|\d[\d.,]*\s?[%€$₹]?|(?:https?://|www\.)\S+)\s*$")
INLINE = re.compile(r"\s*(?:::|[;•·|]|(?<=[^\d\s]),|,(?=\s)|\s[/–-](?=\s)|\s»)\s*")
RULE_LINE = re.compile(r"^[\s|+:=\-_–—]{3,}$")
# Delimiters of tables; those of items in a row have blanks after them.
CELLS = (("\t", re.compile(r"\t")), ("|", re.compile(r"\s*\|\s*")), (";", re.compile(r";(?=\S|$)")), (",", re.compile(r",(?=\S|$)")), ("  ", re.compile(r"\s{2,}")))
MAX_ITEM_WORDS = 3
MIN_RUN = 3
MIN_INLINE = 5
MIN_INLINE_RUN = 3
SURE_SHARE = 0.35
KNOWN_SHARE = 0.2
TOP4_SHARE = 0.6
LONG_WORD = 30
MIN_SHORT_WORDS = 4
MAX_WORD_CELLS = 5


class Analysis:
    """Numbers of a batch. ``line_*`` by line that is not blank, ``sent_*`` by sentence, ``doc_*`` by text."""

    def __init__(self, texts: list[str | None], words: WordTable):
        self.texts = texts
        self.lines: list[str] = []
        line_doc, sents, sent_line = [], [], []
        for d, t in enumerate(texts):
            if not t:
                continue
            for line in t.split("\n"):
                if not line or line.isspace():
                    continue
                at = len(self.lines)
                self.lines.append(line)
                line_doc.append(d)
                for s in SENTENCE_END.split(line):
                    sents.append(WORD.findall(s.lower()))
                    sent_line.append(at)
        self.line_doc, self.sent_line = np.array(line_doc, np.int64), np.array(sent_line, np.int64)
        ids = words.lookup(sents)
        self.ids = ids
        self.sent_n = np.fromiter(map(len, sents), np.int64, len(sents))
        self.sent_score = segment_sum(words.scores[ids], self.sent_n)
        self.sent_chars = segment_sum(words.size[ids], self.sent_n)
        per_line = np.bincount(self.sent_line, minlength=len(self.lines))
        self.line_n = segment_sum(self.sent_n, per_line).astype(np.int64)
        known = segment_sum(words.known[ids], self.sent_n)
        self.line_known = segment_sum(known, per_line)
        self.line_known_max = self.line_known.max(1) if len(self.line_known) and self.line_known.shape[1] else np.zeros(len(self.lines))
        self.line_common = segment_sum(segment_sum(words.common[ids], self.sent_n), per_line)  # by language
        self.line_letters = segment_sum(self.sent_chars - self.sent_n, per_line)
        self.line_first = np.searchsorted(self.line_doc, np.arange(len(texts) + 1))
        self.sent_first = np.searchsorted(self.sent_line, self.line_first)
        self.word_first = np.concatenate([[0], np.cumsum(self.line_n)])


def _cells(line: str) -> tuple[int, ...]:
    """Number of cells by delimiter, 0 where there are fewer than three, or one is long and the delimiter is one that prose has, too."""
    s = line.strip()
    out = []
    for sign, p in CELLS:
        if sign not in s:
            out.append(0)
            continue
        c = p.split(s.strip("|").strip() if sign == "|" else s)
        out.append(len(c) if len(c) >= 3 and (sign in "\t|" or max(x.count(" ") for x in c) < 5) else 0)
    return tuple(out)


def _piped(rows: list[str]) -> bool:
    """Are rows that agree in their pipes a table? Broken rows of items agree, too, so rows without frame are one
    if they are three or more with few cells, or have long cells or a column of figures."""
    cells = [CELLS[1][1].split(x.strip("|").strip()) for x in rows]
    if all(x[0] == "|" for x in rows) or (len(rows) >= 3 and len(cells[0]) <= MAX_WORD_CELLS) or any(y.count(" ") >= 5 for x in cells for y in x):
        return True
    return any(all(any(map(str.isdigit, y)) for y in column) for column in zip(*cells))


def _item(line: str) -> bool:
    x = line.strip()
    m = MARKER.match(x)
    y = TAIL.sub("", x[m.end():] if m else x)
    k = len(WORD.findall(y))
    return 1 <= k <= MAX_ITEM_WORDS and k >= len(y.split()) - 2 and not y.endswith(("!", "?", "।"))


def _items_in_row(line: str) -> int:
    """Number of items of one to three words in a row; 0 if a fifth of the parts are something else."""
    parts = [q for q in INLINE.split(line.strip()) if q]
    good = sum(1 <= len(WORD.findall(q)) <= MAX_ITEM_WORDS for q in parts)
    return len(parts) if len(parts) >= MIN_INLINE_RUN and good >= 0.8 * len(parts) else 0


def _few_words(a: Analysis, lo: int, lines: list[int]) -> bool:
    """Do four words make up most of at least twelve words of these lines?"""
    own: list[int] = []
    for i in lines:
        own += a.ids[a.word_first[lo + i] : a.word_first[lo + i + 1]].tolist()
    return _repeats(own)


def _repeats(own: list) -> bool:
    return len(own) >= 12 and len(set(own)) <= 0.6 * len(own) and sum(c for _, c in Counter(own).most_common(4)) > TOP4_SHARE * len(own)


# What a line that is not prose is, and by which rule.
LINE_RULES = {"cells": "table", "items": "list", "items_in_row": "list", "repeated_words": "junk", "no_words": "junk", "unknown_words": "junk", "few_letters": "junk", "unknown_short_lines": "junk"}


def nonprose(a: Analysis, d: int) -> tuple[str | None, dict[str, int]]:
    """Kind of text d ("list", "table", "junk", or None for prose) and its characters by the rule of LINE_RULES their
    line fails ("prose" for none).

    Rows of three or more cells that agree in delimiter and number with a neighbour are a table. Runs of at
    least three lines that, without marker, price or address, have one to three words are a list, and so are
    lines with five or more such items in a row and runs of three lines with three or more. Of the rest, lines
    whose words are not of any language known, lines without words, and lines in which four words make up
    most, are junk. A text has a kind if more than half of its characters, blank lines not counted, are not
    prose; the kind is the one with most of them."""
    lo, hi = a.line_first[d], a.line_first[d + 1]
    n = hi - lo
    kind = [""] * n  # the rule a line fails
    lines = a.lines[lo:hi]
    words = a.line_n[lo:hi].tolist()
    known = a.line_known_max[lo:hi].tolist()
    sure = [w >= 6 and k >= SURE_SHARE * w for w, k in zip(words, known)]
    solid = []
    cells = {}
    for i, x in enumerate(lines):
        if not RULE_LINE.match(x):
            solid.append(i)
            if not sure[i] or "\t" in x or "|" in x:
                c = _cells(x)
                if sure[i]:
                    c = (*c[:2], 0, 0, 0)
                if any(c):
                    cells[i] = c
    # Tables.
    if cells:
        none = (0,) * len(CELLS)
        for p in range(len(CELLS)):
            i = 0
            while i < len(solid):
                c, j = cells.get(solid[i], none)[p], i + 1
                if c < 3:
                    i += 1
                    continue
                while j < len(solid) and cells.get(solid[j], none)[p] >= 3 and abs(cells[solid[j]][p] - c) <= (p >= 3):
                    j += 1
                if j - i >= 2 and (CELLS[p][0] != "|" or _piped([lines[k].strip() for k in solid[i:j]])):
                    for k in solid[i:j]:
                        kind[k] = kind[k] or "cells"
                i = j
        ruled = set(range(n)) - set(solid)
        for i in ruled:
            if (i and kind[i - 1] == "cells") or (i + 1 < n and kind[i + 1] == "cells"):
                kind[i] = "cells"
    # Lists: items on lines of their own, then in a row.
    row = [0] * n
    for test, least in ((_item, MIN_RUN), (_items_in_row, MIN_INLINE_RUN)):
        run: list[int] = []
        for i in range(n + 1):
            hit = 0
            if i < n and not kind[i]:
                if test is _item:
                    hit = (words[i] <= 12 and not sure[i]) and test(lines[i])
                elif words[i] >= 3 and not (sure[i] and words[i] < 8):
                    x = lines[i]
                    hit = row[i] = test(x) if x.count(",") + x.count(";") + x.count("•") + x.count("·") + x.count("|") + x.count("::") + x.count(" / ") + x.count(" - ") + x.count(" – ") + x.count("»") >= 2 else 0
            if hit:
                run.append(i)
                continue
            if len(run) >= least:
                for k in run:
                    kind[k] = "items" if test is _item else "items_in_row"
            run = []
    for i in range(n):
        if not kind[i] and row[i] >= MIN_INLINE:
            kind[i] = "items_in_row"
    # Junk: first what looks like a list but says the same few words again and again.
    listed = [i for i in range(n) if kind[i].startswith("items")]
    if listed and _repeats([w for i in listed for w in WORD.findall(TAIL.sub("", lines[i].strip()).lower())]):
        for i in listed:
            kind[i] = "repeated_words"
    else:
        for i in listed:
            if words[i] >= 12 and _few_words(a, lo, [i]):
                kind[i] = "repeated_words"
    rest = [i for i in range(n) if not kind[i]]
    for i in rest:
        w, line = words[i], lines[i]
        if w >= 6 and known[i] >= KNOWN_SHARE * w:
            if w >= 12 and _few_words(a, lo, [i]):
                kind[i] = "repeated_words"
            continue
        chars = len(line) - line.count(" ")
        if w == 0:
            kind[i] = "no_words" if chars >= 4 else ""
        elif w >= 6 or chars > 60 or chars >= LONG_WORD * w:
            kind[i] = "unknown_words" if known[i] < KNOWN_SHARE * w else ""
        elif a.line_letters[lo + i] < 0.3 * chars and chars >= 8:
            kind[i] = "few_letters"
    # Short lines together: those that are prose by themselves say nothing about them.
    short = [i for i in rest if not kind[i] and words[i] < 6]
    w = sum(words[i] for i in short)
    if short and w >= MIN_SHORT_WORDS and a.line_known[[lo + i for i in short]].sum(0).max() < (KNOWN_SHARE * w if w >= 8 else 1):
        for i in short:
            kind[i] = "unknown_short_lines"
    chars_by: Counter = Counter()
    for k, x in zip(kind, lines):
        chars_by[k or "prose"] += len(x.strip())
    by_kind: Counter = Counter()
    for k, v in chars_by.items():
        if k != "prose":
            by_kind[LINE_RULES[k]] += v
    total = sum(chars_by.values())
    if total and 2 * sum(by_kind.values()) > total:
        return max(sorted(by_kind), key=by_kind.get), dict(chars_by)
    return None, dict(chars_by)


@dataclass(frozen=True)
class Calibration:
    """What held-out passages say about scores. ``limit``: highest cross-entropy per character that is accepted, by
    language. ``slack``: a text judged as a whole may exceed it by this share over the root of its characters.
    ``scale`` and ``power``: log probabilities per character count as if scale * characters ** power were independent."""

    limit: np.ndarray
    slack: float
    scale: float
    power: float

    def accepts(self, k: int, score: np.ndarray, chars: float) -> bool:
        return bool(chars > 0 and -score[k] / chars <= self.limit[k] * (1 + self.slack / np.sqrt(chars)))

    def confidence(self, score: np.ndarray, chars: float) -> float:
        """Posterior of the best language."""
        n = max(chars, 1)
        z = score / n * (self.scale * n**self.power)
        return float(1 / np.exp(z - z.max()).sum())


def languages(a: Analysis, d: int, models: LanguageModels, cal: Calibration) -> tuple[list[tuple[int, float, int, int]], int | None, float]:
    """Segments of text d: (language, confidence, first sentence, sentences), and language and confidence of all.

    The lowest cross-entropy per character decides; sentences of fewer than five words, and those whose lowest
    cross-entropy is above the calibrated limit of the language, carry no vote and belong to what surrounds
    them. A text none of whose sentences has a vote is judged as a whole, with the limit that goes with its length; if
    it is above that, too, it is of no language known: no segment, None and 0. A change of language costs a fixed number
    of nats, so one odd sentence needs real evidence."""
    lo, hi = a.sent_first[d], a.sent_first[d + 1]
    if hi == lo or not models.langs:
        return [], None, 0.0
    s, n, c = a.sent_score[lo:hi], a.sent_n[lo:hi], a.sent_chars[lo:hi]
    if not n.sum():
        return [], None, 0.0
    best = s.argmax(1)
    ok = (n >= MIN_WORDS) & (-s.max(1) <= cal.limit[best] * np.maximum(c, 1))
    votes = np.nonzero(ok)[0]
    if len(votes) == 0:
        total, chars = s.sum(0), c.sum()
        k = int(total.argmax())
        if not cal.accepts(k, total, chars):
            return [], None, 0.0
        p = cal.confidence(total, chars)
        return [(k, p, 0, hi - lo)], k, p
    total, chars = s[ok].sum(0), c[ok].sum()
    if (best[votes] == best[votes[0]]).all():
        k = int(total.argmax())
        p = cal.confidence(total, chars)
        return [(k, p, 0, hi - lo)], k, p
    cost = s[votes[0]].copy()
    from_ = []
    for i in votes[1:]:
        top = int(cost.argmax())
        jump = cost[top] - SWITCH_COST
        stay = cost >= jump
        from_.append(np.where(stay, np.arange(len(cost)), top))
        cost = np.where(stay, cost, jump) + s[i]
    path = [int(cost.argmax())]
    for f in reversed(from_):
        path.append(int(f[path[-1]]))
    path.reverse()
    out: list[list] = []
    for i, k in zip(votes, path):
        if out and out[-1][0] == k:
            out[-1][1] += s[i]
            out[-1][2] += c[i]
        else:
            out.append([k, s[i].copy(), c[i], int(i) if out else 0])
    ends = [o[3] for o in out[1:]] + [hi - lo]
    return [(o[0], cal.confidence(o[1], o[2]), o[3], e - o[3]) for o, e in zip(out, ends)], int(total.argmax()), cal.confidence(total, chars)


def held_out(samples: list[tuple[str, str]], folds: int = 5) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Languages, and scores, characters, true language and words of pieces of samples under models that do not know
    them: whole passages (words = 0) and their runs of 1, 2, 4, 8 and 16 words."""
    langs = sorted({x for x, t in samples if x and t})
    score, chars, true, words = [np.zeros((0, len(langs)))], [np.zeros(0)], [np.zeros(0, int)], [np.zeros(0, int)]
    for f in range(folds):
        m = LanguageModels([x for i, x in enumerate(samples) if i % folds != f])
        if m.langs != langs:
            continue
        table = WordTable(m)
        for size in (0, 1, 2, 4, 8, 16):
            pieces, of = [], []
            for i, (lang, text) in enumerate(samples):
                if i % folds != f or not lang or not text:
                    continue
                w = WORD.findall(text.lower())
                for lo in range(0, len(w), size or max(1, len(w))):
                    if size == 0 or lo + size <= len(w):
                        pieces.append(w[lo : lo + size] if size else w)
                        of.append(langs.index(lang))
            ids, n = table.lookup(pieces), np.fromiter(map(len, pieces), np.int64, len(pieces))
            score.append(segment_sum(table.scores[ids], n))
            chars.append(segment_sum(table.size[ids], n))
            true.append(np.array(of, int))
            words.append(np.full(len(pieces), size))
    return langs, np.concatenate(score), np.concatenate(chars), np.concatenate(true), np.concatenate(words)


def calibrate(samples: list[tuple[str, str]]) -> Calibration:
    """Limits: the largest cross-entropy of a held-out passage under its own language, and a margin of a tenth. Slack:
    what one in a hundred of the runs of one to eight words needs above that. Scale and power: those under which
    the held-out pieces are most probable, among a grid."""
    langs, score, chars, true, words = held_out(samples)
    top = np.zeros(len(langs))
    own = score[np.arange(len(true)), true] if len(true) else np.zeros(0)
    entropy = -own / np.maximum(chars, 1)
    for k in range(len(langs)):
        mine = entropy[(true == k) & (words == 0) & (chars > 0)]
        top[k] = mine.max() if len(mine) else 0
    limit = np.where(top > 0, top * 1.1, np.inf)
    short = (words > 0) & (words <= 8)
    over = (entropy[short] / limit[true[short]] - 1) * np.sqrt(chars[short])
    slack = max(0.0, float(np.quantile(over, 0.99))) if len(over) else 0.0
    best = (np.inf, 1.0, 0.5)
    n = np.maximum(chars, 1)
    for power in np.arange(0.3, 1.01, 0.1):
        for scale in 2.0 ** np.arange(-5, 4.1, 0.5):
            z = score / n[:, None] * (scale * n**power)[:, None]
            z = z - z.max(1, keepdims=True)
            loss = float((np.log(np.exp(z).sum(1)) - z[np.arange(len(true)), true]).mean()) if len(true) else 0.0
            best = min(best, (loss, float(scale), float(power)))
    return Calibration(limit, slack, best[1], best[2])


def reliability(samples: list[tuple[str, str]]) -> list[tuple[float, int, float, float]]:
    """(lower edge, pieces, mean confidence, share right) by confidence, on pieces held out from the models, with a
    calibration by every other passage."""
    langs, score, chars, true, _ = held_out(samples)
    cal = calibrate(samples[::2])
    p = np.array([cal.confidence(s, c) for s, c in zip(score, chars)])
    right = score.argmax(1) == true
    edges = (0.0, 0.5, 0.7, 0.8, 0.9, 0.95, 0.99, 1.01)
    return [(lo, int(k.sum()), float(p[k].mean()), float(right[k].mean())) for lo, hi in zip(edges, edges[1:]) if (k := (p >= lo) & (p < hi)).any()]
