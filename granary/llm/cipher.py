"""Unknown code-page swaps of texts in scripts of their own, as substitution ciphers learned by expectation-maximization."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pandas as pd

RUN = re.compile(r"[^\x00-\x7f]+")
BLANK = " "
ROUNDS = 120
STARTS = 3
FIRST_ROUNDS = 12
FLOOR = 1e-9
# A key counts if it rests on so many pairs, in all and for each symbol, and if so large a share of them has sure letters.
LEAST_PAIRS = 300
PAIRS_A_SYMBOL = 4
SURE = 0.9
SURE_SHARE = 0.85
# Symbols of a document that must be known to judge it alone.
LEAST_SYMBOLS = 8
# A byte of UTF-8 in three is the lead: share of the lead places that one symbol must hold.
LEAD_SHARE = 0.6
WIDTHS = (1, 3)
# Parts of the passages, each held out once, and the least length of words with their blanks that has a mean to go by.
FOLDS = 5
LEAST_LINE = 22


def _pairs(word: Iterable[str]) -> list[tuple[str, str]]:
    s = [BLANK, *word, BLANK]
    return list(zip(s, s[1:]))


class WordModel:
    """How often each pair of characters stands in the words of one language; the blank is character 0. ``limit`` is the
    least mean log probability of a character after another in held-out passages, less a tenth."""

    limit = 0.0

    def __init__(self, n: Counter):
        """n: pairs of characters of the words of all passages."""
        self.chars = [BLANK, *sorted({c for p in n for c in p} - {BLANK})]
        self.at = {c: i for i, c in enumerate(self.chars)}
        joint = np.full((len(self.chars), len(self.chars)), 0.05)
        for (a, b), k in n.items():
            joint[self.at[a], self.at[b]] += k
        joint[0, 0] = 1e-6
        self.joint = joint / joint.sum()
        self.cond = np.log(self.joint / self.joint.sum(1, keepdims=True))

    def scores(self, line: str) -> np.ndarray:
        """Log probability of each character after the one before it."""
        i = np.array([self.at.get(c, -1) for c in line], np.int64)
        a, b = i[:-1], i[1:]
        return np.where((a < 0) | (b < 0), np.log(FLOOR), self.cond[a, b])


def word_line(text: str) -> str:
    """The words of a text with one blank before and after each, empty if there are none: its neighbours are the pairs of all words."""
    words = RUN.findall(text)
    return BLANK + BLANK.join(words) + BLANK if words else ""


def word_models(counts: dict[str, list[Counter]]) -> tuple[dict[str, WordModel], dict[str, list[WordModel]]]:
    """Models of languages from the pairs of each fold of their passages, and those that leave one fold out."""
    whole = {k: sum(v, Counter()) for k, v in sorted(counts.items())}
    return {k: WordModel(n) for k, n in whole.items()}, {k: [WordModel(n - fold) for fold in counts[k]] for k, n in whole.items()}


def least_mean(passages: Iterable[tuple[str, int, str]], rest: dict[str, list[WordModel]]) -> dict[str, float]:
    """Least mean of the passages (language, fold, text) of each language under the model without their fold."""
    least: dict[str, float] = {}
    for lang, fold, text in passages:
        m, line = rest[lang][fold], word_line(text)
        if len(line) >= LEAST_LINE and len(m.chars) > 1:
            least[lang] = min(least.get(lang, 0.0), float(np.mean(m.scores(line))))
    return least


def lead_of(runs: list[str]) -> str:
    """The character that begins most threes of the runs that have a length in threes."""
    n: Counter = Counter()
    for r in runs:
        if len(r) % 3 == 0:
            n.update(r[::3])
    return n.most_common(1)[0][0] if n else ""


def symbols(run: str, lead: str) -> tuple[int, list[str]]:
    """Width and symbols of a run: threes where their first characters are mostly ``lead``, else single characters."""
    if lead and len(run) % 3 == 0 and run[::3].count(lead) >= LEAD_SHARE * len(run) / 3:
        return 3, [run[i : i + 3] for i in range(0, len(run), 3)]
    return 1, list(run)


def _em(n: np.ndarray, joint: np.ndarray, e: np.ndarray, rounds: int) -> tuple[float, np.ndarray]:
    """Log likelihood by pair, and the probability e[letter, symbol] that a letter is written as a symbol, for counts n
    of pairs of symbols and the joint probability of pairs of letters. Place 0 is the blank on both sides."""
    u, v = np.nonzero(n)
    w, old = n[u, v], -np.inf
    into = np.zeros((len(u), n.shape[0])), np.zeros((len(u), n.shape[0]))
    into[0][np.arange(len(u)), u] = 1
    into[1][np.arange(len(u)), v] = 1
    for i in range(rounds):
        eu, ev = e[:, u], e[:, v]
        right, left = joint @ ev, joint.T @ eu
        p = np.maximum((eu * right).sum(0), 1e-300)
        fit = float((w * np.log(p)).sum())
        c = (eu * right * (w / p)) @ into[0] + (ev * left * (w / p)) @ into[1]
        e = c / np.maximum(c.sum(1, keepdims=True), 1e-300)
        e = np.maximum(e, FLOOR)
        e[0], e[:, 0] = 0, 0
        e[0, 0] = 1
        e /= e.sum(1, keepdims=True)
        if i > 20 and fit - old < 1e-6 * abs(fit):
            break
        old = fit
    return fit / max(1.0, float(w.sum())), e


def _start(n: np.ndarray, joint: np.ndarray, seed: int) -> np.ndarray:
    """Letters begin with symbols about as frequent as they are, and some noise."""
    letters, marks = joint.sum(1), n.sum(1) / n.sum()
    e = np.zeros((len(letters), len(marks)))
    near = np.log(letters[1:, None]) - np.log(np.maximum(marks[None, 1:], 1e-12))
    e[1:, 1:] = np.exp(-0.5 * near**2) * marks[None, 1:] * (1 + 0.3 * np.random.default_rng(seed).random(near.shape)) + FLOOR
    e[1:] /= e[1:].sum(1, keepdims=True)
    e[0, 0] = 1
    return e


def learn(pairs: pd.DataFrame, models: dict[str, WordModel], rounds: int = ROUNDS) -> pd.DataFrame:
    """Key of one source and width: lang, symbol, letter, p. pairs: u, v, n.

    Each language is tried from several starts, the better ones to the end; the likeliest wins. No row where the pairs are too
    few for their symbols, where too few have a sure letter, or where what comes out is not the language: its mean log
    probability is below that of held-out passages."""
    none = pd.DataFrame({"lang": pd.Series(dtype=str), "symbol": pd.Series(dtype=str), "letter": pd.Series(dtype=str), "p": pd.Series(dtype=float)})
    marks = [BLANK, *sorted((set(pairs["u"]) | set(pairs["v"])) - {BLANK})]
    total = int(pairs["n"].sum())
    if total < max(LEAST_PAIRS, PAIRS_A_SYMBOL * len(marks)) or not models or not rounds:
        return none
    at = {c: i for i, c in enumerate(marks)}
    n = np.zeros((len(marks), len(marks)))
    n[pairs["u"].map(at), pairs["v"].map(at)] = pairs["n"]
    n[0, 0] = 0
    tried = sorted(((*_em(n, m.joint, _start(n, m.joint, s), FIRST_ROUNDS), k) for k, m in models.items() for s in range(STARTS)), key=lambda x: -x[0])
    done = [(*_em(n, models[k].joint, e, rounds), k) for _, e, k in tried[: 2 * STARTS]]
    _, e, lang = max(done, key=lambda x: x[0])
    m = models[lang]
    post = e * m.joint.sum(1)[:, None]
    post /= np.maximum(post.sum(0, keepdims=True), 1e-300)
    best, p = post.argmax(0), post.max(0)
    use = n.sum(1)
    if use[1:][p[1:] >= SURE].sum() < SURE_SHARE * use[1:].sum():
        return none
    mean = float((n * m.cond[np.ix_(best, best)]).sum() / n.sum())
    if mean < m.limit:
        return none
    return pd.DataFrame({"lang": lang, "symbol": marks[1:], "letter": [m.chars[i] for i in best[1:]], "p": p[1:]})


def judge(words: list[list[str]], key: dict[str, str], model: WordModel) -> bool:
    """Is a document's share of the cipher a text of the language under the key? Most symbols must have a letter."""
    n = sum(map(len, words))
    if n < LEAST_SYMBOLS or sum(s in key for w in words for s in w) < SURE_SHARE * n:
        return False
    low = np.log(FLOOR)
    score = [model.cond[model.at[a], model.at[b]] if a in model.at and b in model.at else low for w in words for a, b in _pairs([key.get(s, "") for s in w])]
    return float(np.mean(score)) >= model.limit


def decode(text: str, keys: dict[int, dict[str, str]]) -> tuple[str, int]:
    """Text with all symbols that have a letter replaced, through ``translate``, and how many were."""
    lead = lead_of(RUN.findall(text))
    code: dict[tuple[int, str], str] = {}
    letters: dict[int, str] = {}
    out, at, n = [], 0, 0
    for m in RUN.finditer(text):
        width, marks = symbols(m.group(), lead)
        key = keys.get(width)
        if not key or not any(s in key for s in marks):
            continue
        out.append(text[at : m.start()])
        for s in marks:
            if s in key:
                c = code.setdefault((width, s), chr(0xF0000 + len(code)))
                letters[ord(c)] = key[s]
                out.append(c)
                n += 1
            else:
                out.append(s)
        at = m.end()
    return ("".join(out) + text[at:]).translate(letters), n
