"""Interpolated Kneser-Ney character models, one for each language, in sorted hash arrays."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

ORDER = 5
MAX_SAMPLES = 20_000
COMMON_WORDS = 30
# A word: neither white space, ASCII other than letters, nor punctuation of the scripts in use.
WORD = re.compile(r"[^\s\x00-@\[-`{-\xbf\xd7\xf7\u0964\u0965\u2010-\u2027\u202a-\u205e\u20a0-\u20cf\u2190-\u2bff\u3000-\u303f\ufffd]+")


def _hash(grams: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(g.encode("utf-8", "surrogatepass")) for g in grams), np.uint64, len(grams))


class LanguageModels:
    """Scores words under every language at once.

    A character is predicted from up to four before it within the word and its leading blank; the end of the
    word is predicted too. Discounts of the Kneser-Ney estimate come from the counts of counts of each order.
    Tables hold the sorted 64-bit hashes of all n-grams of an order, with a row of log probabilities and a row
    of log back-off weights, a column for each language."""

    def __init__(self, samples: list[tuple[str, str]], order: int = ORDER):
        """samples: (language, text); rows without one of them are skipped."""
        by: dict[str, list[str]] = defaultdict(list)
        for lang, text in samples:
            if lang and text:
                by[lang] += [w.lower() for w in WORD.findall(text)]
        self.order, self.langs = order, sorted(by)
        self.known: dict[str, int] = defaultdict(int)
        prob: list[dict[str, np.ndarray]] = [{} for _ in range(order + 1)]
        back: list[dict[str, np.ndarray]] = [{} for _ in range(order + 1)]
        size = max(2000, 2 * len({c for ws in by.values() for w in ws for c in w}))
        for j, lang in enumerate(self.langs):
            for w in set(by[lang]):
                self.known[w] |= 1 << j
            self._train(by[lang], j, size, prob, back)
        self.floor = -np.log(size)
        self.keys, self.logp, self.keys_b, self.logb = [], [], [], []
        for tables, keys, rows, fill in ((prob, self.keys, self.logp, np.nan), (back, self.keys_b, self.logb, 0.0)):
            for t in tables:
                g = list(t)
                h = _hash(g)
                o = np.argsort(h)
                keys.append(h[o])
                rows.append(np.array([t[x] for x in g], np.float32).reshape(len(g), len(self.langs))[o])
        self.known = dict(self.known)
        self.common: dict[str, int] = defaultdict(int)
        for j, lang in enumerate(self.langs):
            for w, _ in Counter(by[lang]).most_common(COMMON_WORDS):
                self.common[w] |= 1 << j
        self.common = dict(self.common)

    def _train(self, words: list[str], j: int, size: int, prob: list, back: list) -> None:
        n = len(self.langs)
        counts: list[Counter] = [Counter() for _ in range(self.order + 1)]
        for w in words:
            s = " " + w + " "
            for e in range(1, len(s)):
                counts[min(self.order, e + 1)][s[max(0, e + 1 - self.order) : e + 1]] += 1
        # Lower orders count in how many contexts an n-gram ends; those at the word start keep their counts.
        for k in range(self.order, 1, -1):
            for g in counts[k]:
                counts[k - 1][g[1:]] += 1
        lower: dict[str, float] = {}
        for k in range(1, self.order + 1):
            c = counts[k]
            of = Counter(c.values())
            d = of[1] / (of[1] + 2 * of[2]) if of[1] and of[2] else 0.5
            total, kinds = Counter(), Counter()
            for g, v in c.items():
                total[g[:-1]] += v
                kinds[g[:-1]] += 1
            here: dict[str, float] = {}
            for g, v in c.items():
                ctx = g[:-1]
                rest = d * kinds[ctx] / total[ctx]
                here[g] = (v - d) / total[ctx] + rest * (lower.get(g[1:], 1 / size) if k > 1 else 1 / size)
            for g, p in here.items():
                prob[k].setdefault(g, np.full(n, np.nan))[j] = np.log(p)
            for ctx, v in total.items():
                back[k - 1].setdefault(ctx, np.zeros(n))[j] = np.log(d * kinds[ctx] / v)
            lower = here

    def _find(self, keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.searchsorted(keys, h)
        at[at == len(keys)] = 0
        return at, keys[at] == h

    def score(self, words: list[str]) -> np.ndarray:
        """Log probability of each word (with its end) by language."""
        out = np.zeros((len(words), len(self.langs)), np.float32)
        if not words or not self.langs:
            return out
        of, chars = [], []
        for i, w in enumerate(words):
            s = " " + w + " "
            of += [i] * (len(s) - 1)
            chars += [s[max(0, e + 1 - self.order) : e + 1] for e in range(1, len(s))]
        of = np.array(of)
        done = np.zeros((len(chars), len(self.langs)), bool)
        acc = np.zeros((len(chars), len(self.langs)), np.float32)
        width = np.fromiter(map(len, chars), np.int64, len(chars))
        for k in range(self.order, 0, -1):
            rows = np.nonzero(width >= k)[0]
            grams = [chars[r][-k:] for r in rows]
            at, hit = self._find(self.keys[k], _hash(grams))
            p = np.where(hit[:, None], self.logp[k][at], np.nan) if len(self.keys[k]) else np.full((len(rows), len(self.langs)), np.nan)
            new = ~np.isnan(p) & ~done[rows]
            acc[rows] += np.where(new, p, 0)
            done[rows] |= new
            open_ = ~done[rows].all(1)
            if not open_.any():
                continue
            rows, ctx = rows[open_], [g[:-1] for g, o in zip(grams, open_) if o]
            at, hit = self._find(self.keys_b[k - 1], _hash(ctx))
            acc[rows] += np.where(hit[:, None] & ~done[rows], self.logb[k - 1][at], 0)
        acc += np.where(done, 0, self.floor)
        np.add.at(out, of, acc)
        return out


class WordTable:
    """Words of a Python worker with their scores; each is scored once, many at a time."""

    LIMIT = 400_000

    def __init__(self, models: LanguageModels):
        self.m = models
        self.bits = 1 << np.arange(len(models.langs))
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[str, int] = {}
        n = len(self.m.langs)
        self.scores, self.size, self.known = np.zeros((0, n), np.float32), np.zeros(0, np.int32), np.zeros((0, n), np.int8)
        self.common = np.zeros((0, n), np.int8)

    def lookup(self, per: list[list[str]]) -> np.ndarray:
        """Ids of all words, in order. Ids hold until the next call."""
        if len(self.ids) > self.LIMIT:
            self._reset()
        ids, old = self.ids, len(self.ids)
        flat = [ids.setdefault(w, len(ids)) for ws in per for w in ws]
        new = list(ids)[old:] if len(ids) > old else []
        if new:
            known = np.array([self.m.known.get(w, 0) for w in new])
            self.scores = np.concatenate([self.scores, self.m.score(new)])
            self.size = np.concatenate([self.size, np.array([len(w) + 1 for w in new], np.int32)])
            common = np.array([self.m.common.get(w, 0) for w in new])
            self.common = np.concatenate([self.common, ((common[:, None] & self.bits) > 0).astype(np.int8)])
            self.known = np.concatenate([self.known, ((known[:, None] & self.bits) > 0).astype(np.int8)])
        return np.array(flat, np.int64)


def segment_sum(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over consecutive groups of the given sizes; empty groups give 0."""
    out = np.zeros((len(counts), *values.shape[1:]), np.float64)
    full = np.nonzero(counts)[0]
    if len(full):
        starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        out[full] = np.add.reduceat(values.astype(np.float64), starts, axis=0)
    return out
