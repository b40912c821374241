"""Toxicity by a weighted lexicon over folded text, matched by Aho-Corasick.

Folding undoes case, accents, look-alike letters and digit substitutions, drops format
characters, and puts one space for whatever else is no letter.  As accents tell words apart in
many languages, a second reading keeps them, word by word beside the first.  A 1 may stand for
i or l: where one touches a letter, further readings take it for l.  A substitution at the end
of a word may as well be noise or punctuation: the first readings strip it, further ones undo
it.  Matches inside an exception phrase don't count.
The sum of the weights is set against the length of the text.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretrail.llm.common import chunks, remembering, sampled, series_of, staging

#: Terms with a weight of their own, before any are learned.
TERMS = ("idiot", "idiots", "moron", "morons", "stupid", "loser", "losers", "pathetic", "worthless",
         "scum", "scumbag", "clown", "clowns", "trash", "disgusting", "imbecile", "dumb", "dumbass",
         "asshole", "bastard", "bitch", "bullshit", "cunt", "dickhead", "fuck", "fucker", "fucking",
         "motherfucker", "shit", "shithead", "slut", "whore", "retard", "vermin", "subhuman",
         "abschaum", "arschloch", "arschlocher", "drecksack", "dummkopf", "hurensohn", "missgeburt", "schlampe", "trottel", "vollidiot", "wichser",
         "abruti", "abrutie", "batard", "connard", "connasse", "cretin", "cretine", "encule", "ordure", "pourriture", "salope",
         "cabron", "estupida", "estupido", "gilipollas", "hijoputa", "idiota", "imbecil", "malnacido", "pendejo", "subnormal")
#: Phrases in which a term is meant otherwise.
EXCEPTIONS = ("trash can", "trash cans", "trash bin", "trash bag", "trash bags", "trash collection",
              "clown fish", "clown loach", "class clown", "circus clown", "pond scum", "soap scum",
              "stupid simple", "sore loser", "keep it simple stupid", "dumb waiter", "dumb bell")
#: Letters that look like Latin ones.
LOOK_ALIKES = dict(zip("авеѕіјкмнорстухԁһѵɡαβεηικνορτυχωıļɩ", "abesijkmhopctyxdhvgabenikvoptuxwiii", strict=True))
#: Characters that stand for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "+": "t"}

BASE_WEIGHT = 4.0
#: Labelled rows that the terms and the curve are learned from at most.
MAX_TRAIN = 12_000
#: Learned terms at most; the lexicon goes to every task.
MAX_TERMS = 5_000
_STEMS = (3, 4, 5, 6, 7, 8, 9)
#: Characters of text whose terms are counted at once; the partial counts are summed up.
_COUNTED = 500_000
_KNOWN = frozenset(TERMS)
_ANY = re.escape("".join(SUBSTITUTES))
_SUBSTITUTED = re.compile(rf"[{_ANY}]+(?=[^\W\d_])")
_UNDO, _UNDO_L = str.maketrans(SUBSTITUTES), str.maketrans(SUBSTITUTES | {"1": "l"})
#: A 1 in or at a word.
_ONE = re.compile(r"1(?=[^\W\d_])|(?<=[^\W\d_])1")
#: Format characters, such as soft hyphens and zero-width spaces: they divide no word.
_FORMAT = re.compile("[" + "".join(chr(c) for c in range(1 << 16) if unicodedata.category(chr(c)) == "Cf") + "]")
#: In half-folded text: substitutions that end a word.
_ENDING = re.compile(rf"(?<=[^ {_ANY}])[{_ANY}]+(?![^ ])")
_STRIPPED = str.maketrans(dict.fromkeys(SUBSTITUTES, " "))
#: What the end of a word may hold beside its letters: nothing, punctuation or symbol noise.
_NOISE = ("", "!", "@$!+")


class _Fold(dict):
    """Folded form of a character: lower-case base letter, or a space."""

    def __missing__(self, code: int) -> str:
        c = chr(code).lower()
        c = LOOK_ALIKES.get(c, c)
        c = "".join(x for x in unicodedata.normalize("NFKD", c) if x.isalpha()).lower()
        c = "".join(LOOK_ALIKES.get(x, x) for x in c)
        self[code] = c or ("" if unicodedata.combining(chr(code)) or unicodedata.category(chr(code)) == "Cf" else " ")
        return self[code]


_FOLD = _Fold()


class _Accented(dict):
    """The folded form, but for a letter with an accent, which is only lower-cased."""

    def __missing__(self, code: int) -> str:
        c = chr(code).lower()
        marked = len(c) == len(_FOLD[code]) == 1 and _FOLD[code] != " " and unicodedata.decomposition(c)[:1] not in ("", "<")
        self[code] = c if marked else _FOLD[code]
        return self[code]


_ACCENTED = _Accented()


class _Half(dict):
    """The form in another table, but for substitutes, which stay."""

    def __init__(self, table: dict):
        self.table = table

    def __missing__(self, code: int) -> str:
        self[code] = chr(code) if code in _UNDO else self.table[code]
        return self[code]


_HALF, _HALF_ACCENTED = _Half(_FOLD), _Half(_ACCENTED)


def _plain(text: str) -> str:
    return text if text.isascii() else _FORMAT.sub("", unicodedata.normalize("NFC", text))


def _half(plain: str, table: dict, undo: dict = _UNDO) -> str:
    return _SUBSTITUTED.sub(lambda m: m[0].translate(undo), plain).translate(table)


def _spaced(half: str) -> str:
    return " ".join(["", *half.translate(_STRIPPED).split(), ""])


def fold(text: str, table: dict = _FOLD) -> str:
    """" words of letters with one space before, between and after each "."""
    return _spaced(_half(_plain(text), _HALF if table is _FOLD else _HALF_ACCENTED))


def _undone(half: str, noise: str, undo: dict) -> str:
    return _ENDING.sub(lambda m: m[0].rstrip(noise).translate(undo) if noise else m[0].translate(undo), half)


def readings(text: str) -> list[str]:
    """The folded text and, if they differ, the one with accents, either with 1 as l, and all
    of these with the substitutions at the ends of words undone, but for noise after them.  All
    have the same number of words, the first two the same length."""
    plain = _plain(text)
    ways = (_UNDO, _UNDO_L) if _ONE.search(plain) else (_UNDO,)
    halves = [(_half(plain, table, undo), undo) for undo in ways for table in (_HALF, _HALF_ACCENTED)]
    out = dict.fromkeys(_spaced(h) for h, _ in halves)
    if _ENDING.search(halves[0][0]):
        out |= dict.fromkeys(_spaced(_undone(h, noise, undo)) for noise in _NOISE for h, undo in halves)
    return list(out)


@dataclass(frozen=True)
class Lexicon:
    """Terms (" word " or the beginning " stem" of words) with weights, phrases that excuse,
    and the curve (constant, of log1p(sum), of log1p(100 * sum / words)) to a probability."""

    weights: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (-4.0, 1.5, 1.5)


def base_lexicon() -> Lexicon:
    return Lexicon(tuple(sorted((f" {w} ", BASE_WEIGHT) for w in TERMS)))


@functools.lru_cache(maxsize=4)
def _automaton(lexicon: Lexicon) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for w, x in lexicon.weights:
        found.add_word(w, (x, len(w)))
    for p in lexicon.exceptions:
        found.add_word(f" {p} ", (None, len(p) + 2))
    if len(found):
        found.make_automaton()
    return found


def weigh(lexicon: Lexicon, *folded: str) -> tuple[float, int]:
    """Sum of the weights of the matched words (the largest of each word in any of the
    readings), and words."""
    words = folded[0].count(" ") - 1
    found = _automaton(lexicon)
    if not len(found) or words < 1:
        return 0.0, max(words, 0)
    hits: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    for reading in folded:
        at, word = 0, 0
        # by number of the word: the readings differ in the lengths of words
        for start, size, weight in sorted((end - size + 1, size, weight) for end, (weight, size) in found.iter(reading) if weight is not None):
            word, at = word + reading.count(" ", at, start), start
            hits[word] = max(weight, hits.get(word, 0.0))
        at, word = 0, 0
        for start, size in sorted((end - size + 1, size) for end, (weight, size) in found.iter(reading) if weight is None):
            word, at = word + reading.count(" ", at, start), start
            excused.append((word, word + reading.count(" ", start, start + size) - 1))
    if excused:
        begins = sorted(excused)
        reach = list(itertools.accumulate((b for _, b in begins), max))  # how far the phrases begun so far go
        hits = {s: x for s, x in hits.items() if not (k := bisect.bisect(begins, (s, words))) or reach[k - 1] <= s}
    return sum(hits.values()), words


def measures(lexicon: Lexicon, texts: list[str]) -> np.ndarray:
    remembering("toxicity", _automaton.cache_clear)
    s = np.array([weigh(lexicon, *readings(t)) for t in texts], dtype=float).reshape(-1, 2)
    return np.stack([np.ones(len(s)), np.log1p(s[:, 0]), np.log1p(100 * s[:, 0] / np.maximum(s[:, 1], 1))], axis=1)


def scored(text: Column, lexicon: Lexicon) -> Column:
    """Probability (0 to 1) that a text is toxic; null and empty texts get that of no match."""
    curve = np.array(lexicon.curve)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(1 / (1 + np.exp(-np.clip(measures(lexicon, series_of(texts)) @ curve, -30, 30))))

    return score(text.cast("string"))


def _terms_of(word: str) -> list[str]:
    """The word itself and its stems."""
    whole = [f" {word} "] if len(word) > 3 else []
    return whole + [f" {word[:n]}" for n in _STEMS if len(word) > n]


def _term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per part of a batch: term, toxic and other documents, and a 64-bit sketch of the words after it."""
    remembering("toxicity", _automaton.cache_clear)
    for texts, labels in ((x[lo:hi], y[lo:hi]) for b in batches for x, y in [(series_of(b["text"]), b["toxic"].tolist())]
                          for lo, hi in chunks(x, _COUNTED)):
        by: tuple[Counter, Counter] = (Counter(), Counter())
        after: Counter = Counter()
        for text, toxic in zip(texts, labels, strict=True):
            plain, accented = fold(text).split(), fold(text, _ACCENTED).split()
            own: dict[str, int] = {}
            for w, m, nxt in zip(plain, accented, [*plain[1:], ""][:len(plain)], strict=True):  # a text may hold no word
                if w in _KNOWN:
                    continue
                bit = 1 << (hash_of(nxt) & 63)
                for t in _terms_of(w) if w == m else {*_terms_of(w), *_terms_of(m)}:
                    own[t] = own.get(t, 0) | bit
            by[bool(toxic)].update(own.keys())
            if toxic:
                for t, m in own.items():
                    after[t] |= m
        terms = list(by[1])  # those of other documents alone are never chosen ...
        yield pd.DataFrame({"term": pd.Series(terms, dtype=object), "toxic": [by[1][t] for t in terms], "other": [by[0][t] for t in terms],
                            "after": np.array([after[t] for t in terms], dtype=np.uint64).view(np.int64)})
        rest = [t for t in by[0] if t not in by[1]]  # ... but count against what other batches have
        yield pd.DataFrame({"term": pd.Series(rest, dtype=object), "toxic": 0, "other": [by[0][t] for t in rest], "after": 0})


def hash_of(word: str) -> int:
    return zlib.crc32(word.encode())


@staging()
def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_train: int = MAX_TRAIN, max_terms: int = MAX_TERMS,
          min_support: int = 5, min_precision: float = 0.9) -> Lexicon:
    """A lexicon from the texts of labelled ids (label 1: toxic; null labels are left out).

    At most ``max_train`` of them are used.  A term must occur in ``min_support`` toxic
    documents, hardly in others, and before different words, as copies of one text would not
    give.  Without labels: the fixed terms alone.
    """
    sample = sampled(docs, labels, id_col, text_col, label_col, max_train).withColumnRenamed("label", "toxic")
    counts = (sample.mapInPandas(_term_counts, "term string, toxic long, other long, after long")
              .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.bit_count(F.bit_or("after")).alias("after"))
              .where((F.col("toxic") >= min_support) & (F.col("after") >= min_support // 2 + 2)
                     & (F.col("toxic") >= min_precision * (F.col("toxic") + F.col("other"))))
              .orderBy(F.desc("toxic"), "term").limit(max_terms).collect())
    weights = {f" {w} ": BASE_WEIGHT for w in TERMS}
    for r in sorted(counts, key=lambda r: len(r["term"])):
        word = r["term"].rstrip(" ")
        if not any(word[:n] in weights for n in range(2, len(word))):  # a shorter stem says it all
            weights[r["term"]] = max(weights.get(r["term"], 0.0), round(math.log((r["toxic"] + 0.5) / (r["other"] + 0.5)), 4))
    lexicon = Lexicon(tuple(sorted(weights.items())))

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series(list(measures(lexicon, series_of(texts))))

    seen = sample.select(measured("text").alias("m"), "toxic").toPandas()
    if seen["toxic"].nunique() < 2:
        return lexicon
    return Lexicon(lexicon.weights, lexicon.exceptions, _curve(np.array(seen["m"].tolist()), seen["toxic"].to_numpy(float)))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, held back towards zero a little."""
    w = np.zeros(3)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hold = np.array([1e-3, 0.5, 0.5])
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(hold), x.T @ (p - y) + hold * w)
    return tuple(float(v) for v in w)
