"""Text quality by a factorisation machine.

Inputs of a score: hashed words (log counts, unit length), statistics of the structure, and
the stored length as metadata.  All pairs interact through low-rank factors; the sum over
pairs is half the difference of squared sums and sums of squares, linear in the inputs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretrail.llm.common import chunks, sampled, series_of, staging, words_of

BUCKETS = 1 << 12
RANK = 8
#: Labelled documents that the model is fitted on at most (those with the smallest hash of the id).
MAX_TRAIN = 8_000
_SPACE = b" \t\n\v\f\r"
_SYMBOLS = b"#*$%&|<>{}[]\\^~=+_@/"
_N_STATS = 13


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        b = zlib.crc32(word.lower()) % BUCKETS
        if len(self) < 250_000:
            self[word] = b
        return b


_BUCKETS = _Buckets()


def statistics(text: str, words: list[bytes], n_chars: float | None) -> tuple[float, ...]:
    raw = text.encode("utf-8", "surrogatepass")
    n, w = max(len(raw), 1), max(len(words), 1)
    count = lambda chars: (len(raw) - len(raw.translate(None, chars))) / n
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACE)]
    length = len(text)
    return (np.log1p(len(words)), np.log1p(length), np.log1p(len(lines)), n / w, count(_SYMBOLS), count(b"0123456789"),
            count(b".,;:!?"), count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), count(b"|"), len(set(words)) / w,
            1 - len(set(lines)) / max(len(lines), 1), len(words) / max(len(lines), 1) / 100,
            0.0 if n_chars is None or n_chars != n_chars else np.log1p(max(n_chars, 0)) - np.log1p(length))


def features(texts: list[str], n_chars: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of the words, sorted by row, and the statistics of each row."""
    words = [words_of(t) for t in texts]
    sizes = np.array([len(x) for x in words])
    at = np.fromiter((b for x in words for b in map(_BUCKETS.__getitem__, x)), np.int64, int(sizes.sum()))
    key, count = np.unique(np.repeat(np.arange(len(texts)), sizes) * BUCKETS + at, return_counts=True)
    row, bucket = key // BUCKETS, key % BUCKETS
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(row, value * value, len(texts)))
    value = value / norm[row]
    stats = np.array([statistics(*x) for x in zip(texts, words, n_chars, strict=True)], dtype=float)
    return row, bucket, value, stats.reshape(-1, _N_STATS)


@dataclass
class Machine:
    """Constant, weights and factors of words and statistics; scaling of the statistics."""

    bias: float
    word_w: np.ndarray
    word_v: np.ndarray
    stat_w: np.ndarray
    stat_v: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def sums(self, row, bucket, value, stats):
        z = np.clip((stats - self.centre) / self.scale, -5, 5)
        n = len(stats)
        linear = self.bias + z @ self.stat_w + np.bincount(row, value * self.word_w[bucket], n)
        part = self.word_v[bucket] * value[:, None]
        s = z @ self.stat_v + _by_row(row, part, n)
        q = (z * z) @ (self.stat_v ** 2) + _by_row(row, part * part, n)
        return z, s, linear + 0.5 * (s * s - q).sum(axis=1)

    def probability(self, row, bucket, value, stats) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.sums(row, bucket, value, stats)[2], -30, 30)))


def _by_row(row: np.ndarray, part: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, part.shape[1]))
    if len(row):
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        out[row[first]] = np.add.reduceat(part, first, axis=0)
    return out


def fit(row, bucket, value, stats, y: np.ndarray, rank: int = RANK, epochs: int = 12, batch: int = 256,
        step: float = 0.02, hold: float = 1e-4, seed: int = 5) -> Machine:
    """Logistic loss by Adam over small batches, a fixed number of epochs."""
    rng = np.random.default_rng(seed)
    m = Machine(0.0, np.zeros(BUCKETS), rng.normal(0, 0.05, (BUCKETS, rank)), np.zeros(_N_STATS),
                rng.normal(0, 0.05, (_N_STATS, rank)), stats.mean(axis=0), stats.std(axis=0) + 1e-3)
    p = float(np.clip(y.mean(), 0.01, 0.99))
    m.bias = float(np.log(p / (1 - p)))
    names = ("word_w", "word_v", "stat_w", "stat_v")
    first, second = ({k: np.zeros_like(getattr(m, k)) for k in names} for _ in range(2))
    begins = np.searchsorted(row, np.arange(len(y) + 1))
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            own = np.sort(order[lo:lo + batch])
            take = np.concatenate([np.arange(begins[i], begins[i + 1]) for i in own])
            r = np.repeat(np.arange(len(own)), begins[own + 1] - begins[own])
            b, x = bucket[take], value[take]
            z, s, raw = m.sums(r, b, x, stats[own])
            g = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[own]) / len(own)
            part = m.word_v[b] * x[:, None]
            word_v = np.zeros_like(m.word_v)
            np.add.at(word_v, b, (g[r] * x)[:, None] * (s[r] - part))
            grads = {"word_w": np.bincount(b, g[r] * x, BUCKETS), "word_v": word_v, "stat_w": z.T @ g,
                     "stat_v": (z * g[:, None]).T @ s - ((z * z * g[:, None]).sum(axis=0))[:, None] * m.stat_v}
            t += 1
            m.bias -= step * float(g.sum())
            for k in names:
                w, d = getattr(m, k), grads[k]
                d = d + hold * w
                first[k] += 0.1 * (d - first[k])
                second[k] += 0.001 * (d * d - second[k])
                w -= step * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
    return m


@staging()
def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", n_chars_col: str | None = None, max_train: int = MAX_TRAIN) -> Machine | float:
    """A machine from the texts of labelled ids (null labels are left out), fitted on at most
    ``max_train`` of them.  With labels of one kind only, that kind's share is returned in
    its place."""
    n_chars = F.col(n_chars_col).cast("double") if n_chars_col else F.lit(None).cast("double")
    rows = sampled(docs.withColumn("_ft_n", n_chars), labels, id_col, text_col, label_col, max_train, "_ft_n")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = series_of(b["text"])
            for lo, hi in chunks(texts):
                row, bucket, value, stats = features(texts[lo:hi], b["n"].tolist()[lo:hi])
                cut = np.searchsorted(row, np.arange(1, hi - lo))
                yield pd.DataFrame({"y": b["y"].to_numpy()[lo:hi], "bucket": np.split(bucket.astype(np.int16), cut),
                                    "value": np.split(value.astype(np.float32), cut), "stats": list(stats)})

    sample = (rows.select("text", F.col("_ft_n").alias("n"), F.col("label").alias("y"))
              .mapInPandas(run, "y int, bucket array<short>, value array<float>, stats array<double>").toPandas())
    if sample["y"].nunique() < 2:
        return float(sample["y"].mean()) if len(sample) else 0.5
    sizes = sample["bucket"].map(len).to_numpy()
    return fit(np.repeat(np.arange(len(sample)), sizes), np.concatenate(sample["bucket"].to_list()).astype(np.int64),
               np.concatenate(sample["value"].to_list()).astype(float), np.array(sample["stats"].tolist()), sample["y"].to_numpy(float))


def scored(text: Column, machine: Machine | float, n_chars: Column | None = None) -> Column:
    """Probability (0 to 1) of label 1 for every text; a null text counts as empty.

    The machine is a few hundred kB, whatever the corpus."""
    @F.pandas_udf("double")
    def score(texts: pd.Series, n: pd.Series) -> pd.Series:
        all_texts, sizes = series_of(texts), n.tolist()
        if isinstance(machine, float):
            return pd.Series(machine, index=texts.index)
        return pd.Series(np.concatenate([machine.probability(*features(all_texts[lo:hi], sizes[lo:hi])) for lo, hi in chunks(all_texts)] or [np.empty(0)]))

    return score(text.cast("string"), (F.lit(None) if n_chars is None else n_chars).cast("double"))
