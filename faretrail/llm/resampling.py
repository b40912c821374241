"""Importance resampling towards a target text, over hashed runs of words.

A document weighs the sum of its features' gains, the logarithms of how much likelier their
buckets are in the target than in the corpus.  Gumbel noise from the id makes the highest
scores a draw without replacement.

The hash is CRC-32, for all features of many texts at once.  It is linear but for a constant of
the length: each byte adds what a table holds for it and its distance from the feature's end,
and ``bitwise_xor.reduceat`` sums these over the spans.  A span longer than the table is cut
into blocks from its end; neighbouring blocks fold pairwise, the left one shifted by a table
of twice the length at every turn.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretrail.functions.keys import attach_dense_id, stage_ranked
from faretrail.llm.common import ID, chunks, drop_written, id_key, original_id, remembering, series_of, written

BUCKETS = 10_000
MIN_WORDS = 20
#: Distances from the end that the table holds.
POSITIONS = 64
#: Characters of text that are hashed at once (one text may be longer).
_AT_ONCE = 200_000
_POLYNOMIAL = 0xEDB88320
_ONES = np.uint32(0xFFFFFFFF)
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Bytes of words, after A-Z became a-z: digits, a-z, and all of characters beyond ASCII.
_WORD = np.zeros(256, dtype=bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


@functools.cache
def position_table() -> np.ndarray:
    """(POSITIONS, 256): what a byte adds to the remainder at each distance from the end."""
    row = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        row = np.where(row & 1, (row >> 1) ^ np.uint32(_POLYNOMIAL), row >> 1).astype(np.uint32)
    table = [row]
    for _ in range(POSITIONS - 1):
        table.append((table[-1] >> 8) ^ row[table[-1] & 255])
    return np.array(table)


@functools.cache
def _shift_table(turn: int) -> np.ndarray:
    """(4, 256): what each byte of a remainder becomes when POSITIONS * 2**turn zeros follow."""
    if turn == 0:
        return position_table()[POSITIONS - 1 - np.arange(4)]
    return _shifted(_shift_table(turn - 1), turn - 1)


def _shifted(remainder: np.ndarray, turn: int) -> np.ndarray:
    table = _shift_table(turn)
    return (table[0][remainder & 255] ^ table[1][remainder >> 8 & 255]
            ^ table[2][remainder >> 16 & 255] ^ table[3][remainder >> 24])


def _length_constants(lengths: np.ndarray) -> np.ndarray:
    """The CRC-32 of as many zeros."""
    register = np.full(POSITIONS, _ONES)
    row = position_table()[0]
    for n in range(1, POSITIONS):
        register[n] = (register[n - 1] >> 8) ^ row[register[n - 1] & 255]
    out, blocks, turn = register[lengths % POSITIONS], lengths // POSITIONS, 0
    while blocks.any():
        out = np.where(blocks & 1, _shifted(out, turn), out)
        blocks, turn = blocks >> 1, turn + 1
    return out ^ _ONES


def crc32_of_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of data[start:end] for every span; spans may overlap, an empty one has 0."""
    out = np.zeros(len(starts), dtype=np.uint32)
    some = np.flatnonzero(ends > starts)
    if not len(some):
        return out
    starts, lengths = starts[some], (ends - starts)[some]
    # blocks of a span, the last ones whole: number from the end, start and length of each
    per = -(-lengths // POSITIONS)
    first = np.cumsum(per) - per
    back = np.repeat(first + per - 1, per) - np.arange(per.sum())
    to = np.repeat(starts + lengths, per) - back * POSITIONS
    size = np.minimum(POSITIONS, to - np.repeat(starts, per))
    offset = np.cumsum(size) - size
    distance = np.repeat(offset + size - 1, size) - np.arange(size.sum())
    at = np.repeat(to - 1, size) - distance
    added = position_table().ravel()[distance * 256 + data[at]]
    value = np.bitwise_xor.reduceat(added, offset)
    turn = 0
    while len(value) > len(some):
        value = np.where(back & 1, _shifted(value, turn), value)
        back, turn = back >> 1, turn + 1
        span = np.repeat(np.arange(len(per)), per)
        new = np.flatnonzero(np.r_[True, (back[1:] != back[:-1]) | (span[1:] != span[:-1])])
        value, back = np.bitwise_xor.reduceat(value, new), back[new]
        per = np.bincount(span[new], minlength=len(per))
    out[some] = value ^ _length_constants(lengths)
    return out


def features(texts: list[str], max_words: int = 1, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, bucket) of every run of 1 to ``max_words`` consecutive words, joined
    by one space, and the number of words of each text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]).translate(_LOWER), dtype=np.uint8)
    inside = _WORD[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # one byte after each word, which becomes the space
    data, of = data[keep], inside[keep]
    text_ends = np.cumsum([len(r) + 1 for r in raw])
    data = np.where(of, data, 32).astype(np.uint8)
    edge = np.diff(np.r_[False, of, False].astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    text = np.searchsorted(text_ends, np.flatnonzero(keep)[starts], "right")
    found_text, found_bucket = [], []
    for k in range(min(max_words, len(starts))):
        own = np.flatnonzero(text[:len(text) - k] == text[k:])
        found_text.append(text[own])
        found_bucket.append(crc32_of_spans(data, starts[own], ends[own + k]) % buckets)
    empty = np.empty(0, dtype=np.int64)
    return (np.concatenate([empty, *found_text]), np.concatenate([empty, *found_bucket]).astype(np.int64),
            np.bincount(text, minlength=len(texts))[:len(texts)])


def bucket_counts(texts: DataFrame, text_col: str, max_words: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket, over all texts: one row a task and bucket is shuffled, and
    ``buckets`` numbers reach the driver."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remembering("resampling")
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            all_texts = series_of(b["text"])
            for lo, hi in chunks(all_texts, _AT_ONCE):
                total += np.bincount(features(all_texts[lo:hi], max_words, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": some.astype(np.int32), "n": total[some]})

    found = (texts.select(F.col(text_col).cast("string").alias("text")).mapInPandas(run, "bucket int, n long")
             .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(buckets, dtype=np.int64)
    out[found["bucket"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of how much likelier each bucket is in the target, counts begun at one."""
    n, all_corpus, all_target = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * float(all_corpus + n) / ((s + 1) * float(all_target + n))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def weighed(text: Column, gain: np.ndarray, max_words: int = 1) -> Column:
    """struct<n_words, n_features, weight> of every whole text; a null text has none.

    ``gain`` holds one number a bucket, whatever the corpus."""
    @F.pandas_udf("struct<n_words:bigint,n_features:bigint,weight:bigint>")
    def weigh(texts: pd.Series) -> pd.DataFrame:
        remembering("resampling")
        all_texts, out = series_of(texts), [np.empty((0, 3), dtype=np.int64)]
        for lo, hi in chunks(all_texts, _AT_ONCE):
            of, bucket, words = features(all_texts[lo:hi], max_words, len(gain))
            total = np.zeros(hi - lo, dtype=np.int64)
            np.add.at(total, of, gain[bucket])
            out.append(np.column_stack([words, np.bincount(of, minlength=hi - lo), total]))
        return pd.DataFrame(np.concatenate(out), columns=["n_words", "n_features", "weight"])

    return weigh(text.cast("string"))


def noise(key: Column, seed: int) -> Column:
    """floor(-1000 * ln(-ln u)), u from the first 32 bits of sha256(``seed:key``); a null key
    counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resampled(docs: DataFrame, target: DataFrame, percent: int = 10, seed: int = 2024, id_col: str = "doc_id",
              text_col: str = "text", target_col: str = "text", max_words: int = 1, buckets: int = BUCKETS,
              min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs``.

    Of the rows with ``min_words`` words at least, ``percent`` hundredths (rounded down) are
    drawn: those with the highest scores, ties to the smaller id, a null id before all.  Their
    ranks run from 1; all other rows have none.  Null and empty texts weigh 0; repeated rows are
    drawn each by itself, in any order; empty tables give no rows, an empty target counts 0.
    """
    gain = gains(bucket_counts(docs, text_col, max_words, buckets), bucket_counts(target, target_col, max_words, buckets))
    weights = docs.select(id_key(id_col).alias(ID), F.col(id_col).alias("_ft_as"), weighed(F.col(text_col), gain, max_words).alias("_ft_w"))
    scored = written(weights.select(ID, "_ft_w.*", (F.col("_ft_w.weight") + noise(F.col("_ft_as"), seed)).alias("score")), "weights")
    # ranked by a range sort over all tasks: the share drawn grows with the corpus
    enough = F.col("n_words") >= min_words
    stage = stage_ranked(scored.where(enough), [F.desc("score"), F.asc(ID)], "llm-ranked")
    drawn = stage.row_count() * percent // 100
    ranked = attach_dense_id(stage, "rank").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    out = written(ranked.unionByName(rest).select(original_id().alias("doc_id"), "n_features", "weight", "score", "rank"), "resampled")
    stage.release()
    drop_written(scored)
    return out
