"""Exact repeats of long word runs: seeds on winnowed anchors, extended both ways.

Of every window of ``span`` words, the k-gram with the smallest hash is its anchor.  Equal
windows have equal anchors at the same place, so only windows around anchors that occur twice
can repeat.  The run of windows around one anchor occurrence is its maximal extension to both
sides; equal runs are settled at once, and only runs that differ (where a repeat begins or
ends) are compared window by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretrail.llm.common import (ID, TEXT, TH, chunks, drop_written, keyed, original_id, remembering,
                                  staging, with_key, words_of, written)

SPAN = 20
SEED = 6
#: Characters whose words are hashed together: about twenty 64-bit numbers stand by for each word.
TOGETHER = 1 << 20
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_KEYS = f"{ID} long, {TH} long"


class _Hashes(dict):
    """64-bit hashes of words; a worker remembers a bounded number."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, 7)
        if len(self) < 250_000:
            self[word] = h
        return h


_HASHES = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def grams(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words, from the hashes of the halves."""
    parts: list[tuple[int, np.ndarray]] = []
    power, width = h, 1
    while width <= size:
        if size & width:
            parts.append((width, power))
        if 2 * width <= size:
            power = _mix(power[:len(power) - width] * _M1 + power[width:])
        width *= 2
    at, out = 0, np.zeros(max(len(h) - size + 1, 0), np.uint64)
    for width, p in parts:
        out = _mix(out * _M1 + p[at:at + len(out)])
        at += width
    return out


def hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts one after the other, and where each text begins (and the end)."""
    remembering("substring", _HASHES.clear)
    words = [words_of(t) for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])
    h = np.fromiter((x for w in words for x in map(_HASHES.__getitem__, w)), np.uint64, int(starts[-1]))
    return h, starts


def runs(h: np.ndarray, starts: np.ndarray, span: int, seed: int) -> dict[str, np.ndarray]:
    """The runs of windows with one anchor: text number, first window, number, anchor, content."""
    n = len(h) - span + 1
    if n <= 0:
        return {k: np.empty(0, np.int64) for k in ("text", "pos", "n", "a", "s")}
    gram, window = grams(h, seed), grams(h, span)
    least = np.lib.stride_tricks.sliding_window_view(gram, span - seed + 1)
    anchor = np.empty(n, np.int64)
    for lo in range(0, n, 200_000):
        anchor[lo:lo + 200_000] = least[lo:lo + 200_000].argmin(axis=1)
    anchor += np.arange(n)
    text = np.searchsorted(starts, np.arange(n), side="right") - 1
    inside = np.arange(n) + span <= starts[text + 1]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new & inside)
    total = np.concatenate([[np.uint64(0)], np.cumsum(_mix(window) * inside, dtype=np.uint64)])
    ends = np.concatenate([first[1:], [n]])
    stop = np.concatenate([[0], np.cumsum(inside)])
    count = stop[ends] - stop[first]
    content = _mix(total[first + count] - total[first] + count.astype(np.uint64) * _M1)
    return {"text": text[first], "pos": first - starts[text[first]], "n": count,
            "a": gram[anchor[first]].view(np.int64), "s": content.view(np.int64)}


def seeds(rows: DataFrame, span: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = list(b[TEXT])
            for lo, hi in chunks(texts, TOGETHER):
                h, starts = hashed(texts[lo:hi])
                r = runs(h, starts, span, seed)
                at = r["text"] + lo
                yield pd.DataFrame({ID: b[ID].to_numpy()[at], TH: b[TH].to_numpy()[at], "a": r["a"],
                                    "s": r["s"], "pos": r["pos"].astype(np.int32), "n": r["n"].astype(np.int32)})

    return rows.mapInPandas(run, f"{_KEYS}, a long, s long, pos int, n int")


def _windows(rows: DataFrame, runs_: DataFrame, span: int) -> DataFrame:
    """(a, w, key, pos) of every window in ``runs_`` (key, pos, n, a)."""
    wanted = runs_.groupBy(ID, TH).agg(F.collect_list(F.struct("pos", "n", "a")).alias("r"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, th, text, r in zip(b[ID], b[TH], b[TEXT], b["r"], strict=True):
                w = grams(hashed([text])[0], span)
                n = np.array([x["n"] for x in r])
                at = np.repeat([x["pos"] for x in r], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield pd.DataFrame({"a": np.repeat([x["a"] for x in r], n), "w": w[at].view(np.int64),
                                    ID: i, TH: th, "pos": at.astype(np.int32)})

    # one row per document is enough here, whatever copies of the row there are
    return (rows.join(written(wanted, "wanted"), [ID, TH]).dropDuplicates([ID, TH])
            .mapInPandas(run, f"a long, w long, {_KEYS}, pos int"))


def repeats(rows: DataFrame, span: int = SPAN, seed: int = SEED) -> DataFrame:
    """(key, r): for each document with repeats, its (pos, n) runs of window starts whose
    words also start earlier.  ``rows``: of :func:`keyed`."""
    at = F.struct(ID, TH, "pos")
    with staging() as keep:
        every = written(seeds(rows, span, seed), "seeds")
        twice = written(every.groupBy("a").agg(F.count("*").alias("c")).where("c > 1").select("a"), "anchors")
        found = written(every.join(twice, "a"), "found")
        drop_written(every)
        first = written(found.groupBy("a", "s").agg(F.min(F.struct(ID, TH, "pos", "n")).alias("f"), F.count("*").alias("c")), "first")
        whole = (found.join(first.where("c > 1").select("a", "s", "f"), ["a", "s"])
                 .where(at != F.struct(f"f.{ID}", f"f.{TH}", "f.pos")).select(ID, TH, "pos", "n"))
        mixed = written(first.groupBy("a").agg(F.count("*").alias("k")).where("k > 1").select("a"), "mixed")
        edges = written(_windows(rows, first.join(mixed, "a").select("f.*", "a"), span), "windows")
        early = written(edges.groupBy("a", "w").agg(F.min(at).alias("f"), F.count("*").alias("c")).where("c > 1"), "early")
        single = edges.join(early, ["a", "w"]).where(at != F.col("f")).select(ID, TH, "pos", F.lit(1).alias("n"))
        out = written(whole.unionByName(single).groupBy(ID, TH)
                      .agg(F.collect_list(F.struct("pos", "n")).alias("r")), "repeats")
        keep(out)
    return out


def covered(n_words: int, found: list | None, span: int) -> np.ndarray:
    """Which words lie in a window of ``found``."""
    change = np.zeros(n_words + 1, np.int64)
    if found is not None and len(found):
        lo = np.array([x["pos"] for x in found])
        np.add.at(change, lo, 1)
        np.add.at(change, lo + np.array([x["n"] for x in found]) - 1 + span, -1)
    return np.cumsum(change[:-1]) > 0


def _applied(rows: DataFrame, found: DataFrame, span: int, schema: str,
             out: Callable[[pd.DataFrame, list], dict]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cuts = [covered(len(words_of(t)), r, span) for t, r in zip(b[TEXT], b["r"], strict=True)]
            yield pd.DataFrame(out(b, cuts))

    return rows.join(found, [ID, TH], "left").mapInPandas(run, schema)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           span: int = SPAN, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row.

    Words covered by a window of ``span`` words that starts earlier (smaller id, then text
    hash, then place) go; windows are judged on the input.  Null and empty texts have no
    words; equal rows are one document, so they don't repeat each other; a null id is first.
    """
    def out(b: pd.DataFrame, cuts: list) -> dict:
        kept = [b" ".join([w for w, c in zip(words_of(t), cut, strict=True) if not c] if cut.any() else words_of(t))
                for t, cut in zip(b[TEXT], cuts, strict=True)]
        ids = b[ID].astype("Int64").where(b[ID] != -(2**63))
        return {"doc_id": ids, "n_words": [len(c) for c in cuts], "n_removed": [int(c.sum()) for c in cuts],
                "kept_sha256": pd.Series([hashlib.sha256(k).hexdigest() for k in kept], dtype=object)}

    rows = keyed(docs, id_col, text_col)
    return _applied(rows, repeats(rows, span, seed), span,
                    "doc_id long, n_words long, n_removed long, kept_sha256 string", out)


def cut_text(text: str, cut: np.ndarray) -> str:
    """``text`` without its cut words; what stands between kept words stays as it is."""
    if not cut.any():
        return text
    raw, out, at, k = text.encode("utf-8", "surrogatepass"), [], 0, 0
    for word in raw.split():
        start = raw.index(word, at)
        if not cut[k]:
            out.append(raw[at:start + len(word)])
        at, k = start + len(word), k + 1
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass").strip(" \t\n\v\f\r")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    span: int = SPAN, seed: int = SEED) -> DataFrame:
    """``docs`` with the repeated words cut from the text; all rows and columns stay, and
    rows without repeats are unchanged."""
    rows = keyed(docs, id_col, text_col)
    found = repeats(rows, span, seed)

    @F.pandas_udf("string")
    def cut(parts: pd.DataFrame) -> pd.Series:
        return pd.Series([t if r is None or not isinstance(t, str) else cut_text(t, covered(len(words_of(t)), r, span))
                          for t, r in zip(parts[TEXT], parts["_ft_r"], strict=True)], dtype=object)

    found = found.withColumnRenamed("r", "_ft_r")
    joined = with_key(docs, id_col, text_col).join(found, [ID, TH], "left")
    cleaned = cut(F.struct(F.col(text_col).cast("string").alias(TEXT), "_ft_r"))
    return joined.withColumn(text_col, F.when(F.col("_ft_r").isNull(), F.col(text_col)).otherwise(cleaned)).select(docs.columns)


__all__ = ["digest", "without_repeats", "repeats", "original_id"]
