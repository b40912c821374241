"""SimHash near-duplicates found through one-wildcard variants of few segments.

With ``max_bits`` differing bits and max_bits // 2 + 1 segments, some segment of two linked
fingerprints differs by one bit at most.  Each segment is therefore indexed once per wildcard
position; fingerprints that share a variant are verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretrail.llm.common import ID, TEXT, TH, chunks, keyed, original_id, remembering, staging, with_key, words_of, written
from faretrail.llm.components import components

SHINGLE = 3
MAX_BITS = 2
#: Fingerprints that a variant may hold for its pairs to be verified one by one; why the links of
#: larger ones have the same components, at whatever number, is said in :func:`links`.
SMALL_BUCKET = 32
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_AT_ONCE = 100_000


def shingles(text: str, size: int) -> list[bytes]:
    words = words_of(text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass"))
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return [b" ".join(x) for x in zip(*(words[i:] for i in range(size)), strict=False)]


def fingerprints(texts: list[str], size: int = SHINGLE) -> np.ndarray:
    """Fingerprints as signed 64-bit numbers; a text without a word has 0."""
    out = np.zeros(len(texts), dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for lo, hi in chunks(texts, 400_000):
        hashes, ends = [], []
        for t in texts[lo:hi]:
            hashes += [digest(s, 42) for s in shingles(t, size)]
            ends.append(len(hashes))
        ends = np.array(ends)
        starts = np.concatenate([[0], ends[:-1]])
        h = np.array(hashes, dtype=np.uint64)
        counts = np.zeros((hi - lo, 64), dtype=np.int64)
        for at in range(0, len(h), _AT_ONCE):  # a long text goes through in several turns
            part = h[at:at + _AT_ONCE]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            own = np.flatnonzero((ends > at) & (starts < at + len(part)) & (ends > starts))
            counts[own] += np.add.reduceat(bits, np.maximum(starts[own] - at, 0), axis=0, dtype=np.int64)
        over = 2 * counts > (ends - starts)[:, None]
        out[lo:hi] = (over * weights).sum(axis=1, dtype=np.uint64).view(np.int64)
    return out


def with_fingerprint(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(key columns, fp) of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remembering("simhash")
        for b in batches:
            yield pd.DataFrame({ID: b[ID], TH: b[TH], "fp": fingerprints(list(b[TEXT]), size)})

    return keyed(docs, id_col, text_col).mapInPandas(run, f"{ID} long, {TH} long, fp long")


def _signed(m: int) -> int:
    return m - (1 << 64) if m >= 1 << 63 else m


def wildcards(max_bits: int) -> list[tuple[int, int, int]]:
    """(segment, bit left out, first bit of the segment) as masks, for every variant."""
    parts = max_bits // 2 + 1
    width = -(-64 // parts)
    out = []
    for s in range(parts):
        bits = range(s * width, min(64, (s + 1) * width))
        out += [(sum(1 << b for b in bits), 1 << b, 1 << bits[0]) for b in bits]
    return out


def variants(fps: DataFrame, max_bits: int) -> DataFrame:
    """(part, key, fp): every segment with every one of its bits left out."""
    keys = F.array(*(F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(full & ~bit))).alias("key"))
                     for i, (full, bit, _) in enumerate(wildcards(max_bits))))
    return fps.select("fp", F.explode(keys).alias("k")).select("k.part", "k.key", "fp")


def _linked(max_bits: int) -> tuple[Column, ...]:
    """Verified pairs of a bucket ``m``, each given by one variant of a segment: the one
    without the bit that differs, or without the first bit if none does."""
    full, bit, first = (F.element_at(F.array(*(F.lit(_signed(x)).cast("long") for x in xs)), F.col("part") + 1)
                        for xs in zip(*wildcards(max_bits), strict=True))

    def of(a: Column, i: Column) -> Column:
        def linked(b: Column) -> Column:
            own = a.bitwiseXOR(b).bitwiseAND(F.col("full"))
            return (F.bit_count(a.bitwiseXOR(b)) <= max_bits) & ((own == F.col("bit")) | ((own == 0) & (F.col("bit") == F.col("first"))))

        others = F.filter(F.slice(F.col("m"), i + 2, F.size("m")), linked)
        return F.transform(others, lambda b: F.struct(a.alias("a"), b.alias("b")))

    return full.alias("full"), bit.alias("bit"), first.alias("first"), F.flatten(F.transform("m", of))


def balls(fps: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp): all fingerprints within max_bits // 2 bits of fp (and one more bit left out
    if max_bits is odd).  Two share one exactly if at most max_bits bits differ."""
    ones = [1 << b for b in range(63)] + [-(1 << 63)]
    out = fps.select("fp", F.col("fp").alias("key"))
    for _ in range(max_bits // 2):
        step = F.array(F.lit(0).cast("long"), *(F.lit(b).cast("long") for b in ones))
        out = out.select("fp", F.explode(F.transform(step, lambda b: F.col("key").bitwiseXOR(b))).alias("key")).distinct()
    if max_bits % 2:
        drop = F.array(*(F.struct(F.lit(i).alias("i"), F.col("key").bitwiseAND(F.lit(~b)).alias("k")) for i, b in enumerate(ones)))
        return out.select("fp", F.explode(drop).alias("d")).select(F.col("d.i").alias("part"), F.col("d.k").alias("key"), "fp")
    return out.select(F.lit(0).alias("part"), "key", "fp")


def links(fps: DataFrame, max_bits: int = MAX_BITS, small: int = SMALL_BUCKET) -> DataFrame:
    """Edges (a < b) whose components are those of "at most max_bits bits differ".

    ``fps``: distinct fingerprints, in a written table.  Variants shared by few fingerprints
    are verified pair by pair.  Members of larger ones link through the fingerprints around
    them instead: all that share a neighbour within half the distance are linked by
    definition, so a star says as much as all pairs, and its size is linear.

    ``small`` only chooses between two exact forms.  Every link has a variant that gives it (see
    :func:`_linked`).  If that holds at most ``small`` fingerprints, the pair is verified there.
    If it holds more, both ends have all their neighbours in ``around``, meet at one of them and
    hang on its star.  And no star joins what isn't linked: two fingerprints around one
    neighbour differ in at most ``max_bits`` bits.
    """
    index = variants(fps, max_bits)
    sizes = written(index.groupBy("part", "key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    # the sizes grow with the corpus, so they are merged, never sent to every task
    shared = written(index.join(sizes.hint("merge"), ["part", "key"]).select("part", "key", "fp", "n"), "variants")
    few = (shared.where(F.col("n") <= small).groupBy("part", "key")
           .agg(F.sort_array(F.collect_list("fp")).alias("m")))
    full, bit, first, linked = _linked(max_bits)
    pairs = few.select("m", full, bit, first).select(F.explode(linked).alias("e")).select("e.a", "e.b")
    around = balls(shared.where(F.col("n") > small).select("fp").distinct(), max_bits)
    hubs = written(around.groupBy("part", "key").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1"), "hubs")
    stars = around.join(hubs, ["part", "key"]).where("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(key columns, fp, component) of every row; component: the smallest id reachable.

    Null and empty texts have fingerprint 0 and link like any other; equal texts share a
    fingerprint.  A null id counts as the smallest; a component led by it reports null.
    """
    with staging() as keep:
        rows = written(with_fingerprint(docs, id_col, text_col, shingle), "fingerprints")
        fps = written(rows.groupBy("fp").agg(F.min(ID).alias("first")), "distinct-fingerprints")
        of = components(links(fps.select("fp"), max_bits))
        roots = fps.join(of.withColumnRenamed("vertex", "fp"), "fp", "left").select(
            "fp", "first", F.coalesce("component", "fp").alias("root"))
        # written, so that the join meets plain shuffles and a component of very many rows can be split
        least = written(roots.groupBy("root").agg(F.min("first").alias("component")), "least")
        named = written(roots.join(least, "root").select("fp", "component"), "components")
        keep(rows, named)
    return rows.join(named, "fp")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id; one row per input row."""
    found = near_duplicates(docs, id_col, text_col, shingle, max_bits)
    return found.select(original_id().alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.when(F.col("component") != F.lit(-(2**63)), F.col("component")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row left of each component: the smallest id, then text hash; of
    repeated rows one."""
    found = near_duplicates(docs, id_col, text_col, shingle, max_bits)
    keep = found.groupBy("component").agg(F.min(F.struct(ID, TH)).alias("k")).select(f"k.{ID}", f"k.{TH}")
    kept = with_key(docs, id_col, text_col).join(keep, [ID, TH], "left_semi")
    return kept.dropDuplicates([ID, TH]).drop(ID, TH)
