"""Recurring lines by a template tree of fixed depth.

A line falls to the leaf of its token count and its first tokens, where a token with a digit
counts as ``<*>``.  A template leaves some places of a line open, no more than ``min_fixed``
allows: any one place, or those of the least support, which is the number of the leaf's lines
that have the line's token there.  Support is compared within a line, with no bound of its own,
so fields are found however often each of their values stands.  All contents of the leaf that a
template fits count together, frequent or not; one in ``min_docs`` documents recurs.  So do near
copies, however their places differ: one more template of a leaf holds all contents that have
``min_fixed`` of their tokens in common with its lead, the content in most documents.  A line of
fewer than ``SHORT`` tokens has no variable fields but tokens with digits, where these are half
of it at most, and needs one document more; empty lines never recur.

Each content goes with one of its recurring templates, that of most documents, and the earliest
line among the contents that go with a template stays.  So a line is dropped only for one that
stays and has the template in common with it: chains of near copies lose no text.

All tables joined here grow with the corpus, so they are merged at every size and none is
sent to all tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretrail.llm.common import ID, TEXT, TH, drop_written, keyed, original_id, remembering, with_key, written

DEPTH = 3
MIN_TOKENS = 1
#: Lines below this many tokens recur only as they are, numbers apart.
SHORT = 5
#: Rows that a task puts together before it hands them on (one line may have more tokens).
HELD = 65_536
#: Parts that the contents of one template are dealt into.
SALTS = 64
MIN_DOCS = 3
MIN_FIXED = 0.75
FIELD = b"<*>"
_DIGIT = re.compile(rb"[0-9]")
_KEYS = f"{ID} long, {TH} long"


def masked(line: bytes) -> list[bytes]:
    tokens = line.split()
    if _DIGIT.search(line):
        tokens = [FIELD if _DIGIT.search(t) else t for t in tokens]
    return tokens


def short_masked(line: bytes) -> list[bytes]:
    """The tokens of a short line: numbers are fields only beside as many fixed words."""
    tokens = masked(line)
    return tokens if 2 * tokens.count(FIELD) <= len(tokens) else line.split()


def _hash(x: bytes) -> int:
    return xxhash.xxh64_intdigest(x, 3) - (1 << 63)


def _leaf(tokens: list[bytes], depth: int) -> int:
    return _hash(b"%d " % len(tokens) + b" ".join(tokens[:depth]))


def parsed(rows: DataFrame, depth: int, min_tokens: int) -> DataFrame:
    """(leaf, line content, whether it is short, key, line number) of every line of at least
    ``min_tokens``, empty ones left out.  A short line is a leaf of its own."""
    names = ["leaf", "sig", "short", ID, TH, "line"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remembering("lines")
        out = []
        for b in batches:
            for i, th, text in zip(b[ID], b[TH], b[TEXT], strict=True):
                for k, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
                    n = len(line.split())
                    if n < max(min_tokens, 1):
                        continue
                    short = n < SHORT
                    tokens = short_masked(line) if short else masked(line)
                    out.append((_leaf(tokens, SHORT if short else depth), _hash(b" ".join(tokens)), short, i, th, k))
                    if len(out) >= HELD:
                        yield pd.DataFrame(out, columns=names)
                        out = []
        yield pd.DataFrame(out, columns=names)

    return rows.mapInPandas(run, f"leaf long, sig long, short boolean, {_KEYS}, line int")


def _tokens(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(leaf, sig, docs, total, lead, place, token hash) of one line for each wanted (leaf, sig), written.

    The hash is of the token and its place, so that a template's is the XOR of its fixed ones."""
    per_doc = written(wanted.groupBy(F.col(f"at.{ID}").alias(ID), F.col(f"at.{TH}").alias(TH))
                      .agg(F.collect_list(F.struct("leaf", "sig", "docs", "total", "lead", "at.line")).alias("r")), "wanted-lines")
    names = ["leaf", "sig", "docs", "total", "lead", "place", "token"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for b in batches:
            for text, r in zip(b[TEXT], b["r"], strict=True):
                lines = text.encode("utf-8", "surrogatepass").split(b"\n")
                for x in r:
                    own = tuple(x[c] for c in names[:5])
                    out += [(*own, p, _hash(b"%d " % p + t)) for p, t in enumerate(masked(lines[x["line"]]))]
                    if len(out) >= HELD:
                        yield pd.DataFrame(out, columns=names)
                        out = []
        yield pd.DataFrame(out, columns=names)

    out = written(rows.join(per_doc.hint("merge"), [ID, TH]).dropDuplicates([ID, TH])
                  .mapInPandas(run, "leaf long, sig long, docs long, total long, lead boolean, place int, token long"), "tokens")
    drop_written(per_doc)
    return out


def _masks(support: np.ndarray, token: np.ndarray, lead: np.ndarray, total: int, min_fixed: float) -> np.ndarray:
    """The templates that a line content may belong to, from its tokens in order of support:
    one place left open, wherever the leaf has another token, and the two, three ... places of
    least support, as many as ``min_fixed`` allows; places of one support open together.  0 is
    the template of the leaf's lead."""
    n = len(token)
    most = int(n * (1 - min_fixed) + 1e-9)
    if not most:
        return token[:0]
    whole = np.bitwise_xor.reduce(token)
    k = np.arange(2, most + 1)
    k = k[(support[k - 1] < support[np.minimum(k, n - 1)]) & (k < n)]
    open_ = np.append(token[support < total], np.bitwise_xor.accumulate(token)[k - 1])
    return np.append(whole ^ open_, np.zeros(int(n - lead.sum() <= most), dtype=np.int64))


def possible(rows: DataFrame, sigs: DataFrame, min_docs: int, min_fixed: float) -> DataFrame:
    """(leaf, template, sig, docs, at) of the general templates of every content, written."""
    leaves = written(sigs.groupBy("leaf").agg(F.sum("docs").alias("total"), F.count("*").alias("k"),
                                                F.max_by("sig", F.struct("docs", "sig")).alias("of"))
                     .where((F.col("total") >= min_docs) & (F.col("k") > 1)).select("leaf", "total", "of"), "leaves")
    wanted = written(sigs.join(leaves.hint("merge"), "leaf")
                     .select("leaf", "sig", "docs", (F.col("sig") == F.col("of")).alias("lead"), "total", "at"), "wanted")
    tokens = _tokens(rows, wanted)
    support = written(tokens.groupBy("leaf", "place", "token")
                      .agg(F.sum("docs").alias("support"), F.max("lead").alias("lead")), "support")
    # the tokens of a content follow one another, so a task holds one content beside a batch of rows
    placed = (tokens.select("leaf", "sig", "total", "place", "token").join(support.hint("merge"), ["leaf", "place", "token"])
              .repartition("leaf", "sig").sortWithinPartitions("leaf", "sig", "support", "token"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []  # columns of the content that the last batch ended in

        def templates_of(columns: list[np.ndarray], last: bool) -> Iterator[pd.DataFrame]:
            leaf, sig, total, token, support_, lead_ = columns
            starts = np.flatnonzero(np.r_[True, (leaf[1:] != leaf[:-1]) | (sig[1:] != sig[:-1])]) if len(leaf) else np.empty(0, int)
            ends = np.append(starts[1:], len(leaf))
            if not last:
                starts, ends = starts[:-1], ends[:-1]
            masks = [_masks(support_[x:y], token[x:y], lead_[x:y], int(total[x]), min_fixed) for x, y in zip(starts, ends, strict=True)]
            at = np.repeat(starts, [len(m) for m in masks])
            yield pd.DataFrame({"leaf": leaf[at], "template": np.concatenate([np.empty(0, np.int64), *masks]), "sig": sig[at]})
            held[:] = [] if last or not len(leaf) else [c[(ends[-1] if len(ends) else 0):] for c in columns]

        def joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
            return [np.concatenate(c) for c in zip(*parts, strict=True)]

        waiting: list[list[np.ndarray]] = []
        for b in batches:
            own = [b[c].to_numpy() for c in ("leaf", "sig", "total", "token", "support", "lead")]
            if not len(b):
                continue
            waiting.append(own)
            if own[0][0] == own[0][-1] and own[1][0] == own[1][-1]:  # perhaps all one content: read on
                continue
            yield from templates_of(joined([held, *waiting] if held else waiting), last=False)
            waiting = []
        if held or waiting:
            yield from templates_of(joined([held, *waiting] if held else waiting), last=True)

    out = written(placed.mapInPandas(run, "leaf long, template long, sig long")
                  .join(wanted.select("leaf", "sig", "docs", "at").hint("merge"), ["leaf", "sig"])
                  .select("leaf", "template", "sig", "docs", "at"), "possible")
    for t in (tokens, support, wanted, leaves):
        drop_written(t)
    return out


def templates(rows: DataFrame, lines: DataFrame, min_docs: int, min_fixed: float) -> DataFrame:
    """(leaf, sig, first) for every line content of a recurring template: the earliest line of the
    contents that go with the same one.  A content goes with the template of most documents (those
    of its contents together; then the one with the earlier line, then the smaller hash).  A
    content in ``min_docs`` documents is a template by itself, and belongs to the general ones of
    its leaf beside."""
    sigs = written(lines.groupBy("leaf", "sig", "short", ID, TH).agg(F.min("line").alias("line"))
                   .groupBy("leaf", "sig", "short").agg(F.count("*").alias("docs"), F.min(F.struct(ID, TH, "line")).alias("at")), "line-contents")
    maybe = possible(rows, sigs.where(~F.col("short")), min_docs, min_fixed)
    general = written(maybe.groupBy("leaf", "template")
                      .agg(F.count("*").alias("k"), F.sum("docs").alias("n"), F.max("docs").alias("most"), F.min("at").alias("first"))
                      .where((F.col("k") > 1) & (F.col("n") >= min_docs)), "general")
    # contents may share documents: where none has enough by itself, documents are counted
    known = ["leaf", "template", "n", "first"]
    unsure = general.where(F.col("most") < min_docs).select(known)
    few = written(maybe.join(unsure.hint("merge"), ["leaf", "template"]).select("sig", *known), "unsure")
    counted = (lines.join(few.hint("merge"), ["leaf", "sig"]).groupBy(*known, ID, TH).agg(F.lit(1).alias("one"))
               .groupBy(known).agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs))
    sure = written(general.where(F.col("most") >= min_docs).select(known).unionByName(counted.select(known)), "recurring")
    whole = (sigs.where(F.col("docs") >= min_docs + F.col("short").cast("int"))
             .select("leaf", "sig", "at", F.struct((-F.col("docs")).alias("n"), F.col("at").alias("first"), F.lit(True).alias("whole"), F.col("sig").alias("template")).alias("of")))
    fitting = (maybe.join(sure.hint("merge"), ["leaf", "template"])
               .select("leaf", "sig", "at", F.struct((-F.col("n")).alias("n"), "first", F.lit(False).alias("whole"), "template").alias("of")))
    chosen = written(fitting.unionByName(whole).groupBy("leaf", "sig").agg(F.min("of").alias("of"), F.min("at").alias("at"))
                     .select("leaf", "sig", "at", "of.whole", "of.template", F.pmod(F.xxhash64("sig"), F.lit(SALTS)).alias("salt")), "chosen")
    # one template may hold a third of all contents: its first line goes to each salt that it has
    stays = (chosen.groupBy("leaf", "whole", "template").agg(F.min("at").alias("first"), F.collect_set("salt").alias("salts"))
             .select("leaf", "whole", "template", "first", F.explode("salts").alias("salt")))
    out = written(chosen.join(stays.hint("merge"), ["leaf", "whole", "template", "salt"]).select("leaf", "sig", "first"), "templates")
    for t in (few, general, sure, maybe, sigs, chosen):
        drop_written(t)
    return out


def recurring(rows: DataFrame, depth: int = DEPTH, min_tokens: int = MIN_TOKENS, min_docs: int = MIN_DOCS,
              min_fixed: float = MIN_FIXED, keep_first: bool = True) -> DataFrame:
    """(key, drop): for each document its line numbers that go.  ``rows``: of :func:`keyed`."""
    lines = written(parsed(rows, depth, min_tokens), "lines")
    of = templates(rows, lines, min_docs, min_fixed)
    gone = lines.join(of.hint("merge"), ["leaf", "sig"])
    if keep_first:
        gone = gone.where(F.struct(ID, TH, "line") != F.col("first"))
    out = written(gone.groupBy(ID, TH).agg(F.collect_set("line").alias("drop")), "dropped-lines")
    drop_written(lines)
    drop_written(of)
    return out


def _applied(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (with_key(docs, id_col, text_col)
            .join(found.withColumnRenamed("drop", "_ft_drop").hint("merge"), [ID, TH], "left"))


def _kept(text_col: str) -> Column:
    lines = F.split(F.col(text_col).cast("string"), "\n", -1)
    kept = F.filter(lines, lambda x, i: ~F.array_contains("_ft_drop", i))
    return F.when(F.col("_ft_drop").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))


def without_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the lines of recurring templates, but for those (smallest id, text
    hash, line) that are the earliest of their template; ``keep_first=False`` drops these too.

    Empty lines and shorter ones than ``min_tokens`` never recur.  All rows and columns stay; null and empty
    texts are unchanged; equal rows are one document, so they don't make a line recur.
    """
    found = recurring(keyed(docs, id_col, text_col), **how)
    return _applied(docs, found, id_col, text_col).withColumn(text_col, _kept(text_col)).select(docs.columns)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 (of the kept lines joined by \\n) of every row."""
    found = recurring(keyed(docs, id_col, text_col), **how)
    kept = F.coalesce(_kept(text_col), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return _applied(docs, found, id_col, text_col).select(
        original_id().alias("doc_id"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("_ft_drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))
