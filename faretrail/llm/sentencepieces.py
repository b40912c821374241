"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch stand one after the other in one indexed text.  All its suffixes
are sorted as far as a piece is long; every piece of the vocabulary finds its occurrences there
by binary search.  The occurrences are edges between places of a word; sorted by their end,
they are relaxed from the left.  For a merge vocabulary, an edge holds if merging its piece
with the one before it gives just these two: exactly one edge per place does, and following
them back from the end of a word gives the ids that merging in order of score gives.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretrail.llm.common import chunks, series_of

SPACE = "▁"
#: Characters of text that are indexed at once (one longer text is split between words).
INDEXED = 6_000_000
_SLOTS = 1 << 21
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_BEGIN, _NONE = -1, -2


class _Units(dict):
    """Number of each distinct word, in order of first sight."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Vocabulary:
    """Pieces, scores and kinds of a model file with merges and byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.size = model.get_piece_size()
        self.unknown = model.unk_id()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.bytes_of, self.byte_ids, self.ids = [], {}, {}
        for i, p in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte_ids[int(p[1:-1], 16)] = i
                self.bytes_of.append(bytes([int(p[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes_of.append(b" \xe2\x81\x87 " if model.is_unknown(i) else b"")
            else:
                self.ids[p] = i
                self.bytes_of.append(p.replace(SPACE, " ").encode())
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        letters = sorted({c for p in self.ids for c in p})
        #: 0 parts words; the last code is any character outside the vocabulary
        self.code = np.full(0x110000, len(letters) + 1, np.uint16)
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.letters, self.other = letters, len(letters) + 1
        # code of a letter -> its own piece, or a number past the vocabulary
        self.single = np.array([n, *(self.ids.get(c, n + 1 + k) for k, c in enumerate(letters)), n + 1 + len(letters)])
        self.longest = max(map(len, self.ids))
        many = [p for p in self.ids if len(p) > 1]
        self.many = np.array([self.ids[p] for p in many])
        self.lengths = np.array([len(p) for p in many])
        coded = np.zeros((len(many), -(-self.longest // 4) * 4), np.uint64)
        for k, p in enumerate(many):
            coded[k, :len(p)] = self.code[[ord(c) for c in p]]
        past = np.arange(coded.shape[1]) >= self.lengths[:, None]
        self.low, self.high = _packed(coded), _packed(np.where(past, np.uint64(0xFFFF), coded))
        self.alone = np.full(n + self.other + 2, -1, np.int8)
        self.known: dict[int, bool] = {}
        self.slot_key = np.full(_SLOTS, -1, np.int64)
        self.slot_value = np.zeros(_SLOTS, bool)

    def string(self, token: int) -> str:
        if token < self.size:
            return self.pieces[token]
        k = token - self.size - 1
        return self.letters[k] if k < len(self.letters) else "\0"

    def merged(self, text: str) -> list[str]:
        """Merging in order of score, leftmost first; only ever of one or two pieces."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def stands_alone(self, tokens: np.ndarray) -> np.ndarray:
        for t in np.unique(tokens[self.alone[tokens] < 0]).tolist():
            self.alone[t] = self.merged(self.string(t)) == [self.string(t)]
        return self.alone[tokens] > 0

    def stands_after(self, before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Whether merging the two pieces' letters gives back the two; remembered by pair."""
        key = before * (1 << 20) + tokens
        slot = (((key.astype(np.uint64) * _SPREAD) >> np.uint64(40)) & np.uint64(_SLOTS - 1)).astype(np.int64)
        miss = self.slot_key[slot] != key
        if miss.any():
            if len(self.known) > 1_500_000:
                self.known.clear()
            left, at, back = np.unique(key[miss], return_index=True, return_inverse=True)
            answer = np.empty(len(left), bool)
            for i, k in enumerate(left.tolist()):
                hit = self.known.get(k)
                if hit is None:
                    a, b = self.string(k >> 20), self.string(k & ((1 << 20) - 1))
                    hit = self.known[k] = "\0" in (a, b) or self.merged(a + b) == [a, b]
                answer[i] = hit
            out = np.empty(len(key), bool)
            out[~miss] = self.slot_value[slot[~miss]]
            out[miss] = answer[back]
            self.slot_key[slot[miss]], self.slot_value[slot[miss]] = key[miss], answer[back]
            return out
        return self.slot_value[slot]


def _packed(codes: np.ndarray) -> np.ndarray:
    """Four 16-bit codes a number, most significant first."""
    c = codes.reshape(len(codes), -1, 4).astype(np.uint64)
    return (c[..., 0] << np.uint64(48)) | (c[..., 1] << np.uint64(32)) | (c[..., 2] << np.uint64(16)) | c[..., 3]


def _ranks(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key)
    step = np.empty(len(key), np.int64)
    sorted_ = key[order]
    step[0] = 0
    step[1:] = sorted_[1:] != sorted_[:-1]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(step)
    return order, rank


def suffix_order(four: np.ndarray, longest: int) -> np.ndarray:
    """Suffixes in order of their first ``longest`` codes, by doubling; ``four``: packed codes."""
    order, rank = _ranks(four)
    width = 4
    while width < longest:
        after = np.zeros(len(rank), np.int64)
        after[:-width] = rank[width:] + 1
        order, rank = _ranks((rank << 31) | after)
        width *= 2
    return order


def occurrences(vocabulary: Vocabulary, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, token, length) of every occurrence of every piece of more than one character."""
    n, words = len(codes), vocabulary.low.shape[1]
    padded = np.concatenate([codes, np.zeros(4 * words + 4, np.uint16)]).astype(np.uint64)
    four = (padded[:-3] << np.uint64(48)) | (padded[1:-2] << np.uint64(32)) | (padded[2:-1] << np.uint64(16)) | padded[3:]
    order = suffix_order(four[:n], vocabulary.longest)

    def bound(target: np.ndarray, right: bool) -> np.ndarray:
        lo, hi = np.zeros(len(target), np.int64), np.full(len(target), n)
        while (lo < hi).any():
            mid = (lo + hi) // 2
            at = order[np.minimum(mid, n - 1)]
            less = np.zeros(len(target), bool)
            same = np.ones(len(target), bool)
            for k in range(words):
                x, t = four[at + 4 * k], target[:, k]
                less |= same & (x < t)
                same &= x == t
                if not same.any():
                    break
            go = (less | (same & right)) & (lo < hi)
            lo, hi = np.where(go, mid + 1, lo), np.where(go | (lo >= hi), hi, mid)
        return lo

    first, last = bound(vocabulary.low, False), bound(vocabulary.high, True)
    count = last - first
    at = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    return order[at], np.repeat(vocabulary.many, count), np.repeat(vocabulary.lengths, count)


def encode_words(vocabulary: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words one after the other, and where each word's begin (and the end)."""
    if not words:
        return np.empty(0, np.int64), np.zeros(1, np.int64)
    points = np.frombuffer(("\0".join(words) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    codes = vocabulary.code[points]
    codes[begins + sizes] = 0
    inside = np.flatnonzero(codes)
    start, token, length = occurrences(vocabulary, codes)
    start = np.concatenate([inside, start])
    token = np.concatenate([vocabulary.single[codes[inside]], token])
    end = start + np.concatenate([np.ones(len(inside), np.int64), length])
    offset = end - np.repeat(begins, sizes + 1)[start]
    by_end = np.argsort(offset.astype(np.uint16) if sizes.max() < 65536 else offset, kind="stable")
    start, token, end = start[by_end], token[by_end], end[by_end]
    edges = np.concatenate([[0], np.cumsum(np.bincount(offset)[1:])])
    last, origin = np.full(len(codes) + 1, _NONE, np.int64), np.zeros(len(codes) + 1, np.int64)
    last[begins] = _BEGIN
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        s, t, e = start[lo:hi], token[lo:hi], end[lo:hi]
        before = last[s]
        ok = before == _BEGIN
        ok[ok] = vocabulary.stands_alone(t[ok])
        rest = np.flatnonzero(before >= 0)
        ok[rest] = vocabulary.stands_after(before[rest], t[rest])
        last[e[ok]], origin[e[ok]] = t[ok], s[ok]
    # back from the ends of all words at once
    at, own, found = begins + sizes, np.arange(len(words)), []
    own, at = own[sizes > 0], at[sizes > 0]
    while len(at):
        found.append((own, last[at], at - 1))
        at = origin[at]
        more = at > begins[own]
        own, at = own[more], at[more]
    unit, token, place = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3
    order = np.argsort(place)
    unit, token, place = unit[order], token[order], place[order]
    strange = np.flatnonzero(token > vocabulary.size)
    width = np.ones(len(token), np.int64)
    ids = [vocabulary.byte_ids] if vocabulary.byte_ids else []
    spelled = {}
    for k in strange.tolist():
        c = int(points[place[k]])
        spelled[k] = [ids[0][x] for x in chr(c).encode("utf-8", "replace")] if ids else [vocabulary.unknown]
        width[k] = len(spelled[k])
    out = np.repeat(token, width)
    where = np.cumsum(width) - width
    for k, own_ids in spelled.items():
        out[where[k]:where[k] + width[k]] = own_ids
    ends = np.concatenate([[0], np.cumsum(np.bincount(unit, width, len(words)).astype(np.int64))])
    return out, ends


_WORD = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")


def encode(vocabulary: Vocabulary, texts: list[str]) -> list[np.ndarray]:
    """Ids of each text.  No piece goes on after a space or over a line end, so words apart."""
    out = []
    for lo, hi in chunks(texts, INDEXED):
        units = _Units()
        at = [np.fromiter(map(units.__getitem__, _WORD.findall(SPACE + t.replace(" ", SPACE)) if t else ()), np.int64) for t in texts[lo:hi]]
        ids, ends = encode_words(vocabulary, list(units))
        for own in at:
            n = ends[own + 1] - ends[own]
            out.append(ids[np.repeat(ends[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())].astype(np.int32))
    return out


def decode(vocabulary: Vocabulary, ids: list[int]) -> str:
    """Text of ids: pieces joined, the space before the first word taken off, bytes put
    together (what is no UTF-8 becomes U+FFFD)."""
    raw = b"".join(map(vocabulary.bytes_of.__getitem__, ids))
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encoded(text: Column, model: str | None = None) -> Column:
    """Ids of a text column as array<int>; null and empty texts have none."""
    model = model or default_model()

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(encode(vocabulary(model), series_of(texts)))

    return run(text.cast("string"))


def decoded(ids: Column, model: str | None = None) -> Column:
    """Text of an ids column; null ids give null, empty ones the empty text."""
    model = model or default_model()

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        v = vocabulary(model)
        return pd.Series([None if x is None else decode(v, x) for x in column], dtype=object)

    return run(ids)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (little-endian unsigned 32-bit ids), round_trip (whether
    decoding gives the text back: a U+2581 in a text comes back as a space) of every row.

    A null text has no ids and decodes to the empty text; repeated rows give equal rows."""
    model = model or default_model()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabulary(model)
        for b in batches:
            texts = series_of(b["text"])
            for lo, hi in chunks(texts, INDEXED):
                ids = encode(v, texts[lo:hi])
                yield pd.DataFrame({"doc_id": b["doc_id"].iloc[lo:hi].astype("Int64").to_numpy(dtype=object, na_value=None),
                                    "n_ids": [len(x) for x in ids], "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids],
                                    "round_trip": [decode(v, x.tolist()) == t for x, t in zip(ids, texts[lo:hi], strict=True)]})

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInPandas(run, "doc_id long, n_ids long, ids_crc32 long, round_trip boolean"))
