"""Token packing: whole documents into sequences of fixed length, few of them.

Sum-of-squares placement: a document goes to the open bin for which the sum, over all
residual gaps, of the squared number of open bins with that gap becomes smallest.
"""

from __future__ import annotations

import base64
import functools
import math
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faretrail.llm.common import remembering, series_of, written

#: Pieces that one packing group holds on average; a group is packed in one task.
GROUP_PIECES = 40_000
#: Longest run of characters that the rank encoder gets; its time is quadratic in a run.
LONG_RUN = 1_000
#: Words that a worker remembers; later ones are encoded each time.
_CACHE = 200_000
_MARKS = ".,;:!?$%&*#|()-"


class _OddSpace(Exception):
    """White space meets white space, so a cut at the single space would not be safe."""


class Ids(dict):
    """Token ids (little-endian unsigned 32-bit) by the run of text that follows a space.

    ``base`` is the tokenizer file of the ``tokenizers`` library, ``ranks`` the same
    vocabulary as ranks.  Both give the same ids; the second is quicker on short runs.
    """

    def __init__(self, base: str, ranks: str | None):
        from tokenizers import Tokenizer

        super().__init__()
        self._slow, self._quick, self._piece = Tokenizer.from_file(base), None, None
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=table, special_tokens={})
            self._quick, self._piece = quick.encode_ordinary, getattr(quick, "_encode_single_piece", None)

    def run(self, run: str) -> bytes:
        if self._quick is None or len(run) > LONG_RUN or "<|" in run:
            ids = self._slow.encode(run, add_special_tokens=False).ids
        else:
            ids = self._quick(run)
        return array("I", ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _OddSpace
        stem = word.rstrip(_MARKS)
        if self._piece is not None and len(word) <= 60 and stem.isalpha():
            # letters, then marks: the vocabulary's pattern makes these two runs of them
            ids = self._piece(" " + stem)
            if len(stem) < len(word):
                ids += self._piece(word[len(stem):])
            out = array("I", ids).tobytes()
        else:
            out = self.run(" " + word)
        if len(word) <= 60 and len(self) < _CACHE:
            self[word] = out
        return out

    def text(self, text: str) -> bytes:
        """Ids of a whole text.  Cut only at single spaces between two other characters:
        there the pattern of the vocabulary always begins a new run."""
        parts = text.split(" ")
        try:
            return b"".join([self.run(parts[0]), *map(self.__getitem__, parts[1:])])
        except _OddSpace:
            pass
        runs = [parts[0]]
        for part in parts[1:]:
            if not part or part[0].isspace() or not runs[-1] or runs[-1][-1].isspace():
                runs[-1] += " " + part
            else:
                runs.append(part)
        return b"".join([self.run(runs[0]),
                         *(self.run(" " + r) if r[-1].isspace() else self[r] for r in runs[1:])])


@functools.lru_cache(maxsize=2)
def encoder(base: str, ranks: str | None) -> Ids:
    return Ids(base, ranks)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return (public_tokenizers.path("byte_bpe_50k.json"),
            public_tokenizers.path("byte_bpe_50k.tiktoken"))


def cut(total: int, size: int) -> Iterator[tuple[int, int, int]]:
    """(piece, start, length) of a document of ``total`` ids: the first takes the odd rest."""
    first = total if total <= size else (total % size or size)
    yield 0, 0, first
    for k, start in enumerate(range(first, total, size), 1):
        yield k, start, size


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 size: int = 2048, end_id: int = 0, base: str | None = None,
                 ranks: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 (and ids).

    A null text counts as empty; every document ends with ``end_id``, so an empty one has
    one piece of one id.  Equal rows give equal pieces, each once per row.
    """
    if base is None:
        base, ranks = default_vocabulary()
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        remembering("packing", encoder.cache_clear)
        ids = encoder(base, ranks)
        for b in batches:
            rows = []
            for i, t in zip(b.iloc[:, 0], series_of(b.iloc[:, 1]), strict=True):
                raw = ids.text(t) + end if t else end
                for k, start, n in cut(len(raw) // 4, size):
                    own = raw[4 * start:4 * (start + n)]
                    rows.append((i, k, start, n, zlib.crc32(own), *([np.frombuffer(own, "<u4").astype("int64")] * keep_ids)))
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * keep_ids
    return (docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
            .mapInPandas(run, schema))


def place(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (1..size), longest first.

    Among the open bins that hold the piece, the one with the smallest resulting sum of
    squares, ties to the smallest rest; a new bin only where none holds it.
    """
    count = np.zeros(size + 1, dtype=np.int64)  # of open bins by gap; full ones are closed
    bins: list[list[int]] = [[] for _ in range(size + 1)]
    bin_of, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    n = 0
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        open_ = count[s:size]
        gaps = np.flatnonzero(open_)
        if len(gaps):
            # count[g] falls by one, count[g - s] grows by one unless the bin is full then
            change = -2 * open_[gaps] + np.where(gaps > 0, 2 * count[gaps] + 1, 0)
            g = int(gaps[np.argmin(change)]) + s
            b = bins[g].pop()
            count[g] -= 1
        else:
            g, b, n = size, n, n + 1
        bin_of[i], offset[i] = b, size - g
        if g > s:
            bins[g - s].append(b)
            count[g - s] += 1
    return bin_of, offset


def pack(pieces: DataFrame, size: int = 2048, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (a written table) with sequence_id and offset.

    Groups of about ``group_pieces`` pieces, dealt evenly by position, are packed apart,
    so no task holds more; each group leaves a few open sequences at most.  Full pieces
    are sequences of their own.
    """
    n = pieces.count()
    groups = max(1, math.ceil(n / group_pieces))
    schema = pieces.schema.simpleString()[len("struct<"):-1] + ",sequence_id:bigint,offset:bigint"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        group = int(rows.pop("_ft_group").iloc[0])
        bin_of, offset = place(rows["length"].to_numpy(), size)
        rows["doc_id"] = rows["doc_id"].astype("Int64")
        return rows.assign(sequence_id=bin_of + (group << 32), offset=offset)

    at = F.monotonically_increasing_id()
    dealt = at.bitwiseAND((1 << 33) - 1) + F.shiftright(at, 33)
    return (pieces.withColumn("_ft_group", F.pmod(dealt, F.lit(groups)))
            .groupBy("_ft_group").applyInPandas(run, schema.replace(":", " ")))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   size: int = 2048, end_id: int = 0, base: str | None = None,
                   ranks: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack ``docs``: one row per piece with its place.

    doc_id, piece, start (ids of the document before it), length, ids_crc32,
    [ids,] sequence_id, offset.  An empty table gives no rows.
    """
    pieces = written(token_pieces(docs, id_col, text_col, size, end_id, base, ranks, keep_ids), "pieces")
    return pack(pieces, size)


def sequences(packed: DataFrame) -> DataFrame:
    """Token sequences of ``pack_documents(keep_ids=True)``: sequence_id, ids, doc_ids."""
    return (packed.groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("_p"))
            .select("sequence_id", F.flatten("_p.ids").alias("ids"), F.col("_p.doc_id").alias("doc_ids")))
