"""Language of a text, by a bidirectional gated recurrent network over its bytes.

Two networks of gated units read every byte, one from either end of a stretch of ``STRETCH``
bytes; both states together label the position.  A document's probabilities are the means over
all its positions.  Trained in numpy by backpropagation through time.  Gates and states are
bent by x / (1 + abs(x)), which costs far less than exponentials.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faretrail.llm.common import ID, chunks, remembering, series_of

UNITS = 8
#: Bytes that are read together; the state starts anew with each stretch.
STRETCH = 128
#: Labelled documents that are learned from at most, and stretches of each, dealt over its text.
MAX_TRAIN, STRETCHES_EACH = 2_000, 4
#: Stretches that go through the network together.
_TOGETHER = 2_048
#: Number of a place behind the end of a text: an untouched state stays zero there.
_PAD = 256
UNKNOWN = "und"
R, Z, N = range(3)


@dataclass
class Network:
    """Of each direction and gate (reset, update, new): what a byte adds, and the state;
    of each direction: what a state says for each language; and a constant a language."""

    languages: tuple[str, ...]
    byte: np.ndarray  # (2, 3, 257, units)
    state: np.ndarray  # (2, 3, units, units)
    out: np.ndarray  # (2, units, languages)
    bias: np.ndarray  # (languages,)


def fresh(languages: tuple[str, ...], units: int = UNITS, seed: int = 3) -> Network:
    r = np.random.default_rng(seed)
    byte = r.normal(0, 0.3, (2, 3, 257, units))
    byte[:, Z] += 0.5
    byte[:, :, _PAD] = 0
    kind = np.float32
    return Network(languages, byte.astype(kind), r.normal(0, 0.3 / units ** 0.5, (2, 3, units, units)).astype(kind),
                   r.normal(0, 0.3, (2, units, len(languages))).astype(kind), np.zeros(len(languages), kind))


def logits(net: Network, x: np.ndarray) -> np.ndarray:
    """(stretch length, stretches, languages) of byte numbers (stretch length, stretches)."""
    size, many = x.shape
    units, kind = net.state.shape[-1], net.byte.dtype
    out = np.empty((size, many, len(net.bias)), kind)
    r, z, n, m, h = (np.empty((many, units), kind) for _ in range(5))
    one, half = kind.type(1), kind.type(0.5)
    for way in range(2):
        byte, state = net.byte[way], net.state[way]
        h[:] = 0
        for t in range(size) if way == 0 else range(size - 1, -1, -1):
            for gate, g in ((R, r), (Z, z)):
                byte[gate].take(x[t], axis=0, out=g, mode="clip")
                np.matmul(h, state[gate], out=m)
                g += m
                np.abs(g, out=m)
                m += one
                g /= m
                g *= half
                g += half
            byte[N].take(x[t], axis=0, out=n, mode="clip")
            np.matmul(h, state[N], out=m)
            m *= r
            n += m
            np.abs(n, out=m)
            m += one
            n /= m
            h -= n
            h *= z
            h += n
            if way == 0:
                np.matmul(h, net.out[0], out=out[t])
            else:
                out[t] += h @ net.out[1]
    out += net.bias
    return out


def probabilities(scores: np.ndarray) -> np.ndarray:
    """Softmax over the last axis."""
    p = np.exp(np.clip(scores, -30, 30))
    return p / p.sum(axis=-1, keepdims=True)


def _bent(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bent values and their slopes."""
    below = 1 / (1 + np.abs(a))
    return a * below, below * below


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy of all positions against the languages ``y`` of the stretches, and its
    gradients, by backpropagation through time in both directions."""
    size, many = x.shape
    units = net.state.shape[-1]
    real = x != _PAD
    states, seen = [], []
    for way in range(2):
        h, steps = np.zeros((many, units), net.byte.dtype), []
        all_states = np.empty((size, many, units), net.byte.dtype)
        for t in range(size) if way == 0 else range(size - 1, -1, -1):
            byte, state = net.byte[way], net.state[way]
            m = h @ state[N]
            r, slope_r = _bent(byte[R][x[t]] + h @ state[R])
            z, slope_z = _bent(byte[Z][x[t]] + h @ state[Z])
            r, z = 0.5 + 0.5 * r, 0.5 + 0.5 * z
            n, slope_n = _bent(byte[N][x[t]] + r * m)
            steps.append((t, h, r, z, n, m, slope_r, slope_z, slope_n))
            h = n + z * (h - n)
            all_states[t] = h
        states.append(all_states)
        seen.append(steps)
    p = probabilities(states[0] @ net.out[0] + states[1] @ net.out[1] + net.bias)
    count = max(int(real.sum()), 1)
    loss = float(-np.log(np.maximum(np.take_along_axis(p, np.broadcast_to(y[None, :, None], (size, many, 1)), 2)[..., 0], 1e-12))[real].sum() / count)
    d_out = p
    d_out[:, np.arange(many), y] -= 1
    d_out *= real[:, :, None] / count
    grads = {k: np.zeros_like(getattr(net, k)) for k in ("byte", "state", "out", "bias")}
    grads["bias"] = d_out.sum(axis=(0, 1))
    order = np.argsort(x.ravel(), kind="stable")
    cut = np.flatnonzero(np.r_[True, np.diff(x.ravel()[order]) != 0])
    which = x.ravel()[order][cut]
    for way in range(2):
        grads["out"][way] = np.tensordot(states[way], d_out, axes=((0, 1), (0, 1)))
        state, d_state = net.state[way], grads["state"][way]
        d_byte = np.empty((3, size, many, units), net.byte.dtype)
        d_h = np.zeros((many, units), net.byte.dtype)
        for t, h, r, z, n, m, slope_r, slope_z, slope_n in reversed(seen[way]):
            d_h = d_h + d_out[t] @ net.out[way].T
            d_a = d_h * (1 - z) * slope_n
            d_z = d_h * (h - n) * (0.5 * slope_z)
            d_r = d_a * m * (0.5 * slope_r)
            d_m = d_a * r
            d_h = d_h * z + d_m @ state[N].T + d_z @ state[Z].T + d_r @ state[R].T
            d_state[R] += h.T @ d_r
            d_state[Z] += h.T @ d_z
            d_state[N] += h.T @ d_m
            d_byte[:, t] = d_r, d_z, d_a
        by = d_byte.reshape(3, -1, units)[:, order]
        grads["byte"][way][:, which] = np.add.reduceat(by, cut, axis=1)
    grads["byte"][:, :, _PAD] = 0
    return loss, grads


def fit(languages: tuple[str, ...], x: np.ndarray, y: np.ndarray, epochs: int = 4, batch: int = 256,
        step: float = 0.02, seed: int = 3) -> Network:
    """Adam over small batches of stretches (rows of ``x``), a fixed number of epochs; the step
    falls to nothing in a straight line."""
    net, rng = fresh(languages, seed=seed), np.random.default_rng(seed)
    names = ("byte", "state", "out", "bias")
    first, second = ({k: np.zeros_like(getattr(net, k)) for k in names} for _ in range(2))
    total, t = epochs * -(-len(x) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), batch):
            own = order[lo:lo + batch]
            _, grads = gradients(net, np.ascontiguousarray(x[own].T), y[own])
            norm = float(np.sqrt(sum((g.astype(float) ** 2).sum() for g in grads.values())))
            rate, t = step * (1 - t / total), t + 1
            for k in names:
                d = grads[k] * np.float32(min(1.0, 1.0 / max(norm, 1e-9)))
                first[k] += np.float32(0.1) * (d - first[k])
                second[k] += np.float32(0.01) * (d * d - second[k])
                getattr(net, k)[...] -= (rate / (1 - 0.9 ** t)) * first[k] / (np.sqrt(second[k] / (1 - 0.99 ** t)) + 1e-8)
    return net


def _stretches(raw: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, and of every stretch its text, start and length."""
    lengths = np.array([len(r) for r in raw], dtype=np.int64)
    per = -(-lengths // size)
    of = np.repeat(np.arange(len(raw)), per)
    k = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    at = (np.cumsum(lengths) - lengths)[of] + k * size
    return np.frombuffer(b"".join(raw), np.uint8), of, at, np.minimum(size, lengths[of] - k * size)


def _padded(data: np.ndarray, at: np.ndarray, length: np.ndarray, size: int) -> np.ndarray:
    """(size, stretches) byte numbers, ``_PAD`` behind the ends."""
    place = np.arange(size)[:, None]
    inside = place < length
    return np.where(inside, data[np.where(inside, at + place, 0)].astype(np.intp), _PAD)


def pooled(net: Network, texts: list[str], size: int = STRETCH) -> np.ndarray:
    """(texts, languages): mean probabilities over all positions of each; zeros for an empty text."""
    total = np.zeros((len(texts), len(net.languages)))
    for lo, hi in chunks(texts, 1 << 20):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts[lo:hi]]
        data, of, at, length = _stretches(raw, size)
        for k in range(0, len(at), _TOGETHER):
            own = slice(k, k + _TOGETHER)
            x = _padded(data, at[own], length[own], size)
            p = np.exp(np.clip(logits(net, x), -30, 30))
            weight = (x != _PAD) / np.add.reduce(p, axis=2)
            said = np.einsum("tbc,tb->bc", p, weight.astype(p.dtype))
            np.add.at(total, lo + of[own], said)
        total[lo:hi] /= np.maximum([len(r) for r in raw], 1)[:, None]
    return total


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_train: int = MAX_TRAIN, each: int = STRETCHES_EACH) -> Network | None:
    """A network of all languages that ``docs`` names, from at most ``max_train`` documents.

    The same number of each language is taken, by the smallest hash of the id; of each up to
    ``each`` stretches evenly over its whole text.  Rows without an id, a language or a byte
    of text are not learned from.  Without any: None.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & (F.length(F.col(text_col).cast("string")) > 0))
    known = known.select(F.col(id_col).cast("long").alias(ID), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(counts))
    if not languages:
        return None
    each_lang = max(1, max_train // len(languages))
    # the share of the hashes that holds so many ids, with room for chance, leaves few to rank
    place = F.shiftrightunsigned(F.xxhash64(ID), 32) / float(1 << 32)
    shares = ((F.lit(v), F.lit(min(1.0, (each_lang + 6 * each_lang ** 0.5 + 20) / counts[v]))) for v in languages)
    low = known.select(ID, "lang").where(place < F.create_map(*itertools.chain.from_iterable(shares))[F.col("lang")]).distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(place, ID))
    chosen = low.withColumn("n", rank).where(F.col("n") <= each_lang).select(ID, "lang")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = []
            for t in b["text"]:
                raw = t.encode("utf-8", "surrogatepass")
                places = np.unique(np.linspace(0, max(len(raw) - STRETCH, 0), each).astype(int))
                parts.append([raw[p:p + STRETCH] for p in places])
            yield pd.DataFrame({ID: b[ID], "lang": b["lang"], "parts": parts})

    rows = (known.join(F.broadcast(chosen), [ID, "lang"]).mapInPandas(cut, f"{ID} long, lang string, parts array<binary>")
            .groupBy(ID, "lang").agg(F.min("parts").alias("parts")).toPandas().sort_values([ID, "lang"]))
    parts = [bytes(p) for own in rows["parts"] for p in own]
    x = np.full((len(parts), STRETCH), _PAD, dtype=np.intp)
    for i, p in enumerate(parts):
        x[i, :len(p)] = np.frombuffer(p, np.uint8)
    number = {v: i for i, v in enumerate(languages)}
    y = np.repeat(rows["lang"].map(number).to_numpy(np.int64), rows["parts"].map(len).to_numpy(np.int64))
    return fit(languages, x, y)


def predicted(text: Column, net: Network | None) -> Column:
    """struct<lang, score>: the likeliest language and its mean probability over all positions of
    the whole text.  ``und`` and 0 where the text is null or has no letter, or nothing was learned;
    of equal languages the first by name.  The network is a few tens of kB, whatever the corpus."""
    @F.pandas_udf("struct<lang:string,score:double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        remembering("language")
        all_texts = series_of(texts)
        lettered = [net is not None and any(map(str.isalpha, t)) for t in all_texts]
        own = [t for t, yes in zip(all_texts, lettered, strict=True) if yes]
        lang = np.full(len(all_texts), UNKNOWN, dtype=object)
        score = np.zeros(len(all_texts))
        if own:
            p = pooled(net, own)
            lang[lettered] = np.array(net.languages, dtype=object)[p.argmax(axis=1)]
            score[lettered] = np.clip(p.max(axis=1), 0, 1)
        return pd.DataFrame({"lang": lang, "score": score})

    return predict(text.cast("string"))
