"""Periodic runs, importance resampling and language identification against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from faretrail.llm import language, periods, queries, resampling
from faretrail.llm.queries import in_fold

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_runs(x, min_exponent=4, min_length=6):
    """Every period, every place."""
    out, n = [], len(x)
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and x[i] == x[i + q]:
                i += 1
            e = i + q
            if e - s >= max(min_length, min_exponent * q) and not any(all(x[j] == x[j + k] for j in range(s, e - k)) for k in range(1, q)):
                out.append((s, e - s, q))
    return sorted(out)


def plain_periodic(doc_id, words):
    """The words of a document as the query makes them periodic."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)] if h % 10 == 0 else words


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_row(words):
    runs = plain_runs(words)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            digest("".join(f"{s},{k},{q}\n" for s, k, q in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("prime, generator", periods.PRIMES)
def test_transforms(prime, generator):
    assert all(prime % d for d in range(2, 2000)) and pow(7, prime - 1, prime) == 1
    assert pow(generator, (prime - 1) // 2, prime) == prime - 1  # so roots of every power of two have that order
    r = np.random.default_rng(1)
    rows = r.integers(0, prime, (3, 64), dtype=np.uint64)
    assert (periods.transform_back(periods.transform(rows, prime, generator), prime, generator) == rows).all()
    for size in (1, 2, 8, 32):
        block, window = r.integers(0, 1000, (4, size)), r.integers(0, 1000, (4, 2 * size))
        got = periods.squared_differences(block, window, prime, generator)
        want = [[int(((b - w[e:e + size]) ** 2).sum()) for e in range(size)] for b, w in zip(block, window, strict=True)]
        assert (got == np.array(want) % prime).all()


@pytest.mark.parametrize("seed", range(3))
def test_runs_against_every_period(seed):
    r = random.Random(seed)
    seen = 0
    for _ in range(500):
        k, x = r.choice([1, 2, 2, 3, 5]), []
        for _ in range(r.randint(0, 5)):
            w = [r.randrange(k) for _ in range(r.randint(1, r.choice([3, 9, 20])))]
            x += w * r.randint(1, 6) + w[:r.randint(0, len(w))]
        for least in (3, 4):
            want = plain_runs(x, least)
            assert periods.runs_of(np.array(x, dtype=np.int64), least) == want, x
            seen += len(want)
    assert seen > 500
    with pytest.raises(ValueError):
        periods.runs_of(np.zeros(9, dtype=np.int64), 2)


def test_chance_zeros_of_one_prime_are_no_match(monkeypatch):
    """Differences whose squares add up to a multiple of the first prime, all words being large."""
    prime = periods.PRIMES[0][0]
    a = next(a for a in range(1, 70_000) if math.isqrt(prime - a * a) ** 2 == prime - a * a)  # prime = a*a + b*b
    b = math.isqrt(prime - a * a)
    x = np.array([0, 0, a, b, 1, 2], dtype=np.int64)
    assert int(periods.squared_differences(x[None, :2], x[None, 2:6], *periods.PRIMES[0])[0, 0]) == 0
    assert list(periods._matches(x, np.array([0]), 2, int(x.max()) + 1)) == []


def test_long_runs_and_nested_ones():
    x = np.arange(30_000) % 7_001
    assert periods.runs_of(x) == [(0, 30_000, 7_001)]
    assert periods.runs_of(np.zeros(50_000, dtype=np.int64)) == [(0, 50_000, 1)]
    nested = np.array(([0] * 9 + [1]) * 500)
    assert periods.runs_of(nested) == sorted([(10 * i, 9, 1) for i in range(500)] + [(0, 5_000, 10)])


def test_runs_of_all_rows(spark, wide_docs, no_docs):
    texts = [(i, " ".join(f"w{j % 37}" if i % 3 else f"w{j * j % 101}" for j in range(i * 3))) for i in range(40)]
    docs = wide_docs.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in texts], "doc_id long, text string"))
    docs = docs.selectExpr("doc_id", "text", "1 AS start", "2 AS runs", "3 AS n_words", "4 AS collapsed", "5 AS _ft_x", "6 AS period")
    got = docs.select("doc_id", "text", periods.found(F.col("text")).alias("f")).collect()
    assert len(got) == docs.count()
    for x in got:
        words = WORD.findall(x.text or "")
        assert x.f.n_words == len(words)
        if len(words) < 3_000:
            assert [tuple(y) for y in x.f.runs] == plain_runs(words)
        else:
            assert [tuple(y) for y in x.f.runs] == [(0, 40_000, 977)] and len(x.f.collapsed.split()) == 977
        if not words:
            assert x.f.collapsed == ""
    assert no_docs.select(periods.found(F.col("text"))).count() == 0


def test_runs_query(spark, odd_docs, tmp_path):
    rows = [(i, " ".join(f"w{j * 7 % (i + 3)}x{j % 5}" for j in range(i % 90))) for i in range(20, 400)] + [(21, "a b"), (21, None)]
    docs = odd_docs.where("doc_id IS NULL OR doc_id <> 4").unionByName(
        spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], odd_docs.schema)).withColumn("runs", F.lit("x"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = Counter((x.doc_id, *plain_row(plain_periodic(x.doc_id, WORD.findall(x.text or "")))) for x in docs.collect())
    out = queries.op11_periodic_runs(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert Counter(tuple(x) for x in out.collect()) == want
    assert sum(c for k, c in want.items() if k[1]) > 15  # about every tenth of 390


def test_checksums_of_spans():
    r = random.Random(1)
    blob = np.frombuffer(bytes(r.randrange(256) for _ in range(60_000)), np.uint8)
    sizes = [0, 1, 2, 5, 63, 64, 65, 127, 128, 129, 1_000, 8_192, 40_000]
    starts = np.array([r.randrange(20_000) for _ in range(60) for _ in sizes])
    ends = starts + np.array(sizes * 60)
    assert resampling.crc32_of_spans(blob, starts, ends).tolist() == [zlib.crc32(blob[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
    assert resampling.crc32_of_spans(blob, starts[:0], ends[:0]).tolist() == []


def plain_terms(text, max_words=1):
    w = TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return w, [" ".join(w[i:i + k]) for k in range(1, max_words + 1) for i in range(len(w) - k + 1)]


@pytest.mark.parametrize("max_words", [1, 3])
def test_features(max_words):
    r = random.Random(2)
    texts = ["", "Hello World é 12a", " x ", "a-b_c", "ÀÉ x", "z" * 1000, "end", "\x00a\x7fb\x80c"] + ["".join(r.choices("abAB09 é-_.漢", k=r.randint(0, 50))) for _ in range(200)]
    of, bucket, words = resampling.features(texts, max_words, 997)
    want = [(i, zlib.crc32(t.encode()) % 997) for i, x in enumerate(texts) for t in plain_terms(x, max_words)[1]]
    assert sorted(zip(of.tolist(), bucket.tolist(), strict=True)) == sorted(want)
    assert words.tolist() == [len(plain_terms(x)[0]) for x in texts]


def plain_draw(docs, target, percent=10, seed=2024, buckets=10_000, min_words=20):
    place = lambda t: [zlib.crc32(x.encode()) % buckets for x in plain_terms(t)[1]]
    corpus, wanted = Counter(b for _, t in docs for b in place(t)), Counter(b for t in target for b in place(t))
    n, m = sum(corpus.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (n + buckets) / ((corpus[b] + 1) * (m + buckets))))
    rows = []
    for i, t in docs:
        own = place(t)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, own))
        rows.append((i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))))
    able = sorted((x for x in rows if x[1] >= min_words), key=lambda x: (-x[3], x[0] is not None, x[0] or 0))
    rank = dict(zip(range(len(able) * percent // 100), able, strict=False))
    drawn = Counter((*x, k + 1) for k, x in rank.items())
    rest = Counter(rows) - Counter(rank.values())
    return drawn + Counter({(*x, None): c for x, c in rest.items()})


def test_draw_against_plain(spark, wide_docs, no_docs):
    r = random.Random(4)
    words = [f"word{i}" for i in range(60)]
    rows = [(100 + i, " ".join(r.choices(words[:30] if i % 4 else words, k=r.randint(0, 60)))) for i in range(300)]
    own = spark.createDataFrame(rows, "doc_id long, text string")
    docs = wide_docs.unionByName(own, allowMissingColumns=True).withColumns({c: F.lit(1) for c in ("rank", "weight", "n_words", "bucket")})
    target = spark.createDataFrame([(1, " ".join(words[30:])), (2, None), (3, "")], "item_id long, text string")
    got = Counter(tuple(x) for x in resampling.resampled(docs, target, percent=30).collect())
    want = plain_draw([(x.doc_id, x.text) for x in docs.collect()], [x.text for x in target.collect()], percent=30)
    assert got == want
    assert sum(x[4] is not None for x in want) > 50
    assert resampling.resampled(no_docs, target).count() == 0
    none = resampling.resampled(docs, target.limit(0)).collect()
    assert len(none) == docs.count() and max(x["rank"] or 0 for x in none) == sum(x.n_features >= 20 for x in none) // 10


def test_draw_leaves_only_its_result(spark, odd_docs, tmp_path):
    import pathlib

    from faretrail.session import shared_dir
    folder = pathlib.Path(shared_dir(spark).replace("file:", "")) / "faretrail"
    before = set(folder.iterdir()) if folder.exists() else set()
    out = resampling.resampled(odd_docs, odd_docs.limit(3))
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before}
    assert left == {"llm-resampled"} and out.count() == odd_docs.count()


def test_backpropagation_against_differences():
    net = language.fresh(("a", "b", "c"), 4)
    for k in ("byte", "state", "out", "bias"):
        setattr(net, k, getattr(net, k).astype(float))
    r = np.random.default_rng(0)
    x, y = r.integers(97, 103, (9, 5)).astype(np.intp), np.array([0, 1, 2, 1, 0])
    x[6:, 0] = language._PAD
    loss, grads = language.gradients(net, x, y)
    p = language.probabilities(language.logits(net, x))
    real = x != language._PAD
    assert loss == pytest.approx(-np.log(p[:, np.arange(5), y])[real].mean())
    for k in ("byte", "state", "out", "bias"):
        flat, own = getattr(net, k).reshape(-1), grads[k].reshape(-1)
        for i in np.flatnonzero(own)[::7]:
            kept, sides = flat[i], []
            for d in (1e-6, -1e-6):
                flat[i] = kept + d
                sides.append(language.gradients(net, x, y)[0])
            flat[i] = kept
            assert (sides[0] - sides[1]) / 2e-6 == pytest.approx(own[i], abs=1e-7), (k, i)


def test_pooled_over_every_position():
    """Each text by itself, position by position, against all together in stretches."""
    net = language.fresh(("a", "b"))
    texts = ["x", "abc é", "long " * 100, "z" * 128, "z" * 129, ""]
    got = language.pooled(net, texts)
    for t, p in zip(texts, got, strict=True):
        raw = t.encode()
        said = [language.probabilities(language.logits(net, np.frombuffer(raw[k:k + 128], np.uint8).astype(np.intp)[:, None]))[:, 0] for k in range(0, len(raw), 128)]
        want = np.concatenate(said).mean(axis=0) if said else np.zeros(2)
        assert p == pytest.approx(want, abs=1e-5)


@pytest.fixture(scope="module")
def network(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return docs, language.learn(docs.where(~in_fold("doc_id", 5, 0)), max_train=1_000)


def test_language_held_out(network):
    docs, net = network
    assert net.languages == ("de", "en", "es", "fr")
    rows = (docs.where(in_fold("doc_id", 5, 0) & F.col("lang").isNotNull() & (F.length("text") > 200))
            .select("lang", language.predicted(F.col("text"), net).alias("p")).select("lang", "p.lang", "p.score").toDF("lang", "said", "score").toPandas())
    right = rows.lang == rows.said
    assert right.mean() > 0.99 and all(right[rows.lang == v].mean() > 0.98 for v in net.languages)
    assert rows.score.between(0, 1).all()


def test_language_odd_rows(spark, wide_docs, no_docs, network):
    _, net = network
    odd = wide_docs.unionByName(spark.createDataFrame([(30, "12 -- 34²½"), (31, "ñ")], "doc_id long, text string"), allowMissingColumns=True)
    odd = odd.withColumns({"lang_pred": F.lit(1), "p": F.lit(2)})
    got = {x.doc_id: x.p for x in odd.select("doc_id", language.predicted(F.col("text"), net).alias("p")).collect()}
    assert all(tuple(got[i]) == ("und", 0.0) for i in (1, 2, 3, 30))
    assert all(got[i].lang in net.languages and 0 < got[i].score <= 1 for i in (4, 5, 6, 9, 10, 31, None))
    assert no_docs.select(language.predicted(F.col("text"), net)).count() == 0
    assert language.learn(no_docs) is None and language.learn(odd.where("doc_id IN (1, 2)")) is None
    assert {x.p.lang for x in odd.select(language.predicted(F.col("text"), None).alias("p")).collect()} == {"und"}
    one = language.learn(odd.where("doc_id IN (5, 6, 8) AND lang = 'en'").withColumn("n", F.lit(1)))
    assert one.languages == ("en",)
    assert {x.p.lang for x in odd.where("doc_id > 3").select(language.predicted(F.col("text"), one).alias("p")).collect()} == {"en", "und"}
