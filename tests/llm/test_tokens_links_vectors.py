"""Token pieces, packing, SentencePiece pieces, link graph, pivot index and the pipeline."""

import random
import zlib
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from faretrail.llm import linkgraph, lines, outliers, packing, pivots, quality, sentencepieces, simhash, substring, toxicity
from faretrail.llm.common import staging, written
from faretrail.session import shared_dir

TEXTS = ["", " ", "a", "  a  b\n\nc d ﬁ é é", "\t　x▁y<s><0x0A>", "a" * 3000, "ééé 漢字 日本語 🙂🙂", "    indented\n        more",
         "the thethethe" * 20, "\x00 a", "￿ ퟿", "<|endoftext|> x <|endoftext|>y", "don't 's  'll THE'S", "1,234.5%% ###  $$$ x", "a b c d"]


def test_pieces_equal_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.default_model())
    v = sentencepieces.vocabulary(sentencepieces.default_model())
    r = random.Random(1)
    texts = TEXTS + ["".join(r.choices("abcdehilnorst  \n.é▁🙂", k=r.randint(0, 80))) for _ in range(300)]
    for t, ids in zip(texts, sentencepieces.encode(v, texts), strict=True):
        assert ids.tolist() == model.encode(t), t
        assert sentencepieces.decode(v, ids.tolist()) == model.decode(ids.tolist()), t


def test_pieces_odd_rows(wide_docs, no_docs):
    rows = sentencepieces.digest(wide_docs).collect()
    assert len(rows) == wide_docs.count() and all(x.round_trip for x in rows)
    assert {x.doc_id: x.n_ids for x in rows}[1] == 0
    assert sentencepieces.digest(no_docs).count() == 0
    back = wide_docs.select("text", sentencepieces.encoded(wide_docs.text).alias("ids"))
    back = back.select("text", sentencepieces.decoded(back.ids).alias("again"))
    assert all((x.text or "") == x.again for x in back.collect())


def test_ids_equal_the_library():
    own = packing.encoder(*packing.default_vocabulary())
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    r = random.Random(2)
    texts = TEXTS + ["".join(r.choices("abcdeé.,'\n\t $#0123   ", k=r.randint(0, 60))) for _ in range(400)]
    for t in texts:
        assert np.frombuffer(own.text(t), "<u4").tolist() == theirs.encode(t, add_special_tokens=False).ids, t


def check_places(rows, size):
    """No gap, no overlap, nothing longer than a sequence; pieces of a document complete."""
    for _, of in rows.groupby("sequence_id"):
        of = of.sort_values("offset")
        assert (of.offset.to_numpy() == np.r_[0, of.length.cumsum().to_numpy()[:-1]]).all() and of.length.sum() <= size
    for _, of in rows[rows.doc_id.notna()].drop_duplicates(["doc_id", "piece"]).groupby("doc_id"):
        of = of.sort_values("piece")
        assert (of.piece.to_numpy() == np.arange(len(of))).all()
        assert (of.start.to_numpy() == np.r_[0, of.length.cumsum().to_numpy()[:-1]]).all()
        assert (of.length[1:] == size).all()


def test_packing_odd_rows(wide_docs, no_docs):
    odd_docs = wide_docs
    rows = packing.pack_documents(odd_docs).toPandas()
    check_places(rows, 2048)
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for x in odd_docs.collect():
        ids = theirs.encode(x.text or "", add_special_tokens=False).ids + [0]
        own = rows[rows.doc_id.isna()] if x.doc_id is None else rows[rows.doc_id == x.doc_id]
        for p in own.drop_duplicates("piece").itertuples():
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes())
        assert own.length.sum() == len(ids) * sum(y.doc_id == x.doc_id for y in odd_docs.collect())
    assert packing.pack_documents(no_docs).count() == 0


def test_sequences_hold_the_ids(odd_docs):
    packed = packing.pack_documents(odd_docs, keep_ids=True)
    whole = packing.sequences(packed).collect()
    assert all(0 < len(x.ids) <= 2048 for x in whole)
    assert sum(len(x.ids) for x in whole) == packed.groupBy().sum("length").first()[0]


@pytest.mark.parametrize("seed", [0, 1])
def test_placing_is_close_to_the_least(seed):
    r = np.random.default_rng(seed)
    lengths = np.minimum(2048, r.lognormal(6, 1, 4000).astype(int) + 1)
    bins, offset = packing.place(lengths, 2048)
    check_places(pd.DataFrame({"sequence_id": bins, "offset": offset, "length": lengths, "doc_id": None, "piece": 0}), 2048)
    assert bins.max() + 1 <= -(-lengths.sum() // 2048) + 2
    assert packing.place(np.empty(0, int), 8)[0].size == 0


def test_placing_takes_the_smallest_sum_of_squares():
    """Every step against the definition, over all open bins."""
    r = np.random.default_rng(3)
    size, lengths = 12, r.integers(1, 10, 60)
    bins, _ = packing.place(lengths, size)
    fill, open_ = {}, np.zeros(size + 1, int)
    for i in np.argsort(-lengths, kind="stable"):
        s, b = int(lengths[i]), int(bins[i])
        fits = {g for g in range(s, size) if open_[g]}
        cost = {}
        for g in fits:
            n = open_.copy()
            n[g] -= 1
            n[g - s] += g > s
            cost[g] = int((n[1:size] ** 2).sum())
        g = size - fill.get(b, 0)
        assert (b in fill) == bool(fits)
        if fits:
            assert cost[g] == min(cost.values())
            open_[g] -= 1
        fill[b] = fill.get(b, 0) + s
        if g > s:
            open_[g - s] += 1


PAGES = [
    (1, "http://A.Example.NET/en/x?q", '<a href="http://friend.org/x">'),
    (2, "https://a.example.net/de/", '<a href="//other.com">'),
    (3, "http://spam.net/", None),
    (4, "http://friend.org/fr/a#b", '<a href=http://deep.com/>'),
    (5, "http://friend.org/en", ""),
    (6, "http://farm.com/a", '<a HREF="HTTP://Spam.NET/x"> <a href="http://spam.net/y"> <a href="/own">'),
    (7, "http://deep.com", ""),
    (8, None, "x"), (9, "no host", "x"), (10, "", ""),
    (11, "http://net/x", ""), (11, "http://net/x", ""), (None, "http://x.com/?u=http://net/", ""),
]


def test_rules_and_propagation(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS rule", "3 AS n")
    got = {x.page_id: x for x in linkgraph.judged(pages).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert (got[2].rule, got[2].verdict) == ("net/", "block")
    assert (got[4].rule, got[4].verdict) == ("org/fr/", "allow") and (got[5].rule, got[5].verdict) == (None, "allow")
    assert (got[6].rule, got[6].verdict) == (None, "block")  # links to a blocked host alone
    assert got[6].distrust == pytest.approx(0.85, abs=1e-4) and got[7].trust > 0 and got[7].verdict == "allow"
    for i in (8, 9, 10):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == ("", "", None, "allow")
    assert got[11].rule == "net/" and got[None].host == "x.com" and got[None].path == "/"
    assert linkgraph.judged(pages).count() == len(PAGES)
    assert linkgraph.judged(pages.limit(0)).count() == 0


def test_propagation_against_power_iteration(spark):
    r = random.Random(7)
    n = 12
    links = {(r.randrange(n), r.randrange(n)) for _ in range(40)}
    links = {(a, b): r.randint(1, 4) for a, b in links if a != b}
    edges = spark.createDataFrame([(f"h{a}", f"h{b}", c) for (a, b), c in links.items()], "src string, dst string, n long")
    seeds = spark.createDataFrame([(f"h{i}", i < 2, i > 9) for i in range(n)], "host string, trusted boolean, blocked boolean")
    m = np.zeros((n, n))
    for (a, b), c in links.items():
        m[a, b] = c
    onward = np.divide(m, m.sum(axis=1, keepdims=True), where=m.sum(axis=1, keepdims=True) > 0, out=np.zeros_like(m))
    back = np.divide(m, m.sum(axis=0, keepdims=True), where=m.sum(axis=0, keepdims=True) > 0, out=np.zeros_like(m))
    t0, d0 = (np.arange(n) < 2).astype(float), (np.arange(n) > 9).astype(float)
    t, d = t0, d0
    for _ in range(200):
        t, d = t0 + 0.85 * onward.T @ t, d0 + 0.85 * back @ d
    for x in linkgraph.propagated(edges, seeds).collect():
        i = int(x.host[1:])
        assert x.trust == pytest.approx(t[i], abs=0.05 * (1 + t[i])) and x.distrust == pytest.approx(d[i], abs=0.05 * (1 + d[i]))


def plain_top(rows, k):
    v = {i: [int(np.floor(256 * float(c))) for c in x] for i, x in rows}
    return sorted((q, r + 1, i, s) for q in v if q % 50 == 0 for r, (s, i) in enumerate(
        sorted((((sum(a * b for a, b in zip(v[q], x, strict=False))), i) for i, x in v.items() if i != q), key=lambda p: (-p[0], p[1]))[:k]))


@pytest.mark.parametrize("block", [16, 16_384])
def test_top_k_against_all(spark, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    r = np.random.default_rng(2)
    rows = [(i, (r.normal(size=8) * (5 if i % 7 == 0 else 1)).tolist()) for i in range(300)]
    rows += [(i, [1.0] * 8) for i in range(300, 401)]  # one very common vector: ties
    rows += [(401, [0.0] * 8), (450, [1.0, 2.0])]
    bad = [(500, None), (501, [1.0, None]), (550, [float("nan")] * 8), (600, [float("inf")] * 8)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").selectExpr("*", "1 AS v", "2 AS rank", "3 AS pivot")
    got = sorted(tuple(x) for x in pivots.top_k(frame).collect())
    assert got == plain_top(rows, 5)


def test_top_k_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.0]), (50, [2.0]), (3, [0.5])], "vec_id long, embedding array<float>")
    assert sorted(tuple(x) for x in pivots.top_k(frame).collect()) == plain_top([(0, [1.0]), (50, [2.0]), (3, [0.5])], 5)
    assert pivots.top_k(frame.limit(0)).count() == 0


def test_top_k_visits_few_rings_of_clustered_vectors(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(40, 16)) * 3
    rows = [(i, (centres[i % 40] + r.normal(size=16) * 0.05).tolist()) for i in range(2_000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    scaled = pivots.scaled(frame)
    index = pivots.build(scaled)
    got = sorted(tuple(x) for x in pivots.search(index, scaled.where("vec_id % 50 = 0")).collect())
    assert got == plain_top(rows, 5)
    assert sum(index.visits) < 40 * np.count_nonzero(index.size) / 2
    assert index.size.sum() == 2_000


def test_top_k_odd_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    frame = spark.createDataFrame([(None, [9.0]), (0, [1.0]), (0, [1.0]), (50, []), (7, [9.0])], schema)
    assert sorted((tuple(x) for x in pivots.top_k(frame, k=2).collect()), key=str) == sorted([
        (0, 1, None, 256 * 256 * 9), (0, 2, 7, 256 * 256 * 9), (50, 1, None, 0), (50, 2, 0, 0)], key=str)
    assert pivots.top_k(spark.createDataFrame([(0, []), (1, [])], schema)).collect() == [(0, 1, 1, 0)]
    with pytest.raises(ValueError, match="64 bits"):
        pivots.top_k(spark.createDataFrame([(0, [1e17]), (1, [2e17])], schema))


def test_top_k_of_one_query_many_times(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 16)
    rows = [(50 * i, [1.0, 2.0]) for i in range(60)] + [(50 * i + 1, [float(i), 1.0]) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(x) for x in pivots.top_k(frame).collect()) == plain_top(rows, 5)


def test_pipeline_stages(spark, odd_docs, tmp_path):
    """Each stage on rows of every kind: columns stay, decisions take effect, the last packs."""
    docs = odd_docs.unionByName(spark.createDataFrame([(20, "you m0r0n idiot", "en", "a", 15), (21, "entirely fine words here", "en", "a", 24)], odd_docs.schema))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    now, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / f"s{k}"))
        now = spark.read.parquet(str(tmp_path / f"s{k}"))
        seen[name] = now.toPandas()
        if name != "packing":
            assert now.columns == docs.columns
    assert 20 not in set(seen["toxicity"].doc_id) and 21 in set(seen["toxicity"].doc_id)
    assert len(seen["toxicity"]) == docs.count() - 1 == len(seen["line dedup"])
    near = seen["near copies"]
    assert {5, 6, 9, 21} <= set(near.doc_id.dropna()) and len(near) == near.doc_id.nunique(dropna=False)
    assert len(seen["repeated runs"]) == len(near)
    cut = seen["repeated runs"].set_index("doc_id").text
    assert "shared30" in cut[5] and "shared30" not in cut[6]
    check_places(seen["packing"], 2048)
    assert set(seen["packing"].doc_id.dropna()) == set(near.doc_id.dropna())
    before = scratch_of(spark)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert len(out.collect()) == len(seen["packing"])
    assert {name.rsplit("-", 1)[0] for name in scratch_of(spark) - before} == {"llm-packing"}
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name


def test_pipeline_with_labelled_odd_rows(spark, wide_docs, tmp_path):
    """Labels on null, empty, blank, very long and repeated texts; clashing column names."""
    bad = wide_docs.limit(1).selectExpr(*[{"doc_id": "20L AS doc_id", "text": "'you m0r0n idiot' AS text"}.get(c, f"`{c}`") for c in wide_docs.columns])
    docs = wide_docs.unionByName(bad)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, int(i in (1, 3, 20))) for i in (1, 2, 3, 4, 5, 6, 8, 9, 10, 20, 99)] + [(7, None, None), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / f"s{k}"))
        now = spark.read.parquet(str(tmp_path / f"s{k}"))
        if name != "packing":
            assert now.columns == docs.columns
        if name == "toxicity":
            left = [x.doc_id for x in now.collect()]
            assert 20 not in left and len(left) == docs.count() - 1
    check_places(now.toPandas(), 2048)


def test_propagation_reaches_the_end_of_a_chain(spark):
    n = 33
    links = [("h0", f"bad{i}", 1) for i in range(300)] + [(f"h{i + 1}", f"h{i}", 1) for i in range(n)]
    edges = spark.createDataFrame(links, "src string, dst string, n long").coalesce(1)
    seeds = spark.createDataFrame([(f"bad{i}", False, True) for i in range(300)], "host string, trusted boolean, blocked boolean").coalesce(1)
    got = {x.host: x.distrust for x in linkgraph.propagated(edges, seeds).collect()}
    assert got[f"h{n}"] == pytest.approx(300 * 0.85 ** (n + 1)) and got[f"h{n}"] > linkgraph.THRESHOLD


def test_propagation_takes_a_damping_below_one(spark):
    with pytest.raises(ValueError):
        linkgraph.propagated(None, None, damping=1.0)


def test_rules_on_very_long_pages(spark):
    """Megabytes of url or html, and columns with the names that the operator uses itself."""
    long_html = "".join(f'<a href="http://h{i % 50}.example.net/{i}">x</a>' for i in range(60_000)) + "<a href=http://a.net/>"
    pages = [(1, "http://a.net/" + "p" * 2_000_000, ""), (2, "http://b.com/x", long_html), (3, "http://" + "h" * 1_000_000 + ".org/fr/", None),
             (4, None, "<a href=//b.com/>"), (None, "no host", "x"), (2, "http://b.com/x", long_html)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    frame = frame.withColumns({c: F.lit("x") for c in ("host", "path", "found", "src", "dst", "n", "trust", "distrust", "rule", "verdict")})
    got = {x.page_id: x for x in linkgraph.judged(frame).collect()}
    assert len(got) == 5 and len(got[1].path) == 2_000_001 and (got[1].rule, got[1].verdict) == ("net/", "block")
    assert (got[2].host, got[2].rule, got[2].verdict) == ("b.com", None, "block")  # its last link leads to a blocked host
    assert got[3].rule == "org/fr/" and got[4].host == got[None].host == "" and got[None].verdict == "allow"


def test_packing_without_the_encoder_of_pieces(monkeypatch):
    """The rank encoder's inner function may go; the ids stay."""
    import tiktoken

    texts = ["plain words, and marks!", "x  y\n\nz", "word " * 300, "caf\u00e9 1234 $$$"]
    want = [packing.Ids(*packing.default_vocabulary()).text(t) for t in texts]
    monkeypatch.delattr(tiktoken.Encoding, "_encode_single_piece")
    bare = packing.Ids(*packing.default_vocabulary())
    assert bare._piece is None and [bare.text(t) for t in texts] == want


STAGED = {"op1": lambda d, t: sentencepieces.digest(d), "op2": lambda d, t: d.select("doc_id", quality.scored(F.col("text"), quality.learn(d, t))),
          "op3": lambda d, t: d.select("doc_id", toxicity.scored(F.col("text"), toxicity.learn(d, t))), "op4": lambda d, t: outliers.judged(d),
          "op7": lambda d, t: substring.digest(d), "op8": lambda d, t: simhash.classes(d), "op9": lambda d, t: lines.digest(d),
          "op10": lambda d, t: packing.pack_documents(d)}


def scratch_of(spark):
    folder = Path(shared_dir(spark).removeprefix("file:")) / "faretrail"
    return {p.name for p in folder.iterdir()} if folder.exists() else set()


@pytest.mark.parametrize("op", STAGED)
def test_operators_leave_what_their_result_reads(spark, odd_docs, tmp_path, op):
    labels = spark.createDataFrame([(5, 1, 1), (6, 0, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    before = scratch_of(spark)
    with staging():
        out = STAGED[op](odd_docs, labels)
        reads = {Path(f.removeprefix("file:")).parent.name for f in out.inputFiles()}
        assert scratch_of(spark) - before == {f for f in reads if f.startswith("llm-")}
        out.write.parquet(str(tmp_path / "out"))
    assert scratch_of(spark) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() >= odd_docs.count()


def test_staging_after_an_error(spark):
    before = scratch_of(spark)
    with staging() as outer:
        with pytest.raises(ZeroDivisionError), staging() as keep:
            keep(written(spark.range(3), "a"))
            1 / 0
        assert scratch_of(spark) == before
        with staging() as keep:
            kept, gone = written(spark.range(3), "b"), written(spark.range(3), "c")
            keep(kept)
        assert kept.count() == 3 and scratch_of(spark) - before == {Path(kept._ft_path).name}
        outer()
    assert scratch_of(spark) == before and gone is not None
