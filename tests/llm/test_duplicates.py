"""Substring, SimHash and line duplicates against plain Python."""

import hashlib
import random
from collections import defaultdict

import pytest
import xxhash

from faretrail.llm import lines, simhash, substring
from faretrail.llm.components import components


def plain_repeats(rows, span):
    """(id, text) rows in order -> n_words, n_removed, digest."""
    seen, out = set(), {}
    for i, text in rows:
        w = (text or "").encode().split()
        cut = [False] * len(w)
        for p in range(len(w) - span + 1):
            k = tuple(w[p:p + span])
            if k in seen:
                cut[p:p + span] = [True] * span
            seen.add(k)
        kept = b" ".join(x for x, c in zip(w, cut, strict=True) if not c)
        out[i] = (len(w), sum(cut), hashlib.sha256(kept).hexdigest())
    return out


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = lower.encode().split()
    s = [b" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(fps, max_bits):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_random(spark, seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    base = [" ".join(r.choices(words, k=60)) for _ in range(4)]
    docs = []
    for i in range(120):
        parts = []
        for _ in range(r.randint(0, 4)):
            t = r.choice(base).split()
            a = r.randint(0, 40)
            parts += [*t[a:a + r.randint(5, 40)], *r.choices(words, k=r.randint(0, 6))]
        docs.append((i, r.choice([" ", "\n"]).join(parts)))
    got = substring.digest(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256) for x in got} == plain_repeats(docs, 20)


def test_repeats_odd_rows(spark, wide_docs, no_docs):
    got = sorted(((x.doc_id or 0, x.n_words, x.n_removed) for x in substring.digest(wide_docs).collect()))
    by = {i: (n, c) for i, n, c in got}
    assert len(got) == wide_docs.count()
    assert by[1] == by[2] == by[3] == (0, 0)
    assert by[5][1] == 0 and by[6][1] == 60 and by[7] == by[8] == (63, 63)
    assert by[4] == (40_000, 40_000 - 977)
    assert substring.digest(no_docs).count() == 0
    kept = substring.without_repeats(wide_docs)
    assert kept.columns == wide_docs.columns and kept.count() == wide_docs.count()
    texts = {x.doc_id: x.text for x in kept.collect()}
    assert texts[1] is None and texts[2] == "" and texts[7] == "" and texts[6].split() == ["four", "five", "six"]


def test_cut_text_keeps_the_rest():
    cut = substring.covered(4, [{"pos": 1, "n": 1}], 2)
    assert substring.cut_text("a  b\tc\n d ", cut) == "a\n d"
    assert substring.cut_text("a b", substring.covered(2, None, 2)) == "a b"


@pytest.mark.parametrize("max_bits", [1, 2, 3])
def test_links_lose_nothing(spark, max_bits):
    r = random.Random(max_bits)
    fps = set()
    for _ in range(12):
        base = r.getrandbits(64)
        group = {base}
        for _ in range(r.choice([2, 60])):
            x = r.choice(sorted(group))
            for _ in range(r.randint(0, max_bits + 2)):
                x ^= 1 << r.randrange(64)
            group.add(x)
        fps |= group
    signed = {f - (1 << 64) if f >= 1 << 63 else f: f for f in fps}
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    for small in (2, 32):
        of = {x.vertex: x.component for x in components(simhash.links(table, max_bits, small)).collect()}
        want = plain_classes(signed, max_bits)
        got, exp = defaultdict(set), defaultdict(set)
        for f in signed:
            got[of.get(f, f)].add(f)
            exp[want[f]].add(f)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, exp.values()))


@pytest.mark.parametrize("members", [simhash.SMALL_BUCKET, simhash.SMALL_BUCKET + 1])
def test_links_at_the_edge_of_a_small_bucket(spark, members):
    """One variant that holds just so many fingerprints: linked pairs, chains and strangers."""
    r = random.Random(members)
    low = r.getrandbits(32)
    fps = {low}
    while len(fps) < members:  # one segment is equal, the other differs by one bit, or by many
        x = r.choice(sorted(fps)) ^ 1 << r.randrange(32, 64)
        fps.add(x if r.random() < 0.6 else low | r.getrandbits(32) << 32)
    signed = {f - (1 << 64) if f >= 1 << 63 else f: f for f in fps}
    table = spark.createDataFrame([(f,) for f in signed], "fp long")
    sizes = {x["count"] for x in simhash.variants(table, 2).groupBy("part", "key").count().collect()}
    assert members in sizes
    of = {x.vertex: x.component for x in components(simhash.links(table)).collect()}
    want = plain_classes(signed, 2)
    got, exp = defaultdict(set), defaultdict(set)
    for f in signed:
        got[of.get(f, f)].add(f)
        exp[want[f]].add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, exp.values())) and 1 < len(exp) < members


def test_simhash_odd_rows(spark, wide_docs, no_docs):
    rows = simhash.classes(wide_docs).collect()
    assert len(rows) == wide_docs.count()
    by = {x.doc_id: x for x in rows}
    assert by[1].fingerprint == by[2].fingerprint == by[3].fingerprint == "0" * 16
    assert by[1].component_id == by[2].component_id == by[3].component_id == 1
    assert by[6].component_id == by[7].component_id == by[8].component_id
    for i, text in [(x.doc_id, x.text) for x in wide_docs.collect()]:
        assert int(by[i].fingerprint, 16) == plain_fingerprint(text)
    assert simhash.classes(no_docs).count() == 0
    one = simhash.one_of_each(wide_docs)
    assert one.columns == wide_docs.columns
    ids = sorted(x.doc_id or 0 for x in one.collect())
    assert 1 in ids and not {2, 3, 7, 8} & set(ids) and ids.count(6) == 1


def plain_lines(docs, depth, min_tokens, min_docs, min_fixed):
    """Which (id, line) go: the template tree in plain Python."""
    parsed = [(i, k, tuple(b.split())) for i, t in docs for k, b in enumerate((t or "").encode().split(b"\n"))]
    parsed = [(i, k, tuple(b"<*>" if any(48 <= c <= 57 for c in t) else t for t in ts)) for i, k, ts in parsed if len(ts) >= min_tokens]
    of_line, leaves = defaultdict(set), defaultdict(set)
    for i, _, ts in parsed:
        of_line[ts].add(i)
        leaves[len(ts), ts[:depth]].add(ts)
    template = {}
    for leaf, contents in leaves.items():
        support = defaultdict(int)
        for ts in contents:
            for p, t in enumerate(ts):
                support[p, t] += len(of_line[ts])
        for ts in contents:
            if len(of_line[ts]) >= min_docs:
                template[ts] = (leaf, ts)
            else:
                general = tuple(t if support[p, t] >= min_docs else None for p, t in enumerate(ts))
                if sum(t is not None for t in general) / len(ts) >= min_fixed and sum(len(of_line[x]) for x in contents) >= min_docs and len(contents) > 1:
                    template[ts] = ("general", leaf, general)
    where = defaultdict(list)
    for i, k, ts in parsed:
        if ts in template:
            where[template[ts]].append((i, k))
    return {x for found in where.values() if len({i for i, _ in found}) >= min_docs for x in sorted(found)[1:]}


def test_lines_against_plain(spark):
    r = random.Random(4)
    words = [f"{a}{b}" for a in "abcd" for b in "xyz"]
    docs = []
    for i in range(80):
        own = [f"user {r.choice(words)} logged in from host {r.randint(1, 99)} at noon", "fixed footer line of the whole site",
               f"the quick {r.choice(words)} fox jumps over {r.choice(words)} dogs", " ".join(r.choices(words, k=r.randint(1, 9)))]
        docs.append((i, "\n".join(r.sample(own, r.randint(0, 4)))))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x.doc_id: (x.n_dropped, x.kept_sha256) for x in lines.digest(frame).collect()}
    gone = plain_lines(docs, lines.DEPTH, lines.MIN_TOKENS, lines.MIN_DOCS, lines.MIN_FIXED)
    assert len(gone) > 60
    for i, t in docs:
        kept = [x for k, x in enumerate(t.split("\n")) if (i, k) not in gone]
        assert got[i] == (len(t.split("\n")) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())


def test_lines_odd_rows(wide_docs, no_docs):
    kept = lines.without_recurring_lines(wide_docs)
    assert kept.columns == wide_docs.columns
    texts = [(x.doc_id, x.text) for x in kept.collect()]
    assert len(texts) == wide_docs.count() and (1, None) in texts and (2, "") in texts
    by = dict(texts)
    assert by[6].startswith("four ") and by[7] == by[8] == "six"
    assert lines.digest(no_docs).count() == 0
    assert {x.doc_id: x.n_lines for x in lines.digest(wide_docs).collect()}[1] == 1


def kept_lines(spark, texts):
    """The kept texts, by number."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [x.text for x in lines.without_recurring_lines(docs).orderBy("doc_id").collect()]


def test_short_lines_recur(spark):
    texts = [f"All rights reserved.\n\nPage {i}\nHome\nonly line number {'abcdefgh'[i]} of this one document {i * 'x'}" for i in range(8)]
    got = [t.split("\n") for t in kept_lines(spark, texts)]
    assert got[0][:4] == ["All rights reserved.", "", "Page 0", "Home"]
    assert all(t[0] == "" and f"Page {i}" not in t and "Home" not in t for i, t in enumerate(got) if i)
    numbers = ["12", "13 4", "2024", "1 2 and 3", "99"]
    assert kept_lines(spark, numbers) == numbers
    rare = ["Read more here", "Read more here", "Read more here", "Read more there"]
    assert kept_lines(spark, rare) == rare


def test_rare_variants_meet_the_recurring_line(spark):
    common = "all our articles are checked by two editors before print"
    texts = [common] * 6 + [common.replace("two", "seven"), common.replace("print", "publication"), common.replace("editors", "readers of ours")]
    texts = [f"{t}\n{'abcdefghi'[i] * 4}" for i, t in enumerate(texts)]
    got = kept_lines(spark, texts)
    assert got[0] == texts[0] and got[8] == texts[8]
    assert got[1:8] == [t.split("\n")[1] for t in texts[1:8]]


def test_fields_whose_values_recur(spark):
    cities, days = [f"city{c}" for c in "abcdefghijklmnopqrst"], ["monday", "tuesday", "friday", "saturday", "sunday"]
    texts = [f"report filed by our {c} bureau on {d}" for c in cities for d in days]
    other = ["report filed by our readers about a bridge", "report filed by our guests from the coast", "report filed by nobody in all these years"]
    assert kept_lines(spark, texts + other) == texts[:1] + [""] * (len(texts) - 1) + other


def test_near_copies_meet(spark):
    base = [f"w{a}{b}" for a in "abcde" for b in "fghij"]
    texts = []
    for i in range(12):
        own = list(base)
        for p in {3 + (5 * i) % 22, 3 + (7 * i + 4) % 22, 3 + (3 * i + 9) % 22} if i > 4 else ():
            own[p] = "x" * (i + 1)
        texts.append(" ".join(own))
    assert kept_lines(spark, texts) == texts[:1] + [""] * 11
