"""Recurring lines against a plain version of their rule: sets of fixed places instead of hashes."""

import hashlib
import random
from collections import defaultdict

import pytest

from faretrail.llm import lines


def fixed_sets(tokens, support, total, lead, min_fixed):
    """The templates that a line may belong to: its fixed (place, token) pairs, or the lead's."""
    n = len(tokens)
    most = int(n * (1 - min_fixed) + 1e-9)
    if not most:
        return set()
    places = list(enumerate(tokens))
    found = {frozenset(x for x in places if x != open_) for open_ in places if support[open_] < total}
    ordered = sorted(places, key=lambda x: support[x])
    for k in range(2, most + 1):  # the k places of least support, if no further one has as little
        if k < n and support[ordered[k - 1]] < support[ordered[k]]:
            found.add(frozenset(ordered[k:]))
    if sum(a != b for a, b in zip(tokens, lead, strict=True)) <= most:
        found.add("near the lead")
    return found


def hash_of(template):
    """What settles ties between templates of as many documents and one earliest line."""
    found = 0
    for p, t in template if template != "near the lead" else ():
        found ^= lines._hash(b"%d " % p + t)
    return found


def plain_lines(docs, depth=lines.DEPTH, min_docs=lines.MIN_DOCS, min_fixed=lines.MIN_FIXED):
    """(id, line number) of the lines that go, over (id, text) with one text an id."""
    of = defaultdict(list)  # (leaf, tokens): places
    for i, text in docs:
        for k, raw in enumerate((text or "").encode().split(b"\n")):
            tokens = raw.split()
            if not tokens:
                continue
            plain = tuple(tokens)
            tokens = tuple(b"<*>" if any(48 <= c <= 57 for c in t) else t for t in tokens)
            if len(tokens) < lines.SHORT:
                of["short", tokens if 2 * tokens.count(b"<*>") <= len(tokens) else plain].append((i, k))
            else:
                of[(len(tokens), tokens[:depth]), tokens].append((i, k))
    holders = {x: {i for i, _ in at} for x, at in of.items()}
    fitting = defaultdict(list)  # (leaf, tokens): the recurring templates it may go with, best first
    leaves = defaultdict(list)
    for (leaf, tokens), own in holders.items():
        if len(own) >= min_docs + (leaf == "short"):
            fitting[leaf, tokens].append((-len(own), min(of[leaf, tokens]), True, tokens))
        if leaf != "short":
            leaves[leaf].append(tokens)
    for leaf, contents in leaves.items():
        total = sum(len(holders[leaf, t]) for t in contents)
        if len(contents) < 2 or total < min_docs:
            continue
        # of equally frequent contents the one with the larger hash leads
        lead = max(contents, key=lambda t: (len(holders[leaf, t]), lines._hash(b" ".join(t))))
        support = defaultdict(int)
        for t in contents:
            for x in enumerate(t):
                support[x] += len(holders[leaf, t])
        members = defaultdict(list)
        for t in contents:
            for template in fixed_sets(t, support, total, lead, min_fixed):
                members[template].append(t)
        for template, own in members.items():
            if len(own) > 1 and len(set().union(*(holders[leaf, t] for t in own))) >= min_docs:
                first = min(min(of[leaf, t]) for t in own)
                for t in own:
                    fitting[leaf, t].append((-sum(len(holders[leaf, t]) for t in own), first, False, hash_of(template)))
    together = defaultdict(list)
    for (leaf, tokens), found in fitting.items():
        together[leaf, min(found)[2:]] += of[leaf, tokens]
    return {at for lines_ in together.values() for at in lines_ if at != min(lines_)}


def held_against_plain(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x.doc_id: (x.n_lines, x.n_dropped, x.kept_sha256) for x in lines.digest(frame).collect()}
    gone = plain_lines(docs)
    for i, text in docs:
        own = (text or "").split("\n")
        kept = "\n".join(x for k, x in enumerate(own) if (i, k) not in gone)
        assert got[i] == (len(own), sum(x == i for x, _ in gone), hashlib.sha256(kept.encode()).hexdigest()), text
    return len(gone)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_corpora(spark, seed):
    """Lines of a few words, so that leaves hold many contents, with planted templates, fields,
    near copies, short lines and numbers."""
    r = random.Random(seed)
    words = [f"{a}{b}" for a in "abcd" for b in "xyz"]
    bases = [[r.choice(words) for _ in range(r.choice([5, 6, 8, 12, 16, 20]))] for _ in range(8)]
    docs = []
    for i in range(120):
        own = []
        for _ in range(r.randint(0, 6)):
            kind = r.random()
            if kind < 0.5:
                line = list(r.choice(bases))
                for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
                    line[r.randrange(len(line))] = r.choice([*words, f"n{r.randint(0, 99)}"])
            elif kind < 0.7:
                line = ["user", r.choice(words), "logged", "in", "from", f"host{r.randint(1, 99)}", "at", r.choice(words)]
            elif kind < 0.85:
                line = r.choices(words[:3], k=r.randint(1, 4))
            else:
                line = r.choices(words, k=r.randint(5, 9))
            own.append(r.choice([" ", "  ", "\t"]).join(line))
        docs.append((i, r.choice(["\n", "\n\n"]).join(own) if r.random() < 0.95 else None))
    assert held_against_plain(spark, docs) > 60


def test_planted_corpora(spark):
    common = "all our articles are checked by two editors before print"
    variants = [common] * 6 + [common.replace("two", "seven"), common.replace("print", "publication"), common.replace("editors", "readers of ours")]
    cities, days = [f"city{c}" for c in "abcdefghijkl"], ["monday", "tuesday", "friday", "saturday"]
    fields = [f"report filed by our {c} bureau on {d}" for c in cities for d in days] + ["report filed by nobody in all these years"]
    short = [f"All rights reserved.\nPage {i}\nHome" for i in range(5)]
    base = [f"w{a}{b}" for a in "abcde" for b in "fghij"]
    near = []
    for i in range(12):
        own = list(base)
        for p in {3 + (5 * i) % 22, 3 + (7 * i + 4) % 22, 3 + (3 * i + 9) % 22} if i > 4 else ():
            own[p] = "x" * (i + 1)
        near.append(" ".join(own))
    docs = list(enumerate([*variants, *fields, *short, *near, "", None, " \t "]))
    assert held_against_plain(spark, docs) > 70


@pytest.mark.parametrize("held", [1, 7])
def test_few_rows_at_a_time(spark, monkeypatch, held):
    """The same lines go however few rows a task holds, and however the batches cut a content."""
    monkeypatch.setattr(lines, "HELD", held)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    try:
        test_planted_corpora(spark)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_chains_keep_a_line_like_each_that_goes(spark):
    """Ten contents of twelve words, each one word from the one before, in two documents each."""
    words = [f"word{c}" for c in "abcdefghijkl"]
    chain = []
    for i in range(10):
        chain.append(" ".join(words))
        words[3 + i % 9] = "x" * (i + 1)
    docs = [(i, chain[i // 2]) for i in range(20)]
    gone = {i for i, _ in plain_lines(docs)}
    held_against_plain(spark, docs)
    kept = [set(enumerate(t.split())) for i, t in docs if i not in gone]
    assert gone and all(max(len(set(enumerate(docs[i][1].split())) & k) for k in kept) >= 6 for i in gone)
