"""Near copies of the pipeline against all pairs of five-word shingle sets."""

import os
import random
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402
from doseledger.llm import near_copies, simhash  # noqa: E402

rng = random.Random(11)


def words(n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def edited(own, edits):
    own = list(own)
    for at in rng.sample(range(len(own)), edits):
        own[at] = f"e{rng.randrange(10**6)}"
    return own


def texts():
    out = [None, "", " \n\t ", "one", "One", "one two three four", "no id at all here"]
    for n, edits in ((100, 1), (100, 2), (200, 2), (400, 4), (60, 1), (30, 1), (12, 1), (2000, 30)):
        for _ in range(6):
            base = words(n)
            out += [" ".join(base), " ".join(edited(base, edits)), " ".join(edited(base, 4 * edits))]
    hub = words(300)  # copies that are near their source, but hardly near each other
    return out + [" ".join(hub)] + [" ".join(edited(hub, 5)) for _ in range(25)]


def shingles(text):
    own = (text or "").lower().split()
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def groups(bodies):
    sets, group = [shingles(t) for t in bodies], list(range(len(bodies)))
    for a in range(len(sets)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and group[a] != group[b]:
                group = [min(group[a], group[b]) if g in (group[a], group[b]) else g for g in group]
    return group


def test_stage_drops_all_copies_of_four_fifths(spark):
    bodies = texts()
    order = list(range(len(bodies)))
    rng.shuffle(order)
    docs = spark.createDataFrame([(i, bodies[i], "x") for i in order], "doc_id long, text string, th string")
    want = groups(bodies)
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs).collect()}
    assert [got[i] for i in range(len(bodies))] == want
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))


def test_repeated_and_missing_ids(spark):
    a, b, c = (" ".join(words(50)) for _ in range(3))
    rows = [(1, a), (1, a), (1, b), (None, a), (None, c), (None, c + " end"), (2, b)]
    kept = near_copies.keep_one_copy(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept if r["doc_id"]) == sorted([(1, a), (1, b)])
    assert len(kept) == 3
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_copies.keep_one_copy(empty).collect() == []


def test_bands_hold_pairs_of_four_fifths():
    gen, met = np.random.default_rng(4), 0
    for _ in range(300):  # 80 of 100 shared
        pool = near_copies._mixed(gen.integers(0, 2**63, 100, dtype=np.uint64))
        a, b = near_copies.sketch(pool[:90]), near_copies.sketch(pool[10:])
        met += (near_copies.band_keys(a) == near_copies.band_keys(b)).any() and (a == b).sum() >= near_copies.LIKELY
    assert met == 300


def test_full_bands_are_cut_into_cells(spark, monkeypatch):
    """A large group around one text, all of which share a passage with texts that are no copies, with small blocks and no stars."""
    hub, passage = words(120), words(60)
    bodies = [" ".join(edited(hub, rng.randint(1, 6)) + passage) for _ in range(120)]
    bodies += [" ".join(words(60) + passage + words(20)) for _ in range(60)]
    want = groups(bodies)
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")
    for block, stars in ((512, 3), (16, 3), (7, 0)):
        monkeypatch.setattr(near_copies, "BLOCK", block)
        monkeypatch.setattr(near_copies, "STARS", stars)
        got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs).collect()}
        assert [got[i] for i in range(len(bodies))] == want, block


def test_stage_links_by_simhash(spark):
    """Texts within three bits of each other, but of too few equal five-word shingles, are near copies too; those further away are not."""
    base, near, far = words(150), None, None
    for _ in range(20000):
        other = edited(base, rng.randint(4, 8))
        bits = (simhash.fingerprint(" ".join(base)) ^ simhash.fingerprint(" ".join(other))).bit_count()
        own, copy = shingles(" ".join(base)), shingles(" ".join(other))
        if 5 * len(own & copy) < 4 * len(own | copy):
            near, far = (other if bits <= simhash.MOST else near), (other if bits > 8 else far)
        if near and far:
            break
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate((base, near, far, words(150)))], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [0, 2, 3]
