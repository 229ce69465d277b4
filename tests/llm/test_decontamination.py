"""Phrases in repetitive texts and in items made from one template."""

import re

from doseledger.llm import decontam


def plain(texts, bench, window=13):
    spell = lambda t: [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", t.lower()) if w]
    wanted = {}
    for item, text in bench:
        w = spell(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            wanted.setdefault(tuple(w[i : i + window]), set()).add(str(item))
    widths, out = {len(p) for p in wanted}, []
    for doc, text in texts:
        w, hit, found = spell(text), set(), set()
        for n in widths:
            for at in range(len(w) - n + 1):
                items = wanted.get(tuple(w[at : at + n]))
                if items:
                    hit |= set(range(at, at + n))
                    found |= items
        out.append((doc, len(w), len(hit), sorted(found)))
    return out


def check(spark, texts, bench):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = decontam.contamination(docs, items).select("id", "n_words", "n_hit", "items").collect()
    assert sorted(map(tuple, got)) == sorted(plain(texts, bench))


def test_a_text_of_equal_words(spark):
    texts = [(1, "again " * 200_000), (2, "again " * 12), (3, "x " * 600 + "again " * 13 + "y again again")]
    check(spark, texts, [(1, "again " * 13), (2, "again " * 40), (3, "again again"), (4, "x y x y")])


def test_windows_across_pieces(spark, monkeypatch):
    monkeypatch.setattr(decontam, "PIECE", 5)
    own = [f"w{i % 37}" for i in range(400)]
    texts = [(i, " ".join(own[i : i + 5 * i])) for i in range(30)]
    check(spark, texts, [(1, " ".join(own[20:60])), (2, " ".join(own[3:9])), (3, "w0 w1 w3"), (4, "w36"), (5, "w36")])


def test_templated_items_share_their_windows(spark):
    shared = " ".join(f"part{i}" for i in range(30))
    docs = spark.createDataFrame([(i, f"{shared} text {i}") for i in range(50)], "doc_id long, text string")
    rows = {}
    # the slots of the template hold words that the corpus has not
    for n in (10, 100):
        bench = [(i, f"question q{i} {shared} answer a{i}") for i in range(n)]
        items = decontam.item_terms(spark.createDataFrame(bench, "item_id long, text string"))
        postings, _, counts = decontam.build_index(docs, items)
        windows, sets = decontam.item_windows(items, 13)
        pairs, lanes = decontam.anchor_pairs(windows, counts)
        asked = decontam.possible_starts(postings, pairs, lanes)
        rows[n] = (postings.join(pairs, "term").count(), asked.count(), decontam.phrase_hits(docs, windows, asked, 13).count())
        assert sets.groupBy(*decontam.ITEM_SET).count().count() == windows.select(*decontam.ITEM_SET).distinct().count()
    assert rows[100] == rows[10]
    check(spark, [(i, f"{shared} text {i}") for i in range(20)], [(i, f"question {i} {shared} answer {i}") for i in range(40)])
