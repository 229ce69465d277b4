"""Language filters against plain sets, pieces against whole texts, held-out accuracy and odd rows."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import DATA

from doseledger.llm import language_id as li

rng = random.Random(12)
SOUNDS = {"aa": ["tion", "the", "ing", "oak"], "bb": ["ö", "schen", "ung", "oak"], "cc": ["çoi", "eau", "le", "oak"], "dd": ["жизнь", "мир", "по"]}
COLUMNS = "doc_id long, text string, lang string, source string, score double, held_out string, body string, gram long"


def prose(lang, n=30):
    return " ".join("".join(rng.choices(SOUNDS[lang], k=rng.randint(1, 3))) for _ in range(n)).capitalize() + "."


ROWS = [(i, prose(lang := rng.choice(list(SOUNDS)), rng.randint(3, 80)), lang) for i in range(200)]
ROWS += [(200, None, "aa"), (201, "", "bb"), (202, "12 34 !?", "cc"), (203, "x", "aa"), (204, prose("dd"), None), (205, prose("bb", 60_000), "bb")]
ROWS += [(None, prose("cc"), "cc"), ROWS[5], ROWS[5], (5, prose("aa"), "aa"), (206, "漢字", None), (207, "ALL CAPS TION THE", "aa")]


def plain_grams(text):
    bare = " " + " ".join("".join(c if c.isalpha() else " " for c in (text or "").lower()).split()) + " "
    return Counter(bare[i : i + n] for n in li.LENGTHS for i in range(len(bare) - n + 1)) if bare.strip() else Counter()


def hashed(gram):
    h = np.array([len(gram)], np.uint64)
    for c in gram:
        h = (h ^ np.uint64(ord(c))) * li.STEP
        h ^= h >> np.uint64(29)
    return int(h[0])


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1 << 20])
def test_grams_equal_plain_ones(monkeypatch, piece):
    monkeypatch.setattr(li, "PIECE", piece)
    for text in (*(r[1] for r in ROWS[:20]), None, "", " ", "a", "..a..", "a b", "ab,,, cd", "'tis\n\nso ", "漢字 x"):
        got = Counter(int(h) for part in li.grams(text) for h in part)
        assert got == Counter({hashed(g): n for g, n in plain_grams(text).items()}), text


def learned(rows):
    counts, totals = defaultdict(dict), Counter()
    for i, text, lang in rows:
        if i is not None and lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            for g, n in plain_grams(text).items():
                counts[g][lang] = counts[g].get(lang, 0) + n
                totals[lang] += n
    held = {}
    for g, own in counts.items():
        shares = {lang: n / totals[lang] for lang, n in own.items()}
        held[g] = {lang for lang, s in shares.items() if s >= max(shares.values()) * li.RATIO and s >= li.LEAST_SHARE}
    return held, totals


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 9.0, "h", "b", 1) for i, t, lang in rows], COLUMNS).repartition(3)


def test_equal_to_plain_sets(spark):
    held, totals = learned(ROWS)
    out = li.identify(frame(spark, ROWS))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = defaultdict(list)
    for r in out.collect():
        got[r["doc_id"]].append((r["held_out"], r["lang_pred"], r["score"]))
        assert 0 <= r["score"] <= 1
    assert sum(map(len, got.values())) == len(ROWS)
    for i, text, _ in ROWS:
        own = Counter()
        for g, n in plain_grams(text).items():
            for lang in held.get(g, ()):
                own[lang] += n
        out_of = i is not None and zlib.crc32(str(i).encode()) % 4 == 2
        if not plain_grams(text):
            assert (out_of, "und", 0.0) in got[i]
        elif own:
            first = min(own, key=lambda lang: (-own[lang], lang))
            # wrong answers of the filters move a score by little
            assert any(h == out_of and p == first and abs(s - own[first] / sum(own.values())) < 0.05 for h, p, s in got[i]), (i, own, got[i])


def test_filter_finds_all_languages_of_a_gram(spark):
    held, _ = learned(ROWS)
    rows = frame(spark, [r for r in ROWS if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2])
    li.ship_package(spark)
    filters = li.learn(rows)
    assert filters.languages == sorted(SOUNDS)
    extra = 0
    for g, own in held.items():
        mask = int(filters.holding(np.array([hashed(g)], np.uint64))[0, 0])
        found = {lang for k, lang in enumerate(filters.languages) if mask >> k & 1}
        assert own <= found
        extra += len(found - own)
    assert extra <= len(held) * sum(filters.wrong) * 1.5 + 10


def test_more_languages_than_a_word_has_bits(spark):
    names = [f"l{k:03d}" for k in range(150)]
    rows = [(k + 1000 * j, f"{chr(0x4E00 + 3 * k)}{chr(0x4E01 + 3 * k)} " * 20, name) for k, name in enumerate(names) for j in range(3)]
    want = {i: lang for i, _, lang in rows}
    met = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    for r in li.identify(frame(spark, rows)).collect():
        assert r["lang_pred"] == want[r["doc_id"]] or want[r["doc_id"]] not in met


def test_without_rows_or_labels(spark):
    assert li.identify(frame(spark, [])).collect() == []
    out = li.identify(frame(spark, [(1, "some text", None), (2, None, "aa")])).collect()
    assert {(r["lang_pred"], r["score"]) for r in out} == {("und", 0.0)}
    # a text of unknown grams gets the language with most grams
    rows = [(i, "oak the oak the", "aa") for i in range(20)] + [(100, "漢字", None)]
    out = {r["doc_id"]: r for r in li.identify(frame(spark, rows)).collect()}
    assert (out[100]["lang_pred"], out[100]["score"]) == ("aa", 0.0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    out = [r for r in li.identify(docs).collect() if r["held_out"] and truth[r["doc_id"]] and r["lang_pred"] != "und"]
    right = sum(r["lang_pred"] == truth[r["doc_id"]] for r in out)
    assert len(out) > 200 and right / len(out) >= 0.98
