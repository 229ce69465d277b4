"""The cascade's order and the work it saves."""

from pyspark.sql import functions as F

from doseledger.llm import quality_rules as q

GOOD = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)} of" for i in range(40))
ROWS = [GOOD] * 30 + ["12345 6789 " * 3 + " ".join(str(10**5 + i) for i in range(40))] * 20 + ["too short"] * 10
ROWS += ["same five words come again " * 20] * 5 + [None, "", "x" * 5000 + " a b c d e f g h i j k", "([a]) {b} [c] (d) [e] {f} (g) [h] (i) [j] (k)"]


def frame(spark):
    return spark.createDataFrame(list(enumerate(ROWS)), "doc_id long, text string")


def test_next_rule_is_picked_on_what_is_left():
    work = dict.fromkeys(q.MEASURES, 10)
    # all that symbols rejects, digits rejects too
    rows = [({"digits", "symbols"}, work)] * 9 + [({"digits"}, work)] + [({"brackets"}, work)] * 3 + [(set(), work)] * 5
    order = q.best_order(rows, ("symbols", "brackets", "digits"))
    assert order == ["digits", "brackets", "symbols"]
    dear = dict(work, word_chars=1000)
    assert q.best_order([(bad, dear) for bad, _ in rows], ("symbols", "brackets", "digits"))[0] == "symbols"
    assert q.best_order([(bad, dear) for bad, _ in rows], ("symbols", "brackets", "digits"), ["word_chars"])[0] == "digits"
    assert sorted(q.best_order([])) == sorted(q.RULES)


def test_rejected_texts_skip_later_measures(spark):
    docs = frame(spark).cache()
    bodies = q.carried(docs, body=F.coalesce("text", F.lit("")))
    assert q.rule_order(bodies) == q.rule_order(bodies.repartition(7))
    out = q.judge(docs).select("row.doc_id", "rejected_by", "n_skipped", "n_repeat_words", "n_digits").collect()
    kept = {r["doc_id"] for r in out if r["rejected_by"] is None}
    assert kept == set(range(30)) and all(r["n_skipped"] == 0 for r in out if r["doc_id"] in kept)
    assert sum(r["n_skipped"] for r in out) > 2 * (len(ROWS) - len(kept))
    named = {r["doc_id"]: r["rejected_by"] for r in out}
    assert {named[i] for i in range(30, 50)} == {"digits"} and named[len(ROWS) - 1] == "brackets"
    every = q.judge(docs, measure_all=True)
    assert every.agg(F.sum("n_skipped")).first()[0] == 0
    assert {r["row"]["doc_id"] for r in every.filter("rejected_by IS NULL").collect()} == kept
    docs.unpersist()
