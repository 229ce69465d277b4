"""Language-model scores of a hidden Markov model.

Hidden states emit word classes, and a class emits its words by their smoothed counts: each of the ``own_classes`` most frequent
words is a class of its own, the end of a text another, and all other words share classes by their last two bytes and length. A class's words and one
unseen word get (count + 0.1) / (class total + 0.1 * (words + 1)), so that probabilities sum to one over known words and one unseen word for
each class. The likelihood of a text is then that of its class sequence, by the scaled forward recursion, times one factor for each
word; no probability is approximated.

States are trained by Baum-Welch: in every round each task runs forward and backward over whole texts and adds up expected counts; the
sums over all tasks, of which there are states * (classes + states + 1), give the next parameters. Word counts are
shuffled by word after a first count in each task; a task holds counts of at most ``FLUSH`` words. The ``top_words`` most frequent words
are looked up in a table of that size, all others by a join on the word.

Defined cases: a null text is an empty one and has only its end; a null id is neither held out nor learned from; without
training texts every base score is 0 and classes are equally likely; equal rows give equal results; an empty table an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doseledger.llm.common import id_in, id_out, ship_package
from doseledger.session import write_scratch

ADD, FLUSH, ENDINGS = 0.1, 500_000, 1024
END = "\n"  # not a word, so it can stand for the end of a text
BATCH_TOKENS = 1_000_000


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def ending_class(word: bytes) -> int:
    """Class of a word outside the frequent ones, from its last two bytes and whether it is long."""
    return (word[-1] * 31 + (word[-2] if len(word) > 1 else 0) * 7 + 512 * (len(word) > 7)) % ENDINGS


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter = Counter()

    def out():
        return pd.DataFrame({"word": [w.decode("utf-8", "surrogatepass") for w in counts], "n": list(counts.values())})

    for batch in batches:
        for text in batch["text"]:
            counts.update(tokens(text))
            counts[END.encode()] += 1
            if len(counts) > FLUSH:
                yield out()
                counts.clear()
    if counts:
        yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all training texts."""
    counted = docs.filter("learn").select("text").mapInPandas(_count_words, "word string, n long")
    return write_scratch(counted.groupBy("word").agg(F.sum("n").alias("c")), "words")


def _encode(top: dict[bytes, int], prices: np.ndarray, own_classes: int) -> Callable:
    """For each text: classes as 16-bit numbers, what its frequent words cost, and its other words with their counts."""
    end = top.get(END.encode(), -1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = {c: batch[c] for c in ("row", "id", "held_out", "learn")}
            codes, cost, known, rare, times = [], [], [], [], []
            for text in batch["text"]:
                ranks, other, own = [], Counter(), []
                for word in tokens(text):
                    rank = top.get(word)
                    if rank is None:
                        other[word] += 1
                        own.append(own_classes + ending_class(word))
                    else:
                        ranks.append(rank)
                        own.append(rank if rank < own_classes else own_classes + ending_class(word))
                if end >= 0:
                    ranks.append(end)
                own.append(end if end >= 0 else own_classes + ENDINGS)
                codes.append(np.array(own, np.uint16).tobytes())
                cost.append(float(prices[ranks].sum()) if ranks else 0.0)
                known.append(len(ranks))
                rare.append([w.decode("utf-8", "surrogatepass") for w in other])
                times.append(list(other.values()))
            out |= {"n_tokens": [len(c) // 2 for c in codes], "codes": codes, "top_cost": cost, "top_known": known, "rare": rare, "times": times}
            yield pd.DataFrame(out)

    return run


def _passes(codes: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Row numbers in groups of similar length and bounded size, longest first."""
    order = np.argsort([-len(c) for c in codes], kind="stable")
    at = 0
    while at < len(order):
        n = max(1, BATCH_TOKENS // max(1, len(codes[order[at]])))
        yield order[at : at + n]
        at += n


def forward(codes: list[np.ndarray], start, move, emit) -> np.ndarray:
    """Natural log-likelihoods of class sequences by the scaled forward recursion."""
    out = np.zeros(len(codes))
    for rows in _passes(codes):
        own = [codes[r] for r in rows]
        lengths = np.array([len(c) for c in own])
        alpha, total = None, np.zeros(len(own))
        grid = _grid(own, lengths)
        for t in range(grid.shape[0]):
            live = int((lengths > t).sum())  # longest first
            alpha = (np.tile(start, (live, 1)) if t == 0 else alpha[:live] @ move) * emit[grid[t, :live]]
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            total[:live] += np.log(scale)
        out[rows] = total
    return out


def _grid(own: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
    grid = np.zeros((int(lengths.max()), len(own)), np.int64)
    for i, c in enumerate(own):
        grid[: len(c), i] = c
    return grid


def expected_counts(codes: list[np.ndarray], start, move, emit) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch sums: first states, transitions, emissions, and the log-likelihood."""
    k, sums = len(start), (np.zeros_like(start), np.zeros_like(move), np.zeros_like(emit))
    likelihood = 0.0
    for rows in _passes(codes):
        own = [codes[r] for r in rows]
        lengths = np.array([len(c) for c in own])
        grid, live = _grid(own, lengths), [int((lengths > t).sum()) for t in range(int(lengths.max()))]
        alphas, scales = [], []
        for t, n in enumerate(live):
            alpha = (np.tile(start, (n, 1)) if t == 0 else alphas[-1][:n] @ move) * emit[grid[t, :n]]
            scale = alpha.sum(axis=1)
            alphas.append(alpha / scale[:, None])
            scales.append(scale)
            likelihood += float(np.log(scale).sum())
        beta = np.ones((0, k))
        gammas = [None] * len(live)
        for t in range(len(live) - 1, -1, -1):
            n = live[t]
            if t + 1 < len(live):
                m = live[t + 1]
                ahead = emit[grid[t + 1, :m]] * beta / scales[t + 1][:, None]
                sums[1][:] += move * (alphas[t][:m].T @ ahead)
                here = np.ones((n, k))
                here[:m] = ahead @ move.T
                beta = here
            else:
                beta = np.ones((n, k))
            gammas[t] = alphas[t] * beta
        sums[0][:] += gammas[0].sum(axis=0)
        flat, gamma = np.concatenate([grid[t, :n] for t, n in enumerate(live)]), np.concatenate(gammas)
        for s in range(k):
            sums[2][:, s] += np.bincount(flat, gamma[:, s], minlength=len(emit))
    return *sums, likelihood


def _train_task(model) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start, move, emit = model
        total = np.zeros(start.size + move.size + emit.size + 1)
        for batch in batches:
            codes = [np.frombuffer(c, np.uint16) for c in batch["codes"]]
            if codes:
                s, m, e, likelihood = expected_counts(codes, start, move, emit)
                total += np.concatenate([s, m.ravel(), e.ravel(), [likelihood]])
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at, "value": total[at]})

    return run


def first_model(states: int, shares: np.ndarray, seed: int):
    """Sticky states whose emissions are the shares of the classes, unevenly disturbed."""
    rng = np.random.default_rng(seed)
    emit = shares[:, None] * np.exp(rng.normal(0, 1, (len(shares), states)))
    move = np.full((states, states), 0.05 / max(1, states - 1))
    np.fill_diagonal(move, 0.95 if states > 1 else 1.0)
    return np.full(states, 1 / states), move, emit / emit.sum(axis=0)


def train(encoded: DataFrame, shares: np.ndarray, states: int, rounds: int, seed: int):
    """(start, move, emit) after ``rounds`` of Baum-Welch over all training texts; and the likelihood of each round."""
    model, history = first_model(states, shares, seed), []
    k, c = states, len(shares)
    for _ in range(rounds):
        sums = encoded.filter("learn").select("codes").mapInPandas(_train_task(model), "at long, value double")
        total = np.zeros(k + k * k + c * k + 1)
        for row in sums.groupBy("at").agg(F.sum("value").alias("value")).collect():
            total[row["at"]] = row["value"]
        if not total.any():
            break
        history.append(total[-1])
        start, move, emit = total[:k] + 0.1, total[k : k + k * k].reshape(k, k) + 0.1, total[k + k * k : -1].reshape(c, k)
        emit = emit + shares[:, None]  # one word's worth of the average, so that no class is impossible
        model = start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0)
    return model, history


def _score_task(model, own_classes: int, inside: np.ndarray, own_cost: np.ndarray) -> Callable:
    """``chain``: log likelihood of the classes, less what later stands for words: the cost of words that are a class,
    and the divisor of shared classes."""
    # an end that training lacks has a class and a factor of its own
    less = np.concatenate([own_cost, np.zeros(own_classes - len(own_cost)), inside])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes = [np.frombuffer(c, np.uint16).astype(np.int64) for c in batch["codes"]]
            out = batch[["row", "id", "held_out", "n_tokens", "top_cost", "top_known"]].copy()
            out["chain"] = forward(codes, *model) / np.log(10) - np.array([less[c].sum() for c in codes]) if codes else []
            yield out

    return run


def _class_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total, words = np.zeros(ENDINGS), np.zeros(ENDINGS, np.int64)
    for batch in batches:
        classes = np.array([ending_class(w.encode("utf-8", "surrogatepass")) for w in batch["word"]], np.int64)
        total += np.bincount(classes, batch["c"].to_numpy(float), ENDINGS)
        words += np.bincount(classes, minlength=ENDINGS)
    yield pd.DataFrame({"class_no": np.arange(ENDINGS), "total": total, "words": words})


def score_texts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    states: int = 4,
    rounds: int = 5,
    own_classes: int = 4_000,
    top_words: int = 50_000,
    seed: int = 7,
) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    ship_package(docs.sparkSession)
    body, held = F.coalesce(F.col(text), F.lit("")), F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(10))
    rows = docs.select(
        id_in(doc_id).alias("id"),
        F.coalesce(held == 0, F.lit(False)).alias("held_out"),
        F.coalesce(held != 0, F.lit(False)).alias("learn"),
        body.alias("text"),
    )
    words = word_counts(rows)
    n, v, ends = (int(x or 0) for x in words.agg(F.sum("c"), F.count(F.lit(1)), F.sum(F.when(F.col("word") == END, F.col("c")))).first())
    # the most frequent words, whole levels of counts as long as they fit; the levels are few and the words at most ``top_words``
    level = F.floor(16 * F.log2("c"))
    known = words.filter(F.col("word") != END).withColumn("level", level)
    room, lowest = top_words, None
    for r in sorted(known.groupBy("level").count().collect(), key=lambda r: -r["level"]):
        room -= r["count"]
        if room < 0:
            break
        lowest = r["level"]
    frequent = [] if lowest is None else known.filter(F.col("level") >= lowest).collect()
    frequent.sort(key=lambda r: (-r["c"], r["word"]))
    listed = ([(END, ends)] if ends else []) + [(r["word"], r["c"]) for r in frequent]
    top = {w.encode("utf-8", "surrogatepass"): i for i, (w, _) in enumerate(listed)}
    own = listed[:own_classes]
    prices = np.log10(np.array([c for _, c in listed], float) + ADD)

    # words that share a class: all but the first ones of the list; ties by word
    others = known
    if own[len(listed) - len(frequent) :]:
        last = own[-1]
        others = others.filter((F.col("c") < last[1]) | ((F.col("c") == last[1]) & (F.col("word") > last[0])))
    total, n_words = np.zeros(ENDINGS), np.zeros(ENDINGS)
    sums = others.select("word", "c").mapInPandas(_class_sums, "class_no int, total double, words long")
    for r in sums.groupBy("class_no").agg(F.sum("total").alias("total"), F.sum("words").alias("words")).collect():
        total[r["class_no"]], n_words[r["class_no"]] = r["total"], r["words"]
    # the last shared class is an end that no training text has
    inside = np.log10(np.append(total + ADD * (n_words + 1), ADD))
    mass = np.zeros(own_classes + ENDINGS + 1)
    mass[: len(own)], mass[own_classes:-1], mass[-1] = [c for _, c in own], total + ADD, 0 if ends else ADD
    shares = np.maximum(mass, 1e-3) / np.maximum(mass, 1e-3).sum()

    encoded = rows.withColumn("row", F.monotonically_increasing_id()).mapInPandas(
        _encode(top, prices, own_classes),
        "row long, id long, held_out boolean, learn boolean, n_tokens long, codes binary, top_cost double, top_known long, "
        "rare array<string>, times array<long>",
    )
    # written once: the row numbers below are those of the table
    encoded = write_scratch(encoded, "classes")
    model, _ = train(encoded, shares, states, rounds, seed)
    scored = encoded.drop("rare", "times", "learn").mapInPandas(
        _score_task(model, own_classes, inside, prices[: len(own)]),
        "row long, id long, held_out boolean, n_tokens long, top_cost double, top_known long, chain double",
    )
    asked = encoded.select("row", F.explode_outer(F.arrays_zip("rare", "times")).alias("w")).select(
        "row", F.col("w.rare").alias("word"), F.col("w.times").alias("times")
    )
    unlisted = known if lowest is None else known.filter(F.col("level") < lowest)
    met = asked.join(unlisted.select("word", "c"), "word")
    per_row = met.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("c") + F.lit(ADD))).alias("cost"), F.sum("times").alias("known"))
    out = scored.join(per_row, "row", "left")
    n_known = F.col("top_known") + F.coalesce("known", F.lit(0))
    # the logarithms of counts + 0.1 of all tokens
    cost = F.col("top_cost") + F.coalesce("cost", F.lit(0.0)) + (F.col("n_tokens") - n_known) * float(np.log10(ADD))
    return out.select(
        id_out("id").alias("doc_id"),
        "held_out",
        "n_tokens",
        n_known.cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (cost - F.col("n_tokens") * float(np.log10(n + ADD * (v + 1)))).alias("base_score"),
        (F.col("chain") + cost).alias("score"),
    )


def op1_query(spark, sf_dir: str) -> DataFrame:
    from doseledger.llm.common import table

    return score_texts(table(spark, sf_dir, "documents"))
