"""Language identification with bit-sliced Bloom filters: one look-up tells all languages that hold an n-gram.

Runs of letters are lower-cased and parted by single blanks; their n-grams of two and three characters are counted per language over all
learning rows. A language holds a gram if the gram's share in it is at least ``ratio`` of the gram's largest share in any language,
and at least ``least_share``; as shares sum to one, no language holds more than ``1 / least_share`` grams, whatever the
corpus. The filters of all languages share their positions: a position is a word with one bit per language (62 languages
a word), so that the words at a gram's four positions, combined by AND, are the bitmask of all languages that may hold it.

A text's grams give a count of set bits per language. A filter with a share ``f`` of its positions set answers wrongly with probability
``f`` to the fourth power; the expected wrong answers are taken off the count. The language with the largest corrected
count is predicted, its share of all corrected counts is the score.

Only the filters leave the counts: at most sixteen positions for each possible gram of one language, 8 MB for every 62 languages.

Defined cases: a null text or one without a letter is ``und`` with score 0; of equal counts the language first by code points wins;
a text of unknown grams gets the language with most learned grams and score 0; a row with a null id is neither learned from nor held out;
without learning rows every text is ``und``; equal rows give equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doseledger.llm.common import ship_package, table
from doseledger.session import write_scratch

LENGTHS, HASHES, RATIO, LEAST_SHARE = (2, 3), 4, 0.2, 1e-5
UNKNOWN = "und"
#: languages in one word of a position; positions for each gram of the fullest language
PER_WORD, ROOM = 62, 8
#: characters of a text taken at a time, and grams counted before they leave a task
PIECE, HELD = 1 << 20, 1 << 22
STEP = np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd 64-bit factor of well spread bits


@lru_cache(1)
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letter_pieces(text: str) -> Iterator[np.ndarray]:
    """Code points of the lower-cased letters of a text with single blanks between runs and at both ends.

    A piece repeats the end of the one before it, as far as a longest gram but one character reaches.
    """
    held = np.array([32], np.uint32)
    over = max(LENGTHS) - 1
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer(text[at : at + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.concatenate([held, np.where(letters()[codes], codes, np.uint32(32))])
        codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]
        yield codes
        held = codes[-over:]
    if held[-1] != 32:
        yield np.concatenate([held, np.array([32], np.uint32)])


def grams(text: str | None) -> Iterator[np.ndarray]:
    """64-bit hashes of all grams of a text, each once, piece by piece; none where it has no letter."""
    before = 1  # characters that the piece before ended with and this one repeats
    for n, codes in enumerate(letter_pieces(text or "")):
        repeated = before if n else 0
        wide = codes.astype(np.uint64)
        out = []
        for length in LENGTHS:
            # grams that end in this piece's own part
            first = max(0, repeated - length + 1)
            count = len(wide) - length + 1 - first
            if count > 0:
                hashes = np.full(count, length, np.uint64)
                for i in range(length):
                    hashes = (hashes ^ wide[first + i : first + i + count]) * STEP
                    hashes ^= hashes >> np.uint64(29)
                out.append(hashes)
        before = min(len(codes), max(LENGTHS) - 1)
        if out and (wide != 32).any():
            yield np.concatenate(out)


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def emit():
        for lang, parts in held.items():
            own, times = np.unique(np.concatenate(parts), return_counts=True)
            yield pd.DataFrame({"lang": lang, "gram": own.view(np.int64), "n": times})
        held.clear()

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            for part in grams(text):
                held.setdefault(lang, []).append(part)
                size += len(part)
                if size >= HELD:
                    yield from emit()
                    size = 0
    yield from emit()


def positions(gram: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The positions of grams, one array for each hash function, from two halves of one hash."""
    step = (gram >> np.uint64(32)) | np.uint64(1)
    for i in range(HASHES):
        yield ((gram + step * np.uint64(i)) * STEP) >> np.uint64(64 - bits)


def _placed(bits: int):
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch["gram"].to_numpy(np.int64).view(np.uint64)
            for at in positions(own, bits):
                yield pd.DataFrame({"word": batch["word"], "mask": batch["mask"], "at": at.view(np.int64)})

    return place


class Filters:
    """Bit-sliced Bloom filters of several languages: ``words[w, at]`` has a bit for each of 62 languages."""

    def __init__(self, languages: list[str], words: np.ndarray, common: str | None):
        self.languages, self.words, self.common = languages, words, common
        self.bits = int(words.shape[1]).bit_length() - 1
        places = [(i // PER_WORD, np.uint64(i % PER_WORD)) for i in range(len(languages))]
        full = [float((words[w] >> b & np.uint64(1)).mean()) for w, b in places]
        #: probability of a wrong yes, per language
        self.wrong = np.array(full) ** HASHES

    def holding(self, gram: np.ndarray) -> np.ndarray:
        """(words, grams): the bitmask of languages that may hold each gram."""
        out = None
        for at in positions(gram, self.bits):
            met = self.words[:, at]
            out = met if out is None else out & met
        return out

    def counted(self, gram: np.ndarray) -> np.ndarray:
        """How many of the grams each language may hold."""
        masks = self.holding(gram)
        return np.array([int((masks[i // PER_WORD] >> np.uint64(i % PER_WORD) & np.uint64(1)).sum()) for i in range(len(self.languages))])

    def decide(self, text: str | None) -> tuple[str, float]:
        """(language, score) of a text."""
        total, found = 0, np.zeros(len(self.languages))
        for part in grams(text):
            total += len(part)
            found += self.counted(part) if self.languages else 0
        if not total or not self.languages:
            return UNKNOWN, 0.0
        likely = np.maximum(0.0, found - total * self.wrong) / np.maximum(1.0 - self.wrong, 1e-9)
        if not likely.sum() > 0:
            return self.common, 0.0
        best = int(likely.argmax())
        return self.languages[best], float(likely[best] / likely.sum())


def learn(rows: DataFrame, lang: str = "lang", text: str = "text", ratio: float = RATIO, least_share: float = LEAST_SHARE) -> Filters:
    """Filters of the languages of labelled rows."""
    known = rows.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    per_task = known.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInPandas(_counts, "lang string, gram long, n long")
    counts = write_scratch(per_task.groupBy("gram", "lang").agg(F.sum("n").alias("n")), "gram-counts")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}  # one row a language
    languages = sorted(totals)
    if not languages:
        return Filters([], np.zeros((1, 1), np.uint64), None)
    named = [(name, i, float(totals[name])) for i, name in enumerate(languages)]
    names = rows.sparkSession.createDataFrame(named, "lang string, place int, total double")
    # a gram has at most one entry for each language
    shares = counts.join(names, "lang").groupBy("gram").agg(F.collect_list(F.struct((F.col("n") / F.col("total")).alias("share"), "place")).alias("of"))
    largest = F.array_max(F.transform("of", lambda x: x["share"]))
    enough = F.filter("of", lambda x: (x["share"] >= F.col("largest") * ratio) & (x["share"] >= least_share))
    held = shares.withColumn("largest", largest).select("gram", F.explode(enough).alias("x")).select("gram", "x.place")
    held = write_scratch(held, "held-grams")
    fullest = held.groupBy("place").count().agg(F.max("count")).first()[0]
    bits = max(16, (ROOM * (fullest or 1) - 1).bit_length())
    masks = held.groupBy("gram", F.floor(F.col("place") / PER_WORD).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, place % {PER_WORD})")).alias("mask")
    )
    placed = masks.mapInPandas(_placed(bits), "word int, mask long, at long").groupBy("word", "at").agg(F.bit_or("mask").alias("mask"))
    words = np.zeros((-(-len(languages) // PER_WORD), 1 << bits), np.uint64)
    found = placed.toArrow()  # at most one row a position
    words[found["word"].to_numpy(), found["at"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return Filters(languages, words, max(languages, key=lambda name: (totals[name], name)))


def predicted(filters: Filters, text: Column, spark) -> Column:
    """A struct (lang_pred, score) of each text."""
    shared = spark.sparkContext.broadcast(filters)

    def decide(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for part in texts:
            yield pd.DataFrame([own.decide(t) for t in part], columns=["lang_pred", "score"])

    decide.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(decide, "lang_pred string, score double")(text)


def identify(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", parts: int = 4, held_part: int = 2
) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred and score.

    Learns from rows whose id's crc32 modulo ``parts`` is not ``held_part``; a prediction sees the text alone.
    """
    ship_package(docs.sparkSession)
    part = F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts
    filters = learn(docs.filter(part != held_part), lang, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(part == held_part, F.lit(False)).alias("held_out"), F.col(text).alias("body"))
    return rows.withColumn("p", predicted(filters, F.col("body"), docs.sparkSession)).select("doc_id", "held_out", "p.lang_pred", "p.score")


def op12_query(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
