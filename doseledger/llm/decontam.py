"""Benchmark decontamination with a distributed positional inverted index.

The index holds (term, document, position) for every word of the corpus that some test item uses, written
once. Windows of equal words are one window, however many items hold them. The two rarest terms of a window by corpus count and
the distance between them are its anchor pair, which overlapping and templated windows share. Postings of both terms, adjusted by
the distance, meet on (document, pair, place); each meeting names the starts at which a window with that pair may stand. Only
these documents are read again: the words at each start are spelt out and joined with the windows by equality, so a hash
never decides what a document holds. Common terms are never intersected unless a window has nothing rarer.

A text is cut into pieces of ``PIECE`` words before its starts are spelt out, so work and memory grow with its
length alone, also where every place is a start. Windows with the same set of items share one list of them; sets are told
apart by their size and two 64-bit hashes.

Defined cases: null texts have no words; an item of fewer words than the window is one window, an item without words
none; equal item ids count as one item; a null item id is one item, written as an empty string; equal rows give equal results;
an empty table on either side gives no hits. Document ids are numbers; a null id and -2^63 count as one id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from doseledger.functions.columns import once
from doseledger.llm.common import ascii_lower, carried, id_in, id_out, text_key
from doseledger.session import write_scratch

PIECE = 512
PROBE = 16
ITEM_SET = ("set_size", "set_a", "set_b")
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def terms(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAKS), lambda w: w != "")


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Items with words: a number, the id as text, the words; equal items once."""
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), terms(F.col(text)).alias("item_words"))
    rows = rows.filter(F.size("item_words") > 0).distinct()
    return write_scratch(rows.withColumn("item_no", F.monotonically_increasing_id()), "items")


def build_index(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(postings, documents, counts): term, id, th, pos of test terms; id, th, n_words of each row; word, term, count.

    A last empty word closes each document, so that one pass over the texts gives both.
    """
    spark = items.sparkSession
    words = items.select(F.explode("item_words").alias("word")).distinct().withColumn("term", F.monotonically_increasing_id())
    closing = spark.range(1).select(F.lit("").alias("word"), F.lit(-1).cast("long").alias("term"))
    # written first, so that the planner knows its true size
    vocabulary = write_scratch(words.unionByName(closing), "vocabulary")
    # keys are made below the generator, else they would be made again for every word; an outer explode adds no
    # filter on the array, which would make it twice
    keyed = docs.select(
        id_in(doc_id).alias("id"),
        text_key(F.coalesce(F.col(text), F.lit(""))).alias("th"),
        F.concat(terms(F.col(text)), F.array(F.lit(""))).alias("all_words"),
    )
    positions = keyed.select("id", "th", F.posexplode_outer("all_words").alias("pos", "word"))
    index = write_scratch(positions.join(vocabulary, "word").select("term", "id", "th", "pos"), "postings")
    ends = index.filter("term = -1").select("id", "th", F.col("pos").cast("long").alias("n_words"))
    counted = vocabulary.join(index.filter("term >= 0").groupBy("term").count(), "term")
    return index.filter("term >= 0"), ends, write_scratch(counted, "term-counts")


def anchors(items: DataFrame, counts: DataFrame, window: int, rarest: int = 2) -> DataFrame:
    """The ``rarest`` terms of every window: term, item_no, offset and how many anchors a hit needs.

    A window with a term that the corpus lacks can't occur and gets no anchors.
    """
    n = F.size("item_words")
    windows = items.select("item_no", "item_words", F.explode(F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))).alias("w"))
    spread = windows.select(
        "item_no", "w", F.least(n, F.lit(window)).alias("width"), F.posexplode(F.slice("item_words", F.col("w") + 1, window)).alias("o", "word")
    )
    counted = spread.join(counts, "word")
    whole = Window.partitionBy("item_no", "w")
    ranked = counted.withColumns(
        {"found": F.count(F.lit(1)).over(whole), "rank": F.row_number().over(whole.orderBy("count", "o"))}
    )
    chosen = ranked.filter((F.col("found") == F.col("width")) & (F.col("rank") <= rarest))
    return (
        chosen.select("term", "item_no", (F.col("w") + F.col("o")).alias("offset"), F.least(F.col("width"), F.lit(rarest)).alias("need"))
        .groupBy("term", "item_no", "offset")
        .agg(F.min("need").alias("need"))
    )


def proximity_matches(postings: DataFrame, chosen: DataFrame, slop: int) -> DataFrame:
    """(id, th, item_no, start): diagonals within ``slop`` words of each other hold ``need`` anchors.

    Nearby diagonals meet in one of two overlapping buckets of 2 * (slop + 1); start is the smallest in its bucket.
    """
    width = 2 * (slop + 1)
    hits = postings.join(chosen, "term").select("id", "th", "item_no", "offset", "need", (F.col("pos") - F.col("offset")).alias("start"))
    bucket = lambda shift: F.floor((F.col("start") + shift) / width) * 2 + (1 if shift else 0)
    near = hits.withColumn("bucket", F.explode(F.array(bucket(0), bucket(slop + 1))))
    ordered = Window.partitionBy("id", "th", "item_no", "bucket").orderBy("start").rangeBetween(0, slop)
    met = near.withColumn("n", F.size(F.collect_set("offset").over(ordered))).filter("n >= need")
    return met.groupBy("id", "th", "item_no", "bucket").agg(F.min("start").alias("start")).select("id", "th", "item_no", "start").distinct()


def item_windows(items: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(windows, set_items): win_no, phrase, width and the key of its item set; that key and each item of the set."""
    n = F.size("item_words")
    starts = F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))
    last = lambda s: F.least(s + window, n) - 1
    phrases = F.transform(starts, lambda s: F.array_join(F.transform(F.sequence(s, last(s)), lambda i: F.get("item_words", i)), " "))
    own = write_scratch(items.select("item", F.explode(phrases).alias("phrase")).distinct(), "item-windows")
    windows = own.groupBy("phrase").agg(
        F.count(F.lit(1)).alias("set_size"),
        F.bit_xor(F.xxhash64("item")).alias("set_a"),
        F.bit_xor(F.xxhash64(F.lit(1), "item")).alias("set_b"),
    )
    width = F.size(F.split("phrase", " "))
    windows = write_scratch(windows.withColumns({"width": width, "win_no": F.monotonically_increasing_id()}), "windows")
    one = windows.groupBy(*ITEM_SET).agg(F.min("phrase").alias("phrase"))
    return windows, write_scratch(own.join(one, "phrase").select(*ITEM_SET, "item"), "item-sets")


def anchor_pairs(windows: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, lanes): pair_no, term, delta, need of each anchor; pair_no, back, width of the windows with that pair.

    A window with a term that the corpus lacks can't occur and gets no anchors. A window of one word has one anchor, as has one whose
    second term is over ``PROBE`` times as frequent: spelling out the few places costs less than that term's postings.
    """
    spread = windows.select("win_no", "width", F.posexplode(F.split("phrase", " ")).alias("o", "word")).join(counts, "word")
    whole = Window.partitionBy("win_no")
    ranked = spread.withColumns(
        {
            "found": F.count(F.lit(1)).over(whole),
            "least": F.min("count").over(whole),
            "rank": F.row_number().over(whole.orderBy("count", "o")),
        }
    )
    useful = (F.col("rank") == 1) | ((F.col("rank") == 2) & (F.col("count") <= PROBE * F.col("least")))
    rarest = ranked.filter((F.col("found") == F.col("width")) & useful).groupBy("win_no", "width")
    ends = rarest.agg(F.min(F.struct("o", "term")).alias("lo"), F.max(F.struct("o", "term")).alias("hi"))
    key = {"first": F.col("lo.term"), "second": F.col("hi.term"), "delta": F.col("hi.o") - F.col("lo.o")}
    keyed = write_scratch(ends.select("width", F.col("lo.o").alias("back"), *[c.alias(k) for k, c in key.items()]), "anchor-pairs")
    numbered = keyed.select(*key).distinct().withColumn("pair_no", F.monotonically_increasing_id())
    numbered = write_scratch(numbered, "pair-numbers")
    # both ends of a pair at no distance are one anchor
    need = F.when(F.col("delta") > 0, 2).otherwise(1)
    begin = numbered.select("pair_no", F.col("first").alias("term"), F.lit(0).alias("delta"), need.alias("need"))
    end = numbered.filter("delta > 0").select("pair_no", F.col("second").alias("term"), "delta", F.lit(2).alias("need"))
    lanes = keyed.join(numbered, list(key)).select("pair_no", "back", "width").distinct()
    return write_scratch(begin.unionByName(end), "pair-terms"), write_scratch(lanes, "lanes")


def possible_starts(postings: DataFrame, pairs: DataFrame, lanes: DataFrame) -> DataFrame:
    """(id, th, asked): for each piece of a document its number and the (start, width) at which a window may stand.

    All steps group within a document, so one shuffle by document serves them.
    """
    hits = postings.join(pairs, "term").select("id", "th", "pair_no", (F.col("pos") - F.col("delta")).alias("place"), "need")
    met = hits.repartition("id", "th").groupBy("id", "th", "pair_no", "place").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("need"))
    starts = met.filter("n >= need").join(lanes, "pair_no").select("id", "th", (F.col("place") - F.col("back")).alias("start"), "width")
    piece = F.floor(F.col("start") / PIECE).cast("int")
    in_piece = starts.filter("start >= 0").groupBy("id", "th", piece.alias("piece")).agg(F.collect_set(F.struct("start", "width")).alias("starts"))
    return in_piece.groupBy("id", "th").agg(F.collect_list(F.struct("piece", "starts")).alias("asked"))


def phrase_hits(
    docs: DataFrame, windows: DataFrame, asked: DataFrame, window: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, th, at, width, item set): every place where a window stands in a document."""
    asked = asked.withColumnsRenamed({"id": "a_id", "th": "a_th"})
    body = docs.select(id_in(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    body = body.withColumn("th", text_key(F.col("body"))).join(asked, (F.col("id") == F.col("a_id")) & (F.col("th") == F.col("a_th")))
    spelt = once(body.select("id", "th", "asked", "body"), "doc_words", terms(F.col("body"))).drop("body")
    # words are fetched one by one, as taking a slice inside a lambda copies the whole array first
    cut = lambda words, low, high: F.transform(F.sequence(low, high), lambda i: F.get(words, i))
    pieces = F.transform(
        "asked",
        lambda a: F.struct(
            (a["piece"] * PIECE).alias("base"),
            a["starts"].alias("starts"),
            cut(F.col("doc_words"), a["piece"] * PIECE, (a["piece"] + 1) * PIECE + window - 2).alias("part"),
        ),
    )
    one = spelt.select("id", "th", F.explode(pieces).alias("p")).select("id", "th", "p.base", "p.starts", "p.part")
    # a start too near the end of the text spells fewer words
    spelling = F.transform(
        "starts",
        lambda s: F.struct(
            s["start"].alias("at"),
            F.array_join(cut(F.col("part"), s["start"] - F.col("base"), s["start"] - F.col("base") + s["width"] - 1), " ").alias("phrase"),
        ),
    )
    spelt_out = one.select("id", "th", F.explode(spelling).alias("s")).select("id", "th", "s.at", "s.phrase")
    return spelt_out.join(windows, "phrase").select("id", "th", "at", "width", *ITEM_SET).distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, th, n_words, n_hit, items (sorted ids), contaminated.

    A document is contaminated if its hit words are at least one in twenty.
    """
    items = item_terms(items)
    postings, ends, counts = build_index(docs, items, doc_id, text)
    windows, set_items = item_windows(items, window)
    asked = possible_starts(postings, *anchor_pairs(windows, counts))
    hits = write_scratch(phrase_hits(docs, windows, asked, window, doc_id, text), "phrases")
    covered = hits.select("id", "th", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("width") - 1)).alias("p")).distinct()
    per_doc = covered.groupBy("id", "th").agg(F.count(F.lit(1)).alias("n_hit"))
    named = hits.select("id", "th", *ITEM_SET).distinct().join(set_items, list(ITEM_SET))
    by_item = named.groupBy("id", "th").agg(F.sort_array(F.collect_set("item")).alias("items"))
    out = ends.join(per_doc.join(by_item, ["id", "th"]), ["id", "th"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "id",
        "th",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 13) -> DataFrame:
    """The rows that are not contaminated, with their own columns."""
    bad = contamination(docs, items, window).filter("contaminated").select("id", "th").distinct()
    rows = carried(docs, id=id_in("doc_id"), th=text_key(F.coalesce("text", F.lit(""))))
    return rows.join(bad, ["id", "th"], "left_anti").select("row.*")


def op10_query(spark, sf_dir: str) -> DataFrame:
    from doseledger.llm.common import table

    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        id_out("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (SELECT DISTINCT item, least(len(w), 13) AS width, array_to_string(w[i:i+12], ' ') AS phrase
      FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
widths AS (SELECT DISTINCT width FROM q),
p AS (SELECT r, width, i, array_to_string(w[i:i+width-1], ' ') AS phrase
      FROM (SELECT r, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM d, widths WHERE len(w) >= width)),
h AS (SELECT p.r, p.i, p.width, q.item FROM p JOIN q ON p.phrase = q.phrase AND p.width = q.width),
n AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + width)) AS pos FROM h) GROUP BY r),
t AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n ON d.r = n.r LEFT JOIN t ON d.r = t.r
"""
