"""URL filter: block and allow rules first, then the ratio of two character language models.

URLs that a rule decides train one variable-order Markov model each for accepted and rejected addresses: counts
of characters after up to three preceding ones, interpolated from short to long contexts with weights that follow
how many different characters a context has been seen with (Witten-Bell). An address without a rule gets the
log-likelihood difference per character; it is blocked below a threshold calibrated so that a given share of the
accepted addresses would pass. Hosts and paths are scored once each however many pages share them, and
model tables have one row per distinct n-gram. An address of any length is cut into characters once, and its grams carry a key of it only.

Defined cases: a null address, or one without ``://``, has an empty host and path; it scores nothing and is allowed. Without
accepted or without rejected addresses there is no model, and what no rule decides is allowed. Equal rows give equal results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doseledger.functions.columns import once
from doseledger.llm.common import ascii_lower, carried
from doseledger.session import write_scratch

#: fixed values: rule text (host, then path) and verdict
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
START, ORDER = "\x02", 4
#: parts of a range in one job of the quantile
PARTS = 1024


def host_and_path(url: Column) -> tuple[Column, Column]:
    host = ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_table(spark, rules=RULES) -> DataFrame:
    rows = [(r, r[: r.index("/")], r[r.index("/") :], v) for r, v in rules]
    return spark.createDataFrame(rows, "rule string, rule_host string, rule_path string, rule_verdict string")


def match_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest fitting rule of each (host, path).

    Each host is joined by its own suffixes, as far as the rule with most labels reaches, so that many rules stay an equality join.
    """
    deepest = rules.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0] or 1
    labels = F.expr(f"slice(split(host, '[.]'), greatest(1, size(split(host, '[.]')) - {deepest - 1}), {deepest})")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = places.withColumn("rule_host", F.explode(F.array_distinct(suffixes))).join(rules, "rule_host").filter("startswith(path, rule_path)")
    best = fits.groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "rule_verdict"), F.struct(F.length("rule"), F.col("rule"))).alias("best")
    )
    return places.join(best, ["host", "path"], "left").select("*", "best.rule", "best.rule_verdict").drop("best")


def grams(parts: DataFrame) -> DataFrame:
    """Every character of a part with the ORDER - 1 characters before it, one row each: a string of ORDER characters.

    Instead of the part, rows have its length in grams ``n`` and two hashes ``h1`` and ``h2`` that name it.
    """
    padded = F.concat(F.lit(START * (ORDER - 1)), F.col("part"), F.lit(START))
    keyed = parts.withColumns({"h1": F.xxhash64("part"), "h2": F.xxhash64(F.lit(1), "part"), "n": F.length("part") + 1})
    # one regular expression pass; the lambda below looks characters up by place
    cut = once(keyed.withColumn("part", padded), "chars", F.regexp_extract_all("part", F.lit("(?s)."), F.lit(0))).drop("part")
    chars = F.col("chars")
    whole = F.transform(
        F.slice(chars, 1, F.size(chars) - (ORDER - 1)), lambda c, i: F.concat(c, *[F.get(chars, i + k) for k in range(1, ORDER)])
    )
    return cut.select(*[c for c in cut.columns if c != "chars"], F.explode(whole).alias("gram"))


def log_ratios(train: DataFrame, asked: DataFrame) -> DataFrame:
    """For each gram in ``asked``: the log ratio of its last character's probability, accepted over rejected.

    ``train``: gram, accepted, rejected (counts). Probabilities start uniform over the characters seen and are
    interpolated with ever longer contexts.
    """
    alphabet = train.select(F.substring("gram", ORDER, 1).alias("c")).distinct().count() + 1
    out = asked.withColumns({f"p_{s}": F.lit(1.0 / alphabet) for s in ("accepted", "rejected")})
    for k in range(1, ORDER + 1):
        tail, head = f"tail{k}", f"head{k}"
        of_tail = F.substring("gram", ORDER - k + 1, k)
        of_head = F.substring("gram", ORDER - k + 1, k - 1) if k > 1 else F.lit("")
        sums = train.groupBy(of_tail.alias(tail)).agg(*[F.sum(s).alias(f"n_{s}") for s in ("accepted", "rejected")])
        heads = sums.groupBy((F.substring(tail, 1, k - 1) if k > 1 else F.lit("")).alias(head)).agg(
            *[F.sum(f"n_{s}").alias(f"h_{s}") for s in ("accepted", "rejected")],
            *[F.count_if(F.col(f"n_{s}") > 0).alias(f"t_{s}") for s in ("accepted", "rejected")],
        )
        out = out.withColumn(tail, of_tail).join(sums, tail, "left")
        if k == 1:  # one context that all grams share
            only = heads.first()
            out = out.withColumns({c: F.lit(only[c] if only else None).cast("long") for c in heads.columns if c != head})
        else:
            out = out.withColumn(head, of_head).join(heads, head, "left")
        mixed = {}
        for s in ("accepted", "rejected"):
            n, h, t = (F.coalesce(F.col(f"{x}_{s}"), F.lit(0)) for x in "nht")
            mixed[f"p_{s}"] = F.when(h + t > 0, (n + t * F.col(f"p_{s}")) / (h + t)).otherwise(F.col(f"p_{s}"))
        out = out.select("gram", *[v.alias(c) for c, v in mixed.items()])
    return out.select("gram", (F.log("p_accepted") - F.log("p_rejected")).alias("ratio"))


def score_places(places: DataFrame) -> DataFrame:
    """Add ``score``, the log-likelihood difference per character, to (host, path, rule_verdict, pages).

    The model counts every page that a rule decides, by its host and by its path.
    """
    side = lambda c: F.col(c).alias("part")
    seen = lambda v: F.sum(F.when(F.col("rule_verdict") == v, F.col("pages")).otherwise(0))
    parts = [
        places.groupBy(side(c)).agg(seen("allow").alias("accepted"), seen("block").alias("rejected")) for c in ("host", "path")
    ]
    pieces = write_scratch(grams(parts[0].withColumn("kind", F.lit("host")).unionByName(parts[1].withColumn("kind", F.lit("path")))), "url-grams")
    train = write_scratch(
        pieces.groupBy("gram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")), "url-model"
    )
    ratios = log_ratios(train.filter("accepted + rejected > 0"), train.select("gram"))
    # a part's equal grams travel as one row
    counted = pieces.groupBy("kind", "h1", "h2", "n", "gram").agg(F.count(F.lit(1)).alias("times"))
    scored = counted.join(ratios, "gram").groupBy("kind", "h1", "h2", "n").agg(F.sum(F.col("ratio") * F.col("times")).alias("sum"))
    scored = write_scratch(scored, "url-scores")
    out = places
    for c in ("host", "path"):
        own = scored.filter(F.col("kind") == c).select("h1", "h2", F.col("sum").alias(f"{c}_sum"), F.col("n").alias(f"{c}_n"))
        out = out.withColumns({"h1": F.xxhash64(c), "h2": F.xxhash64(F.lit(1), c)}).join(own, ["h1", "h2"], "left").drop("h1", "h2")
    return out.withColumn("score", (F.col("host_sum") + F.col("path_sum")) / (F.col("host_n") + F.col("path_n")))


def weighted_quantile(rows: DataFrame, value: str, weight: str, share: float) -> float | None:
    """The exact quantile of values that each count ``weight`` times, interpolated between its two neighbours; None without rows.

    A job counts the weights in equal parts of the range and goes on with the one part that holds the wanted rank, until it
    holds one value only. No task or driver ever has more than a row for each of the parts.
    """
    total, low, high = rows.agg(F.sum(weight), F.min(value), F.max(value)).first()
    if not total:
        return None
    place = share * (total - 1)

    def at(rank: int) -> float:
        first, last = low, high
        while first < last:
            part = F.least(F.floor((F.col(value) - F.lit(first)) / F.lit(last - first) * F.lit(PARTS)), F.lit(PARTS - 1))
            inside = rows.filter(F.col(value).between(first, last)).groupBy(part.alias("part"))
            for r in sorted(inside.agg(F.sum(weight).alias("w"), F.min(value).alias("a"), F.max(value).alias("b")).collect()):
                if rank < r["w"]:
                    first, last = r["a"], r["b"]
                    break
                rank -= r["w"]
        return first

    below, above = at(math.floor(place)), None
    if place == math.floor(place):
        return below
    above = at(math.ceil(place))
    return below if below == above else (math.ceil(place) - place) * below + (place - math.floor(place)) * above


def judge_urls(pages: DataFrame, url: str = "url", rules=RULES, pass_share: float = 0.98) -> DataFrame:
    """Columns row (the input row), host, path, rule, verdict and score (null where a rule decided).

    The threshold lets ``pass_share`` of the pages pass that a rule allows, over all of them.
    """
    host, path = host_and_path(F.col(url))
    split = carried(pages, host=host, path=path)
    places = split.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"))
    places = write_scratch(match_rules(places, rule_table(pages.sparkSession, rules)), "url-places")
    scored = write_scratch(score_places(places), "url-scored")
    threshold = weighted_quantile(scored.filter("rule_verdict = 'allow'"), "score", "pages", 1 - pass_share)
    low = F.lit(False)
    if threshold is not None and not scored.filter("rule_verdict = 'block'").isEmpty():
        low = (F.col("score") < F.lit(threshold)) & (F.col("host") != "")
    verdict = F.coalesce("rule_verdict", F.when(low, "block").otherwise("allow"))
    judged = scored.select("host", "path", "rule", verdict.alias("verdict"), F.when(F.col("rule").isNull(), F.col("score")).alias("score"))
    return split.join(judged, ["host", "path"], "left").select("row", "host", "path", "rule", "verdict", "score")


def op9_query(spark, sf_dir: str) -> DataFrame:
    from doseledger.llm.common import table

    out = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return out.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict", "score")
