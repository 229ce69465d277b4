"""The URL filter against a plain version: model, threshold and verdicts; very long addresses."""

import math
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from doseledger.llm import url_filter as uf

rng = random.Random(9)


def address():
    host = rng.choice(["a.net", "www.b.net", "example.net", "x.example.net", "example.com", "m.example.com", "c.org", "w.d.org", "shop.io", "q.de"])
    path = rng.choice(["/", "/en/", "/de/", "/fr/", "/en/cheap-", "/fr/news/", ""]) + "".join(rng.choices(rng.choice(["abcde", "xyz01", "éü/"]), k=rng.randint(0, 12)))
    return rng.choice(["http://", "https://", "HTTP://"]) + host + path + rng.choice(["", "?a=1", "#b"])


URLS = [address() for _ in range(400)] + [None, "", "no scheme", "://", "://.", "http://a..net/x", "http://😀.net/😀😀"] + ["http://example.net/en/same"] * 30


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.partition("://")[2]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]


def rule_of(host, path):
    fits = [r for r, _ in uf.RULES if (host == r[: r.index("/")] or host.endswith("." + r[: r.index("/")])) and path.startswith(r[r.index("/"):])]
    return max(fits, key=lambda r: (len(r), r)) if fits else None


def plain(urls, share=0.98):
    verdicts = dict(uf.RULES)
    places = Counter(split(u) for u in urls)
    counts = {v: Counter() for v in ("allow", "block")}
    for (host, path), n in places.items():
        rule = rule_of(host, path)
        if rule:
            for part in (host, path):
                padded = uf.START * 3 + part + uf.START
                for i in range(len(part) + 1):
                    counts[verdicts[rule]][padded[i : i + 4]] += n
    alphabet = len({g[3] for c in counts.values() for g in c}) + 1
    contexts = {v: defaultdict(Counter) for v in counts}
    for v, c in counts.items():
        for g, n in c.items():
            for k in range(4):
                contexts[v][k, g[3 - k : 3]][g[3]] += n

    def log_p(v, gram):
        p = 1 / alphabet
        for k in range(4):
            own = contexts[v].get((k, gram[3 - k : 3]), Counter())
            total, kinds = sum(own.values()), len(own)
            if total:
                p = (own[gram[3]] + kinds * p) / (total + kinds)
        return math.log(p)

    scores = {}
    for host, path in places:
        own = [g for part in (host, path) for i in range(len(part) + 1) for g in [(uf.START * 3 + part + uf.START)[i : i + 4]]]
        scores[host, path] = sum(log_p("allow", g) - log_p("block", g) for g in own) / len(own)
    allowed = sorted(scores[p] for p, n in places.items() if (r := rule_of(*p)) and verdicts[r] == "allow" for _ in range(n))
    low = np.quantile(allowed, 1 - share)
    out = []
    for u in urls:
        host, path = split(u)
        rule = rule_of(host, path)
        out.append((host, path, rule, verdicts[rule] if rule else "block" if scores[host, path] < low and host else "allow"))
    return out


def test_equal_to_plain(spark):
    pages = spark.createDataFrame([(i, u, "h", "p", "g", 1) for i, u in enumerate(URLS)], "page_id long, url string, host string, part string, gram string, n int")
    got = {r["row"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in uf.judge_urls(pages).collect()}
    want = plain(URLS)
    assert [got[i] for i in range(len(URLS))] == want
    assert {w[3] for w in want if w[2] is None and w[0]} == {"allow", "block"}


@pytest.mark.parametrize("share", [0.0, 0.02, 0.5, 0.731, 1.0])
def test_quantile_equals_the_gathered_one(spark, share):
    gen = np.random.default_rng(2)
    values = [*gen.normal(size=300).tolist(), *[0.25] * 40, -1e12, 1e-300, *gen.normal(size=50).round(1).tolist()]
    rows = spark.createDataFrame([(float(v), int(gen.integers(1, 9))) for v in values], "v double, w long")
    want = rows.agg(F.expr(f"percentile(v, {share}, w)")).first()[0]
    assert uf.weighted_quantile(rows, "v", "w", share) == want
    assert uf.weighted_quantile(rows.filter("false"), "v", "w", share) is None


def test_very_long_addresses(spark):
    long = ["http://example.net/en/" + "".join(rng.choices("abcdefgh", k=1_000_000)), "http://q.de/" + "a" * 1_000_000, "http://" + "a." * 200_000 + "net/x"]
    urls = URLS[:100] + long
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    began = time.time()
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in uf.judge_urls(pages).select("row.page_id", "rule", "verdict").collect()}
    assert time.time() - began < 200
    assert len(got) == len(urls) and got[100] == ("example.net/en/", "allow") and got[102] == ("net/", "block")
