"""Near copies of texts: sets of five-word shingles whose Jaccard similarity is 0.8 or more, or SimHash prints within three bits.

The pipeline links by both, and SimHash comes first: prints meet by the Golay-code keys of :mod:`doseledger.llm.simhash`, are verified there, and each link joins the
shingle sets behind its prints. Three bits hold a pair of similarity 0.8 only now and then, so bands of min-hashes find the
others; what SimHash has joined is not compared again.

A set's sketch is one byte of each of 160 min-hashes. Five bytes in a row are a band, so the sketch holds the 32 band keys whole. Two sets of
similarity s share a band with probability 1 - (1 - s^5)^32: all but 3 of a million pairs at 0.8, fewer above. Inside a band, sketches
are compared first: at 0.8 two differ in more than 56 bytes about three times in a million. Links are decided on the two
whole shingle sets, so no hash of a set or band decides.

Rows are distinct shingle sets, so copies cost nothing. Only bands that hold several components go on, and within them only pairs of
different components whose sizes fit; a pair is looked at in the first band it shares. Very full bands first compare each member with
one centre a round, which joins whole groups of near copies. Then every band is cut into cells of a block of members outside its largest
component against a block of all its members, each a task's piece of bounded size. Cells compare sketches and name the members
that have a likely partner; only these fetch their shingle sets, once for each cell. Pairs never leave a cell, only links that join components do.

Defined cases: a null text is an empty one; a text of fewer than five words is one shingle, one without words has the empty
set, and empty sets are equal; a null id counts only if all ids of a component are null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doseledger.llm import simhash
from doseledger.llm.common import carried, drop_scratch, ship_package, text_key
from doseledger.llm.simhash import components, first_of_each, grouped
from doseledger.session import write_scratch

WIDTH, SEED = 5, 42
#: at least this many of so many shingles of both are shared
SIMILAR, OF = 4, 5
BANDS, HASHES = 32, 5
#: of all bytes of two sketches so many are equal, or the sets aren't compared
LIKELY = 104
#: members of a block; bands with more have star rounds first, so many; tasks that share a centre
BLOCK, STARS, SALTS_OF_A_CENTRE = 512, 3, 16
_gen = np.random.default_rng(SEED)
FACTORS = _gen.integers(0, 2**63, BANDS * HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SALTS = _gen.integers(0, 2**63, BANDS * HASHES, dtype=np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15)  # fixed values: odd 64-bit factors of well spread bits
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    own = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    n = min(width, len(own))
    hashes = np.full(len(own) - n + 1, n, np.uint64)
    for i in range(n):
        hashes = hashes * STEP + own[i : len(own) - n + 1 + i]
    return np.unique(_mixed(hashes))


def set_key(hashes: np.ndarray) -> int:
    """A signed 64-bit key of a shingle set."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """One byte of the lowest value of each hash function over a set."""
    lowest = np.full(len(FACTORS), 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 512):
        np.minimum(lowest, ((hashes[at : at + 512, None] ^ SALTS) * FACTORS).min(axis=0), out=lowest)
    return _mixed(lowest).astype(np.uint8)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """(n, BANDS) keys of (n, 160) sketches: a band's number and its five bytes."""
    rows = sketches.reshape(-1, BANDS, HASHES).astype(np.int64)
    keys = np.repeat(np.arange(BANDS, dtype=np.int64)[None], len(rows), axis=0)
    for i in range(HASHES):
        keys = keys << 8 | rows[:, :, i]
    return keys


def _signatures(texts: pd.Series) -> pd.DataFrame:
    sets = [shingle_set(t) for t in texts]
    return pd.DataFrame({"fp": [set_key(s) for s in sets], "n": [len(s) for s in sets], "sketch": [sketch(s).tobytes() for s in sets]})


def _sets(texts: pd.Series) -> pd.Series:
    return pd.Series([shingle_set(t).tobytes() for t in texts], dtype=object)


def _keys(sketches: pd.Series) -> pd.Series:
    return pd.Series(list(band_keys(_stack(sketches))), dtype=object)


def _stack(sketches) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, len(FACTORS))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two whole shingle sets are similar enough."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small):
        return not len(large)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    shared = int((large[at] == small).sum())
    return shared * OF >= (len(a) + len(b) - shared) * SIMILAR


def likely_pairs(key: int, cell: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Positions (x, y) of members of a cell that the sets must decide on, most alike first."""
    left, right = np.flatnonzero(cell["out"]), np.flatnonzero(cell["every"])
    sketches, sizes, roots, names, out = _stack(cell["sketch"]), cell["n"], cell["root"], cell["fp"], cell["outside"]
    band, found = key >> 8 * HASHES, []
    for x in left:
        # two members outside the largest component meet from both sides
        y = right[(roots[right] != roots[x]) & (~out[right] | (names[right] > names[x]))]
        y = y[np.minimum(sizes[y], sizes[x]) * OF >= np.maximum(sizes[y], sizes[x]) * SIMILAR]
        if not len(y):
            continue
        equal = sketches[y] == sketches[x]
        alike = equal.sum(axis=1)
        near = alike >= LIKELY
        if near.any():
            y, equal, alike = y[near], equal[near], alike[near]
            first = equal.reshape(len(y), BANDS, HASHES).all(axis=2).argmax(axis=1) == band
            found.append(np.stack([np.full(first.sum(), x), y[first], alike[first]]))
    pairs = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    pairs = pairs[:, np.argsort(-pairs[2], kind="stable")]
    return pairs[0], pairs[1]


_CELL = "key long, i int, j int, fp long, root long, n int, outside boolean, out boolean, every boolean, sketch binary"


_NAMES = [c.split()[0] for c in _CELL.split(", ")]


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """Whole cells of rows that come sorted by cell, as arrays; a cell may go on in the next batch."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        own = {c: batch[c].to_numpy() for c in batch.columns}
        held = own if held is None else {c: np.concatenate([held[c], own[c]]) for c in own}
        if not len(held["key"]):
            continue
        new = np.logical_or.reduce([held[c][1:] != held[c][:-1] for c in ("key", "i", "j")])
        starts = [0, *(np.flatnonzero(new) + 1).tolist()]
        for s, e in zip(starts, starts[1:]):
            yield int(held["key"][s]), {c: v[s:e] for c, v in held.items()}
        held = {c: v[starts[-1] :] for c, v in held.items()}
    if held is not None and len(held["key"]):
        yield int(held["key"][0]), held


def _hopeful(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Members of cells that are in a likely pair there."""
    held: list[dict[str, np.ndarray]] = []

    def emit():
        return pd.DataFrame({c: np.concatenate([part[c] for part in held]) for c in _NAMES})

    for key, cell in _cells(batches):
        x, y = likely_pairs(key, cell)
        if len(x):
            at = np.unique(np.concatenate([x, y]))
            held.append({c: v[at] for c, v in cell.items()})
        if len(held) >= 2048:
            yield emit()
            held = []
    if held:
        yield emit()


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links (a, b) of cells, each joining two components that this task hasn't joined."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while x in parent:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    for key, cell in _cells(batches):
        own = [np.frombuffer(b, np.uint64) for b in cell["own"]]
        roots, names, out = cell["root"].tolist(), cell["fp"].tolist(), []
        for x, y in zip(*likely_pairs(key, cell)):
            a, b = top(roots[x]), top(roots[y])
            if a != b and similar(own[x], own[y]):
                parent[max(a, b)] = min(a, b)
                out.append((names[x], names[y]))
        if out:
            yield pd.DataFrame(out, columns=["a", "b"])


def _pair_kept(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b)])


def _placed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """key, fp and root of the members of bands with several components, with the band's largest one and counts; written."""
    named = members.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    per_root = named.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    per_key = per_root.groupBy("key").agg(
        F.sum("n").alias("members"), F.max(F.struct("n", "root")).alias("most"), F.count(F.lit(1)).alias("parts")
    ).filter("parts > 1")
    mixed = per_key.select("key", "members", F.col("most.root").alias("largest"), (F.col("members") - F.col("most.n")).alias("others"))
    return write_scratch(named.select("key", "fp", "root").join(write_scratch(mixed, "mixed-bands"), "key"), "band-members")


def _stars(members: DataFrame, sets_of, roots: DataFrame) -> DataFrame:
    """Roots after each member of a very full band has met a centre a few times."""
    full = members.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > BLOCK).select("key")
    full = write_scratch(full, "full-bands")
    if full.isEmpty():
        return roots
    members = write_scratch(members.join(full, "key"), "full-band-members")
    sets = write_scratch(sets_of(members.select("fp").distinct()), "shingle-sets")
    salt = F.pmod(F.xxhash64("a"), F.lit(SALTS_OF_A_CENTRE)).cast("int")
    for turn in range(STARS):
        left = _placed(members, roots)
        # of the centres that a set meets, only the first one
        rank = F.struct(F.xxhash64(F.lit(turn), "fp").alias("by"), F.col("fp"), F.col("root"))
        centre = left.groupBy("key").agg(F.min(rank).alias("c"))
        met = left.join(centre, "key").filter("root <> c.root").groupBy("fp").agg(F.min("c").alias("c"))
        asked = met.select(F.col("fp").alias("a"), F.col("c.fp").alias("b")).withColumn("salt", salt)
        centres = sets.join(asked.select(F.col("b").alias("fp")).distinct(), "fp").select(
            F.col("fp").alias("b"), F.col("own").alias("own_b"), F.explode(F.sequence(F.lit(0), F.lit(SALTS_OF_A_CENTRE - 1))).alias("salt")
        )
        both = asked.join(centres, ["b", "salt"]).join(sets.select(F.col("fp").alias("a"), F.col("own").alias("own_a")), "a")
        found = both.filter(F.pandas_udf(_pair_kept, "boolean")("own_a", "own_b")).select("a", "b")
        # a forest is enough of what is known
        before, forest = roots, found.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = write_scratch(components(forest), "copies")
        drop_scratch(left)
        if turn:
            drop_scratch(before)
    drop_scratch(sets)
    drop_scratch(members)
    return roots


def simhash_roots(rows: DataFrame) -> DataFrame:
    """(node, root) of every set that SimHash links to another. rows: fp, print (the signed fingerprint of a text).

    A print stands for the smallest set it has, so that prints and sets aren't mixed up as nodes.
    """
    behind = write_scratch(rows.select("fp", "print").distinct(), "prints-of-sets")
    named = write_scratch(behind.groupBy("print").agg(F.min("fp").alias("set")), "sets-of-prints")
    found = simhash.links(named.select(F.col("print").alias("fp")))
    for end in ("a", "b"):
        found = found.join(named.select(F.col("print").alias(end), F.col("set").alias(f"set_{end}")), end)
    same = behind.join(named, "print").select(F.col("fp").alias("a"), F.col("set").alias("b"))
    edges = found.select(F.col("set_a").alias("a"), F.col("set_b").alias("b")).unionByName(same)
    return write_scratch(components(edges), "simhash-copies")


def links(per_set: DataFrame, sets_of, known: DataFrame) -> DataFrame:
    """(node, root) of every set that has a near copy. per_set: fp, n, sketch. sets_of: from a frame of fp to fp, own. known: links so far, as (node, root)."""
    keyed = per_set.select("fp", F.explode(F.pandas_udf(_keys, "array<long>")("sketch")).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key")
    members = write_scratch(keyed.join(write_scratch(shared, "shared-bands"), "key").select("key", "fp"), "bands")
    roots = _stars(members, sets_of, known)
    left = _placed(members, roots)
    drop_scratch(members)
    blocks = [F.ceil(F.col(c) / BLOCK).cast("int") for c in ("others", "members")]
    outside = F.col("root") != F.col("largest")
    own_i = F.pmod(F.xxhash64(F.lit(1), "fp"), blocks[0].cast("long")).cast("int")
    own_j = F.pmod(F.xxhash64(F.lit(2), "fp"), blocks[1].cast("long")).cast("int")
    as_out = F.when(outside, F.transform(F.sequence(F.lit(0), blocks[1] - 1), lambda j: F.struct(own_i.alias("i"), j.alias("j"))))
    as_any = F.transform(F.sequence(F.lit(0), blocks[0] - 1), lambda i: F.struct(i.alias("i"), own_j.alias("j")))
    none = F.array().cast("array<struct<i:int,j:int>>")
    dealt = left.select(
        "key", "fp", "root", outside.alias("outside"), own_i.alias("own_i"), own_j.alias("own_j"),
        F.explode(F.array_union(F.coalesce(as_out, none), as_any)).alias("cell"),
    ).select(
        "key", "cell.i", "cell.j", "fp", "root", "outside",
        (F.col("outside") & (F.col("cell.i") == F.col("own_i"))).alias("out"), (F.col("cell.j") == F.col("own_j")).alias("every"),
    )
    rows = dealt.join(per_set.select("fp", F.col("n").cast("int").alias("n"), "sketch"), "fp").select(*_NAMES)
    cells = ["key", "i", "j"]
    hopeful = write_scratch(rows.repartition(*cells).sortWithinPartitions(*cells).mapInPandas(_hopeful, _CELL), "likely-members")
    drop_scratch(left)
    sets = write_scratch(sets_of(hopeful.select("fp").distinct()), "shingle-sets")
    whole = hopeful.join(sets, "fp").select(*hopeful.columns, "own")
    found = whole.repartition(*cells).sortWithinPartitions(*cells).mapInPandas(_links, "a long, b long").distinct()
    forest = write_scratch(found.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))), "copy-links")
    drop_scratch(hopeful)
    drop_scratch(sets)
    return write_scratch(components(forest), "copies")


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", prints: bool = False) -> DataFrame:
    """One row per input row: doc_id, th, fp (key of its shingle set), component_id (smallest id it reaches), root.

    With ``prints``, texts link by SimHash as well as by their shingle sets.
    """
    spark = docs.sparkSession
    ship_package(spark)
    body = F.coalesce(F.col(text), F.lit(""))
    signed = F.pandas_udf(_signatures, "fp long, n long, sketch binary")(F.col(text))
    own = [simhash.fingerprints(F.col(text)).alias("print")] if prints else []
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(body).alias("th"), signed.alias("s"), *own)
    rows = write_scratch(rows.select("doc_id", "th", "s.fp", "s.n", "s.sketch", *(["print"] if prints else [])), "signatures")
    one = rows.groupBy("fp").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "th")).alias("one"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    per_set = write_scratch(one, "shingle-keys")

    def sets_of(asked: DataFrame) -> DataFrame:
        chosen = per_set.join(asked, "fp").select("fp", F.col("one.doc_id").alias("k_id"), F.col("one.th").alias("k_th"))
        texts = docs.select(F.col(doc_id).alias("id"), text_key(body).alias("th"), body.alias("body"))
        found = texts.join(chosen, F.col("id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th")))
        return found.select("fp", F.pandas_udf(_sets, "binary")("body").alias("own")).dropDuplicates(["fp"])

    known = simhash_roots(rows) if prints else spark.createDataFrame([], "node long, root long")
    roots = links(per_set.select("fp", "n", "sketch"), sets_of, known)
    ids = grouped(per_set, roots)
    return rows.select("doc_id", "th", "fp").join(ids, "fp").select("doc_id", "th", "fp", "component_id", "root")


def keep_one_copy(docs: DataFrame) -> DataFrame:
    """One row of each component: that of its smallest id; of rows with this id, the one of smallest text key."""
    judged = near_copies(docs, prints=True).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keys = judged.select(F.col("doc_id").alias("k_id"), F.col("th").alias("k_th"), "root").distinct()
    rows = carried(docs, id=F.col("doc_id"), th=text_key(F.coalesce("text", F.lit(""))))
    return first_of_each(rows.join(keys, F.col("id").eqNullSafe(F.col("k_id")) & (F.col("th") == F.col("k_th"))))
