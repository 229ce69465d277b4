"""Exact removal of repeated byte strings with suffix arrays.

A byte goes if a string of ``span`` bytes that covers it starts anywhere else. Suffix arrays of all bytes would sort and move two hundred times the
corpus, so content picks what is sorted: in every window of ``span`` bytes the gram of smallest hash is its anchor. Equal strings have equal
anchors at equal places, so a string can only repeat where its anchor does.

1. Anchors with the hash of their context (all bytes of the strings whose anchor it is) are counted. An anchor found once is
   dropped. A context found twice is repeated as a whole, and needs no sorting.
2. One copy of each other context goes to a shard by its anchor. Strings whose inner bytes no other context of the anchor has are left
   out. The shard sorts the remaining suffixes by Larsson-Sadakane refinement up to ``span`` bytes, and Kasai's common prefixes give the
   classes of equal strings. A class is repeated if two places hold it.
3. An anchor with very many contexts is cut over several shards. Their sorted string keys are merged by binary search.
4. Repeated starts go back to the documents, whose bytes are dropped by a mask.

Defined cases: a null text is an empty one; equal rows are different places, so their texts of ``span`` bytes or more go; nulls in the id are
allowed; an empty table gives an empty result. Texts are cut in blocks while anchors are picked, so memory does not grow with a text's length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doseledger.llm.common import drop_scratch, id_in, ship_package, text_key
from doseledger.session import write_scratch

SPAN, GRAM = 200, 96
REACH = SPAN - GRAM  # how far before its anchor a string may start
STRIDE = 13  # starts whose strings are ruled out together before sorting
BLOCK = 1 << 20
SHARD_ROWS = 2_500  # contexts in a shard, about
CUT_ROWS = 6_000  # contexts of one anchor beyond which it is cut over shards
MERGE_KEYS = 2_000_000
_rng = np.random.default_rng(2024)
_CODES = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BACK = np.uint64(pow(int(_STEP), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, BLOCK + 4 * SPAN), base, np.uint64)
        steps[0] = 1
        have = _powers[str(base)] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Hashes:
    """Hashes of any interval of bytes, the same wherever the bytes stand."""

    def __init__(self, data: np.ndarray, family: int):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_CODES[family][data] * _power(_STEP, len(data)), out=self.sums[1:], dtype=np.uint64)
        self.back = _power(_BACK, len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start])


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return pick(values[:-rest], values[rest:]) if rest else values


def owned_starts(at: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) starts of the strings whose smallest gram each anchor is; anchors of equal hash may own some in common.

    An anchor's strings end where a smaller one comes into the window; with a smaller one before, they start after that.
    """
    first, last = at - REACH, at.copy()
    smaller = h[1:] < h[:-1]
    first[1:] = np.where(smaller, first[1:], np.maximum(first[1:], at[:-1] + 1))
    last[:-1] = np.where(smaller, np.minimum(last[:-1], at[1:] - REACH - 1), last[:-1])
    return first, last


def find_anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first byte of the context, its size, offset of the anchor in it, gram hash, context hash) of the anchors of a text."""
    n, width, found = len(data), REACH + 1, []
    for low in range(0, max(0, n - SPAN + 1), BLOCK):
        windows = min(BLOCK, n - SPAN + 1 - low)  # those that start in this block
        back = min(low, REACH)
        part = data[low - back : low + windows + 2 * SPAN]
        at = np.arange(back, back + windows + REACH)
        h = Hashes(part, 0).of(at, at + GRAM)
        least = _sliding(h, width, np.minimum)
        pad = np.zeros(width - 1, np.uint64)
        chosen = np.flatnonzero(_sliding(np.concatenate([pad, least, pad]), width, np.maximum) == h)
        h, at = h[chosen], at[chosen]
        first, last = owned_starts(at, h)
        first, last = np.maximum(first, 0), np.minimum(last, len(part) - SPAN)
        owns = last >= first
        first, last, at, h = first[owns], last[owns], at[owns], h[owns]
        context = Hashes(part, 1).of(first, last + SPAN) ^ (at - first).astype(np.uint64)
        found.append((first + (low - back), last - first + SPAN, at - first, h, context))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    first, size, lead, h, context = (np.concatenate(x) for x in zip(*found))
    # at a border two blocks may have an anchor; the first one has all its strings
    _, keep = np.unique(first + lead, return_index=True)
    return first[keep], size[keep], lead[keep], h[keep], context[keep]


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def _anchor_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        parts = []
        for id_, th, text in zip(batch["id"], batch["th"], batch["text"]):
            *place, h, context = find_anchors(_bytes(text))
            if len(h):
                own = np.full(len(h), id_, np.int64), np.full(len(h), th, np.int64)
                parts.append((*own, *(x.astype(np.int32) for x in place), h.view(np.int64), context.view(np.int64)))
        if parts:
            names = ("id", "th", "first", "size", "lead", "anchor", "ctx")
            yield pd.DataFrame(dict(zip(names, (np.concatenate(x) for x in zip(*parts)))))


def eight_bytes(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a number that sorts like them."""
    padded, key = np.concatenate([text, np.zeros(8, np.uint8)]), np.zeros(len(text), np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | padded[i : i + len(text)]
    return key


def _sorted_by(high: np.ndarray, low: np.ndarray | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(turn, where a new value begins) of rows by two numbers of ``bits`` bits each, or by one of ``64 - bits``.

    Short numbers are sorted in one word with their row, which is faster than sorting rows by reference.
    """
    one = np.uint64(bits)
    if low is None:
        word = high << one
    elif 3 * bits <= 64:
        word = (high.astype(np.uint64) << one | low.astype(np.uint64)) << one
    else:
        joint = high.astype(np.int64) * (1 << bits) + low
        turn = np.argsort(joint)
        joint = joint[turn]
        return turn, np.concatenate([[True], joint[1:] != joint[:-1]])
    word |= np.arange(len(high), dtype=np.uint64)
    word.sort()
    value = word >> one
    return (word & np.uint64((1 << bits) - 1)).astype(np.int64), np.concatenate([[True], value[1:] != value[:-1]])


def refine(key: np.ndarray, depth: int = SPAN, room: np.ndarray | None = None) -> np.ndarray:
    """All positions in the order of their next ``depth`` bytes, by Larsson-Sadakane refinement.

    The first ranks come from the first bytes of ``key``; then only groups that are still tied are sorted again, by the rank of the
    position as far ahead as is known, so that each round doubles the depth. Positions with less ``room`` than a round's depth are
    not sorted further; no other position asks for their rank.
    """
    n = len(key)
    if not n:
        return np.zeros(0, np.int32)
    bits = max(1, (n + 1).bit_length())
    known = (64 - bits) // 8
    order, head = _sorted_by(key >> np.uint64(64 - 8 * known), None, bits)
    order, rank = order.astype(np.int32), np.empty(n, np.int32)
    while known < depth:
        starts = np.flatnonzero(head).astype(np.int32)
        sizes = np.diff(np.append(starts, n))
        group = np.repeat(starts, sizes)
        rank[order] = group
        step = min(known, depth - known)
        tied = np.repeat(sizes > 1, sizes)
        if room is not None:
            tied &= room[order] >= known + step
        tied = np.flatnonzero(tied)
        if not len(tied):
            break
        at = order[tied]
        ahead = at + step
        turn, fresh = _sorted_by(group[tied], np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0), bits)
        order[tied] = at[turn]
        head[tied] = fresh
        known += step
    return order


def leading_zero_bytes(words: np.ndarray) -> np.ndarray:
    """Of words other than zero."""
    count = np.zeros(len(words), np.int64)
    for width in (4, 2, 1):
        none = words >> np.uint64(64 - 8 * width) == 0
        count += none * width
        words = np.where(none, words << np.uint64(8 * width), words)
    return count


def common_prefixes(key: np.ndarray, order: np.ndarray, base: np.ndarray, length: np.ndarray, depth: int = SPAN) -> np.ndarray:
    """Kasai's common prefixes of each suffix in ``order`` with the one before it, ``depth`` at most.

    Going one byte on in the text loses one byte of prefix at most, so each step starts where the last one ended. As the order holds to
    ``depth`` only and has no suffixes near a context's end, that is used where the earlier suffix, also moved on by a byte, still
    stands before. The contexts (first byte ``base``, ``length``) are independent, and one step is done for all at once.
    """
    before, rank = np.full(len(key), -1, np.int32), np.full(len(key) + 1, -1, np.int32)
    before[order[1:]] = order[:-1]
    rank[order] = np.arange(len(order))
    last = np.full(len(base), -1, np.int64)
    found = np.zeros(len(key), np.int16)
    prefix = np.zeros(len(base), np.int64)
    padded = np.concatenate([key, np.zeros(depth, np.uint64)])
    for offset in range(int(length.max()) - depth + 1):
        lanes = np.flatnonzero(length - depth >= offset)
        at = base[lanes] + offset
        other = before[at]
        moved = rank[last[lanes] + 1]
        holds = (other >= 0) & (last[lanes] >= 0) & (moved >= 0) & (moved < rank[at])
        own = np.where(holds, np.maximum(prefix[lanes] - 1, 0), 0)
        going = np.flatnonzero((other >= 0) & (own < depth))
        while len(going):
            # eight bytes at a time; the first that differs shows in the highest bit of the difference
            differ = padded[at[going] + own[going]] ^ padded[other[going] + own[going]]
            same = differ == 0
            ended = going[~same]
            own[ended] += leading_zero_bytes(differ[~same])
            going = going[same]
            own[going] += 8
            going = going[own[going] < depth]
        own = np.minimum(own, depth)
        prefix[lanes], last[lanes] = own, other
        found[at] = own
    return found[order]


def repeated_starts(contexts: list[bytes], places: np.ndarray, firsts: np.ndarray, several_times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mask over the joined contexts of the starts of repeated strings, first byte of each context there).

    ``places`` and ``firsts``: the document, as a number, and the position there of each context; ``several_times``: whether
    the context stands elsewhere as well.
    """
    length = np.array([len(c) for c in contexts])
    base = np.cumsum(length) - length
    key = eight_bytes(np.frombuffer(b"".join(contexts), np.uint8))
    row = np.repeat(np.arange(len(contexts), dtype=np.int32), length)
    offset = np.arange(len(key), dtype=np.int32) - base.astype(np.int32)[row]
    room = length.astype(np.int32)[row] - offset
    order = refine(key, SPAN, room)
    order = order[(room >= SPAN)[order]]
    del room
    tied = common_prefixes(key, order, base, length) >= SPAN
    # only strings with an equal neighbour are looked at further
    klass = np.cumsum(~tied, dtype=np.int32)
    shared = np.flatnonzero(tied | np.append(tied[1:], False))
    mask = np.zeros(len(key), bool)
    mask[order] = several_times[row[order]]
    at, k = order[shared], klass[shared]
    if len(at):
        place = places[row[at]].astype(np.int64) << 40 | (firsts[row[at]] + offset[at])
        starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        # equal strings at one and the same place are one string
        apart = np.minimum.reduceat(place, starts) != np.maximum.reduceat(place, starts)
        apart |= np.logical_or.reduceat(several_times[row[at]], starts)
        mask[at] = np.repeat(apart, np.diff(np.append(starts, len(at))))
    return mask, base


def _runs(offsets: np.ndarray) -> list[int]:
    """Sorted offsets as start, end (exclusive), start, end ..."""
    cuts = np.flatnonzero(np.diff(offsets) > 1)
    return np.column_stack([offsets[np.append(0, cuts + 1)], offsets[np.append(cuts, len(offsets) - 1)] + 1]).ravel().tolist()


def starts_to_sort(contexts: list[bytes], lead: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) start in each context that may have an equal string in another one; none where first > last.

    The strings that start ``STRIDE * q`` to ``STRIDE * (q + 1)`` bytes before the anchor share ``SPAN - STRIDE`` bytes. Equal strings have
    these in common, so starts for which no other context of the anchor has them can't repeat.
    """
    length = np.array([len(c) for c in contexts])
    base = np.cumsum(length) - length
    hashes = Hashes(np.frombuffer(b"".join(contexts), np.uint8), 0)
    first, last = np.full(len(contexts), SPAN), np.full(len(contexts), -1)
    for q in range(-(-REACH // STRIDE)):
        inner = lead - STRIDE * q  # where the shared bytes begin, the last start of these
        low, high = np.maximum(inner - STRIDE, 0), np.minimum(inner, length - SPAN)
        own = np.flatnonzero(low <= high)
        key = hashes.of(base[own] + inner[own], base[own] + inner[own] + SPAN - STRIDE) ^ _mix(anchor[own].view(np.uint64))
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        own = own[times[which] > 1]
        first[own], last[own] = np.minimum(first[own], low[own]), np.maximum(last[own], high[own])
    return first, last


def _sort_shard(shard: pd.DataFrame) -> pd.DataFrame:
    """Rows with ``runs``: the repeated starts of a context. Rows with ``keys``: of an anchor cut over shards, the sorted keys of
    its strings in this shard, cut by binary search at the borders of the merge."""
    shard = shard.sort_values(["anchor", "ctx"], kind="stable").reset_index(drop=True)
    contexts = list(shard["body"])
    places = pd.factorize(pd.MultiIndex.from_arrays([shard["id"], shard["th"]]))[0]
    anchor, ctx, cut = shard["anchor"].to_numpy(np.int64), shard["ctx"].to_numpy(), shard["cut"].to_numpy()
    low, high = starts_to_sort(contexts, shard["lead"].to_numpy(np.int64), anchor)
    chosen = np.flatnonzero(low <= high)
    several = shard["n"].to_numpy() > 1
    out, asked = [], {}
    if len(chosen):
        bodies = [contexts[i][low[i] : high[i] + SPAN] for i in chosen]
        mask, base = repeated_starts(bodies, places[chosen], shard["first"].to_numpy(np.int64)[chosen] + low[chosen], several[chosen])
        for i, at in zip(chosen, base):
            again = np.flatnonzero(mask[at : at + high[i] - low[i] + 1])
            # a context found several times goes as a whole
            if len(again) and not several[i]:
                out.append((anchor[i], ctx[i], _runs(again + low[i]), 0, None, None, None, None))
    for i in range(len(contexts)):
        if cut[i]:
            own = np.arange(len(contexts[i]) - SPAN + 1)
            keys = Hashes(np.frombuffer(contexts[i], np.uint8), 0).of(own, own + SPAN)
            # where the string stands; a context found several times stands elsewhere than any other
            here = shard["th"][i] ^ shard["id"][i] if shard["n"][i] == 1 else ctx[i]
            spots = _mix(np.full(len(own), here, np.int64).view(np.uint64)) + (own + shard["first"][i]).astype(np.uint64)
            asked.setdefault((anchor[i], cut[i]), []).append((keys, np.full(len(own), ctx[i]), own, spots.view(np.int64)))
    for (of, parts), found in asked.items():
        keys, ctxs, starts, spots = (np.concatenate(x) for x in zip(*found))
        turn = np.argsort(keys, kind="stable")
        keys, ctxs, starts, spots = keys[turn], ctxs[turn], starts[turn], spots[turn]
        borders = [(2**64 * b) // int(parts) for b in range(1, int(parts))]
        at = [0, *np.searchsorted(keys, np.array(borders, np.uint64)), len(keys)]
        for b, (low, high) in enumerate(zip(at[:-1], at[1:])):
            if high > low:
                out.append((of, 0, None, b, keys[low:high].view(np.int64), ctxs[low:high], starts[low:high], spots[low:high]))
    return pd.DataFrame(out, columns=["anchor", "ctx", "runs", "part", "keys", "ctxs", "starts", "spots"])


def _merge_shards(part: pd.DataFrame) -> pd.DataFrame:
    """Strings of one shard that another shard has too: each shard's sorted keys are looked up in all by binary search."""
    keys = [np.asarray(k, np.int64).view(np.uint64) for k in part["keys"]]
    pooled, spots = np.concatenate(keys), np.concatenate([np.asarray(x, np.int64) for x in part["spots"]])
    turn = np.lexsort((spots, pooled))
    pooled, spots = pooled[turn], spots[turn]
    # one entry for each place of a string
    pooled = pooled[np.concatenate([[True], (pooled[1:] != pooled[:-1]) | (spots[1:] != spots[:-1])])]
    out = []
    for own, ctxs, starts in zip(keys, part["ctxs"], part["starts"]):
        many = np.searchsorted(pooled, own, "right") - np.searchsorted(pooled, own, "left") > 1
        out.append(pd.DataFrame({"anchor": part["anchor"].iloc[0], "ctx": np.asarray(ctxs)[many], "start": np.asarray(starts)[many]}))
    found = pd.concat(out).sort_values(["ctx", "start"])
    rows = [(a, c, _runs(g["start"].to_numpy(np.int64))) for (a, c), g in found.groupby(["anchor", "ctx"], sort=False)]
    return pd.DataFrame(rows, columns=["anchor", "ctx", "runs"])


def _context_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for id_, th, text, wanted in zip(batch["id"], batch["th"], batch["text"], batch["wanted"]):
            data = text.encode("utf-8", "surrogatepass")
            for w in wanted:
                body = data[w["first"] : w["first"] + w["size"]]
                out.append((id_, th, w["anchor"], w["ctx"], w["n"], w["shard"], w["cut"], w["first"], w["lead"], body))
        yield pd.DataFrame(out, columns=["id", "th", "anchor", "ctx", "n", "shard", "cut", "first", "lead", "body"])


def removed_mask(n: int, whole: np.ndarray, parts) -> np.ndarray:
    """Bytes to drop: ``whole`` contexts (first << 32 | size), and strings from the runs of starts in ``parts`` (first, runs)."""
    edge = np.zeros(n + 1, np.int64)
    first = whole >> 32
    np.add.at(edge, first, 1)
    np.add.at(edge, first + (whole & 0xFFFFFFFF), -1)
    for first, runs in parts:
        for start, end in zip(runs[::2], runs[1::2]):
            edge[first + start] += 1
            edge[first + end - 1 + SPAN] -= 1
    return np.cumsum(edge[:-1]) > 0


def _cut_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for id_, th, text, whole, parts in zip(batch["id"], batch["th"], batch["text"], batch["whole"], batch["parts"]):
            data = _bytes(text)
            parts = [] if parts is None else [(p["first"], p["runs"]) for p in parts]
            mask = removed_mask(len(data), np.array(whole, np.int64), parts)
            spans = int(mask[0] + (mask[1:] & ~mask[:-1]).sum())
            kept = data[~mask].tobytes()
            out.append((id_, th, int(mask.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
        yield pd.DataFrame(out, columns=["id", "th", "n_removed", "n_spans", "kept_sha256", "kept"])


def repeated_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_rows: int = SHARD_ROWS, cut_rows: int = CUT_ROWS) -> DataFrame:
    """For texts with repeated bytes: id, th, n_removed, n_spans, kept_sha256, kept (bytes). Equal rows give one."""
    ship_package(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(id_in(doc_id).alias("id"), text_key(body).alias("th"), body.alias("text"))
    anchors = write_scratch(rows.mapInPandas(_anchor_rows, "id long, th long, first int, size int, lead int, anchor long, ctx long"), "anchors")
    # as a table of its own, both sides of the join are dealt for it, and an anchor that many texts share can be split
    twice = write_scratch(anchors.groupBy("anchor").count().filter("count > 1").select("anchor"), "anchors-twice")
    met = write_scratch(anchors.join(twice, "anchor"), "met-anchors")
    drop_scratch(anchors)
    drop_scratch(twice)
    contexts = met.groupBy("anchor", "ctx").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "th", "first", "size", "lead")).alias("at")
    )
    contexts = write_scratch(contexts, "contexts")
    several = write_scratch(contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "anchors-several")
    total = several.agg(F.sum("m")).first()[0] or 0
    shards = max(1, -(-total // shard_rows))
    salts = F.ceil(F.col("m") / cut_rows)
    salt = F.pmod("ctx", salts)
    parts = F.when(salts > 1, F.ceil(F.col("m") * SPAN / MERGE_KEYS)).otherwise(0)
    to_sort = contexts.join(several, "anchor").select(
        "at.*", "anchor", "ctx", "n", parts.cast("int").alias("cut"),
        F.when(salts > 1, F.xxhash64("anchor", salt)).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards))).alias("shard"),
    )
    wanted = to_sort.groupBy("id", "th").agg(F.collect_list(F.struct("first", "size", "lead", "anchor", "ctx", "n", "shard", "cut")).alias("wanted"))
    # whole contexts by place; the others by the key that their runs come back with
    marked = met.join(contexts.select("anchor", "ctx", "n"), ["anchor", "ctx"])
    places = marked.groupBy("id", "th").agg(
        F.collect_set(F.when(F.col("n") > 1, F.shiftleft(F.col("first").cast("long"), 32) + F.col("size"))).alias("whole"),
        F.collect_set(F.when(F.col("n") == 1, F.struct("first", "anchor", "ctx"))).alias("single"),
    )
    # equal rows are one from here on
    found = places.join(wanted, ["id", "th"], "left").join(rows, ["id", "th"]).dropDuplicates(["id", "th"])
    found = write_scratch(found, "repeating-texts")

    bodies = found.filter("wanted IS NOT NULL").select("id", "th", "text", "wanted").mapInPandas(
        _context_rows, "id long, th long, anchor long, ctx long, n long, shard long, cut int, first long, lead int, body binary"
    )
    ordered = bodies.groupBy("shard").applyInPandas(
        _sort_shard, "anchor long, ctx long, runs array<int>, part int, keys array<long>, ctxs array<long>, starts array<int>, spots array<long>"
    )
    ordered = write_scratch(ordered, "sorted-shards")
    across = ordered.filter("keys IS NOT NULL").groupBy("anchor", "part").applyInPandas(_merge_shards, "anchor long, ctx long, runs array<int>")
    drop_scratch(met)
    runs = ordered.filter("runs IS NOT NULL").select("anchor", "ctx", "runs").unionByName(across)
    parts = (
        found.select("id", "th", F.explode("single").alias("s"))
        .select("id", "th", "s.first", "s.anchor", "s.ctx")
        .join(runs, ["anchor", "ctx"])
        .groupBy("id", "th")
        .agg(F.collect_list(F.struct("first", "runs")).alias("parts"))
    )
    return found.select("id", "th", "text", "whole").join(parts, ["id", "th"], "left").mapInPandas(
        _cut_rows, "id long, th long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        id_in(doc_id).alias("id"),
        text_key(body).alias("th"),
        F.octet_length(body).cast("long").alias("n_bytes"),
        F.sha2(body, 256).alias("own_sha256"),
    )
    cut = write_scratch(repeated_bytes(docs, doc_id, text, **sizes).drop("kept"), "cut-texts")
    return rows.join(cut, ["id", "th"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "own_sha256").alias("kept_sha256"),
    )


def op4_query(spark, sf_dir: str) -> DataFrame:
    from doseledger.llm.common import table

    return drop_repeats(table(spark, sf_dir, "documents"))
