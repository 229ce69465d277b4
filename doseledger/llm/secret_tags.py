"""Secret scan: base patterns and a linear-chain conditional random field.

Texts are cut into tokens; the field tags each as the begin of a secret, inside one, or outside. Features are the token's shape (length, letters,
digits, signs, key words), the shapes of its neighbours, and what kind of text the file is. It is trained on windows of a
bounded sample of texts, labelled by the base patterns, by gradient steps on the exact likelihood.

Decoding is exact Viterbi. A token is certainly outside if changing it to outside would raise the score of any labelling; such
tokens cut a text into short pieces, and only the pieces between them are decoded, many at once. Whole texts are read, in blocks of many.

Defined cases: a null text is an empty one; without a base match in the sample there is no model and only base spans; equal rows give
equal results; spans of the field that touch a base span give way; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doseledger.llm.common import id_in, id_out, ship_package, spread_sample

#: fixed values: base patterns, their least lengths, and the order of kinds
ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
KEY_WORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
KINDS = ("assign", "access", "hex", "crf")
LEAST = {"assign": 8, "access": 16, "hex": 32}

OUT, BEGIN, IN = 0, 1, 2
LENGTHS = np.array([2, 4, 8, 12, 16, 24, 32, 40])
SHAPES = 9 * 4 * 3 * 2 * 2
OTHER = {"edge": SHAPES, "quote": SHAPES + 1, "colon": SHAPES + 2, "sign": SHAPES + 3, "foreign": SHAPES + 4, "key": SHAPES + 5, "key_set": SHAPES + 6, "akia": SHAPES + 7}
N_SHAPES, N_FILES = SHAPES + 8, 4
BLOCK = 2 << 20

_KIND = np.full(256, 2, np.uint8)  # 0 blank, 1 word, 2 sign
_KIND[list(b" \t\n\x0b\x0c\r")] = 0
_KIND[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = 1
_KIND[128:] = 1


def _member(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(chars)] = 1
    return out


_DIGIT, _UPPER = _member(b"0123456789"), _member(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_HEXED, _SIGNS = _member(b"0123456789abcdef"), _member(b"+/_.=-")
_FOREIGN = np.concatenate([np.zeros(128, np.uint8), np.ones(128, np.uint8)])


def _found(data: bytes, word: bytes) -> list[int]:
    out, at = [], data.find(word)
    while at >= 0:
        out.append(at)
        at = data.find(word, at + 1)
    return out


def tokenize(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(starts, ends, shapes, key word positions) of the runs of word bytes and of signs."""
    raw = np.frombuffer(data, np.uint8)
    kind = _KIND[raw]
    edge = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]])) if len(raw) else np.zeros(0, np.int64)
    ends = np.append(edge[1:], len(raw)) if len(raw) else edge
    solid = kind[edge] > 0
    starts, ends = edge[solid], ends[solid]
    size = ends - starts

    def count(member):
        sums = np.concatenate([[0], np.cumsum(member[raw], dtype=np.int32)])
        return sums[ends] - sums[starts]

    digits, upper, hexed = count(_DIGIT), count(_UPPER), count(_HEXED)
    signs, foreign = count(_SIGNS), count(_FOREIGN)
    digit_part = np.where(digits == 0, 0, np.where(digits == size, 3, np.where(digits * 3 <= size, 1, 2)))
    upper_part = np.where(upper == 0, 0, np.where(upper == size - digits - signs, 2, 1))
    shape = (((np.searchsorted(LENGTHS, size, "right") * 4 + digit_part) * 3 + upper_part) * 2 + (signs > 0)) * 2 + (hexed == size)
    shape[foreign > 0] = OTHER["foreign"]
    sign = kind[starts] == 2
    first = raw[starts]
    shape[sign] = OTHER["sign"]
    shape[sign & ((first == 34) | (first == 39))] = OTHER["quote"]
    shape[sign & (first == 58)] = OTHER["colon"]
    low = data.lower()
    keys = sorted(at for word in KEY_WORDS for at in _found(low, word))
    if keys:
        at = np.searchsorted(starts, keys, "right") - 1
        shape[at] = np.where(raw[ends[at] - 1] == 61, OTHER["key_set"], OTHER["key"])
    akia = _found(data, b"AKIA")
    if akia:
        shape[np.searchsorted(starts, akia, "right") - 1] = OTHER["akia"]
    return starts, ends, shape, keys


def base_spans(data: bytes, starts: np.ndarray, ends: np.ndarray, keys: list[int]) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, start of the secret itself), in bytes; leftmost, not overlapping within a kind."""
    out, last = [], 0
    for at in keys:
        if at >= last and (m := ASSIGN.match(data, at)):
            last = m.end()
            if len(m[1]) >= LEAST["assign"]:
                out.append((m.start(), m.end(), "assign", m.start(1)))
    # runs of these characters never leave a token
    last = 0
    for at in _found(data, b"AKIA"):
        if at >= last and (m := ACCESS.match(data, at)):
            last = m.end()
            if m.end() - m.start() >= LEAST["access"]:
                out.append((m.start(), m.end(), "access", m.start()))
    for i in np.flatnonzero(ends - starts >= LEAST["hex"]):
        for m in HEX.finditer(data, int(starts[i]), int(ends[i])):
            if m.end() - m.start() >= LEAST["hex"]:
                out.append((m.start(), m.end(), "hex", m.start()))
    return out


class Features:
    """Per token: shapes of itself and its neighbours, the class of its file, and its file's number."""

    def __init__(self, starts: np.ndarray, shape: np.ndarray, borders: np.ndarray):
        self.file = np.searchsorted(borders, starts, "right") - 1
        same = self.file[1:] == self.file[:-1]
        self.shape = shape
        self.before = np.concatenate([[OTHER["edge"]], np.where(same, shape[:-1], OTHER["edge"])]) if len(shape) else shape
        self.after = np.concatenate([np.where(same, shape[1:], OTHER["edge"]), [OTHER["edge"]]]) if len(shape) else shape
        n = len(borders)
        tokens = np.maximum(np.bincount(self.file, minlength=n), 1)
        digits = np.bincount(self.file, (shape < SHAPES) & (shape // 12 % 4 > 0), n)
        keys = np.bincount(self.file, (shape == OTHER["key"]) | (shape == OTHER["key_set"]), n)
        self.kind = ((digits * 20 > tokens).astype(np.int64) * 2 + (keys > 0))[self.file]

    def scores(self, w: dict[str, np.ndarray]) -> np.ndarray:
        return w["own"][self.shape] + w["before"][self.before] + w["after"][self.after] + w["file"][self.kind]


def _empty_weights() -> dict[str, np.ndarray]:
    return {k: np.zeros((n, 3)) for k, n in (("own", N_SHAPES), ("before", N_SHAPES), ("after", N_SHAPES), ("file", N_FILES))} | {"move": np.zeros((3, 3)), "start": np.zeros(3)}


def _allowed(w):
    move, start = w["move"].copy(), w["start"].copy()
    move[OUT, IN] = start[IN] = -1e9
    return move, start


def fit(windows: list[tuple[np.ndarray, ...]], rounds: int = 150, rate: float = 0.1, decay: float = 1e-3) -> dict[str, np.ndarray]:
    """Weights by gradient steps with adapted rates; windows: (own, before, after, file, labels) of equal width, labels -1 past the end."""
    own, before, after, file, label = (np.stack(x) for x in zip(*windows))
    real = label >= 0
    n, length = label.shape
    w = _empty_weights()
    slots = {"own": own, "before": before, "after": after, "file": file}
    truth = np.eye(3)[np.maximum(label, 0)] * real[..., None]
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, rounds + 1):
        move, start = _allowed(w)
        score = sum(w[k][slots[k]] for k in slots)
        score = np.exp(score - score.max(axis=2, keepdims=True))
        score[~real] = 1.0
        hop = np.exp(move)
        alpha, scale = np.zeros((length, n, 3)), np.ones((length, n))
        for t in range(length):
            a = (np.exp(start) if t == 0 else alpha[t - 1] @ hop) * score[:, t]
            a = np.where(real[:, t, None], a, alpha[t - 1] if t else 1.0)
            scale[t] = np.where(real[:, t], a.sum(axis=1), 1.0)
            alpha[t] = a / scale[t][:, None]
        beta, grad = np.ones((n, 3)), {k: np.zeros_like(v) for k, v in w.items()}
        for t in range(length - 1, -1, -1):
            gamma = alpha[t] * beta
            gamma = gamma / gamma.sum(axis=1, keepdims=True)
            delta = (truth[:, t] - gamma) * real[:, t, None]
            for k, at in slots.items():
                np.add.at(grad[k], at[:, t], delta)
            if t == 0:
                grad["start"] += delta.sum(axis=0)
                break
            ahead = score[:, t] * beta / scale[t][:, None]
            pair = alpha[t - 1][:, :, None] * hop[None] * ahead[:, None, :]
            pair = pair / pair.sum(axis=(1, 2), keepdims=True)
            live = (real[:, t] & real[:, t - 1])[:, None, None]
            grad["move"] += ((truth[:, t - 1][:, :, None] * truth[:, t][:, None, :] - pair) * live).sum(axis=0)
            beta = np.where(real[:, t, None], ahead @ hop.T, beta)
        for k in w:
            g = grad[k] / n - decay * w[k]
            first[k], second[k] = 0.9 * first[k] + 0.1 * g, 0.999 * second[k] + 0.001 * g * g
            w[k] += rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return w


def viterbi(scores: np.ndarray, move: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Best labels of many pieces of one length, (n, length, 3) scores; ``start`` and ``end`` stand for the neighbours."""
    n, length, _ = scores.shape
    back = np.zeros((length, n, 3), np.uint8)
    best = scores[:, 0] + start
    for t in range(1, length):
        reach = best[:, :, None] + move[None]
        back[t] = reach.argmax(axis=1)
        best = reach.max(axis=1) + scores[:, t]
    labels = np.zeros((n, length), np.uint8)
    labels[:, -1] = (best + end).argmax(axis=1)
    for t in range(length - 1, 0, -1):
        labels[:, t - 1] = back[t][np.arange(n), labels[:, t]]
    return labels


def decode(feats: Features, w: dict[str, np.ndarray]) -> np.ndarray:
    """The best label of every token, each file on its own."""
    scores, n = feats.scores(w), len(feats.shape)
    labels = np.zeros(n, np.uint8)
    if not n:
        return labels
    move, start = _allowed(w)
    new_file = np.concatenate([[True], feats.file[1:] != feats.file[:-1]])
    last = np.append(new_file[1:], True)
    # what outside gains at least over the best other label, whatever stands around; the largest losses of moves are taken off
    into = max(move[y, z] - move[y, OUT] for y in range(3) for z in (BEGIN, IN) if move[y, z] > -1e8)
    into = max(into, start[BEGIN] - start[OUT])
    onward = max(move[z, y] - move[OUT, y] for z in (BEGIN, IN) for y in (OUT, BEGIN))
    inside = max(move[z, IN] for z in (BEGIN, IN)) - move[OUT, BEGIN] + max(0.0, max(move[IN, y] - move[BEGIN, y] for y in range(3)))
    change = np.append((scores[1:, IN] - scores[1:, BEGIN]), 0.0) + inside
    loss = np.maximum(np.where(last, 0.0, np.maximum(onward, change)), 0.0)
    certain = scores[:, OUT] - np.maximum(scores[:, BEGIN], scores[:, IN]) - into - loss > 0
    open_ = np.flatnonzero(~certain)
    if not len(open_):
        return labels
    cut = np.flatnonzero((np.diff(open_) > 1) | new_file[open_[1:]]) + 1
    firsts, lasts = open_[np.append(0, cut)], open_[np.append(cut, len(open_)) - 1]
    lengths = lasts - firsts + 1
    begins = np.where(new_file[firsts][:, None], start, move[OUT])
    ends = np.where(last[lasts][:, None], 0.0, move[:, OUT])
    for length in np.unique(lengths):
        own = np.flatnonzero(lengths == length)
        at = firsts[own][:, None] + np.arange(length)
        labels[at] = viterbi(scores[at], move, begins[own], ends[own])
    return labels


def _blocks(texts) -> Iterator[tuple[list[int], bytes, np.ndarray]]:
    """Texts in blocks: their numbers, their bytes with a line feed between them, and where each begins."""
    numbers, parts, size = [], [], 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        numbers.append(i)
        parts.append(data)
        size += len(data) + 1
        if size >= BLOCK:
            yield numbers, b"\n".join(parts), np.cumsum([0] + [len(p) + 1 for p in parts])[:-1]
            numbers, parts, size = [], [], 0
    if numbers:
        yield numbers, b"\n".join(parts), np.cumsum([0] + [len(p) + 1 for p in parts])[:-1]


def training_windows(texts, width: int = 48, each: int = 3) -> list[tuple[np.ndarray, ...]]:
    """Windows around base spans, and some from the start and middle of every text."""
    out = []
    for _, data, borders in _blocks(texts):
        starts, ends, shape, keys = tokenize(data)
        feats = Features(starts, shape, borders)
        labels = np.zeros(len(starts), np.int64)
        centres = []
        for begin, end, _, secret in base_spans(data, starts, ends, keys):
            at = np.flatnonzero((ends > secret) & (starts < end))
            labels[at] = IN
            labels[at[0]] = BEGIN
            centres.append(int(at[0]))
        bounds = np.searchsorted(feats.file, np.arange(len(borders) + 1))
        for f in range(len(borders)):
            low, high = bounds[f], bounds[f + 1]
            own = [c for c in centres if low <= c < high][:each] + [low, (low + high) // 2]
            for c in own:
                first = max(low, min(c - width // 2, high - width))
                part = slice(first, min(first + width, high))
                short = width - (part.stop - part.start)
                if short < width:
                    pad = lambda x, v: np.concatenate([x[part], np.full(short, v, np.int64)])  # noqa: B023, E731
                    out.append((pad(shape, 0), pad(feats.before, 0), pad(feats.after, 0), pad(feats.kind, 0), pad(labels, -1)))
    return out


def train(docs: DataFrame, text: str = "text", sample_texts: int = 300, most_chars: int = 100_000) -> dict[str, np.ndarray] | None:
    """Weights from about ``sample_texts`` texts with a key word or the like and as many of all, picked by hash.

    Texts over ``most_chars`` are left out of the sample only.
    """
    body = docs.select(F.col(text).alias("text"), F.monotonically_increasing_id().alias("n")).filter(F.length("text").between(1, most_chars))
    marks = [F.contains(F.col("text"), F.lit(m)) for m in ("AKIA", "assw", "ASSW", "ecret", "ECRET", "oken", "OKEN", "key", "KEY")]
    marked = marks[0]
    for m in marks[1:]:
        marked = marked | m
    parts = [spread_sample(part, sample_texts, "text", "n").select("text").limit(2 * sample_texts) for part in (body.filter(marked), body)]
    texts = [r["text"] for part in parts for r in part.collect()]
    windows = training_windows(texts)
    if not any((w[4] == BEGIN).any() for w in windows):
        return None
    return fit(windows)


def _digest(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def scan_texts(texts, weights) -> list[list[tuple[int, int, str]]]:
    """(start, end, kind) in code points for each text."""
    out: list[list[tuple[int, int, str]]] = []
    for numbers, data, borders in _blocks(texts):
        starts, ends, shape, keys = tokenize(data)
        spans = [(s, e, k) for s, e, k, _ in base_spans(data, starts, ends, keys)]
        if weights is not None:
            labels = decode(Features(starts, shape, borders), weights)
            begins = np.flatnonzero(labels == BEGIN)
            if len(begins):
                stops = np.append(np.flatnonzero(labels != IN), len(labels))
                lasts = stops[np.searchsorted(stops, begins, "right")] - 1
                base = sorted((s, e) for s, e, _ in spans)
                base_starts = np.array([s for s, _ in base], np.int64)
                highest = np.maximum.accumulate(np.array([e for _, e in base], np.int64)) if base else base_starts
                for a, b in zip(starts[begins], ends[lasts]):
                    i = np.searchsorted(base_starts, b) - 1
                    if i < 0 or highest[i] <= a:
                        spans.append((int(a), int(b), "crf"))
        own: list[list[tuple[int, int, str]]] = [[] for _ in numbers]
        at = np.searchsorted(borders, [s for s, _, _ in spans], "right") - 1
        for f, (s, e, k) in zip(at, spans):
            own[f].append((s - int(borders[f]), e - int(borders[f]), k))
        raw = np.frombuffer(data, np.uint8)
        for f, found in enumerate(own):
            if found:
                stop = int(borders[f + 1]) if f + 1 < len(borders) else len(raw)
                points = np.concatenate([[0], np.cumsum((raw[int(borders[f]) : stop] & 0xC0) != 0x80)])
                found = [(int(points[s]), int(points[e]), k) for s, e, k in found]
            out.append(found)
    return out


def _scan(weights) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for spans in scan_texts(batch["text"], weights):
                base = [x for x in spans if x[2] != "crf"]
                n = [sum(k == kind for _, _, k in base) for kind in KINDS[:3]]
                rows.append((*n, hashlib.sha256(_digest(base).encode()).hexdigest(), _digest(spans)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return run


def tag_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_texts: int = 300) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    ship_package(docs.sparkSession)
    weights = train(docs, text, sample_texts)
    rows = docs.select(id_in(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = rows.mapInPandas(_scan(weights), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return out.withColumn("doc_id", id_out("doc_id"))


def op3_query(spark, sf_dir: str) -> DataFrame:
    from doseledger.llm.common import table

    return tag_secrets(table(spark, sf_dir, "documents"))
