"""Conversation repair against enumeration of all edits and a plain version on odd conversations."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from doseledger.llm import conversation_repair as cr

rng = random.Random(13)
GOOD = re.compile(r"(s?(ua)+)?")
COLUMNS = "conv_id long, turn long, role string, text string, seq long, conv string, fault int, audit string"


def all_edits(messages):
    """The least (cost, audit) of every way to edit a few messages, up to two inserts in each gap."""
    best = None
    edits = [[(0, "K", m[0]), (2, "R", "u"), (2, "R", "a"), (3, "D", "")] if m[1] in (0, 3) else [(3, "D", "")] for m in messages]
    gaps = [(0, "", ""), (2, "I", "u"), (2, "I", "a"), (4, "II", "ua"), (4, "II", "au")]
    for chosen in itertools.product(*edits):
        cost = sum(c[0] + (m[1] == 3 and c[1] != "D") for c, m in zip(chosen, messages))
        if best and cost > best[0]:
            continue
        for new in itertools.product(gaps, repeat=len(messages) + 1):
            total = cost + sum(g[0] for g in new)
            if best and total > best[0]:
                continue
            if GOOD.fullmatch(new[0][2] + "".join(c[2] + g[2] for c, g in zip(chosen, new[1:]))):
                found = (total, new[0][1] + "".join(c[1] + g[1] for c, g in zip(chosen, new[1:])))
                best = min(best or found, found)
    return best


def plain_edits(messages):
    """The same for any length, message by message, with the strings kept."""
    def insert(labels):
        for _ in range(2):
            for s, (_, to) in cr.GIVEN.items():
                if s in labels:
                    found = (labels[s][0] + 2, labels[s][1] + "I")
                    labels[to] = min(labels.get(to, found), found)
        return labels

    labels = insert({0: (0, "")})
    for initial, fault in messages:
        new = {}
        for s, (cost, audit) in labels.items():
            options = [(s, 3, "D")]
            if fault in (0, 3):
                options.append((cr.GIVEN[s][1], 2 + (fault == 3), "R"))
                if initial in cr.KEEPS[s]:
                    options.append((cr.KEEPS[s][initial], int(fault == 3), "K"))
            for to, c, e in options:
                found = (cost + c, audit + e)
                new[to] = min(new.get(to, found), found)
        labels = insert(new)
    return min(labels[s] for s in (0, 3) if s in labels)


def random_messages(n):
    return [(rng.choice("uuaasx "), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]


def test_edits_equal_enumeration():
    for n in (0, 1, 2, 3):
        for _ in range(40):
            messages = random_messages(n)
            assert cr.cheapest_edits(messages) == all_edits(messages), messages
    for _ in range(300):
        messages = random_messages(rng.randint(4, 40))
        assert cr.cheapest_edits(messages) == plain_edits(messages), messages


@pytest.mark.parametrize("size", [1, 2, 5])
def test_blocks_fold_to_the_whole(monkeypatch, size):
    monkeypatch.setattr(cr, "BLOCK", size)
    for _ in range(60):
        messages = random_messages(rng.randint(1, 24))
        blocks = (cr.block_edits(messages[i : i + size], i // size) for i in range(0, len(messages), size))
        assert cr.fold(blocks) == plain_edits(messages)


def plain(rows):
    """Every row of the report."""
    kept = defaultdict(list)
    for conv, turn, role, text in rows:
        kept[conv]
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        role = "user" if kind == 4 else role
        kept[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, own in kept.items():
        own.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1], m[2]))
        seen, messages = set(), []
        for _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = 1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0
            seen.add((role, text))
            messages.append((role[:1], fault))
        turns = {m[0] for m in own if m[0] is not None}
        cost, audit = plain_edits(messages)
        lines, rest, initials = [], iter(own), ""
        for edit in audit:
            state = {"": 0, "s": 1, "u": 2, "a": 3}[initials[-1:]]
            role, text = cr.GIVEN[state][0], ""
            if edit != "I":
                _, old, text = next(rest)
                role = old if edit == "K" else role
            if edit != "D":
                lines.append(f"{role}:{text}")
                initials += role[0]
        assert GOOD.fullmatch(initials)
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(messages, messages[1:]))
        faults = [sum(m[1] == k for m in messages) for k in (1, 2, 3)]
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def said():
    return rng.choice(["Hello there.", "How so?", "well", "Ünder the oak!", "", " \n", "No.\t", "yes... no", "x" * 50 + "."])


ROWS = [(c, t, rng.choice(["user", "assistant", "system", "tool"]) if rng.random() < 0.3 else ["user", "assistant"][t % 2], said())
        for c in range(60) for t in range(rng.randint(1, 9))]
ROWS += [(60, None, "user", "Hi."), (60, None, None, "Hi."), (60, 4, "assistant", None), (60, 4, "", "No role."), (60, 9, "user", "End?")]
ROWS += [(None, t, "user", f"turn {t}.") for t in (3, 1, 7)] + [(None, None, None, None)]
ROWS += [(61, 5, "user", "same."), (61, 5, "user", "same."), (61, 5, "assistant", "other."), (61, -3, "assistant", "early.")]
ROWS += [(62, t, rng.choice(["user", "assistant"]), said()) for t in range(700)]  # several blocks
ROWS += [(63, 0, "user", "long " * 100_000 + "."), (63, 1, "assistant", "ok.")]
ROWS += [(c, 0, "system", "s.") for c in range(100, 160)]  # some are dropped whole


def report(spark, rows):
    df = spark.createDataFrame([(*r, 1, "c", 2, "a") for r in rows], COLUMNS).repartition(3)
    out = cr.op13_report(df)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_report_equals_plain(spark):
    got, want = report(spark, ROWS), plain(ROWS)
    assert [r for r in got if r not in want] == [] and got == want
    nothing = hashlib.sha256(b"").hexdigest()
    assert any(r[-1] == nothing and r[-2] == "" for r in got)


def test_empty_table(spark):
    assert report(spark, []) == []


def test_repaired_messages_alternate(spark):
    df = spark.createDataFrame([(r[0], r[1], r[2], r[3]) for r in ROWS], "conv_id long, turn long, role string, text string")
    plan, repaired = cr.repair(df)
    rows = defaultdict(list)
    for r in repaired.collect():
        rows[r["conv"]].append((r["place"], r["role"], r["edit"]))
    for conv, own in rows.items():
        own.sort()
        assert [o[0] for o in own] == list(range(1, len(own) + 1))
        assert GOOD.fullmatch("".join(o[1][0] for o in own))
    audits = {r["conv"]: r["audit"].replace("D", "") for r in plan.collect()}
    assert {c: "".join(o[2] for o in own) for c, own in rows.items()} == {c: a for c, a in audits.items() if a}
