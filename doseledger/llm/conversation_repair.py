"""Repair of conversation structure: the cheapest edits that make turns alternate, found by bidirectional Dijkstra.

Edits form a lattice of nodes (messages dealt with, state): the state says which role may come next in an optional system message and
pairs of user and assistant. Keep, Rerole and Delete move to the next message, Insert only changes the state. A forward heap starts at the
first message, a reverse heap behind the last; each settles nodes with their cost and their least string of edits. The heaps meet where a
settled node has an edge to a node that the other side settled. The search ends only when no crossing of the best cost can
be left, and of all crossings of that cost the least concatenated string wins.

A string of edits fixes the states it passes, so of two equally cheap strings to one node neither is the beginning of the other. So least
strings can be extended at their end (forward) and at their front (reverse), and parts put together.

Long conversations: messages are numbered by a range sort, so one conversation may spread over all tasks, and cut into blocks.
A block's cheapest edits from each state to each other are found on their own; folding these few rows in order gives the whole. Only the
written-out conversation passes one task, as a stream that is never held. Message texts are shuffled twice, other steps move flags.

Defined cases: a null role or text is one space; messages go by turn, nulls first, then role, then the text's first characters,
then a hash; a null conversation id is one conversation; conversations without messages have no edits; equal rows are copies; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doseledger.functions.ordering import null_safe, number_rows
from doseledger.llm.common import CRC_TABLE_SQL, crc_sql, ship_package, strip_blanks, table
from doseledger.session import write_scratch

#: first fault of a message
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: states: nothing yet; after the system message; after a user's; after an assistant's
START, OPENED, ASKED, ANSWERED = range(4)
ENDS = (START, ANSWERED)
KEEPS = {START: {"s": OPENED, "u": ASKED}, OPENED: {"u": ASKED}, ASKED: {"a": ANSWERED}, ANSWERED: {"u": ASKED}}
#: the role that a new or changed message gets, and the state behind it
GIVEN = {START: ("user", ASKED), OPENED: ("user", ASKED), ASKED: ("assistant", ANSWERED), ANSWERED: ("user", ASKED)}
BEFORE = {to: [s for s in GIVEN if GIVEN[s][1] == to] for to in range(4)}
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 2, 3, 2, 1
BLOCK = 256

Message = tuple[str, int]  # role initial, fault


def _steps(message: Message, state: int) -> list[tuple[int, str, int]]:
    """(cost, edit, state behind) of every edit of a message."""
    initial, fault = message
    out = [(DELETE, "D", state)]
    if fault not in (BLANK, DUPLICATE):
        more = LEFT_TRUNCATED if fault == TRUNCATED else 0
        if initial in KEEPS[state]:
            out.append((more, "K", KEEPS[state][initial]))
        out.append((REROLE + more, "R", GIVEN[state][1]))
    return out


def _steps_back(message: Message, state: int) -> list[tuple[int, str, int]]:
    """(cost, edit, state before) of every edit of a message that leads to a state."""
    return [(cost, edit, s) for s in range(4) for cost, edit, to in _steps(message, s) if to == state]


def cheapest_edits(messages: list[Message], start: int = START, ends=ENDS) -> tuple[int, str] | None:
    """(cost, edits) from a state before the messages to one of ``ends`` behind them: the least string of the cheapest."""
    n = len(messages)
    ahead = [(0, 0, "", start)]  # cost, messages dealt with, edits so far, state
    # without cost an edit goes back one message, so of equal costs those with more messages dealt with settle first
    back = [(0, -n, "", s) for s in ends]
    seen_ahead: dict[tuple[int, int], tuple[int, str]] = {}
    seen_back: dict[tuple[int, int], tuple[int, str]] = {}
    best: tuple[int, str] | None = None

    def meet(found: tuple[int, str] | None) -> tuple[int, str] | None:
        return found if best is None or found < best else best

    while ahead and back and (best is None or ahead[0][0] + back[0][0] <= best[0]):
        if ahead[0][0] <= back[0][0]:
            cost, i, edits, state = heapq.heappop(ahead)
            if (i, state) in seen_ahead:
                continue
            seen_ahead[i, state] = (cost, edits)
            if i == n and state in ends:
                best = meet((cost, edits))
            steps = [(INSERT, "I", i, GIVEN[state][1])]
            if i < n:
                steps += [(c, e, i + 1, to) for c, e, to in _steps(messages[i], state)]
            for c, e, j, to in steps:
                if (j, to) in seen_back:
                    rest = seen_back[j, to]
                    best = meet((cost + c + rest[0], edits + e + rest[1]))
                if (j, to) not in seen_ahead:
                    heapq.heappush(ahead, (cost + c, j, edits + e, to))
        else:
            cost, i, edits, state = heapq.heappop(back)
            i = -i
            if (i, state) in seen_back:
                continue
            seen_back[i, state] = (cost, edits)
            if (i, state) == (0, start):
                best = meet((cost, edits))
            steps = [(INSERT, "I", i, s) for s in BEFORE[state]]
            if i > 0:
                steps += [(c, e, i - 1, s) for c, e, s in _steps_back(messages[i - 1], state)]
            for c, e, j, s in steps:
                if (j, s) in seen_ahead:
                    first = seen_ahead[j, s]
                    best = meet((first[0] + c + cost, first[1] + e + edits))
                if (j, s) not in seen_back:
                    heapq.heappush(back, (cost + c, -j, e + edits, s))
    return best


def block_edits(messages: list[Message], block: int) -> list:
    """[start, end, cost, edits] of a block from each state to each other; end is null when the block is all there is."""
    if block == 0 and len(messages) < BLOCK:
        return [[START, None, *cheapest_edits(messages)]]
    out = []
    for start in [START] if block == 0 else range(4):
        for end in range(4):
            found = cheapest_edits(messages, start, (end,))
            if found:
                out.append([start, end, *found])
    return out


def fold(blocks: Iterator[list]) -> tuple[int, str]:
    """The cheapest edits of a conversation from those of its blocks, in order."""
    labels: dict[int | None, tuple[int, str]] = {START: (0, "")}
    for cells in blocks:
        new: dict[int | None, tuple[int, str]] = {}
        for start, end, cost, edits in cells:
            if start in labels:
                label = (labels[start][0] + cost, labels[start][1] + edits)
                new[end] = min(new.get(end, label), label)
        labels = new
    return min(labels[s] for s in (None, *ENDS) if s in labels)


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Consecutive rows with equal keys, as a stream that crosses batches."""
    rows = (row for batch in batches for row in batch.itertuples(index=False))
    row = next(rows, None)

    def members(key):
        nonlocal row
        while row is not None and tuple(getattr(row, k) for k in keys) == key:
            own, row = row, None
            yield own
            row = next(rows, None)

    while row is not None:
        key = tuple(getattr(row, k) for k in keys)
        own = members(key)
        yield key, own
        for _ in own:  # what the caller left unread
            pass


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in _chunked(_block_rows(batches)):
        yield pd.DataFrame(batch, columns=["conv", "block", "first", "last", "illegal", "cells"])


def _block_rows(batches):
    for (conv, block), rows in _groups(batches, ["conv", "block"]):
        messages = [(r.initial, r.fault) for r in rows]
        initials = [m[0] for m in messages]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        yield conv, block, initials[0], initials[-1], illegal, json.dumps(block_edits(messages, block))


def _folded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in _chunked(_folded_rows(batches)):
        yield pd.DataFrame(batch, columns=["conv", "illegal", "cost", "audit"])


def _folded_rows(batches):
    for (conv,), rows in _groups(batches, ["conv"]):
        illegal, last = 0, None

        def cells():
            nonlocal illegal, last
            for r in rows:
                illegal += r.illegal + (last is not None and last + r.first not in ("su", "ua", "au"))
                last = r.last
                yield json.loads(r.cells)

        cost, audit = fold(cells())
        yield conv, illegal, cost, audit


def _edited(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in _chunked(_edited_rows(batches), 1024):
        yield pd.DataFrame(batch, columns=["conv", "place", "edit", "role", "text"])


def _edited_rows(batches):
    for (conv,), rows in _groups(batches, ["conv"]):
        audit, at, place, state = next(rows).audit, 0, 0, START

        def inserted():
            nonlocal at, place, state
            while audit[at : at + 1] == "I":
                role, state = GIVEN[state]
                at, place = at + 1, place + 1
                yield conv, place, "I", role, ""

        for r in rows:
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "D":
                continue
            role = r.role
            if edit == "R":
                role, state = GIVEN[state]
            else:
                state = KEEPS[state][role[:1]]
            place += 1
            yield conv, place, edit, role, r.text
        yield from inserted()


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in _chunked(_digest_rows(batches)):
        yield pd.DataFrame(batch, columns=["conv", "sha"])


def _digest_rows(batches):
    for (conv,), rows in _groups(batches, ["conv"]):
        out = hashlib.sha256()
        for r in rows:
            out.update(f"{'' if r.place == 1 else chr(10)}{r.role}:{r.text}".encode("utf-8", "surrogatepass"))
        yield conv, out.hexdigest()


def _chunked(rows, size: int = 4096):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def numbered(messages: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> tuple[DataFrame, DataFrame]:
    """(messages, flags): conv, role, text and seq (1, 2, 3, ... in a conversation); conv, turn, seq, fault and the role's initial.

    Messages are written once, by the sort that numbers them.
    """
    rows = messages.select(
        F.col(conv_id).cast("string").alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    ).withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(1), "role", "text")})
    # the range partitioner collects some keys, so they are kept short
    order = [F.asc_nulls_first("turn"), F.substring("role", 1, 64), F.substring("text", 1, 64), F.col("h1"), F.col("h2")]
    rows = number_rows(rows, order, ["conv"], "seq")
    bare = strip_blanks(F.col("text"))
    short = rows.select(
        "conv", "turn", "seq", "h1", "h2", F.substring("role", 1, 1).alias("initial"),
        (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    # the first of equal messages, where there are several; a table of its own, so that a frequent one can be split
    first = short.groupBy("conv", "h1", "h2").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    first = write_scratch(first, "repeated")
    fault = (
        F.when(F.col("blank"), BLANK).when(F.col("seq") > F.col("first"), DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(SOUND)
    )
    joined = short.join(first, null_safe(short, first, ["conv", "h1", "h2"]), "left")
    flags = joined.select(short["conv"], "turn", "seq", fault.alias("fault"), "initial")
    return rows.select("conv", "role", "text", "seq"), write_scratch(flags, "message-flags")


def plan_edits(flags: DataFrame) -> DataFrame:
    """Per conversation of flagged messages: conv, gaps, faults by kind, illegal pairs, cost and audit, the edits' initials."""
    per_turn = flags.groupBy("conv", "turn").agg(
        *[F.count_if(F.col("fault") == code).alias(name) for name, code in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))]
    )
    span = F.max("turn").cast("decimal(38,0)") - F.min("turn").cast("decimal(38,0)") + 1 - F.count("turn")
    counts = per_turn.groupBy("conv").agg(
        F.coalesce(span, F.lit(0)).try_cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    )
    cut = flags.select("conv", F.floor((F.col("seq") - 1) / BLOCK).cast("long").alias("block"), "seq", "fault", "initial")
    blocks = cut.repartition("conv", "block").sortWithinPartitions("conv", "block", "seq").select("conv", "block", "fault", "initial")
    blocks = blocks.mapInPandas(_blocks, "conv string, block long, first string, last string, illegal long, cells string")
    folded = blocks.repartition("conv").sortWithinPartitions("conv", "block").mapInPandas(
        _folded, "conv string, illegal long, cost long, audit string"
    )
    return counts.join(folded, null_safe(counts, folded, ["conv"])).select(
        counts["conv"], "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )


def apply_edits(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Repaired messages: conv, place (1, 2, 3, ...), edit (K, R or I), role and text, conversations whole and in order in a partition."""
    none = F.lit(None).cast("string")
    heads = plan.select("conv", F.lit(0).cast("long").alias("seq"), "audit", none.alias("role"), none.alias("text"))
    both = heads.unionByName(rows.select("conv", "seq", none.alias("audit"), "role", "text"))
    return both.repartition("conv").sortWithinPartitions("conv", "seq").mapInPandas(
        _edited, "conv string, place long, edit string, role string, text string"
    )


def digests(repaired: DataFrame) -> DataFrame:
    """conv and the SHA-256 of its lines ``role:text``; reads partitions of :func:`apply_edits` as they stand."""
    return repaired.mapInPandas(_digests, "conv string, sha string")


def repair(messages: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> tuple[DataFrame, DataFrame]:
    """(plan per conversation, repaired messages)."""
    ship_package(messages.sparkSession)
    rows, flags = numbered(messages, conv_id, turn, role, text)
    plan = write_scratch(plan_edits(flags), "edit-plan")
    return plan, apply_edits(rows, plan)


def damage(messages: DataFrame) -> DataFrame:
    """Messages with faults planted by a hash of conversation and turn."""
    def shown(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = messages.select(F.col("conv_id"), F.col("turn"), shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    changed = rows.filter("kind <> 0").withColumns(
        {
            "text": F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
            "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")),
        }
    )
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return changed.withColumn("copy", F.explode(times)).select("conv_id", "turn", "role", "text")


def op13_report(conversations: DataFrame) -> DataFrame:
    """Every original conversation: faults after damage, cost and string of its edits, digest of what was repaired."""
    plan, repaired = repair(damage(conversations))
    shas = digests(repaired)
    ids = conversations.select(F.col("conv_id"), F.col("conv_id").cast("string").alias("conv")).distinct()
    known = ids.join(plan, null_safe(ids, plan, ["conv"]), "left").select("conv_id", ids["conv"], *plan.columns[1:])
    full = known.join(shas, null_safe(known, shas, ["conv"]), "left")
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return full.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in longs],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def op13_query(spark, sf_dir: str) -> DataFrame:
    return op13_report(table(spark, sf_dir, "conversations"))


def _oracle() -> str:
    """The lattice message by message: a recursive query carries the best (cost, audit, lines) of each state."""

    def after(label: str, cost, edit: str, line: str = "") -> str:
        lines = f"list_append({label}.lines, {line})" if line else f"{label}.lines"
        return f"CASE WHEN {label} IS NOT NULL THEN {{'cost': {label}.cost + {cost}, 'audit': {label}.audit || '{edit}', 'lines': {lines}}} END"

    def least(options) -> str:
        return f"list_min(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL))"

    def with_inserts(source: str) -> str:
        """Two inserts reach every state, a third one comes back."""
        for _ in range(2):
            to = {s: least([f"l{s}"] + [after(f"l{b}", INSERT, "I", f"'{GIVEN[b][0]}:'") for b in BEFORE[s]]) for s in (ASKED, ANSWERED)}
            source = f"(SELECT conv_id, seq, l0, l1, {to[ASKED]} AS l2, {to[ANSWERED]} AS l3 FROM {source})"
        return source

    left = f"(CASE WHEN fault = {TRUNCATED} THEN {LEFT_TRUNCATED} ELSE 0 END)"
    steps = {s: [after(f"l{s}", DELETE, "D")] for s in range(4)}
    for state in range(4):
        role, to = GIVEN[state]
        steps[to].append(f"CASE WHEN fault IN (0, {TRUNCATED}) THEN {after(f'l{state}', f'{REROLE} + {left}', 'R', f"'{role}:' || text")} END")
        for initial, kept in KEEPS[state].items():
            steps[kept].append(f"CASE WHEN fault IN (0, {TRUNCATED}) AND initial = '{initial}' THEN {after(f'l{state}', left, 'K', 'line')} END")
    stepped = ", ".join(f"{least(steps[s])} AS l{s}" for s in range(4))
    label = "STRUCT(cost INTEGER, audit VARCHAR, lines VARCHAR[])"
    opening = (
        "(SELECT conv_id, 0::BIGINT AS seq, {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]} AS l0, "
        + ", ".join(f"NULL::{label} AS l{s}" for s in (1, 2, 3)) + " FROM counts)"
    )
    step = (
        f"(SELECT w.conv_id, m.seq, {stepped} FROM walk w "
        "JOIN faulty m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.seq = w.seq + 1)"
    )
    return rf"""WITH RECURSIVE {CRC_TABLE_SQL},
keyed AS (SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
  COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
marked AS (SELECT *, {crc_sql("list_transform(range(1, length(key) + 1), lambda i: ascii(substr(key, i, 1))::BIGINT)")} % 20 AS kind
  FROM keyed, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM marked WHERE kind <> 0),
placed AS (SELECT *, role || ':' || text AS line, substr(role, 1, 1) AS initial,
    regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS final,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS seq FROM damaged),
faulty AS (SELECT *, CASE WHEN final = '' THEN {BLANK}
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY seq) > 1 THEN {DUPLICATE}
    WHEN final NOT IN ('.', '!', '?') THEN {TRUNCATED} ELSE {SOUND} END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY seq) || initial AS pair FROM placed),
counts AS (SELECT conv_id, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps, COUNT(*) AS n,
    COUNT(*) FILTER (WHERE fault = {BLANK}) AS blank, COUNT(*) FILTER (WHERE fault = {DUPLICATE}) AS duplicate,
    COUNT(*) FILTER (WHERE fault = {TRUNCATED}) AS truncated,
    COUNT(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id),
walk AS (SELECT * FROM {with_inserts(opening)} UNION ALL SELECT * FROM {with_inserts(step)}),
best AS (SELECT c.*, list_min(list_filter([w.l{ENDS[0]}, w.l{ENDS[1]}], lambda o: o IS NOT NULL)) AS b
  FROM counts c JOIN walk w ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.seq = c.n)
SELECT i.conv_id, COALESCE(gaps, 0)::BIGINT AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate,
  COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal, COALESCE(b.cost, 0)::BIGINT AS cost,
  COALESCE(b.audit, '') AS audit, sha256(COALESCE(array_to_string(b.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN best ON i.conv_id IS NOT DISTINCT FROM best.conv_id"""


ORACLE_SQL = _oracle()
