"""Repairs against a search over all edits, over given tables and odd rows."""

import zlib
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pytest

from changeflow.llm import turn_repair
from changeflow.llm.common import load

SF = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def cheapest(rows):
    """rows: (role, text, bad, truncated). The least (cost, audit, repaired lines) over all edits."""

    @lru_cache(None)
    def rest(i, state, inserts):
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []

        def add(cost, edit, line, tail):
            if tail:
                found.append((cost + tail[0], edit + tail[1], ((line,) if line is not None else ()) + tail[2]))

        if inserts < 2:
            for to in set(NEXT[state]) & {"u", "a"}:
                add(3, "I", {"u": "user:", "a": "assistant:"}[to], rest(i, to, inserts + 1))
        if i < len(rows):
            role, text, bad, truncated = rows[i]
            add(4, "D", None, rest(i + 1, state, 0))
            if not bad:
                if role[:1] in NEXT[state]:
                    add(3 * truncated, "K", f"{role}:{text}", rest(i + 1, NEXT[state][role[:1]], 0))
                for to in set(NEXT[state]) & {"u", "a"}:
                    name = {"u": "user", "a": "assistant"}[to]
                    add(3 + 3 * truncated, "R", f"{name}:{text}", rest(i + 1, to, 0))
        return min(found, default=None)

    return rest(0, "", 0)


def brute(rows, damaging=True):
    rows = list(rows)
    by = {}
    for row in rows:
        by.setdefault(row[0], [])
    for row in damage(rows) if damaging else [(*r[:2], *(" " if x is None else x for x in r[2:])) for r in rows]:
        by[row[0]].append(row)
    out = []
    for conv, own in by.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, marked, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in own:
            fault = None
            if not text.strip(SPACES):
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif text.rstrip(SPACES)[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            if fault:
                n[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = cheapest(tuple(marked))
        out.append((conv, gaps, *n.values(), illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    found = turn_repair.op12_turn_repair(spark, SF)
    assert found.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    ]
    assert sorted(map(tuple, found.collect()), key=str) == brute(map(tuple, load(spark, SF, "conversations").collect()))


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(12)
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Fine.", "Well!", "cut off", "", " \t\x0b\n", None, "é.\n", "Why? ", "no end\x1f"]
    rows = []
    for conv in range(300):
        for turn in range(rng.integers(1, 12)):
            share = rng.random() < 0.5
            role = roles[rng.integers(2 if share else len(roles))]
            text = f"{texts[rng.integers(2)]} {turn}." if share else texts[rng.integers(len(texts))]
            at = None if rng.random() < 0.1 else int(rng.integers(0, 30))
            rows += [(None if conv == 7 else conv, at, role, text)] * (1 + (rng.random() < 0.1))
    rows += [(1000, None, None, None), (1001, 5, "user", "x" * 500_000 + "."), (1002, -(1 << 62), "user", "a."), (1002, 1, "user", "b.")]
    schema = "conv_id long, turn long, role string, text string, there int, seen string, conv int"
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], schema).repartition(4), rows


def test_odd_rows_equal_brute_force(odd):
    docs, rows = odd
    found = turn_repair.repair(docs)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows, damaging=False)
    found = turn_repair.repair(turn_repair.damaged(docs), there=turn_repair.F.col("there"))
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_dropped_and_empty(spark, odd):
    docs, _ = odd
    none = docs.where("conv_id = -1")
    assert turn_repair.repair(none).count() == 0
    dropped = turn_repair.repair(docs.where("conv_id = 3"), there=turn_repair.F.lit(False)).collect()
    assert [tuple(r) for r in dropped] == [(3, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]


def test_wide_turns_have_no_gap_count(spark):
    rows = [(1, -(1 << 63), "user", "a."), (1, (1 << 63) - 1, "assistant", "b.")]
    row = turn_repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert row.gaps is None and row.audit == "KK"


@pytest.mark.parametrize("pattern", ["ua", "u", "s", "uua", "suaa"])
def test_long_conversations_keep_their_audit(monkeypatch, pattern):
    """Chunks put aside don't change the order of audits, nor do dropped stacks change the result."""
    rows = [({"u": "user", "a": "assistant", "s": "system"}[pattern[i % len(pattern)]], f"{i}.", i % 7 == 3, i % 5 == 1) for i in range(200)]

    def parsed(chunk):
        monkeypatch.setattr(turn_repair, "CHUNK", chunk)
        parse = turn_repair._Parse()
        for role, text, bad, truncated in rows:
            parse.row(role[:1], bad, truncated, role, text)
            assert len(parse.tops) <= 4
        return parse.end()

    cost, audit, lines = cheapest(tuple(rows))
    assert parsed(4) == parsed(10_000) == (cost, audit, sha256("\n".join(lines).encode()).hexdigest())


def test_a_grammar_that_is_not_slr_is_refused():
    with pytest.raises(ValueError):
        turn_repair._tables((("C", "E"), ("E", "EE"), ("E", "u")))
