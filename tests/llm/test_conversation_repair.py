import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest

from geonet.llm import conversation_repair as repair
from geonet.llm.queries import op13_conversation_repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
FLOW = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
NEED = {"": "u", "s": "u", "u": "a", "a": "u"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out += [] if how == 0 else [(conv, turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    return out


def solve(rows):
    """Cheapest edits by Dijkstra over (rows read, last initial), ties by the string of edits; and the repaired rows."""
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, out = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, out
        if (i, last) in done:
            continue
        done.add((i, last))
        need = NEED[last]
        name = {"u": "user", "a": "assistant"}[need]
        heapq.heappush(heap, (cost + 5, audit + "I", i, need, (*out, f"{name}:")))
        if i < len(rows):
            fault, role, text = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, out))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if role[:1] in FLOW[last]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*out, f"{role}:{text}")))
                heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, need, (*out, f"{name}:{text}")))


def brute(rows, ids):
    out = []
    for conv in ids:
        mine = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, judged = set(), []
        for _, role, text in mine:
            body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((fault, role, text))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [f for f, _, _ in judged]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, repaired = solve(judged)
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256("\n".join(repaired).encode()).hexdigest(), repaired))
    return sorted(out, key=repr)


def made_up(rng, convs, most):
    rows = []
    for c in range(convs):
        for turn in range(rng.randint(0, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "User", None])
            text = rng.choice(["Yes.", "No!", "why", "so? ", "", " \t\n", None, "é.", f"t{rng.randint(0, 30)}.", "f", "ends with f"])
            rows.append((rng.choice([c, c, c, None]) if c == 0 else c, rng.choice([turn, turn, turn // 2, None]), role, text))
    return rows + rows[:3]


def test_tables_against_search():
    rng, tables = random.Random(2), repair.Tables()
    roles = "sua?"
    for _ in range(4000):
        codes = [rng.choice([0, 1, 2, 2, 2, 3, 4, 4, 4, 5, 6, 7, 8]) for _ in range(rng.randint(0, 22))]
        rows = [("blank" if c == 8 else "truncated" if c % 2 else "", roles[c // 2] if c < 8 else "u", "x") for c in codes]
        cost, audit, _ = solve(rows)
        letters, q = tables.edits(np.array(codes, dtype=np.int64), 0, repair.START)
        assert "".join(letters) + repair.tail(q) == audit
        cuts = sorted(rng.randint(0, len(codes)) for _ in range(3))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        frame = pd.DataFrame([(k, *tables.summary(np.array(p, dtype=np.int64))) for k, p in enumerate(parts)], columns=["chunk", "vectors", "states"])
        known, letters = repair.borders(frame), []
        for p, v, state in zip(parts, known["vector"], known["state"]):
            some, q = tables.edits(np.array(p, dtype=np.int64), int(v), int(state))
            letters += some
        assert "".join(letters) + repair.tail(q) == audit


@pytest.mark.parametrize("bits", [16, 2, 0])
def test_made_up(spark, bits):
    """Pieces of at most 65,536 rows, of four rows and of one row give the same."""
    rows = made_up(random.Random(bits), 40, 12)
    docs = spark.createDataFrame(rows, SCHEMA)
    ids = list({r[0] for r in rows}) + [999]
    want = brute([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows], ids)
    got = repair.reports(docs, spark.createDataFrame([(i,) for i in ids], "conv_id bigint"), bits).collect()
    assert sorted((tuple(r) for r in got), key=repr) == [w[:-1] for w in want]
    made = {}
    for r in sorted(repair.repaired(docs, bits).collect(), key=lambda r: r["place"]):
        made.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert made == {w[0]: list(w[-1]) for w in want if w[-1]}


def test_one_conversation_holds_most_rows(spark):
    rng = random.Random(11)
    rows = [(7, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", f"{t}.", f"{t}", "", "c!"])) for t in range(3000)]
    rows += [(7, 5, "user", "same.")] * 500 + [(8, 0, "user", "q."), (8, 1, "assistant", "r.")]
    got = repair.reports(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(7,), (8,)], "conv_id bigint"), 4).collect()
    assert sorted(map(tuple, got)) == [w[:-1] for w in brute(rows, [7, 8])]


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in op13_conversation_repair(spark, "/root/testdata/sf0.01").collect()), key=repr)
    assert got == [w[:-1] for w in brute(damaged(rows), {r[0] for r in rows})]


def test_awkward(spark):
    from pyspark.sql import functions as F

    empty = spark.createDataFrame([], SCHEMA)
    assert repair.reports(repair.damaged(empty), empty).collect() == [] and repair.repaired(empty).collect() == []
    rows = [(None, None, None, None), (None, 1, "user", "x" * 300_000 + "."), (None, 2, "assistant", "ok."), (1, None, "user", "a."), (1, None, "assistant", "b.")] * 2
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("kind", "chunk", "seq", "symbol", "what", "how", "copy", "salt", "letters")})
    got = repair.reports(repair.damaged(docs), docs).collect()
    assert sorted((tuple(r) for r in got), key=repr) == [w[:-1] for w in brute(damaged(rows), [None, 1])]
