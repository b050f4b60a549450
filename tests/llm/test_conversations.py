import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from meshroad.llm import conversations as c

TABLE = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\f\r"


def plain_edits(rows):
    """Cheapest edits of (initial, must go, truncated) rows by Dijkstra's search over (rows read, state), edits as part of the cost."""
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, edits, at, state = heapq.heappop(heap)
        if at == len(rows) and state in (0, 3):
            return cost, edits
        if (at, state) in done:
            continue
        done.add((at, state))
        other = 3 if state == 2 else 2
        heapq.heappush(heap, (cost + 5, edits + "I", at, other))
        if at < len(rows):
            initial, gone, cut = rows[at]
            heapq.heappush(heap, (cost + 2, edits + "D", at + 1, state))
            if not gone:
                heapq.heappush(heap, (cost + 1 + 5 * cut, edits + "R", at + 1, other))
                to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((initial, state))
                if to is not None:
                    heapq.heappush(heap, (cost + 5 * cut, edits + "K", at + 1, to))


def plain(table):
    """The report by direct reading of the contract."""
    of = defaultdict(list)
    for conv, turn, role, text in table:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        rows = of[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {conv: plain_report(rows) for conv, rows in of.items()}


def plain_report(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen, symbols = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
    for _, role, text in rows:
        last = text.rstrip(WHITE)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        symbols.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
    cost, audit = plain_edits(symbols)
    lines, state, at = [], 0, 0
    for edit in audit:
        turn_of = "assistant" if state == 2 else "user"
        role, text = (turn_of, "") if edit == "I" else (turn_of if edit == "R" else rows[at][1], rows[at][2])
        if edit != "D":
            lines.append(f"{role}:{text}")
            state = 1 if edit == "K" and role[:1] == "s" else 3 if state == 2 else 2
        at += edit != "I"
    return (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def reported(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def random_table(seed, conversations, longest):
    rng = random.Random(seed)
    roles, texts = ["system", "user", "user", "user", "assistant", "assistant", "assistant", "tool", "", None], ["Yes.", "No!", "Why?", "cut off", "", " \n", None, "end. \t", "a?b"]
    rows = []
    for conv in [*range(conversations), None]:
        for _ in range(rng.randrange(longest)):
            rows.append((conv, rng.choice([None, *range(longest)]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.3 else f"word {rng.random()}" + rng.choice(".!?,")))
    return rows


@pytest.mark.parametrize("rows, fan", [(4096, 256), (3, 2), (1, 3)])
def test_reports_equal_a_plain_search(spark, monkeypatch, rows, fan):
    monkeypatch.setattr(c, "BLOCK_ROWS", rows)
    monkeypatch.setattr(c, "FAN", fan)
    table = random_table(7, 40, 25)
    df = spark.createDataFrame(table, TABLE).repartition(5)
    assert reported(c.report(c.damage(df))) == plain(table)


def test_symbols_share_one_grammar():
    rng = random.Random(1)
    sequences = ["".join(rng.choice("suaoSUAOx") for _ in range(rng.randrange(1, 40))) for _ in range(60)] + ["ua" * 500, "x" * 777]
    grammar = c.Grammar(sequences)
    assert grammar.rules and len(grammar.sequences[-1]) < 20 and len(grammar.sequences[-2]) < 20
    for k, s in enumerate(sequences):
        audit = grammar.cheapest(k, c.EMPTY, None)
        rows = [(x.lower(), x == "x", x.isupper()) for x in s]
        assert (len(s) > 40 and set(audit) <= set("KD")) or audit == plain_edits(rows)[1]
        m = grammar.product(k)
        for start in c.STATES:  # the order of end states is that of their edits
            found = [(grammar.cheapest(k, start, end), m.rank[start][end]) for end in c.STATES if m.cost[start][end] < c.NEVER]
            assert [r for _, r in sorted(found)] == list(range(len(found)))


def test_edges(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "assistant", "x" * 600_000 + "."), (2, None, None, None), (3, 5, "assistant", "Only an answer."),
            (4, 1, "user", "a."), (4, 1, "user", "a."), (4, 1, "user", "a."), (None, None, "user", "q."), (None, 3, "assistant", "r.")]
    df = spark.createDataFrame(rows, TABLE)
    clash = df.withColumns({n: F.lit("x") for n in ("copies", "part", "no", "idx", "audit", "_conv", "_key", "start", "first_turn")})
    assert reported(c.report(c.damage(clash))) == plain(rows)
    assert c.report(c.damage(df.limit(0))).count() == 0
    assert c.repaired_rows(c.damage(df.limit(0))).count() == 0


def test_a_hot_row_and_repaired_rows(spark, monkeypatch):
    monkeypatch.setattr(c, "BLOCK_ROWS", 50)
    rows = [(1, 2, "user", "same.")] * 333 + [(1, 3, "assistant", "yes.")] + [(2, 0, "user", "a?")]
    made = spark.createDataFrame([(*r, 1) for r in rows], TABLE + ", copies long")
    found = reported(c.report(made))
    for conv in (1, 2):
        assert found[conv] == plain_report([r[1:] for r in rows if r[0] == conv])
    kept = c.repaired_rows(made).orderBy("conv_id", "part", "no", "pos").collect()
    assert [tuple(r)[4:] for r in kept if r.conv_id == 1] == [("user", "same.", "K"), ("assistant", "yes.", "K")]
    assert [tuple(r)[4:] for r in kept if r.conv_id == 2] == []
