import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import conversation_repair
from millrace.llm.conversation_repair import crossings, fold, repair_conversations, solve, unit
from millrace.llm.queries_chat import damage

WHITE = " \t\n\x0b\x0c\r"
GOOD = re.compile("(s?(ua)+)?")


def faults(rows):
    """Fault of each (turn, role, text) in order."""
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(WHITE)
        out.append("blank" if not bare.lstrip(WHITE) else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "sound")
        seen.add((role, text))
    return out


def plain(rows):
    """All of a conversation by a table of whole audits, without any halving."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    kinds, follow = faults(rows), {"": "su", "s": "u", "u": "a", "a": "u"}

    def puts(ways):
        done = dict(ways)
        for _ in range(3):
            for state, (cost, audit, lines) in list(done.items()):
                to = follow[state][-1]
                new = (cost + 5, audit + "I", [*lines, {"u": "user:", "a": "assistant:"}[to]])
                if to not in done or new[:2] < done[to][:2]:
                    done[to] = new
        return done

    ways = {"": (0, "", [])}
    for (_, role, text), kind in zip(rows, kinds, strict=True):
        nxt = {}

        def offer(state, way, nxt=nxt):
            if state not in nxt or way[:2] < nxt[state][:2]:
                nxt[state] = way

        # Every number of messages put in before, not only the cheapest one of each state.
        starts = []
        for state, way in ways.items():
            for _ in range(3):
                starts.append((state, way))
                to = follow[state][-1]
                state, way = to, (way[0] + 5, way[1] + "I", [*way[2], {"u": "user:", "a": "assistant:"}[to]])
        for state, (cost, audit, lines) in starts:
            offer(state, (cost + 2, audit + "D", lines))
            if kind in ("sound", "truncated"):
                more = 5 if kind == "truncated" else 0
                if role[:1] and role[0] in follow[state]:
                    offer(role[0], (cost + more, audit + "K", [*lines, f"{role}:{text}"]))
                to = follow[state][-1]
                offer(to, (cost + more + 1, audit + "R", [*lines, f"{'user' if to == 'u' else 'assistant'}:{text}"]))
        ways = nxt
    ways = puts(ways)
    cost, audit, lines = min((ways[s] for s in ("", "a") if s in ways), key=lambda w: w[:2])
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def told(repair, conversations=None):
    return {r[0]: tuple(r)[1:] for r in repair.audits(conversations).collect()}


def letters_of(rows):
    place = {"sound": 0, "truncated": 1, "blank": 2, "duplicate": 3}
    return "".join(chr(65 + 4 * place[f] + ("sua".index(r[:1]) if r[:1] and r[0] in "sua" else 3)) for f, (_, r, _) in zip(faults(rows), rows, strict=True))


def some_rows(rng, n):
    return [(i, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["Hi.", "No", "", " ", "What?", f"Number {i}.", f"Cut {i}"])) for i in range(n)]


def test_against_every_series_of_edits():
    rng = random.Random(2)
    for _ in range(60):
        rows = some_rows(rng, rng.randint(0, 3))
        kinds, best = faults(rows), None
        for gaps in itertools.product(["", "u", "a", "ua", "au"], repeat=len(rows) + 1):
            for edits in itertools.product("KDUA", repeat=len(rows)):
                if any(k in ("blank", "duplicate") and e != "D" for k, e in zip(kinds, edits, strict=True)):
                    continue
                out, cost, audit = gaps[0], 5 * len("".join(gaps)), "I" * len(gaps[0])
                for (_, role, _), kind, edit, gap in zip(rows, kinds, edits, gaps[1:], strict=True):
                    out += {"K": role[:1] or "?", "D": "", "U": "u", "A": "a"}[edit] + gap
                    cost += {"K": 0, "D": 2, "U": 1, "A": 1}[edit] + (5 if kind == "truncated" and edit != "D" else 0)
                    audit += {"K": "K", "D": "D"}.get(edit, "R") + "I" * len(gap)
                if GOOD.fullmatch(out) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
        assert plain(rows)[5:7] == best
        if rows:
            assert "".join(solve(letters_of(rows))).translate(conversation_repair.AUDIT) == best[1]


def test_halving_equals_the_table():
    rng = random.Random(3)
    for _ in range(300):
        rows = [(i, r, x) for i, (_, r, x) in enumerate(some_rows(rng, rng.randint(1, 40)))]
        assert "".join(solve(letters_of(rows))).translate(conversation_repair.AUDIT) == plain(rows)[6]


def test_blocks_fold_and_come_apart():
    rng = random.Random(4)
    for _ in range(100):
        letters = "".join(chr(65 + rng.randrange(16)) for _ in range(rng.randint(2, 60)))
        cuts = sorted({0, len(letters), *(rng.randrange(len(letters)) for _ in range(4))})
        blocks = [letters[a:b] for a, b in itertools.pairwise(cuts)]
        tables = [fold(b) for b in blocks]
        assert fold(tables) == fold(letters)
        end = conversation_repair.final_state(conversation_repair._sweep(unit(0), tables))
        states = crossings(tables, 0, end)
        steps = [s for b, x, y in zip(blocks, states, states[1:], strict=False) for s in solve(b, x, y)]
        steps[-1] += conversation_repair.TAIL[end]
        assert steps == solve(letters)


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block", [4096, 3])
def test_conversations_of_all_lengths(spark, monkeypatch, block):
    monkeypatch.setattr(conversation_repair, "BLOCK", block)
    monkeypatch.setattr(conversation_repair, "FAN", 2)
    rng, by = random.Random(5), {}
    for c in [None, *range(30)]:
        by[c] = [(rng.choice([None, i, i, i + 3]), r, x) for i, r, x in some_rows(rng, rng.choice([1, 2, 5, 9]))]
    by[99] = [(i, "user" if i % 2 == 0 else "assistant", rng.choice([f"Yes {i}.", "Yes.", "", f"cut {i}"])) for i in range(700)]
    rows = [(c, *r) for c, part in by.items() for r in part]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    repair = repair_conversations(docs)
    have = told(repair)
    assert have == {c: plain(part) for c, part in by.items()}
    lines = {}
    for r in repair.messages().orderBy("conversation", "place").collect():
        lines.setdefault(r.conversation, []).append(f"{r.role}:{r['text']}")
    assert {c: hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() for c in by} == {c: x[-1] for c, x in have.items()}


def test_odd_tables(spark):
    rows = [(None, None, None, None), (None, None, None, None), (1, 5, "user", "a."), (1, 5, "user", "a."), (2, 0, "", "x."), (3, 0, "User", "x."), (4, 2**40, "user", "z" * 300_000 + "."),
            (4, 2**40 + 9, "assistant", "y.")]
    by = {}
    for c, *r in rows:
        by.setdefault(c, []).append(tuple(r))
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"conversation": F.lit(1), "letters": F.lit("x"), "pid": F.lit(0)})
    have = told(repair_conversations(docs), spark.createDataFrame([(1,), (77,), (77,)], "conv_id long"))
    assert have == {**{c: plain(part) for c, part in by.items()}, 77: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    empty = repair_conversations(spark.createDataFrame([], SCHEMA))
    assert empty.audits().count() == 0 and empty.messages().count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(30) for t in range(8)] + [(None, None, None, None)]
    have = sorted(tuple(r) for r in damage(spark.createDataFrame(rows, SCHEMA)).collect() if r.conv_id is not None)
    want = []
    for c, t, role, text in rows[:-1]:
        d = zlib.crc32(f"{c}:{t}".encode()) % 20
        if d:
            want += [(c, t, "user" if d == 4 else role, {1: "", 2: "One Two Three"}.get(d, text))] * (2 if d == 3 else 1)
    assert have == sorted(want)
