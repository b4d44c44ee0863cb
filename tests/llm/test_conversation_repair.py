"""Conversation repair against a shortest-path search over all edits, through the registered query."""

import heapq
import random
import zlib
from hashlib import sha256

import pytest

from gableboard.llm import conversation_repair, queries

WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        end = text.rstrip(WHITE)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Least (cost, audit) by search over (row, state): start, after s, u, a. No lengths, no tables, no bands."""
    found = faults(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            # The least audit of this cost may still be found from another state.
            best = (cost, audit, out)
            while heap and heap[0][0] == cost:
                c, b, j, t, o = heapq.heappop(heap)
                if j == len(rows) and t in ("", "a"):
                    best = min(best, (c, b, o))
                elif (j, t) not in done:
                    done.add((j, t))
                    for x in steps(rows, found, c, b, j, t, o):
                        heapq.heappush(heap, x)
            return best
        for x in steps(rows, found, cost, audit, i, state, out):
            heapq.heappush(heap, x)


def steps(rows, found, cost, audit, i, state, out):
    following = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
    name = {"u": "user", "a": "assistant"}[following]
    yield cost + 5, audit + "I", i, following, (*out, (name, ""))
    if i < len(rows):
        role, text = rows[i]
        yield cost + 2, audit + "D", i + 1, state, out
        if found[i] in ("", "truncated"):
            more = 5 if found[i] else 0
            if role[:1] == following or (role[:1] == "s" and state == ""):
                yield cost + more, audit + "K", i + 1, role[:1], (*out, (role, text))
            yield cost + more + 1, audit + "R", i + 1, following, (*out, (name, text))


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute(rows):
    hurt, out = damage(rows), []
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in hurt if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        said = [(r[2], r[3]) for r in mine]
        turns = {r[1] for r in mine} - {None}
        f = faults(said)
        cost, audit, kept = cheapest(said)
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(said, said[1:])]
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, f.count("blank"), f.count("duplicate"), f.count("truncated"),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()))
    return sorted(out, key=repr)


ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "umpire", "System"]
TEXTS = ["Yes.", "No!", "cut", "  ", "", None, "Why?\n", "a. b", "é.", "x" * 3000, "end. "]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    out = []
    for conv in [*range(60), None, -7]:
        for k in range(r.choice([1, 1, 2, 3, 4, 5, 8, 13])):
            wild = r.random() < 0.3
            role = r.choice(ROLES) if wild else ["user", "assistant"][k % 2]
            out.append((conv, r.choice([None, k, k * 3]) if wild else k, role, r.choice(TEXTS) if wild else f"Turn {k}."))
    out += [(500, k, ["user", "assistant"][k % 2], "Same." if k % 9 == 0 else f"Turn {k}" + "." * (k % 11 > 0)) for k in range(1500)]
    return [*out, (600, 1, "user", "Yes."), (600, 1, "user", "Yes."), (601, -(2 ** 63), "user", "Yes."), (601, 2 ** 63 - 1, "assistant", "Yes.")]


def test_query_equals_search(spark, rows, tmp_path):
    schema = "conv_id long, turn long, role string, text string, audit string, kind int, at long"
    table = spark.createDataFrame([(*r, "clash", 0, 0) for r in rows], schema)
    table.repartition(5).write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op11_conversation_repair(spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = sorted((tuple(r) for r in got.collect() if r.conv_id != 601), key=repr)
    assert got == brute([r for r in rows if r[0] != 601])


def test_alignment_equals_search():
    r = random.Random(11)
    for _ in range(400):
        said = [(r.choice(["user", "assistant", "system", "tool"]), r.choice(["One.", "Two.", "Three.", "cut", " ", f"{r.random()}."])) for _ in range(r.randint(1, 14))]
        codes = "".join("%x" % ("suat".index(role[0]) + 4 * ["", "blank", "duplicate", "truncated"].index(f)) for (role, _), f in zip(said, faults(said)))
        assert conversation_repair.align(codes) == cheapest(said)[:2], said


def test_lines_filled_again_and_wide_bands(monkeypatch):
    r = random.Random(2)
    for _ in range(30):
        codes = "".join(r.choice("0123012df9") for _ in range(80))
        whole = conversation_repair.align(codes)
        monkeypatch.setattr(conversation_repair, "LINES", 7)
        monkeypatch.setattr(conversation_repair, "FIRST_BAND", 1)
        assert conversation_repair.align(codes) == whole
        monkeypatch.undo()


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "user", "cut"), (1, 3, "user", "Ok."), ("1", None, None, None)][:4]
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    found = conversation_repair.audits(turns)
    got = [tuple(r) for r in conversation_repair.repaired(turns, found).orderBy("place").collect()]
    cost, audit, kept = cheapest([r[2:] for r in rows])
    assert [tuple(r)[-2:] for r in found.collect()] == [(cost, audit)]
    assert got == [(1, k, *x) for k, x in enumerate(kept)]


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.repair(none).collect() == []
    gone = spark.createDataFrame([(5,), (5,)], "conv_id long")
    assert [tuple(r) for r in conversation_repair.repair(none, gone).collect()] == [(5, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]
