"""Conversation repair against a plain version, and that against all edits of short conversations."""
import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from helpers import CLASH, sorted_rows

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, " + ", ".join(f"{c} string" for c in CLASH)
SPACE = " \t\n\x0b\x0c\r"


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        c = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if c:
            text = "" if c == 1 else re.sub("[.!?]", "", text) if c == 2 else text
            out += [(conv, turn, "user" if c == 4 else role, text)] * (2 if c == 3 else 1)
    return out


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        end = text.rstrip(SPACE)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _next(state, initial):
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}.get((state, initial))


def _moves(rows, faults, i, state):
    """(edit, cost, rows used, state, role) from a state."""
    other = "assistant" if state == "u" else "user"
    out = [("I", 3, 0, other[0], other)]
    if i < len(rows):
        role, extra = rows[i][1], 3 * (faults[i] == "truncated")
        out.append(("D", 4, 1, state, None))
        if faults[i] not in ("blank", "duplicate"):
            if _next(state, role[:1]):
                out.append(("K", extra, 1, _next(state, role[:1]), role))
            if role != other:
                out.append(("R", 3 + extra, 1, other[0], other))
    return out


def _cheapest(rows, faults):
    """Whole prefixes kept as strings; at most two inserts in a row can be worth their cost."""
    live = {"": (0, "")}

    def inserted(live):
        for _ in range(2):
            for s, (c, e) in list(live.items()):
                edit, cost, _, to, _ = _moves(rows, faults, len(rows), s)[0]
                live[to] = min(live.get(to, (1e9, "")), (c + cost, e + edit))
        return live
    live = inserted(live)
    for i in range(len(rows)):
        new = {}
        for s, (c, e) in live.items():
            for edit, cost, _, to, _ in _moves(rows, faults, i, s)[1:]:
                new[to] = min(new.get(to, (1e9, "")), (c + cost, e + edit))
        live = inserted(new)
    return min(live[s] for s in ("", "a") if s in live)


def _repaired(rows, audit):
    out, i, state = [], 0, ""
    for edit in audit:
        other = "assistant" if state == "u" else "user"
        role, text = (other, "") if edit == "I" else rows[i][1:]
        i += edit != "I"
        if edit != "D":
            role = role if edit == "K" else other
            out.append(f"{role}:{text}")
            state = role[0]
    return "\n".join(out)


def _plain(rows, ids):
    by = {k: [] for k in ids}
    for conv, *row in rows:
        by.setdefault(conv, []).append(tuple(row))
    out = []
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults = _faults(own)
        n = collections.Counter(faults)
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit = _cheapest(own, faults)
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                    hashlib.sha256(_repaired(own, audit).encode()).hexdigest()))
    return sorted(out, key=repr)


def _random(rng, size):
    rows = []
    for turn in range(size):
        role = rng.choice(["user", "assistant", "system", "tool", "u", ""], p=[.4, .33, .15, .06, .03, .03])
        rows.append((turn, str(role), str(rng.choice(["Yes.", "no", "  ", "", "What?", f"own {turn}!", f"own {turn}"]))))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_plain_version_is_cheapest(seed):
    rng = np.random.default_rng(seed)
    for _ in range(12):
        rows = _random(rng, int(rng.integers(0, 5)))
        faults, found = _faults(rows), []

        def walk(i, state, cost, edits, rows=rows, faults=faults, found=found):
            if i == len(rows) and state in ("", "a"):
                found.append((cost, edits))
            for edit, c, used, to, _ in _moves(rows, faults, i, state):
                if not (edit == "I" and edits.endswith("II")):
                    walk(i + used, to, cost + c, edits + edit)
        walk(0, "", 0, "")
        assert min(found) == _cheapest(rows, faults)


def test_survivors_coalesce():
    from sitegraph.llm.conversation import Repair
    rng = np.random.default_rng(5)
    for k in range(60):
        rows = _random(rng, int(rng.integers(0, 60)))
        faults, out = _faults(rows), []
        r = Repair(lambda edit, row, role, text, out=out: out.append((edit, role, text)))
        for (turn, role, text), f in zip(rows, faults):
            r.feed(role, text, f in ("blank", "duplicate"), f == "truncated", turn)
        cost = r.finish()
        audit = "".join(e for e, _, _ in out)
        assert (cost, audit) == _cheapest(rows, faults), k
        assert "\n".join(f"{role}:{text}" for e, role, text in out if e != "D") == _repaired(rows, audit)
    for roles in (["user"], ["assistant"], ["user", "assistant"], ["system", "user", "assistant", "assistant"], ["system"]):
        r = Repair(lambda *a: None)
        for i in range(20_000):
            r.feed(roles[i % len(roles)], "x.", i % 7 == 3, i % 5 == 0, i)
        r.finish()
        assert r.held < 200 or roles == ["system"], roles  # system rows only: the place of an insert stays open to the end


def test_repair_of_the_table(spark, sf):
    import __spark_entry__ as E
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted_rows(E.queries()["op12_conversation_repair"](spark, sf), *COLUMNS)
    assert got == _plain(_damaged(rows), {r[0] for r in rows})


def test_repair_edges(spark):
    from sitegraph.llm.conversation import damage, repair_summary, repaired_rows
    long = "word " * 50_000
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (1, None, "user", "a."), (1, None, "user", "a."), (1, None, "assistant", None),
            (2, 5, "system", "s."), (2, 9, "user", long), (2, 9, "user", long), (2, 9, "assistant", "b."), (2, 12, "user", long),
            (3, 0, "", ""), (4, 0, "assistant", "x"), (4, 1, "assistant", "y."), (4, 1, "assistant", "y."), (5, -3, "é", "é?")]
    rows += [(6, i, ["user", "assistant"][i % 2], f"row {i % 40}.") for i in range(400)]
    rows += [(c, t, "user", "same.") for c in range(20, 60) for t in range(3)]
    df = spark.createDataFrame([(*r, *["z"] * len(CLASH)) for r in rows], SCHEMA)
    got = sorted_rows(repair_summary(damage(df), df), *COLUMNS)
    assert got == _plain(_damaged(rows), {r[0] for r in rows})
    plain = [(r[0], r[1], r[2] if r[2] is not None else " ", r[3] if r[3] is not None else " ") for r in rows]
    assert sorted_rows(repair_summary(df), *COLUMNS) == _plain(plain, set())
    edits = collections.defaultdict(str)
    for r in sorted(repaired_rows(df).collect(), key=lambda r: r.seq):
        edits[r.conv_id] += r.edit
    assert dict(edits) == {r[0]: r[7] for r in _plain(plain, set())}
    empty = df.limit(0)
    assert repair_summary(damage(empty), empty).count() == 0 and repair_summary(empty, df).count() == len({r[0] for r in rows})
