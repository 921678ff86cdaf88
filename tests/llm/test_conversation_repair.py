import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from marketlens.llm import conversation_repair as cr
from marketlens.llm.common import table
from marketlens.llm.queries import damaged, op11_conversation_repair

BLANKS = " \t\n\x0b\x0c\r"


def by_table(rows):
    """(cost, letters) by a plain table over all (rows read, role) states."""
    roles = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "")}

    def put(into, state, cost, letters):
        into[state] = min(into.get(state, (cost, letters)), (cost, letters))

    def inserted(states):
        for _ in range(4):
            for state, (cost, letters) in list(states.items()):
                put(states, roles[state], cost + 5, letters + "I")
        return states

    for initial, fault in rows:
        after = {}
        for state, (cost, letters) in inserted(best).items():
            put(after, state, cost + 2, letters + "D")
            if fault != "gone":
                more = 5 if fault == "cut" else 0
                put(after, roles[state], cost + 1 + more, letters + "R")
                if initial == roles[state] or (initial == "s" and state == ""):
                    put(after, initial, cost + more, letters + "K")
        best = after
    best = inserted(best)
    return min(best[s] for s in ("", "a") if s in best)


def code(initial, fault):
    return cr.STATE_OF.get(initial, 0) + 4 * {"ok": cr.SOUND, "cut": cr.TRUNCATED, "gone": cr.GONE}[fault]


def expected(rows):
    """Every column of one conversation's rows after damage, by brute force."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, kinds, counts = set(), [], dict(blank=0, duplicate=0, truncated=0)
    for _, role, text in rows:
        kept = re.findall(r"[^\x20\x09-\x0D]", text)
        kind = "ok"
        if not kept:
            kind, counts["blank"] = "gone", counts["blank"] + 1
        elif (role, text) in seen:
            kind, counts["duplicate"] = "gone", counts["duplicate"] + 1
        elif kept[-1] not in ".!?":
            kind, counts["truncated"] = "cut", counts["truncated"] + 1
        seen.add((role, text))
        kinds.append((role[:1], kind))
    turns = [t for t, _, _ in rows if t is not None]
    counts["gaps"] = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = by_table(kinds)
    out, left, state = [], iter(rows), ""
    for letter in audit:
        role, text = next(left)[1:] if letter != "I" else ("", "")
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if state == "u" else "user"
        state = role[:1]
        out.append(f"{role}:{text}")
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in out))
    return dict(counts, cost=cost, audit=audit, out=out,
                repaired_sha256=hashlib.sha256("\n".join(out).encode()).hexdigest())


def after_damage(rows):
    """{conversation: rows after damage} by the contract, in plain Python."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        def shown(x):
            return " " if x is None else str(x)
        here = out[conv]
        effect = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if effect == 0:
            continue
        text = "" if effect == 1 else re.sub("[.!?]", "", text) if effect == 2 else text
        here += [(turn, "user" if effect == 4 else role, text)] * (2 if effect == 3 else 1)
    return out


def check(got, rows):
    want = {c: expected(r) for c, r in rows.items()}
    assert len(got) == len(want)
    for r in got:
        for name in (*cr.COUNTS, "audit", "repaired_sha256"):
            assert r[name] == want[r["conv_id"]][name], (r, name, want[r["conv_id"]])


@pytest.mark.parametrize("segment", [1, 2, 3, 7, 1000])
def test_search_equals_a_plain_table(segment):
    rng = random.Random(segment)
    for n in range(400):
        rows = [(rng.choice("suax" if n % 2 else "ua"), rng.choice(["ok", "ok", "ok", "cut", "gone"]))
                for _ in range(rng.randrange(0, 14))]
        codes = bytes(code(*r) for r in rows)
        assert cr.cheapest_edits(codes, segment) == by_table(rows), rows


def test_long_conversations_equal_a_plain_table():
    rng = random.Random(9)
    for n in (127, 128, 129, 900):
        for roles in ("ua", "uuua", "suax"):
            rows = [(rng.choice(roles), rng.choice(["ok"] * 6 + ["cut", "gone"])) for _ in range(n)]
            assert cr.cheapest_edits(bytes(code(*r) for r in rows)) == by_table(rows)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    check(op11_conversation_repair(spark, SF_SMALL).collect(), after_damage(rows))


ODD = [(1, 0, "user", "Hello."), (1, 1, "assistant", "Hi."), (2, None, "user", "a."), (2, None, "user", "a."),
       (2, 5, "assistant", None), (2, 5, None, "b."), (3, 0, None, None), (None, 0, "user", "x."), (None, 3, "assistant", "y"),
       (4, 7, "", "."), (4, 7, "", "."), (4, 9, "system", "é" * 300_000 + "!"), (5, -3, "superuser", "z?"),
       (5, 2**62, "user", " "), (6, 1, "assistant", "\x0b\x0c \r\n\t"), (7, 1, "user", "q"), (7, 2, "assistant", "w")]


def odd(spark, rows=ODD):
    return spark.createDataFrame([(*r, "audit", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, audit string, cost int")


def test_nulls_ties_repeats_long_texts_and_clashing_columns(spark):
    rows = after_damage(ODD)
    check(cr.audits(damaged(odd(spark)), "conv_id", "turn", "role", "text", F.col("present")).collect(), rows)
    plain = defaultdict(list)
    for c, t, r, x in ODD:
        plain[c].append((t, " " if r is None else r, " " if x is None else x))
    check(cr.audits(odd(spark), "conv_id", "turn", "role", "text").collect(), plain)
    empty = cr.audits(odd(spark).limit(0), "conv_id", "turn", "role", "text")
    assert empty.collect() == [] and cr.repaired_rows(odd(spark).limit(0), "conv_id", "turn", "role", "text").count() == 0


def test_a_conversation_without_rows_is_returned(spark):
    got = cr.audits(odd(spark), "conv_id", "turn", "role", "text", F.col("conv_id") != 1).where("conv_id = 1").collect()
    assert [r.asDict() for r in got] == [dict(conv_id=1, gaps=0, blank=0, duplicate=0, truncated=0, illegal=0, cost=0,
                                              audit="", repaired_sha256=hashlib.sha256(b"").hexdigest())]


def test_repaired_rows_and_texts_kept_on_disk(spark, monkeypatch):
    monkeypatch.setattr(cr, "HELD_BYTES", 1000)
    one = cr.Conversation()
    for i in range(50):
        one.add(i, "user" if i % 2 == 0 else "assistant", f"{i}." * 20)
    found, out = one.repair(cr.cheapest_edits)
    assert one.rows.file is not None and found["audit"] == "K" * 50
    assert [t for _, _, t in out] == [f"{i}." * 20 for i in range(50)]
    plain = defaultdict(list)
    for c, t, r, x in ODD:
        plain[c].append((t, " " if r is None else r, " " if x is None else x))
    got = defaultdict(list)
    for r in cr.repaired_rows(odd(spark), "conv_id", "turn", "role", "text").orderBy("position").collect():
        got[r.conv_id].append(f"{r.role}:{r.text}")
    assert all(got.get(c, []) == expected(r)["out"] for c, r in plain.items())
