"""Conversation repair against a plain model that spells every audit out."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from conftest import SF001
from rivulet.llm import conversations as C
from rivulet.llm.queries import op11_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def key(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        plain = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{plain(conv)}:{plain(turn)}".encode()) % 20
        role, text = plain(role), plain(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (conv, turn, "user" if kind == 4 else role, text)
        out += [row] * {0: 0, 3: 2}.get(kind, 1)
    return out


def steps(state, initial, fault):
    """(state, cost, letters) after any inserts that help and one edit."""
    insert = {"": "u", "s": "u", "u": "a", "a": "u"}
    for n in range(3):
        cut = 3 if fault == "truncated" else 0
        yield state, 3 * n + 4, "I" * n + "D"
        if fault in ("", "truncated"):
            yield insert[state], 3 * n + 3 + cut, "I" * n + "R"
            if (state, initial) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                yield initial, 3 * n + cut, "I" * n + "K"
        state = insert[state]


def model(rows):
    """What the contract says of one conversation's rows after damage."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, key(r[2], r[3])))
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(C.SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else
                      "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    best = {"": (0, "")}
    for (_, _, role, _), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit) in best.items():
            for to, more, letters in steps(state, role[:1], fault):
                after[to] = min(after.get(to, (1 << 60, "")), (cost + more, audit + letters))
        best = after
    end = {"": (0, ""), "s": (6, "II"), "u": (3, "I"), "a": (0, "")}
    cost, audit = min((c + end[s][0], a + end[s][1]) for s, (c, a) in best.items())
    at, last, out = iter(rows), "", []
    for letter in audit:
        _, _, role, text = next(at) if letter != "I" else (0, 0, "", "")
        if letter in "RI":
            role = "assistant" if last == "u" else "user"
        if letter != "D":
            out.append(f"{role}:{text}")
            last = role[:1]
    turns = {r[1] for r in rows if r[1] is not None}
    initials = [r[2][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def want(rows, hurt=damage):
    left = hurt(rows)
    return {conv: model([r for r in left if r[0] == conv]) for conv in {r[0] for r in rows}}


def got(df):
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def undamaged(df):
    from pyspark.sql import functions as F
    return df.select(F.col("conv_id").alias("conv"), "turn", "role", "text", F.lit(0).alias("copy"),
                     F.lit(False).alias("gone"))


def test_query_equals_model(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert got(op11_conversation_repair(spark, SF001)) == want(rows)


def test_odd_rows(spark):
    long = "word " * 200_000
    rows = [(1, 0, "user", "a."), (1, 1, None, "b."), (1, 2, "", None), (1, None, "assistant", "c?"), (1, None, "user", "c?"),
            (1, 5, "user", "a."), (1, 5, "user", "a."), (1, 5, "assistant", " \t\n"), (2, None, "system", "x"),
            (None, 0, "user", "é!"), (None, None, None, None), (3, -4, "assistant", long), (3, 9, "zebra", long + "."),
            (4, 7, "system", "s."), (4, 7, "user", "u."), (4, 7, "assistant", "a.")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", digest string, cost int")
    assert got(C.repair(df, "conv_id", "turn", "role", "text")) == want(rows)
    assert got(C.repair(df.limit(0))) == {}
    everything = [(c, t, "user", "a.") for c in range(40) for t in range(1)]
    gone = {r[0] for r in everything} - {r[0] for r in damage(everything)}
    assert gone  # conversations that lose all rows stay
    assert got(C.repair(spark.createDataFrame(everything, SCHEMA))) == want(everything)


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_hot_conversation_in_blocks(spark, block):
    """One conversation holds most rows: blocks, ties and duplicates meet
    across tasks and give what one pass gives."""
    rnd = random.Random(block)
    rows = [(7, rnd.choice([None, *range(500)]), rnd.choice(["user", "assistant", "system", "tool"]),
             rnd.choice(["", "one.", "two!", "three", f"{rnd.random()}.", f"{rnd.random()}"])) for _ in range(900)]
    rows += [(c, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["a.", "b"])) for c in range(30) for t in range(5)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(C.repaired(undamaged(df), block)) == want(rows, hurt=list)


def test_short_audits_by_trying_all():
    """The cheapest, ASCII-least audit among all strings of edits."""
    def cost_of(codes, audit):
        state, cost, at = "", 0, iter(codes)
        for letter in audit:
            initial, fault = next(at) if letter != "I" else ("", "")
            if letter == "D":
                cost += 4
                continue
            if fault in ("blank", "duplicate"):
                return None
            if letter == "K":
                if (state, initial) not in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                    return None
                state = initial
            else:
                state, cost = "a" if state == "u" else "u", cost + 3
            cost += 3 if fault == "truncated" else 0
        return cost if state in ("", "a") else None

    for codes in itertools.product([("s", ""), ("u", ""), ("a", "truncated"), ("x", ""), ("u", "blank")], repeat=3):
        tried = []
        for inserts in itertools.product(range(3), repeat=4):
            for edits in itertools.product("KRD", repeat=3):
                audit = "".join("I" * n + e for n, e in zip(inserts, (*edits, "")))
                cost = cost_of(codes, audit)
                if cost is not None:
                    tried.append((cost, audit))
        assert C.finish(*C.cheapest(list(codes), C.START)) == min(tried)


def test_ties_survive_hash_collisions(monkeypatch):
    """With a hash that says nothing, audits are compared letter by letter."""
    rnd = random.Random(5)
    codes = [(rnd.choice("suax"), rnd.choice(["", "", "truncated", "blank"])) for _ in range(300)]
    plain = C.finish(*C.cheapest(codes, C.START))
    for prime in (1, 2, 7):
        monkeypatch.setattr(C.AuditTree, "PRIME", prime)
        assert C.finish(*C.cheapest(codes, C.START)) == plain


def test_tree_compares_like_strings():
    rnd = random.Random(1)
    tree = C.AuditTree()
    audits = sorted({"".join(rnd.choice("DIKR") for _ in range(rnd.choice([0, 1, 5, 40]))) for _ in range(60)}
                    | {"K" * n for n in range(40)})
    nodes = [tree.extend(0, a) for a in audits]
    assert [tree.audit(n) for n in nodes] == audits
    for i, x in enumerate(nodes):
        for j, y in enumerate(nodes):
            assert tree.less(x, y) == (i < j)
