"""Conversation structure repair with a persistent audit DP.

A conversation is well formed if the initials of its roles spell
``(s?(ua)+)?``. Every row has at most one fault, the first that holds: *blank*
(only space characters), *duplicate* (role and text seen earlier in the
conversation), *truncated* (the last other character is not ``.``, ``!`` or
``?``). A repair edits the rows in order:

======  =================================================  ====
letter  edit                                               cost
======  =================================================  ====
K       keep; the role's initial must fit                     0
R       give it the role user or assistant                    3
D       delete; required for blank and duplicate rows         4
I       insert a user or assistant row with an empty text     3
======  =================================================  ====

and 3 more for a truncated row that stays. The *audit* is the string of the
cheapest repair's letters; of several the ASCII-least. It fixes the repaired
roles: an R or I takes the role that must come next.

Audit DP. After each row there is one cheapest, ASCII-least audit for every
state (nothing yet, s, u, a). Audits share their prefixes as linked nodes of
a tree (``AuditTree``); a node knows its binary-lifting ancestors and a
rolling hash of its audit. Ties in cost are compared by searching the longest
common prefix over the ancestors' hashes. Equal audits are the same node, so
an equal hash is verified by looking whether the nodes are one; if they are
not (a collision), the audits are spelled out. Audits that end in the same
row at the same cost are never prefixes of one another (the longer one would
hold a further I and cost more), so taking the least per state is right.

Scale. Rows are range-partitioned by (conversation, turn, digest), so a
conversation may span many tasks, and every task reads its rows in order. A
conversation that lies inside a task and is short is one block and finished
there. All others (long ones, and the first and last of a task) are cut into
blocks of at most ``BLOCK_ROWS`` rows and ``BLOCK_BYTES`` bytes; the DP runs
over every block from each of the four states, the 4 x 4 costs of the blocks
are folded per conversation (a handful of numbers a block, backward for the
cheapest completion, forward for the least audit), and the chosen pieces of
audit are joined. What stays serial is the SHA-256 of a conversation's whole
repaired text: its rows are streamed, sorted, through one hasher. Duplicates
in blocks are found by a grouping that keeps the first row of each text.

Defined results. Null roles and texts are one space. Rows are taken by turn,
nulls first; rows of one turn by the SHA-256 of their role and text. A null
conversation id is one conversation. Repeated rows are duplicates. Texts of
any length are read whole. A conversation without rows costs nothing and has
an empty audit. Columns besides the four are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import bound_batches, col, save

BLOCK_ROWS = 1024
BLOCK_BYTES = 8 << 20

SPACE = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
NO_WAY = 1 << 60
# the states' role initials; what an Insert leads to; what Keep leads to
_INSERT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER,
         (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Cost and audit of ending in a state: what completes the last pair.
_END = {START: (0, ""), SYSTEM: (6, "II"), USER: (3, "I"), ASSISTANT: (0, "")}


def _moves(initial: str, fault: str) -> list[list[tuple[int, int, str]]]:
    """For every state reached by a row: (state before, cost, letters) of the
    cheapest, ASCII-least edits that end with the row's own."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for before in range(4):
        at, inserted = before, 0
        seen = set()
        while at not in seen:
            seen.add(at)
            cut = 3 if fault == "truncated" else 0
            edits = [(4, "D", at)]
            if fault not in ("blank", "duplicate"):
                edits.append((3 + cut, "R", _INSERT[at]))
                if (at, initial) in _KEEP:
                    edits.append((cut, "K", _KEEP[at, initial]))
            for cost, letter, after in edits:
                found = (3 * inserted + cost, "I" * inserted + letter)
                if found < best.get((before, after), (NO_WAY, "")):
                    best[before, after] = found
            at, inserted = _INSERT[at], inserted + 1
    return [[(p, *best[p, q]) for p in range(4) if (p, q) in best] for q in range(4)]


_MOVES = {(i, f): _moves(i, f) for i in "sua-" for f in ("", "blank", "truncated")}


def moves(initial: str, fault: str) -> list[list[tuple[int, int, str]]]:
    return _MOVES[initial if initial in ("s", "u", "a") else "-", "blank" if fault == "duplicate" else fault]


class AuditTree:
    """Audits as nodes that share their prefixes. Node 0 is the empty audit."""

    BASE, PRIME = 131, (1 << 61) - 1

    def __init__(self) -> None:
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[]]  # up[n][k]: the ancestor 2^k letters before n
        self.child: dict[tuple[int, str], int] = {}

    def extend(self, node: int, letters: str) -> int:
        for c in letters:
            found = self.child.get((node, c))
            if found is None:
                found = len(self.letter)
                self.child[node, c] = found
                self.letter.append(c)
                self.depth.append(self.depth[node] + 1)
                self.hash.append((self.hash[node] * self.BASE + ord(c)) % self.PRIME)
                up, k = [node], 0
                while k < len(self.up[up[k]]):
                    up.append(self.up[up[k]][k])
                    k += 1
                self.up.append(up)
            node = found
        return node

    def audit(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def _ancestor(self, node: int, depth: int) -> int:
        k = 0
        above = self.depth[node] - depth
        while above:
            if above & 1:
                node = self.up[node][k]
            above >>= 1
            k += 1
        return node

    def less(self, x: int, y: int) -> bool:
        """Whether x's audit is before y's."""
        if x == y:
            return False
        depth = min(self.depth[x], self.depth[y])
        a, b = self._ancestor(x, depth), self._ancestor(y, depth)
        if self.hash[a] == self.hash[b]:
            if a == b:  # one is the other's prefix
                return self.depth[x] < self.depth[y]
            return self.audit(x) < self.audit(y)  # a collision
        # the highest ancestors that differ: above them is the common prefix
        for k in range(len(self.up[a]) - 1, -1, -1):
            if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                a, b = self.up[a][k], self.up[b][k]
        if self.up[a][0] != self.up[b][0]:
            return self.audit(x) < self.audit(y)  # a collision
        return self.letter[a] < self.letter[b]


def cheapest(rows: list[tuple[str, str]], entry: int) -> tuple[AuditTree, list[tuple[int, int]]]:
    """The tree and, for every state after ``rows`` of (initial, fault),
    the (cost, node) of the way there from the state ``entry``."""
    tree = AuditTree()
    layer = [(NO_WAY, 0)] * 4
    layer[entry] = (0, 0)
    for initial, fault in rows:
        after = []
        for ways in moves(initial, fault):
            cost, node, letters = NO_WAY, 0, ""
            for before, step, by in ways:
                c, n = layer[before]
                if c < NO_WAY and (c + step < cost or (c + step == cost and tree.less(n, node))):
                    cost, node, letters = c + step, n, by
            after.append((cost, node, letters))
        layer = [(c, tree.extend(n, by) if c < NO_WAY else 0) for c, n, by in after]
    return tree, layer


def finish(tree: AuditTree, layer: list[tuple[int, int]]) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    best = None
    for state, (cost, node) in enumerate(layer):
        cost += _END[state][0]
        if best is None or cost < best[0] or (cost == best[0] and tree.less(node, best[1])):
            best = (cost, node, state)
    return best[0], tree.audit(best[1]) + _END[best[2]][1]


class Repair:
    """Hashes the repaired rows, fed letter by letter."""

    def __init__(self) -> None:
        self.sha, self.state, self.empty = hashlib.sha256(), START, True

    def edit(self, letter: str, role: str = "", text: str = "") -> None:
        if letter == "D":
            return
        if letter == "K":
            self.state = _KEEP[self.state, role[:1]]
        else:
            self.state = _INSERT[self.state]
            role = _ROLE[self.state]
        self.sha.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False


def fault_of(text: str) -> str:
    """The fault of a row that is no duplicate."""
    bare = text.rstrip(SPACE)
    return "blank" if not bare else "" if bare[-1] in ".!?" else "truncated"


def damaged(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows after damage by ``crc32(conv:turn) % 20``, with ``gone`` set
    on dropped ones: conv, turn, role, text, copy, gone."""
    def plain(c):
        return F.coalesce(col(c).cast("string"), F.lit(" "))
    return (rows.select(col(conv).alias("conv"), col(turn).alias("turn"), plain(role).alias("role"),
                        plain(text).alias("text"),
                        (F.crc32(F.concat(plain(conv), F.lit(":"), plain(turn))) % 20).alias("kind"))
            .select("conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind").isin(0, 1), "").when(
                        F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    (F.col("kind") == 0).alias("gone"),
                    F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1)))
                              .otherwise(F.array(F.lit(0)))).alias("copy")))


_ROW = ["conv", "turn", "digest", "id", "copy", "role", "text", "gone"]
_RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _gaps(turns: list) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def _whole(rows: list[dict]) -> dict:
    """The result of a conversation whose rows are all there, in order."""
    rows = [r for r in rows if not r["gone"]]
    seen, faults = set(), []
    for r in rows:
        fault = fault_of(r["text"])
        faults.append("duplicate" if fault != "blank" and r["digest"] in seen else fault)
        seen.add(r["digest"])
    initials = [r["role"][:1] for r in rows]
    cost, audit = finish(*cheapest(list(zip(initials, faults)), START))
    repair, ahead = Repair(), iter(rows)
    for letter in audit:
        if letter == "I":
            repair.edit(letter)
        else:
            r = next(ahead)
            repair.edit(letter, r["role"], r["text"])
    return {"gaps": _gaps([r["turn"] for r in rows]),
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": _illegal(initials), "cost": cost, "audit": audit,
            "repaired_sha256": repair.sha.hexdigest()}


def _out(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _short_or_blocks(schema: pa.Schema, block_rows: int):
    """Results of the conversations that are whole here and short; the rows
    of the others, with their block (the id and copy of its first row)."""
    def run(batches):
        first, held, size, block = True, [], 0, None
        current = object()

        def spill():
            nonlocal block, held, size
            block = (held[0]["id"], held[0]["copy"])
            out = [dict(r, block=block[0], block_copy=block[1]) for r in held]
            held, size = [], 0
            return _out(out, schema)

        long = True  # the first conversation of a task may have begun before
        results = []
        for batch in batches:
            for r in batch.to_pylist():
                if first or r["conv"] != current:
                    if not first and not long:
                        results.append(dict(_whole(held), conv=current))
                        held, size = [], 0
                    elif held:
                        yield from spill()
                    long, current, first = first, r["conv"], False
                held.append(r)
                size += len(r["text"]) + 64
                if len(held) >= block_rows or size >= BLOCK_BYTES:
                    long = True
                    yield from spill()
            yield from _out(results, schema)
            results = []
        if held:  # the last one may go on elsewhere
            yield from spill()
    return run


def _blocks(schema: pa.Schema):
    """Per block of sorted rows: costs, ranks and audits of the ways from
    each state to each other (16 of each), and the block's counts."""
    def summary(rows: list[dict]) -> dict:
        codes = [(r["role"][:1], r["fault"]) for r in rows]
        costs, ranks, audits = [], [], []
        for entry in range(4):
            tree, layer = cheapest(codes, entry)
            ways = [tree.audit(n) if c < NO_WAY else "" for c, n in layer]
            order = sorted(range(4), key=lambda q: ways[q])
            costs += [c for c, _ in layer]
            ranks += [order.index(q) for q in range(4)]
            audits += ways
        initials = [c[0] for c in codes]
        counts = [c[1] for c in codes]
        head = rows[0]
        return {**{k: head[k] for k in ("conv", "turn", "digest", "id", "copy")},
                "costs": costs, "ranks": ranks, "audits": audits, "first": initials[0],
                "last": initials[-1], "illegal": _illegal(initials),
                **{f: counts.count(f) for f in ("blank", "duplicate", "truncated")}}

    def run(batches):
        held, block = [], None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if (r["block"], r["block_copy"]) != block and held:
                    out.append(summary(held))
                    held = []
                block = (r["block"], r["block_copy"])
                held.append(r)
            yield from _out(out, schema)
        if held:
            yield from _out([summary(held)], schema)
    return run


def _fold(schema: pa.Schema):
    """Per conversation of sorted block summaries (numbers only): the way
    taken through each block and, on its first block, the totals."""
    def fold(blocks: list[dict]) -> list[dict]:
        left = [_END[q][0] for q in range(4)]  # the least cost after a block
        after = []
        for b in reversed(blocks):
            after.append(left)
            left = [min(b["costs"][4 * e + q] + left[q] for q in range(4)) for e in range(4)]
        after.reverse()
        entry, out = START, []
        for b, rest in zip(blocks, after):
            ways = [(b["costs"][4 * entry + q] + rest[q], b["ranks"][4 * entry + q], q) for q in range(4)]
            out.append({"id": b["id"], "copy": b["copy"], "conv": b["conv"], "way": 4 * entry + min(ways)[2]})
            entry = min(ways)[2]
        totals = {f: sum(b[f] for b in blocks) for f in ("blank", "duplicate", "truncated", "illegal")}
        totals["illegal"] += sum(_illegal([a["last"], b["first"]]) for a, b in zip(blocks, blocks[1:]))
        out[0] |= totals | {"cost": left[START]}
        out[-1]["tail"] = _END[entry][1]
        return out

    def run(batches):
        held = []
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if held and held[0]["conv"] != r["conv"]:
                    out += fold(held)
                    held = []
                held.append(r)
            yield from _out(out, schema)
        if held:
            yield from _out(fold(held), schema)
    return run


def _hashes(schema: pa.Schema):
    """Per conversation: the SHA-256 of its repaired rows, from its pieces of
    audit (``piece``, before the rows they are for) and rows in order."""
    def run(batches):
        repair, letters, current, first = Repair(), iter(""), None, True

        def inserts_until_row():
            for letter in letters:
                if letter != "I":
                    return letter
                repair.edit(letter)

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if not first and r["conv"] != current:
                    inserts_until_row()
                    out.append({"conv": current, "repaired_sha256": repair.sha.hexdigest()})
                    repair, letters = Repair(), iter("")
                first, current = False, r["conv"]
                if r["piece"] is not None:
                    inserts_until_row()
                    letters = iter(r["piece"])
                else:
                    repair.edit(inserts_until_row(), r["role"], r["text"])
            yield from _out(out, schema)
        if not first:
            inserts_until_row()
            yield from _out([{"conv": current, "repaired_sha256": repair.sha.hexdigest()}], schema)
    return run


_ORDER = ["conv", "turn", "digest", "id", "copy"]


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """One row per distinct ``conv`` of the damaged table: conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    return repaired(damaged(conversations, conv, turn, role, text))


def repaired(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The same for rows as ``damaged`` gives them; of rows marked ``gone``
    only the conversation counts."""
    spark = rows.sparkSession
    bound_batches(spark)
    rows = rows.withColumn("id", F.monotonically_increasing_id()).withColumn("digest", F.substring(F.unhex(F.sha2(
        F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)), 1, 16))
    conv_t, turn_t = rows.schema["conv"].dataType, rows.schema["turn"].dataType
    key = [T.StructField("conv", conv_t), T.StructField("turn", turn_t), T.StructField("digest", T.BinaryType()),
           T.StructField("id", T.LongType()), T.StructField("copy", T.IntegerType())]
    counts = [T.StructField(c, T.LongType()) for c in ("blank", "duplicate", "truncated", "illegal")]

    full = T.StructType([*key, *[T.StructField(c, T.StringType()) for c in ("role", "text")],
                         T.StructField("gone", T.BooleanType()), T.StructField("block", T.LongType()),
                         T.StructField("block_copy", T.IntegerType()), T.StructField("gaps", T.LongType()), *counts,
                         T.StructField("cost", T.LongType()),
                         T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    ranged = (rows.select(*_ROW).repartitionByRange("conv", "turn", "digest", "id")
              .sortWithinPartitions(*_ORDER))
    parts = save(ranged.mapInArrow(_short_or_blocks(_arrow(full), block_rows), full), "repair-parts")
    short = parts.where("block is null").select("conv", *_RESULT)
    long = parts.where("block is not null").select(*_ROW, "block", "block_copy")

    place = F.struct(F.col("turn").isNotNull(), "turn", "id", "copy")
    firsts = (long.where("not gone").groupBy("conv", "digest")
              .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
              .select(F.col("conv").alias("f_conv"), F.col("digest").alias("f_digest"), "first"))
    bare = F.rtrim(F.translate("text", SPACE, " " * len(SPACE)))
    marked = (long.where("not gone")
              .join(firsts, F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("digest") == F.col("f_digest")), "left")
              .withColumn("fault", F.when(bare == "", "blank").when(place != F.col("first"), "duplicate")
                          .when(F.substring(bare, -1, 1).isin(".", "!", "?"), "").otherwise("truncated")))
    block_schema = T.StructType([
        *key, T.StructField("costs", T.ArrayType(T.LongType())), T.StructField("ranks", T.ArrayType(T.IntegerType())),
        T.StructField("audits", T.ArrayType(T.StringType())), T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()), *counts])
    blocks = save(marked.select(*_ORDER, "role", "fault", "block", "block_copy")
                  .repartition("block", "block_copy").sortWithinPartitions("block", "block_copy", *_ORDER)
                  .mapInArrow(_blocks(_arrow(block_schema)), block_schema), "repair-blocks")
    fold_schema = T.StructType([key[0], *key[3:], T.StructField("way", T.IntegerType()), *counts,
                                T.StructField("cost", T.LongType()), T.StructField("tail", T.StringType())])
    ways = (blocks.drop("audits").repartition("conv").sortWithinPartitions(*_ORDER)
            .mapInArrow(_fold(_arrow(fold_schema)), fold_schema)
            .select(F.col("id").alias("w_id"), F.col("copy").alias("w_copy"), "way",
                    *[F.col(c.name).alias(f"w_{c.name}") for c in counts], "cost", "tail"))
    pieces = save(blocks.select(*_ORDER, "audits")
                  .join(ways, (F.col("id") == F.col("w_id")) & (F.col("copy") == F.col("w_copy")))
                  .select(*_ORDER, *[F.col(f"w_{c.name}").alias(c.name) for c in counts], "cost",
                          F.concat(F.get("audits", "way"), F.coalesce("tail", F.lit(""))).alias("piece")),
                  "repair-pieces")
    audits = pieces.groupBy("conv").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(
            F.struct(F.col("turn").isNotNull().alias("has"), "turn", "digest", "id", "copy", "piece"))),
            lambda p: p["piece"]), "").alias("audit"),
        *[F.max(c.name).alias(c.name) for c in counts], F.max("cost").alias("cost"))
    hash_schema = T.StructType([key[0], T.StructField("repaired_sha256", T.StringType())])
    none = F.lit(None).cast("string")
    stream = (long.where("not gone").select(*_ORDER, F.lit(1).alias("kind"), "role", "text", none.alias("piece"))
              .unionAll(pieces.select(*_ORDER, F.lit(0), none, none, "piece")))
    hashes = (stream.repartition("conv").sortWithinPartitions(*_ORDER, "kind")
              .mapInArrow(_hashes(_arrow(hash_schema)), hash_schema)
              .select(F.col("conv").alias("h_conv"), "repaired_sha256"))
    turns = (long.groupBy("conv").agg(
        F.min(F.when(~F.col("gone"), F.col("turn"))).alias("least"),
        F.max(F.when(~F.col("gone"), F.col("turn"))).alias("most"),
        F.count_distinct(F.when(~F.col("gone"), F.col("turn"))).alias("n"))
        .select(F.col("conv").alias("t_conv"),
                F.coalesce(F.col("most") - F.col("least") + 1 - F.col("n"), F.lit(0)).cast("long").alias("gaps")))
    zero = F.lit(0).cast("long")
    whole = (turns.join(audits, F.col("t_conv").eqNullSafe(F.col("conv")), "left").drop("conv")
             .join(hashes, F.col("t_conv").eqNullSafe(F.col("h_conv")), "left")
             .select(F.col("t_conv").alias("conv"), "gaps",
                     *[F.coalesce(c, zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
                     F.coalesce("audit", F.lit("")).alias("audit"),
                     F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))
    return short.unionAll(whole).withColumnRenamed("conv", "conv_id")
