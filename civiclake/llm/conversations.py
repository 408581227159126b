"""Conversation structure repair: the cheapest edits that give a conversation legal roles, by a persistent audit DP.

A repaired conversation is empty, or an optional system row and then pairs of a user and an assistant row. Edits are
Keep (0), Rerole to user or assistant (2), Delete (3; the only edit of blank and of duplicate rows) and Insert of an
empty user or assistant row (2); a truncated row that stays adds 1. The audit is the initials of the edits in order;
of the cheapest ones the least in ASCII order counts. Since the state reached says which role an edit makes, an audit
determines its repair.

Method. Four states (nothing yet, after system, after user, after assistant) are carried over the rows, each with its
least cost and audit. Audits are linked nodes that share their prefixes; a node knows its depth, a rolling hash
modulo a prime and its ancestors at the powers of two. Equal costs are decided at the longest common prefix, which
is searched by lifting both nodes while their hashes differ; equal hashes of different nodes are compared letter by
letter. Two audits of one state never extend one another, so the least prefix stays least.

Spark's part. Equal rows of a turn are counted first; blank, duplicate and truncated rows are marked with
aggregations, and rows get their position in the conversation from ranges that divide a long one. Blocks of
BLOCK rows are solved by themselves: a conversation of one block from the empty state, others from every state,
after which their few results are chained. Texts join only for the digest of the repaired rows, a stream in
order; a SHA-256 cannot be taken in parts, so one conversation's digest is one task's stream, never held.

Contract. Rows of a conversation follow turn, nulls first, then role and the SHA-256 of the text. Null roles and
texts are one space. A null conv_id is a conversation. A role is known by its first character; an empty role cannot
be kept. Repeated rows are duplicates. Texts of any length are judged whole. An empty table has an empty result.
Columns beyond the named ones are ignored. Gaps end at the largest long. An audit is one value, at most 2 GB.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm.common import BATCH_BYTES, BATCH_ROWS, materialise, small_batches, table
from civiclake.operators.ordering import grouped_position

#: Rows that one task solves at once.
BLOCK = 4096
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
_PRIME, _BASE = (1 << 61) - 1, 0x1D8B4F3A6C2E9751 % ((1 << 61) - 1)
#: What a state may go on with: the initial and the state it leads to.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The state that a made row leads to; a made row is a user row unless the last one was.
_MADE = (2, 2, 3, 2)
_ROLES = {2: "user", 3: "assistant"}
_LEGAL = ("su", "ua", "au")
#: A row that no edit but Delete fits: (initial, truncated, times).
Step = tuple[str | None, bool, int]


class Audits:
    """Strings of edit initials as linked nodes; node 0 is the empty one."""

    def __init__(self):
        self.letter, self.parent, self.depth, self.hash = [""], [0], [0], [0]
        self.up: list[list[int]] = [[]]  # ancestors at distances 1, 2, 4, ...

    def add(self, node: int, letter: str) -> int:
        ups, at, k = [node], node, 0
        while len(self.up[at]) > k:
            at = self.up[at][k]
            ups.append(at)
            k += 1
        self.letter.append(letter)
        self.parent.append(node)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * _BASE + ord(letter)) % _PRIME)
        self.up.append(ups)
        return len(self.letter) - 1

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.parent[node]
        return "".join(reversed(out))

    def _lift(self, node: int, depth: int) -> int:
        while (rise := self.depth[node] - depth) > 0:
            node = self.up[node][rise.bit_length() - 1]
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth hold one string, letter by letter up to their common node."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.parent[a], self.parent[b]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether a's string sorts before b's."""
        x, y = self._lift(a, self.depth[b]), self._lift(b, self.depth[a])
        if x == y or (self.hash[x] == self.hash[y] and self.same(x, y)):
            return self.depth[a] < self.depth[b]
        if self.hash[x] == self.hash[y]:
            return self.text(x) < self.text(y)  # a collision
        for k in reversed(range(len(self.up[x]))):
            if k < len(self.up[x]):
                p, q = self.up[x][k], self.up[y][k]
                if p != q and self.hash[p] != self.hash[q]:
                    x, y = p, q
        if self.same(self.parent[x], self.parent[y]):
            return self.letter[x] < self.letter[y]
        return self.text(x) < self.text(y)  # a collision


def solve(steps: list[Step], start: int = 0) -> dict[int, tuple[int, str]]:
    """Least cost and audit of each state that can be reached from ``start`` over the steps."""
    audits = Audits()
    now: dict[int, tuple[int, int]] = {start: (0, 0)}

    def offer(to: dict[int, tuple[int, int]], state: int, cost: int, node: int, letter: str) -> bool:
        held = to.get(state)
        if held is not None and held[0] < cost:
            return False
        made = audits.add(node, letter)
        if held is None or cost < held[0] or audits.less(made, held[1]):
            to[state] = cost, made
            return True
        return False

    def insert() -> None:
        fresh = list(now)
        while fresh:
            fresh = [_MADE[s] for s in fresh if offer(now, _MADE[s], now[s][0] + INSERT, now[s][1], "I")]

    for initial, truncated, times in steps:
        insert()
        after: dict[int, tuple[int, int]] = {}
        for state, (cost, node) in now.items():
            offer(after, state, cost + DELETE * times, node, "D")
            if initial is not None:
                stays = cost + TRUNCATED * truncated
                if initial in _NEXT[state]:
                    offer(after, _NEXT[state][initial], stays, node, "K")
                offer(after, _MADE[state], stays + REROLE, node, "R")
        now = after
    insert()
    counts = [times for *_, times in steps]

    def spelt(node: int) -> str:
        out, row = [], 0
        for letter in audits.text(node):
            out.append(letter * (1 if letter == "I" else counts[row]))
            row += letter != "I"
        return "".join(out)

    return {state: (cost, spelt(node)) for state, (cost, node) in now.items()}


def steps_of(rows: list[tuple[str, bool, bool, int]]) -> list[Step]:
    """Steps of rows (role, goes, truncated, times): a row that stays is followed by the deletion of its copies."""
    out: list[Step] = []
    for role, goes, truncated, times in rows:
        if not goes:
            out.append((role[:1] or "", truncated, 1))
        if times > (not goes):
            out.append((None, False, times - (not goes)))
    return out


def illegal_pairs(rows: list[tuple[str, bool, bool, int]], before: str | None = None) -> int:
    """Adjacent rows whose initials are not a legal pair; ``before`` is the role ahead of the first row."""
    count = 0
    for role, *_, times in rows:
        count += times - 1
        count += before is not None and before[:1] + role[:1] not in _LEGAL
        before = role
    return count


class _Chain:
    """An audit made of the strings of blocks, linked backwards."""

    __slots__ = ("before", "text")

    def __init__(self, before: _Chain | None, text: str):
        self.before, self.text = before, text

    def less(self, other: _Chain) -> bool:
        a, b = [], []
        x, y = self, other
        while x is not y:  # both have a link for each block
            a.append(x.text)
            b.append(y.text)
            x, y = x.before, y.before
        return "".join(reversed(a)) < "".join(reversed(b))

    def spelt(self) -> str:
        out, x = [], self
        while x is not None:
            out.append(x.text)
            x = x.before
        return "".join(reversed(out))


def chained(blocks: list[dict[int, dict[int, tuple[int, str]]]]) -> tuple[int, str]:
    """Cost and audit over blocks, each given as results by first and last state."""
    now: dict[int, tuple[int, _Chain]] = {0: (0, _Chain(None, ""))}
    for block in blocks:
        after: dict[int, tuple[int, _Chain]] = {}
        for state, (cost, chain) in now.items():
            for last, (more, text) in block[state].items():
                link = _Chain(chain, text)
                held = after.get(last)
                if held is None or cost + more < held[0] or (cost + more == held[0] and link.less(held[1])):
                    after[last] = cost + more, link
        now = after
    cost, chain = min((now[s][0] for s in (0, 3) if s in now)), None
    for state in (0, 3):
        if state in now and now[state][0] == cost and (chain is None or now[state][1].less(chain)):
            chain = now[state][1]
    return cost, chain.spelt()


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of rows that agree in their first ``keys`` columns, from sorted batches; the rows come as a stream."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    row = next(rows, None)
    while row is not None:
        key = row[:keys]

        def own() -> Iterator[tuple]:
            nonlocal row
            while row is not None and row[:keys] == key:
                yield row[keys:]
                row = next(rows, None)

        stream = own()
        yield key, stream
        for _ in stream:  # what the reader has left
            pass


def batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of rows, bounded in number and in letters."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


_LONG, _TEXT = pa.int64(), pa.string()
_BLOCKS = pa.schema([("conv_id", _LONG), ("block", _LONG), ("first", _LONG), ("last", _LONG), ("cost", _LONG), ("audit", _TEXT), ("illegal", _LONG), ("opens", _TEXT), ("closes", _TEXT)])
_AUDITS = pa.schema([("conv_id", _LONG), ("illegal", _LONG), ("cost", _LONG), ("audit", _TEXT)])
_DIGESTS = pa.schema([("conv_id", _LONG), ("repaired_sha256", _TEXT)])


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Results of sorted rows (conv_id, block, place, role, goes, truncated, times)."""
    for (conv_id, number), stream in runs(batches, 2):
        held = [row[1:] for row in stream]
        pairs = illegal_pairs(held)
        steps = steps_of(held)
        for first in range(4) if number else (0,):
            for last, (cost, audit) in solve(steps, first).items():
                yield conv_id, number, first, last, cost, audit, pairs, held[0][0], held[-1][0]


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Audits of conversations from the sorted results of their blocks."""
    for (conv_id,), stream in runs(batches, 1):
        found: list[dict[int, dict[int, tuple[int, str]]]] = []
        illegal, before, number = 0, None, -1
        for at, first, last, cost, audit, pairs, opens, closes in stream:
            if at != number:
                number = at
                found.append({})
                illegal += pairs + (before is not None and before[:1] + opens[:1] not in _LEGAL)
                before = closes
            found[-1].setdefault(first, {})[last] = cost, audit
        yield conv_id, illegal, *chained(found)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Digests from sorted rows (conv_id, place, audit, role, goes, times, text); a conversation's audit comes first."""
    for (conv_id,), stream in runs(batches, 1):
        audit = next(stream)[1]
        digest, state, opened, at = hashlib.sha256(), 0, False, 0

        def put(role: str, text: str) -> None:
            nonlocal opened
            digest.update((("\n" if opened else "") + f"{role}:{text}").encode())
            opened = True

        def inserted() -> None:
            nonlocal at, state
            while audit[at: at + 1] == "I":
                state = _MADE[state]
                put(_ROLES[state], "")
                at += 1

        for _, _, role, goes, times, text in stream:
            inserted()
            if not goes:
                letter = audit[at]
                if letter == "K":
                    state = _NEXT[state][role[:1]]
                    put(role, text)
                elif letter == "R":
                    state = _MADE[state]
                    put(_ROLES[state], text)
                at += 1
                if times > 1:
                    inserted()
            at += times - (not goes)
        inserted()
        yield conv_id, digest.hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32 of conv_id and turn brings on each row."""
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.withColumn("fate", F.crc32(key) % 20).where("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def marked(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, digest) with ``times``, whether they are ``blank``, whether they have been
    ``seen`` in an earlier turn and whether they are ``truncated``."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    thin = rows.select("conv_id", "turn", "role", F.sha2("text", 256).alias("digest"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"))
    counted = thin.groupBy("conv_id", "turn", "role", "digest").agg(F.count("*").alias("times"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    # The first turn of a text; Spark splits a skewed side of this join.
    first = counted.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(F.min(turn).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    return counted.join(first, same).select("conv_id", "turn", "role", "digest", "times", "blank", (turn != F.col("first")).alias("seen"), "truncated")


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    ``rows`` (conv_id, turn, role, text) are taken as they are; see :func:`damaged`."""
    small_batches(rows.sparkSession)
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    marks = materialise(marked(rows), "marked-rows")
    placed = grouped_position(marks, ["conv_id"], ["turn", "role", "digest"], position="place", group_size="size")
    placed = materialise(placed, "conversations")  # read for the counts, the blocks and the texts
    goes = F.col("blank") | F.col("seen")
    fresh = F.col("times") - F.when(F.col("seen"), 0).otherwise(1)
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    turns = placed.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("times")).otherwise(0)).alias("blank"), F.sum(F.when(F.col("blank"), 0).otherwise(fresh)).alias("duplicate"),
        F.sum(F.when(~goes & F.col("truncated"), 1).otherwise(0)).alias("truncated"))
    counts = turns.groupBy("conv_id").agg(
        F.when(F.count("turn") > 0, F.least(F.max(wide("turn")) - F.min(wide("turn")) + 1 - F.count("turn"), F.lit((1 << 63) - 1))).otherwise(0).cast("long").alias("gaps"),
        *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")])

    number = F.when(F.col("size") > block, F.call_function("div", F.col("place") - 1, F.lit(block)) + 1).otherwise(F.lit(0)).cast("long")
    dealt = placed.select("conv_id", number.alias("block"), "place", "role", goes.alias("goes"), "truncated", "times")
    dealt = dealt.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "place")
    solved = dealt.mapInArrow(lambda batches: batched(_solved(batches), _BLOCKS), "conv_id long, block long, first long, last long, cost long, audit string, illegal long, opens string, closes string")
    audits = solved.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(lambda batches: batched(_chained(batches), _AUDITS), "conv_id long, illegal long, cost long, audit string")
    audits = materialise(audits, "audits")

    keys = ["conv_id", "turn", "role", "digest"]
    texts = rows.withColumn("digest", F.sha2("text", 256)).groupBy(*[F.col(k).alias(f"t_{k}") for k in keys]).agg(F.first("text").alias("text"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"t_{k}"))
    full = placed.select(*keys, "place", goes.alias("goes"), "times").join(texts, same)
    full = full.select("conv_id", "place", F.lit(None).cast("string").alias("audit"), "role", "goes", "times", F.when(~F.col("goes"), F.col("text")).alias("text"))
    head = audits.select("conv_id", F.lit(0).cast("long").alias("place"), "audit", F.lit("").alias("role"), F.lit(True).alias("goes"), F.lit(0).cast("long").alias("times"), F.lit(None).cast("string").alias("text"))
    hashed = head.unionByName(full).repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(lambda batches: batched(_digested(batches), _DIGESTS), "conv_id long, repaired_sha256 string")

    out = counts
    for k, part in enumerate((audits, hashed)):
        part = part.withColumnRenamed("conv_id", f"c{k}")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col(f"c{k}"))).drop(f"c{k}")
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit and repair of every conversation after the damage; one without rows left is empty."""
    rows = table(spark, sf_dir, "conversations")
    made = repair(damaged(rows)).withColumnRenamed("conv_id", "c")
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    longs = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(made, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", *longs, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
