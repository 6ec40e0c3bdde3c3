"""Conversation repair by a shortest-edit audit over role patterns.

Rows (conv_id, turn, role, text) are taken by turn. A row's first fault counts:
blank, duplicate (role and text stand earlier), truncated. Edits keep a row,
give it the role that the pattern wants, delete it or insert an empty one, so
that the role initials come to ``(s?(ua)+)?`` at the least cost; of equals, the
audit whose letters are least in ASCII wins.

The pattern has four states, so a run of rows acts as a map from state to state.
Rows are dealt by ranges of (conv_id, turn, role, text) and cut into blocks;
each block gives its map, and a conversation folds the maps of its blocks in
order. A conversation of any length is thus shared by many tasks, and a task
holds one block at a time. Only ``repair_digests`` runs through a conversation's
repaired lines in one task, a block at a time, as SHA-256 can't be split.

Within a block, audits that are alive share their prefixes: an audit is a node
that names its last letter and the node before it, with ancestors at distances
of powers of two and a rolling hash. Ties are told by a search for the longest
common prefix over these; a prefix found equal by hash is verified node by node.
Given the start state, an audit's letters fix its path, so equal audits are one
path, none of equal cost is a prefix of another, and ties told in a block stay
told in all that follow.

Defined results: a null role or text is one space; rows of a null turn come
first; rows of one turn go by role, then text; a null conv_id is a conversation;
rows that repeat are repeats like others; a conversation without rows has an
empty audit at no cost. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from trendloom.llm.common import sorted_groups, stage

#: Rows and characters of text after which a block ends.
BLOCK_ROWS, BLOCK_CHARS = 1024, 1 << 20
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
# Costs of the edits, and what a truncated row adds that isn't deleted.
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
#: States of the pattern: nothing yet, after s, after u, after a. START stands for a conversation's begin.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
START = -1
#: The state that a user or assistant row leads to from each state, and its role.
ONWARD = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
MOD, BASE = (1 << 61) - 1, 911_382_323


class Trails:
    """Audits as linked nodes; node 0 is the empty audit."""

    def __init__(self):
        self.letter, self.up, self.hash, self.depth = [""], [[]], [0], [0]

    def add(self, parent: int, letter: str) -> int:
        node = len(self.letter)
        up, k = [parent], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.letter.append(letter)
        self.up.append(up)
        self.hash.append((self.hash[parent] * BASE + ord(letter)) % MOD)
        self.depth.append(self.depth[parent] + 1)
        return node

    def lift(self, node: int, depth: int) -> int:
        gap = self.depth[node] - depth
        while gap:
            k = gap.bit_length() - 1
            node = self.up[node][k]
            gap -= 1 << k
        return node

    def spell(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def same(self, x: int, y: int) -> bool:
        """Whether two nodes of equal depth spell the same audit."""
        while x != y:
            if self.letter[x] != self.letter[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True

    def less(self, x: int, y: int) -> bool:
        """Whether the audit of ``x`` comes before that of ``y``."""
        if x == y:
            return False
        depth = min(self.depth[x], self.depth[y])
        a, b = self.lift(x, depth), self.lift(y, depth)
        if self.hash[a] == self.hash[b]:
            if self.same(a, b):
                return self.depth[x] < self.depth[y]
            return self.spell(x) < self.spell(y)
        for k in range(len(self.up[a]) - 1, -1, -1):
            if k < len(self.up[a]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                a, b = self.up[a][k], self.up[b][k]
        if self.letter[a] == self.letter[b] or not self.same(self.up[a][0], self.up[b][0]):
            return self.spell(x) < self.spell(y)  # the hash has lied
        return self.letter[a] < self.letter[b]


class Repair:
    """The map of a run of rows from one start: by end state, the cheapest audit."""

    def __init__(self, start: int):
        self.trails = Trails()
        self.live: dict[int, tuple[int, int]] = {NOTHING if start == START else start: (0, 0)}
        if start == START:
            self.insert()

    def offer(self, to: dict[int, tuple[int, int]], state: int, cost: int, parent: int, letter: str) -> None:
        held = to.get(state)
        if held is None or cost < held[0]:
            to[state] = (cost, self.trails.add(parent, letter))
        elif cost == held[0]:
            node = self.trails.add(parent, letter)
            if self.trails.less(node, held[1]):
                to[state] = (cost, node)

    def insert(self) -> None:
        """Rows put in after the last row; two at most can pay."""
        for frm in ((NOTHING, SYSTEM, ASSISTANT), (USER,)):
            for state in frm:
                if state in self.live:
                    cost, node = self.live[state]
                    self.offer(self.live, ONWARD[state], cost + INSERT_COST, node, INSERT)

    def row(self, initial: str, fault: str) -> None:
        out: dict[int, tuple[int, int]] = {}
        more = TRUNCATED_COST if fault == "truncated" else 0
        for state, (cost, node) in self.live.items():
            self.offer(out, state, cost + DELETE_COST, node, DELETE)
            if fault in ("blank", "duplicate"):
                continue
            to = ONWARD[state]
            if initial == ROLE[to][0]:
                self.offer(out, to, cost + more, node, KEEP)
            elif initial == "s" and state == NOTHING:
                self.offer(out, SYSTEM, cost + more, node, KEEP)
            self.offer(out, to, cost + REROLE_COST + more, node, REROLE)
        self.live = out
        self.insert()

    def paths(self, start: int) -> list[dict]:
        return [{"start": start, "end": s, "cost": c, "audit": self.trails.spell(n)} for s, (c, n) in self.live.items()]


def apply_edits(audit: str, state: int, roles: list[str], texts: list[str]) -> list[tuple[str, str]]:
    """The repaired rows of a block whose audit begins in ``state``."""
    out, at = [], 0
    state = NOTHING if state == START else state
    for edit in audit:
        if edit == INSERT:
            state = ONWARD[state]
            out.append((ROLE[state], ""))
            continue
        role, text = roles[at], texts[at]
        at += 1
        if edit == DELETE:
            continue
        if edit == KEEP and role[:1] == "s":
            state = SYSTEM
        else:
            state = ONWARD[state]
        out.append((role if edit == KEEP else ROLE[state], text))
    return out


def damage(rows: DataFrame) -> DataFrame:
    """Planted faults, by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text,
    2 takes out its sentence ends, 3 repeats it, 4 makes it the user's."""
    role, text, blank = F.coalesce(F.col("role"), F.lit(" ")), F.coalesce(F.col("text"), F.lit(" ")), F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("kind"))
    changed = rows.where("kind != 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).alias("times"),
    )
    return changed.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(1), F.col("times")))).drop("col")


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n (equal rows of a turn), fault of the first of them."""
    space, text = F.lit(" "), F.col("text")
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), space).alias("role"), F.coalesce(text, space).alias("text"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    key = F.sha2(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"), F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = rows.withColumn("key", key)
    first = F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn")).alias("first")
    again = rows.groupBy("key").agg(F.count("*").alias("turns"), first).where("turns > 1").select("key", "first")
    rows = rows.join(again, "key", "left")
    bare = F.translate(text, " \t\n\x0b\x0c\r", "")
    later = F.coalesce(F.struct(F.col("turn").isNotNull().alias("has"), "turn") > F.col("first"), F.lit(False))
    fault = F.when(bare == "", "blank").when(later, "duplicate").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")
    return rows.select("conv_id", "turn", "role", "text", "n", fault.alias("fault"))


STATS = "n long, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long"
BLOCKS = f"conv_id long, part int, block long, {STATS}, paths array<struct<start:int,end:int,cost:long,audit:string>>, roles array<string>, texts array<string>"


class _Block:
    """A run of rows of one conversation."""

    def __init__(self, conv, starts: Iterable[int]):
        self.conv, self.repairs = conv, {s: Repair(s) for s in starts}
        self.roles, self.texts, self.counts = [], [], {"": 0, "blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.chars = self.turns = 0
        self.low = self.high = None

    def add(self, turn, role: str, text: str, fault: str) -> None:
        if self.roles and self.roles[-1][:1] + role[:1] not in LEGAL:
            self.illegal += 1
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.counts[fault] += 1
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)
        for r in self.repairs.values():
            r.row(role[:1], fault)

    def row(self, part: int, block: int) -> dict:
        c = self.counts
        paths = [p for s, r in self.repairs.items() for p in r.paths(s)]
        return {
            "conv_id": self.conv, "part": part, "block": block, "n": len(self.roles), "blank": c["blank"], "duplicate": c["duplicate"], "truncated": c["truncated"],
            "illegal": self.illegal, "first": self.roles[0][:1], "last": self.roles[-1][:1], "low": self.low, "high": self.high, "turns": self.turns,
            "paths": paths, "roles": self.roles, "texts": self.texts,
        }


def blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The blocks of all conversations, in order of (part, block), with their maps."""
    arrow = to_arrow_schema(StructType.fromDDL(BLOCKS))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc()]
    # written, as the ranges' sample reads it once more; by the begin of a text only, so that long texts don't go into the sample
    dealt = stage(faults(rows), "conversation-faults").repartitionByRange(*order, F.substring("text", 1, 64).asc()).sortWithinPartitions(*order, F.col("text").asc())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, out, size = TaskContext.get().partitionId(), 0, [], 0
        now, only = None, True  # whether the first conversation, which may begin in an earlier part, goes on

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(out, schema=arrow)

        for b in batches:
            for conv, turn, role, text, n, fault in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for copy in range(n):
                    if now is not None and (conv != now.conv or len(now.roles) >= block_rows or now.chars >= BLOCK_CHARS):
                        out.append(now.row(part, number))
                        number, size = number + 1, size + now.chars + 64 * len(now.roles)
                        if conv != now.conv:
                            only = False
                            now = _Block(conv, [START])
                        else:
                            now = _Block(conv, range(4))
                    elif now is None:
                        now = _Block(conv, [START, *range(4)] if only else [START])
                    now.add(turn, role, text, fault if not copy else "blank" if fault == "blank" else "duplicate")
                if size > BLOCK_CHARS:
                    yield flush()
                    out, size = [], 0
        if now is not None:
            out.append(now.row(part, number))
        if out:
            yield flush()

    return stage(dealt.mapInArrow(run, BLOCKS), "conversation-blocks")


AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(blocked: DataFrame) -> DataFrame:
    """For each conversation its counts, cost and audit, and the audit of each of its blocks."""

    def fold(key, rows):
        total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        low = high = last = None
        held: dict[int, tuple[int, tuple | None]] = {START: (0, None)}
        for part, block, _, blank, duplicate, truncated, illegal, first, final, lo, hi, turns, paths in rows:
            total["blank"] += blank
            total["duplicate"] += duplicate
            total["truncated"] += truncated
            total["illegal"] += illegal + (last is not None and last + first not in LEGAL)
            total["turns"] += turns - (lo is not None and lo == high)
            low, high, last = lo if low is None else low, hi if hi is not None else high, final
            onward: dict[int, tuple[int, tuple | None]] = {}
            for p in paths:
                if p["start"] not in held:
                    continue
                cost, before = held[p["start"]]
                new = (cost + p["cost"], (before, part, block, p["start"], p["audit"]))
                old = onward.get(p["end"])
                if old is None or new[0] < old[0] or new[0] == old[0] and _earlier(new[1], old[1]):
                    onward[p["end"]] = new
            held = onward
        ends = [held[s] for s in (NOTHING, ASSISTANT) if s in held]
        best = ends[0]
        for e in ends[1:]:
            if e[0] < best[0] or e[0] == best[0] and _earlier(e[1], best[1]):
                best = e
        cost, node = best
        slices = []
        while node is not None:
            slices.append(node[1:])
            node = node[0]
        slices.reverse()
        gaps = 0 if low is None else high - low + 1 - total["turns"]
        head = (key[0], gaps, total["blank"], total["duplicate"], total["truncated"], total["illegal"], cost, "".join(s[3] for s in slices))
        yield (*head, [{"part": p, "block": b, "start": s, "audit": a} for p, b, s, a in slices])

    schema = f"conv_id long, {AUDIT}, slices array<struct<part:int,block:long,start:int,audit:string>>"
    return sorted_groups(blocked.drop("roles", "texts"), ["conv_id"], ["part", "block"], schema, fold)


def _earlier(x: tuple, y: tuple) -> bool:
    """Whether the audit that ends in ``x`` comes before that of ``y``; both run over the same blocks."""
    a, b = [], []
    while x is not y and x is not None:
        a.append(x[4])
        b.append(y[4])
        x, y = x[0], y[0]
    return "".join(reversed(a)) < "".join(reversed(b))


def _edited(blocked: DataFrame, found: DataFrame, by: list[str], schema: str, consume: Callable[[Iterator[tuple]], Iterator[dict]]) -> DataFrame:
    """``consume`` over the repaired blocks (conv_id, part, block, rows) of each task, dealt ``by`` these columns and in order.

    A block's audit is sorted to stand just before it, so a task holds one block at a time.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    slices = found.select("conv_id", F.explode("slices").alias("s"))
    none = F.lit(None).cast("array<string>")
    audit = slices.select("conv_id", "s.part", "s.block", F.lit(0).alias("kind"), "s.start", "s.audit", none.alias("roles"), none.alias("texts"))
    held = blocked.select("conv_id", "part", "block", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("string").alias("audit"), "roles", "texts")
    dealt = audit.unionByName(held).repartition(*by).sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "block", "kind")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[tuple]:
            start = audit = None
            for b in batches:
                for conv, part, block, kind, s, a, roles, texts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if kind:
                        yield conv, part, block, apply_edits(audit, start, roles, texts)
                    else:
                        start, audit = s, a

        out = []
        for row in consume(blocks()):
            out.append(row)
            if len(out) >= BLOCK_ROWS:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return dealt.mapInArrow(run, schema)


def _lines(blocks: Iterator[tuple]) -> Iterator[dict]:
    for conv, part, block, rows in blocks:
        for i, (role, text) in enumerate(rows):
            yield {"conv_id": conv, "part": part, "block": block, "line": i, "role": role, "text": text}


def _digests(blocks: Iterator[tuple]) -> Iterator[dict]:
    now, sha, lines = (), None, 0
    for conv, _, _, rows in blocks:
        if (conv,) != now:
            if sha:
                yield {"conv_id": now[0], "repaired_sha256": sha.hexdigest()}
            now, sha, lines = (conv,), hashlib.sha256(), 0
        for role, text in rows:
            sha.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
            lines += 1
    if sha:
        yield {"conv_id": now[0], "repaired_sha256": sha.hexdigest()}


def _audited(rows: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    blocked = blocks(rows, block_rows)
    return blocked, stage(audits(blocked), "conversation-audits")


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(audits, repaired): for each conversation conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit;
    and its repaired rows by (part, block, line): conv_id, part, block, line, role, text."""
    blocked, found = _audited(rows, block_rows)
    schema = "conv_id long, part int, block long, line int, role string, text string"
    return found.drop("slices"), _edited(blocked, found, ["part", "block"], schema, _lines)


def repair_digests(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(audits, digests): as ``repair``, with conv_id, repaired_sha256 (of the lines ``role:text``, joined by line ends)."""
    blocked, found = _audited(rows, block_rows)
    return found.drop("slices"), _edited(blocked, found, ["conv_id"], "conv_id long, repaired_sha256 string", _digests)


def repair_damaged(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each conversation of ``rows``: what ``damage`` did to it, the audit that repairs it, the repaired digest."""
    found, sums = repair_digests(damage(rows), block_rows)
    ids = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    empty = F.sha2(F.lit("").cast("binary"), 256)
    out = ids.join(found.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    out = out.join(sums.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    zero = ["gaps", "blank", "duplicate", "truncated", "illegal"]
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in zero], F.coalesce("cost", F.lit(0).cast("long")).alias("cost"), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


#: crc32 over the bytes of ``conv_id:turn`` (digits, signs, spaces), rows and first faults, then the cheapest
#: audit of each state row by row; struct comparison breaks ties.
ORACLE = r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations),
hashed AS (
  SELECT *, xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(name, ''), lambda ch: ascii(ch)::BIGINT)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT,0,0,0,0,0,0,0]),
        lambda v, z: xor(v // 2, 3988292384 * (v % 2))))) % 20 AS kind
  FROM named),
changed AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM changed),
marked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM numbered),
faulty AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM marked),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS rows_left
  FROM faulty GROUP BY conv_id),
steps AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, s AS state, 5 * k AS cost, repeat('I', k) AS audit,
    CASE k WHEN 0 THEN [] WHEN 1 THEN ['user:'] ELSE ['user:', 'assistant:'] END AS lines
  FROM conversations, (VALUES (0, 0), (2, 1), (3, 2)) AS start(s, k)
  UNION ALL
  (WITH moved AS (
    SELECT p.conv_id, f.i, m.state, p.cost + m.cost AS cost, p.audit || m.letter AS audit,
      CASE WHEN m.letter = 'D' THEN p.lines ELSE list_append(p.lines, m.role || ':' || f.text) END AS lines
    FROM steps p JOIN faulty f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = p.i + 1,
    LATERAL (
      SELECT p.state AS state, 2 AS cost, 'D' AS letter, '' AS role
      UNION ALL SELECT CASE WHEN p.state = 2 THEN 3 ELSE 2 END, 1 + CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END, 'R',
        CASE WHEN p.state = 2 THEN 'assistant' ELSE 'user' END WHERE f.fault NOT IN ('blank', 'duplicate')
      UNION ALL SELECT CASE left(f.role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END, 'K', f.role
        WHERE f.fault NOT IN ('blank', 'duplicate') AND (left(f.role, 1) = 's' AND p.state = 0
          OR left(f.role, 1) = 'u' AND p.state <> 2 OR left(f.role, 1) = 'a' AND p.state = 2)
    ) AS m),
  grown AS (
    SELECT * FROM moved
    UNION ALL SELECT conv_id, i, CASE WHEN state = 2 THEN 3 ELSE 2 END, cost + 5, audit || 'I',
      list_append(lines, CASE WHEN state = 2 THEN 'assistant:' ELSE 'user:' END) FROM moved
    UNION ALL SELECT conv_id, i, CASE WHEN state = 2 THEN 2 ELSE 3 END, cost + 10, audit || 'II',
      lines || CASE WHEN state = 2 THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END FROM moved)
  SELECT conv_id, i, state, best.cost, best.audit, best.lines
  FROM (SELECT conv_id, i, state, min({'cost': cost, 'audit': audit, 'lines': lines}) AS best FROM grown GROUP BY conv_id, i, state))),
ended AS (
  SELECT c.conv_id, min({'cost': s.cost, 'audit': s.audit, 'lines': s.lines}) AS best
  FROM counts c JOIN steps s ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND s.i = c.rows_left
  WHERE s.state IN (0, 3) GROUP BY c.conv_id)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank,
  coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
  coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost, coalesce(e.best.audit, '') AS audit,
  sha256(coalesce(array_to_string(e.best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""
