"""Repair of conversation structure by Knuth's lightest-derivation agenda.

A conversation should hold an optional system turn and then user and assistant
turns in pairs. Every row is kept, given another role or deleted, and empty turns
may be inserted; each edit has a cost and a letter. Partial repairs are items of a
hypergraph: ``(i, state)`` says that the first i rows are dealt with and what the
grammar has seen last. A deduction makes an item from one or no item before it and
a row's facts, by ``(cost, audit) -> (cost + price, audit + letter)``, which is
superior and monotone: repairs of equal cost of the same rows are never prefixes of
each other, as only insertions lengthen an audit and each costs something. So the
agenda pops items by (cost, audit), each popped value is final, and the search ends
when the goals are popped.

A conversation may have any number of rows. Rows are ordered by ranges and cut into
pieces of 2**``PIECE_BITS`` at most; the agenda finds the lightest derivation of a piece
from each state to each state, and these tables are multiplied in a tree,
2**``FAN_BITS`` at a time. Only the row's letters go through this. A last pass sends each
conversation's texts, in order and behind its audit, through one task, which
streams them into the digest and holds the audit, a letter for a row.

Defined cases: a null id is a conversation of its own, a null role or text is one
space, and a null turn is one space in the hash and comes first in the order. Rows
of one turn go by role, then by MD5 of the text, so a repeated row stands beside its
equal. Roles count by their first letter, so an empty role, or one with another
letter, can't be kept. An empty table gives no rows; very long texts are read by
pattern once and streamed once. Columns but conv_id, turn, role and text are not
read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.order import numbered
from basketlens.llm.resampling import crc32_sql
from basketlens.sources.landing import land

# Prices of the edits; a truncated row that stays costs one more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

#: Rows of a conversation that one agenda takes, and tables multiplied at once, as powers of two.
PIECE_BITS, FAN_BITS = 8, 6

# What the grammar has seen last: nothing, a system, a user or an assistant turn.
STATES = "-sua"
NEXT = {"-": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
ACCEPTING = "-a"
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

SPANS = "array<struct<start:string,end:string,cost:bigint,audit:string>>"
TABLE = f"conv_id {{id}}, piece bigint, first string, last string, illegal bigint, spans {SPANS}"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def deductions(symbol: str | None, state: str) -> Iterator[tuple[str, int, str, int]]:
    """(state, price, letter, rows used) that follow from a state and the next row, null at the end.

    A row is the initial of its role, in upper case where its text is truncated, or
    ``x`` where it must go.
    """
    for role in ROLES:
        if role in NEXT[state]:
            yield NEXT[state][role], INSERT, "I", 0
    if symbol is None:
        return
    yield state, DELETE, "D", 1
    if symbol == "x":
        return
    extra = TRUNCATED if symbol.isupper() or symbol == "!" else 0
    if symbol.lower() in NEXT[state]:
        yield NEXT[state][symbol.lower()], KEEP + extra, "K", 1
    for role in ROLES:
        if role in NEXT[state]:
            yield NEXT[state][role], REROLE + extra, "R", 1


@lru_cache(maxsize=50_000)
def lightest(symbols: str, start: str) -> tuple[tuple[str, int, str], ...]:
    """(state, cost, audit) of the lightest derivation to each state it can end in."""
    agenda = [(0, "", 0, start)]
    final: set[tuple[int, str]] = set()
    goals = []
    n = len(symbols)
    while agenda:
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == n:
            goals.append((state, cost, audit))
            if len(goals) == len(STATES):
                break
        symbol = symbols[i] if i < n else None
        for after, price, letter, used in deductions(symbol, state):
            if (i + used, after) not in final:
                heapq.heappush(agenda, (cost + price, audit + letter, i + used, after))
    return tuple(goals)


def spans_of(symbols: str) -> list[dict]:
    return [
        {"start": start, "end": end, "cost": cost, "audit": audit}
        for start in STATES for end, cost, audit in lightest(symbols, start)
    ]


def joined(left: list[dict], right: list[dict]) -> list[dict]:
    """The lightest derivations through two pieces, from each state to each state."""
    best: dict[tuple[str, str], tuple[int, str]] = {}
    for a in left:
        for b in right:
            if a["end"] == b["start"]:
                ends = a["start"], b["end"]
                value = a["cost"] + b["cost"], a["audit"] + b["audit"]
                if ends not in best or value < best[ends]:
                    best[ends] = value
    return [{"start": s, "end": e, "cost": c, "audit": t} for (s, e), (c, t) in best.items()]


# The damage, and what is wrong with a row


def _spaced(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of the rows after the damage that the query prescribes."""
    hit = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"), hit.alias("hit")
    )
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("hit") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("hit <> 0").withColumn("copy", F.explode(copies)).select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text")
    )


# Fixed value: white space of the faults.
_SPACE = r"\x20\x09-\x0D"
_ORDER = ("turn", "role", "digest")


def _lettered(rows: DataFrame) -> DataFrame:
    """Light rows, their place ``at`` in the order of all, and what decides their fault."""
    last = F.regexp_extract("text", rf"([^{_SPACE}])[{_SPACE}]*\z", 1)
    light = rows.select(
        "conv_id", "turn", "role", F.md5("text").alias("digest"),
        (last == "").alias("is_blank"), (~last.isin(".", "!", "?")).alias("is_open"),
    )
    return numbered(light, ["conv_id", *_ORDER], "at")


def faults(lettered: DataFrame) -> DataFrame:
    """(conv_id, turn, at, initial, fault) with fault blank, duplicate, truncated or null."""
    firsts = lettered.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at"))
    # Places are unique, so however often a text occurs this join has no hot key.
    marked = lettered.join(firsts.select("at", F.lit(True).alias("is_first")), "at", "left")
    initial = F.substring("role", 1, 1)
    fault = (
        F.when(F.col("is_blank"), "blank").when(F.col("is_first").isNull(), "duplicate")
        .when(F.col("is_open"), "truncated")
    )
    return marked.select(
        "conv_id", "turn", "at", F.when(initial.isin("s", "u", "a"), initial).otherwise("?").alias("initial"),
        fault.alias("fault"),
    )


# Pieces and their product


def _in_order(schema: pa.Schema, rows: list[list]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _table_schema(id_type: pa.DataType) -> pa.Schema:
    span = pa.struct([("start", pa.string()), ("end", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])
    return pa.schema([
        ("conv_id", id_type), ("piece", pa.int64()), ("first", pa.string()), ("last", pa.string()),
        ("illegal", pa.int64()), ("spans", pa.list_(span)),
    ])


def pieces(marked: DataFrame, bits: int = PIECE_BITS) -> DataFrame:
    """A table of derivations for each run of rows of a conversation, of 2**bits at most."""
    initial = F.col("initial")
    symbol = (
        F.when(F.col("fault").isin("blank", "duplicate"), "x")
        .when(F.col("fault") == "truncated", F.when(initial == "?", "!").otherwise(F.upper(initial)))
        .otherwise(initial)
    )
    runs = marked.groupBy("conv_id", F.shiftright("at", bits).alias("piece")).agg(
        F.array_sort(F.collect_list(F.struct("at", "initial", symbol.alias("symbol")))).alias("rows")
    )
    texts = runs.select(
        "conv_id", "piece",
        *[F.array_join(F.transform("rows", lambda r: r[n]), "").alias(n) for n in ("initial", "symbol")],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = _table_schema(batch.schema.field(0).type)
            rows = []
            for conv, piece, initials, symbols in zip(*(batch.column(i).to_pylist() for i in range(4))):
                illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
                rows.append([conv, piece, initials[0], initials[-1], illegal, spans_of(symbols)])
            yield _in_order(schema, rows)

    return texts.mapInArrow(run, TABLE.format(id=dict(marked.dtypes)["conv_id"]))


def multiplied(tables: DataFrame, bits: int = FAN_BITS) -> DataFrame:
    """One table for each conversation: those of its pieces, multiplied in a tree."""
    entry = F.struct("piece", "first", "last", "illegal", "spans")
    schema_text = TABLE.format(id=dict(tables.dtypes)["conv_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = _table_schema(batch.schema.field(0).type)
            rows = []
            for conv, piece, parts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                first, last, illegal, spans = (parts[0][n] for n in ("first", "last", "illegal", "spans"))
                for p in parts[1:]:
                    illegal += p["illegal"] + (last + p["first"] not in LEGAL)
                    last, spans = p["last"], joined(spans, p["spans"])
                rows.append([conv, piece, first, last, illegal, spans])
            yield _in_order(schema, rows)

    while True:
        tables = land(tables, "pieces")
        most = tables.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return tables
        # Places are dense, so a conversation has about 2**bits times fewer pieces each time.
        above = F.lit(0).cast("long") if most <= 2**bits else F.shiftright("piece", bits)
        grouped = tables.groupBy("conv_id", above.alias("piece")).agg(F.array_sort(F.collect_list(entry)).alias("parts"))
        tables = grouped.mapInArrow(run, schema_text)


# The result


def plans(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """(conv_id, counts, cost, audit) for every id of ``conversations``, from its rows after the damage."""
    marked = land(faults(_lettered(rows)), "faults")
    counts = marked.groupBy("conv_id", "turn").agg(
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    ).groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    goal = F.array_min(F.transform(
        F.filter("spans", lambda s: (s["start"] == "-") & s["end"].isin(*ACCEPTING)),
        lambda s: F.struct(s["cost"].alias("cost"), s["audit"].alias("audit")),
    ))
    solved = multiplied(pieces(marked)).select("conv_id", "illegal", goal.alias("goal"))
    zero, none = F.lit(0).cast("long"), F.lit(None)
    parts = [
        conversations.select("conv_id", *[zero.alias(c) for c in COUNTS], F.lit("").alias("audit")),
        counts.select(
            "conv_id", *[(F.col(c) if c in counts.columns else zero).cast("long").alias(c) for c in COUNTS],
            none.cast("string").alias("audit"),
        ),
        solved.select(
            "conv_id", *[zero.alias(c) for c in COUNTS[:-2]], F.col("illegal"), F.col("goal.cost").alias("cost"),
            F.col("goal.audit").alias("audit"),
        ),
    ]
    together = parts[0].distinct().unionByName(parts[1]).unionByName(parts[2])
    return together.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in COUNTS], F.max("audit").alias("audit"))


class _Digest:
    """Streams a conversation's rows along its audit into a digest."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.sha, self.any = audit, 0, "-", hashlib.sha256(), False

    def _add(self, line: str) -> None:
        self.sha.update(f"\n{line}".encode() if self.any else line.encode())
        self.any = True

    def _new_role(self) -> str:
        self.state = next(r for r in ROLES if r in NEXT[self.state])
        return ROLES[self.state]

    def _insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._add(f"{self._new_role()}:")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._insertions()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = role[0]
            self._add(f"{role}:{text}")
        elif letter == "R":
            self._add(f"{self._new_role()}:{text}")

    def hexdigest(self) -> str:
        self._insertions()
        if self.at != len(self.audit):
            raise ValueError("an audit has more letters than its conversation has rows")
        return self.sha.hexdigest()


def repair(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Every conversation with its faults, the cheapest repair and the digest of what it gives.

    ``rows`` (conv_id, turn, role, text) are the rows to repair, ``conversations``
    holds the ids to answer for.
    """
    planned = plans(conversations, rows)
    kinds = dict(conversations.dtypes)
    schema = ", ".join(
        [f"conv_id {kinds['conv_id']}", *[f"{c} bigint" for c in COUNTS], "audit string", "repaired_sha256 string"]
    )
    null_turn, blank = F.lit(None).cast(kinds["turn"]), F.lit(None).cast("string")
    heads = planned.select(
        "conv_id", F.lit(0).alias("kind"), null_turn.alias("turn"), blank.alias("role"), blank.alias("digest"),
        blank.alias("text"), *COUNTS, "audit",
    )
    zero = F.lit(None).cast("long")
    bodies = rows.select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", F.md5("text").alias("digest"), "text",
        *[zero.alias(c) for c in COUNTS], blank.alias("audit"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, digest, out, shape = None, None, [], None
        for batch in batches:
            shape = shape or pa.schema(
                [batch.schema.field("conv_id"), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()),
                 ("repaired_sha256", pa.string())]
            )
            columns = [batch.column(n).to_pylist() for n in ("kind", "role", "text", "conv_id", *COUNTS, "audit")]
            for kind, role, text, *values in zip(*columns):
                if kind:
                    digest.row(role, text)
                    continue
                if head is not None:
                    out.append([*head, digest.hexdigest()])
                head, digest = values, _Digest(values[-1])
            if out:
                yield _in_order(shape, out)
                out = []
        if head is not None:
            yield _in_order(shape, [[*head, digest.hexdigest()]])

    together = heads.unionByName(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_ORDER)
    return together.select("conv_id", "kind", "role", "text", *COUNTS, "audit").mapInArrow(run, schema)


def repair_query(conversations: DataFrame) -> DataFrame:
    return repair(conversations, damaged(conversations))


_STEP = "min({'cost': s.cost + i.cost + e.cost, 'audit': s.audit || i.audit || e.audit})"
_KEY = "coalesce({}::VARCHAR, ' ')"

REPAIR_SQL = f"""
WITH RECURSIVE hits AS (SELECT {_KEY.format("conv_id")} AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_KEY.format("conv_id")} || ':' || {_KEY.format("turn")} AS name FROM conversations),
coded AS (SELECT *, {crc32_sql("name")} % 20 AS hit FROM hits),
damaged AS (SELECT k, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
  CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM coded, unnest(range(CASE hit WHEN 3 THEN 2 ELSE 1 END)) WHERE hit <> 0),
ordered AS (SELECT *, left(role, 1) AS initial, md5(text) AS digest,
  regexp_extract(text, '([^{_SPACE}])[{_SPACE}]*\\z', 1) AS last,
  row_number() OVER (PARTITION BY k, role, text ORDER BY turn NULLS FIRST) AS copy FROM damaged),
rows AS MATERIALIZED (SELECT *, row_number() OVER w AS n, lag(initial) OVER w || initial AS pair,
  CASE WHEN last = '' THEN 'blank' WHEN copy > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
  FROM ordered WINDOW w AS (PARTITION BY k ORDER BY turn NULLS FIRST, role, digest, copy)),
facts AS (SELECT k, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY k),
inserted(q, r, cost, audit) AS (VALUES ('-', '-', 0, ''), ('-', 'u', 2, 'I'), ('-', 'a', 4, 'II'), ('s', 's', 0, ''),
  ('s', 'u', 2, 'I'), ('s', 'a', 4, 'II'), ('u', 'u', 0, ''), ('u', 'a', 2, 'I'), ('a', 'a', 0, ''), ('a', 'u', 2, 'I')),
follows(q, r) AS (VALUES ('-', 's'), ('-', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
states(q) AS (VALUES ('-'), ('s'), ('u'), ('a')),
edits AS MATERIALIZED (SELECT k, n, q, q AS r, 3 AS cost, 'D' AS audit FROM rows, states
  UNION ALL SELECT k, n, q, r, CASE fault WHEN 'truncated' THEN 1 ELSE 0 END, 'K' FROM rows JOIN follows ON r = initial
    WHERE fault IS NULL OR fault = 'truncated'
  UNION ALL SELECT k, n, q, r, CASE fault WHEN 'truncated' THEN 3 ELSE 2 END, 'R' FROM rows, follows
    WHERE r <> 's' AND (fault IS NULL OR fault = 'truncated')),
best AS (SELECT k, 0::BIGINT AS n, '-' AS q, 0 AS cost, '' AS audit FROM facts
  UNION ALL SELECT k, n, r, m.cost, m.audit FROM (SELECT s.k, s.n + 1 AS n, e.r, {_STEP} AS m
    FROM best s JOIN inserted i ON i.q = s.q JOIN edits e ON e.k = s.k AND e.n = s.n + 1 AND e.q = i.r
    GROUP BY s.k, s.n, e.r)),
goals AS (SELECT b.k, min({{'cost': b.cost + i.cost, 'audit': b.audit || i.audit}}) AS m
  FROM best b JOIN facts f ON f.k = b.k AND f.n = b.n JOIN inserted i ON i.q = b.q WHERE i.r IN ('-', 'a') GROUP BY b.k),
letters AS (SELECT k, j, m.audit[j] AS letter FROM (SELECT k, m, unnest(range(1, len(m.audit) + 1)) AS j FROM goals)),
used AS (SELECT *, count(*) FILTER (letter <> 'I') OVER w AS n, count(*) FILTER (letter <> 'D') OVER w AS place
  FROM letters WINDOW w AS (PARTITION BY k ORDER BY j)),
kept AS (SELECT u.k, j, letter, role, text, place
    - max(CASE WHEN letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY u.k) AS place
  FROM used u LEFT JOIN rows r ON r.k = u.k AND r.n = u.n AND letter <> 'I' WHERE letter <> 'D'),
texts AS (SELECT k, string_agg(CASE WHEN letter = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END
  || ':' || coalesce(text, ''), chr(10) ORDER BY j) AS repaired FROM kept GROUP BY k)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(m.cost, 0)::BIGINT AS cost,
  coalesce(m.audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN facts f ON f.k = {_KEY.format("conv_id")}
LEFT JOIN goals g ON g.k = f.k LEFT JOIN texts t ON t.k = f.k"""
