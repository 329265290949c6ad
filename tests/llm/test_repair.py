from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from basketlens.llm import repair
from tools.check_oracles import differences

SCHEMA = "conv_id bigint, turn bigint, role string, text string, piece int, audit string"
NAMES = ["conv_id", *repair.COUNTS, "audit", "repaired_sha256"]


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        hit = zlib.crc32(key.encode()) % 20
        if hit == 0:
            continue
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        out += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, lines) by trying every edit of every row and up to two insertions between."""
    price = {"K": 0, "R": 2, "D": 3}
    best = None
    options = [
        [("D", None)] if fault in ("blank", "duplicate")
        else [("D", None), ("K", role), ("R", "user"), ("R", "assistant")]
        for role, _, fault in rows
    ]
    fills = [f for n in range(3) for f in itertools.product(("user", "assistant"), repeat=n)]
    for edits in itertools.product(*options):
        # Every gap but those beside a deletion that comes before gets its fill.
        for gaps in itertools.product(fills, repeat=len(rows) + 1):
            if sum(map(len, gaps)) > 3:
                continue
            cost, audit, lines = 0, "", []
            for i in range(len(rows) + 1):
                for role in gaps[i]:
                    cost, audit = cost + 2, audit + "I"
                    lines.append((role, ""))
                if i < len(rows):
                    letter, role = edits[i]
                    cost, audit = cost + price[letter] + (letter != "D" and rows[i][2] == "truncated"), audit + letter
                    if letter != "D":
                        lines.append((role, rows[i][1]))
            shape = "".join((r or "?")[0] for r, _ in lines)
            if re.fullmatch(r"(s?(ua)+)?", shape) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def expected(rows, solve=cheapest):
    out = {}
    after = damaged(rows)
    order = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest())
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in after if r[0] == conv), key=order)
        seen, marked = set(), []
        for _, _, role, text in mine:
            solid = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
            if not solid:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = None if solid[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = {r[1] for r in mine} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[0][:1] for r in marked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = solve(marked)
        text = "\n".join(f"{r}:{t}" for r, t in lines)
        n = [sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (conv, gaps, *n, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def got(df):
    return {r.conv_id: tuple(r[n] for n in NAMES) for r in repair.repair_query(df).collect()}


def random_rows(seed, conversations, most):
    draw = random.Random(seed)
    roles = ["user", "assistant", "assistant", "user", "system", "tool", "", None]
    texts = ["Hi.", "Yes!", "No", "open end ", " \t\n", "", None, "a. ", "b?\x0b\n"]
    return [
        (c, draw.choice([t, t, t, None]), draw.choice(roles), draw.choice(texts))
        for c in range(conversations) for t in range(draw.randint(1, most))
    ]


def test_equals_every_possible_repair(spark):
    rows = random_rows(5, 60, 3) + [(None, 0, "user", "Hi."), (None, 4, "assistant", "Yes.")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)
    assert got(df) == expected(rows)


def test_equals_sql(given):
    rows = random_rows(11, 80, 9) + [(500, 3, "user", "Same.")] * 4
    df, con = given("conversations", [(*r, 1, "x") for r in rows], SCHEMA)
    assert differences(repair.repair_query(df), con, repair.REPAIR_SQL) == []


def test_planted_faults(spark):
    # Turns whose hash does no damage.
    calm = [t for t in range(200) if zlib.crc32(f"1:{t}".encode()) % 20 > 4]
    script = [
        ("system", "Be kind."), ("user", "Hello."), ("user", "Hello."), ("assistant", "Hm"), ("user", " "),
        ("tool", "Said."), ("assistant", "Done."),
    ]
    rows = [(1, t, *x, 1, "") for t, x in zip(calm, script)]
    (r,) = repair.repair_query(spark.createDataFrame(rows, SCHEMA)).collect()
    assert (r.blank, r.duplicate, r.truncated, r.audit) == (1, 1, 1, "KKDKDRK")
    assert r.cost == 3 + 1 + 3 + 2
    text = "system:Be kind.\nuser:Hello.\nassistant:Hm\nuser:Said.\nassistant:Done."
    assert r.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_all_rows_dropped_and_empty_table(spark):
    turn = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(7, turn, "user", "Hi.", 1, "")], SCHEMA)
    assert got(df) == {7: (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert got(df.limit(0)) == {}


@pytest.mark.parametrize("piece_bits,fan_bits", [(0, 1), (1, 1), (2, 6)])
def test_pieces_of_a_long_conversation_join_to_the_whole(spark, piece_bits, fan_bits):
    draw = random.Random(piece_bits)
    rows = [(c, i, draw.choice("sua?"), draw.choice([None, "blank", "truncated"])) for c in (1, None) for i in range(37)]
    marked = spark.createDataFrame(
        [(c, i, i + (100 if c else 0), a, f) for c, i, a, f in rows],
        "conv_id bigint, turn bigint, at bigint, initial string, fault string",
    )
    whole = {r.conv_id: r for r in repair.multiplied(repair.pieces(marked)).collect()}
    cut = {r.conv_id: r for r in repair.multiplied(repair.pieces(marked, piece_bits), fan_bits).collect()}
    assert set(cut) == {1, None}
    for conv, r in cut.items():
        assert r.illegal == whole[conv].illegal
        assert sorted(r.spans) == sorted(whole[conv].spans)


def test_agenda_settles_ties_by_letters():
    # One user row: delete it (3) or add an answer (2); two in a row: an answer between costs less than two edits.
    assert ("a", 2, "KI") in repair.lightest("u", "-")
    assert ("a", 2, "KI") in repair.lightest("u", "s")
    assert ("-", 3, "D") in repair.lightest("x", "-")
    assert ("a", 2, "KR") in repair.lightest("uu", "-")


def test_a_long_text_of_spaces_and_a_long_conversation(spark):
    rows = [(1, 0, "user", "x" + " " * 1_000_000 + "y.", 1, ""), (1, 1, "assistant", "." + "\n" * 1_000_000, 1, "")]
    rows += [(2, t, ("user", "assistant")[t % 2], f"Turn {t}.", 1, "") for t in range(3000)]
    result = {r.conv_id: r for r in repair.repair_query(spark.createDataFrame(rows, SCHEMA)).collect()}
    letters = result[2].audit.replace("I", "")
    kept = [t for t in range(3000) for _ in range((0, 1, 1, 2)[min(3, zlib.crc32(f"2:{t}".encode()) % 20)] if
            zlib.crc32(f"2:{t}".encode()) % 20 < 4 else 1)]
    assert len(letters) == len(kept)
