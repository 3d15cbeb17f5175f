from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from skyledger.llm import conversations as ops
from skyledger.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"
ORDER = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    """conv_id -> its rows after damage, in order."""
    found = {}
    for conv_id, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        kept = found.setdefault(conv_id, [])
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        hit = zlib.crc32(name.encode()) % 20
        if hit == 0:
            continue
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if hit == 3 else 1)
    for kept in found.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    return found


def faults(rows):
    seen, told = set(), []
    for _, role, text in rows:
        solid = text.rstrip(BLANKS)
        if not solid:
            told.append("blank")
        elif (role, text) in seen:
            told.append("duplicate")
        else:
            told.append("" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return told


def brute(rows):
    """Cheapest edits by trying all of them: (cost, audit, repaired), least first."""
    found = faults(rows)
    best = (10**9, "", "")

    def go(k, cost, audit, lines, initials):
        nonlocal best
        if cost > best[0]:
            return
        if k == len(rows) and ORDER.fullmatch(initials):
            best = min(best, (cost, audit, "\n".join(lines)))
        if not re.fullmatch(r"s?(ua)*u?", initials):
            return
        for role in ("user", "assistant"):
            if len(initials) < 3 * len(rows) + 3:
                go(k, cost + 2, audit + "I", [*lines, f"{role}:"], initials + role[0])
        if k == len(rows):
            return
        _, role, text = rows[k]
        go(k + 1, cost + 3, audit + "D", lines, initials)
        if found[k] in ("blank", "duplicate"):
            return
        more = found[k] == "truncated"
        if role:
            go(k + 1, cost + more, audit + "K", [*lines, f"{role}:{text}"], initials + role[0])
        for new in ("user", "assistant"):
            go(k + 1, cost + 2 + more, audit + "R", [*lines, f"{new}:{text}"], initials + new[0])

    best = (3 * len(rows) + 1, "", "")
    go(0, 0, "", [], "")
    return best


def expected(rows, conv_id=None):
    found = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, repaired = brute(rows) if rows else (0, "", "")
    return (
        conv_id,
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(found.count(name) for name in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        cost,
        audit,
        hashlib.sha256(repaired.encode()).hexdigest(),
    )


def told(found):
    return sorted((tuple(r) for r in found.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def invented(seed, conversations):
    draw = random.Random(seed)
    rows = []
    for conv_id in range(conversations):
        for turn in range(draw.randint(1, 5)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", None, "tool", "", "unit"])
            text = draw.choice(["Yes.", "no", "", None, " \t", "What?  ", "Yes.", f"n{turn}!", "é…"])
            rows.append((conv_id, draw.choice([turn, turn, turn + 3, None]) if turn % 2 else turn, role, text))
    # One row a turn and role, whose order the contract leaves open.
    return list({(c, t, r): (c, t, r, x) for c, t, r, x in rows}.values())


@pytest.mark.parametrize("piece", [2048, 2])
def test_same_as_trying_all_edits(spark, monkeypatch, piece):
    monkeypatch.setattr(ops, "PIECE_ROWS", piece)
    rows = invented(piece, 120)
    found = ops.repair(ops.damage(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert found.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    ]
    assert told(found) == [expected(kept, c) for c, kept in sorted(damaged(rows).items())]


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert told(QUERIES["op13_repair"](spark, SMALL)) == [
        expected(kept, c) for c, kept in sorted(damaged(rows).items())
    ]


def ranked(rows):
    """Costs and audits of all suffixes, as text, without an agenda."""
    best = {0: (0, ""), 1: (4, "II"), 2: (2, "I"), 3: (0, "")}
    found = faults(rows)
    follow = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    for (_, role, _), fault in zip(reversed(rows), reversed(found), strict=True):
        new = {}
        for q in range(4):
            ways = [(best[q][0] + 3, "D" + best[q][1])]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if (q, role[:1]) in follow:
                    cost, audit = best[follow[q, role[:1]]]
                    ways.append((cost + more, "K" + audit))
                cost, audit = best[follow[q, "a" if q == 2 else "u"]]
                ways.append((cost + more + 2, "R" + audit))
            new[q] = min(ways)
        for _ in range(2):
            for q in range(4):
                cost, audit = new[follow[q, "a" if q == 2 else "u"]]
                new[q] = min(new[q], (cost + 2, "I" + audit))
        best = new
    return best[0]


def test_a_hot_conversation_is_cut_and_put_together(spark, monkeypatch):
    """A third of all rows in one conversation, another one without an id."""
    monkeypatch.setattr(ops, "PIECE_ROWS", 50)
    draw = random.Random(9)
    roles = ["user", "assistant", "system"]
    hot = [(7, t, draw.choice(roles), draw.choice(["a.", "b", f"x{t}.", f"y{t}", ""])) for t in range(2000)]
    rest = [(100 + t // 5, t % 5, draw.choice(roles), f"text {t}.") for t in range(3000)]
    none = [(None, t, roles[t % 2], f"{t}.") for t in range(400)]
    rows = hot + rest + none
    found = {r[0]: r for r in told(ops.repair(ops.damage(spark.createDataFrame(rows, SCHEMA).repartition(5))))}
    kept = damaged(rows)
    assert found.keys() == kept.keys()
    for c, own in kept.items():
        assert (found[c][6], found[c][7]) == ranked(own)
        assert found[c][1:6] == expected_counts(own)
    # What the audit says, done by hand.
    for c in (7, None):
        lines, k, initials = [], 0, ""
        for letter in found[c][7]:
            if letter == "I":
                lines.append(f"{'assistant' if initials[-1:] == 'u' else 'user'}:")
            else:
                _, role, text = kept[c][k]
                k += 1
                if letter == "R":
                    role = "assistant" if initials[-1:] == "u" else "user"
                if letter == "D":
                    continue
                lines.append(f"{role}:{text}")
            initials += lines[-1][0]
        assert ORDER.fullmatch(initials) and k == len(kept[c])
        assert found[c][8] == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def expected_counts(rows):
    found = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(found.count(name) for name in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
    )


def test_nothing_left(spark):
    conv_id = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = spark.createDataFrame([(conv_id, 0, "user", "Hi.", 3)], f"{SCHEMA}, row int")
    nothing = hashlib.sha256(b"").hexdigest()
    assert told(ops.repair(ops.damage(rows))) == [(conv_id, 0, 0, 0, 0, 0, 0, "", nothing)]
    assert ops.repair(ops.damage(spark.createDataFrame([], SCHEMA))).collect() == []


def test_rows_of_any_kind(spark):
    """Without damage; extra columns with the operator's own names; repeated rows."""
    rows = [
        (1, 0, "user", "Hi.", "k", 1), (1, 1, "assistant", "x" * 400_000 + ".", "k", 2),
        (1, 1, "assistant", "x" * 400_000 + ".", "k", 2), (2, None, None, None, "k", 3),
        (2, None, "user", "Why", "k", 3),
    ]
    found = told(ops.repair(spark.createDataFrame(rows, f"{SCHEMA}, key string, fault int")))
    big = hashlib.sha256(("user:Hi.\nassistant:" + "x" * 400_000 + ".").encode()).hexdigest()
    assert found[0] == (1, 0, 0, 1, 0, 1, 3, "KKD", big)
    assert found[1] == (2, 0, 1, 0, 1, 1, 6, "DD", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("seed", range(30))
def test_agenda_against_all_edits(seed):
    draw = random.Random(seed)
    rows = [
        (t, draw.choice(["user", "assistant", "system", "x"]), draw.choice(["a.", "b", "", "c?", "a."]))
        for t in range(draw.randint(0, 6))
    ]
    assert ranked(rows) == brute(rows)[:2] if rows else ranked(rows) == (0, "")
