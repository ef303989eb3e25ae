"""Conversation repair against an exhaustive search."""

import hashlib
import random
import zlib

import pytest

from cellframe.llm import conversation_repair as cr

SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def searched(rows):
    """The cheapest edits of ``(role, fault)`` rows by trying all, with a few insertions."""
    best = None

    def step(i, roles, cost, audit, inserts):
        nonlocal best
        seen = "".join(r[:1] for r in roles)
        body = seen[1:] if seen[:1] == "s" else seen
        if body != "ua" * (len(body) // 2) + "u" * (len(body) % 2):
            return
        if i == len(rows) and len(body) % 2 == 0 and (body or not seen):
            if best is None or (cost, audit) < best[:2]:
                best = cost, audit, list(roles)
        if inserts:
            for role in ("user", "assistant"):
                step(i, [*roles, role], cost + 3, audit + "I", inserts - 1)
        if i < len(rows):
            role, fault = rows[i]
            step(i + 1, roles, cost + 4, audit + "D", inserts)
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                step(i + 1, [*roles, role], cost + more, audit + "K", inserts)
                for new in ("user", "assistant"):
                    step(i + 1, [*roles, new], cost + more + 3, audit + "R", inserts)

    step(0, [], 0, "", len(rows) // 2 + 2)
    return best


def expected(rows):
    digest = lambda r: hashlib.sha256(f"{len(r[2].encode())}:{r[2]}{len(r[3].encode())}:{r[3]}".encode()).digest()[:16]
    key = lambda r: (r[1] is not None, r[1] or 0, digest(r))
    left, out = damaged(rows), {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in left if r[0] == conv), key=key)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, _, role, text in own:
            body = text.rstrip(SPACE)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, roles = searched([(r[2], f) for r, f in zip(own, faults)])
        lines, i, roles = [], 0, iter(roles)
        for edit in audit:
            if edit != "D":
                lines.append(f"{next(roles)}:{'' if edit == 'I' else own[i][3]}")
            i += edit != "I"
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations(rng, n, most):
    rows = []
    for conv in range(n):
        turn = 0
        for _ in range(rng.randint(1, most)):
            turn += rng.choice((0, 1, 1, 1, 2))
            rows.append((conv, rng.choice((turn, turn, turn, None)), rng.choice(("user", "assistant", "user", "assistant", "system", "tool", "", None)),
                         rng.choice(("Yes.", "No", "What?\n", " ", "", None, f"{rng.random()}!"))))
    return rows


def result(spark, rows, extra=""):
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, digest string")
    damage = cr.damage(frame)
    got = cr.with_digests(damage, cr.repairs(damage)).drop("script").collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r)[1:] for r in got}


@pytest.mark.parametrize("ranges", [1, 23])
def test_repairs_equal_exhaustive_search(spark, ranges):
    rng = random.Random(5)
    rows = conversations(rng, 120, 4) + [(None, 1, "user", "A."), (None, None, "user", "A."), (7, 3, "user", "Twice."), (7, 3, "user", "Twice.")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", ranges)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert result(spark, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_long_conversation_is_cut_at_ranges_and_joined(spark):
    """A conversation over all ranges agrees with one agenda over all of it."""
    rng = random.Random(9)
    rows = [(1, t, rng.choice(("user", "assistant", "system")), f"{rng.randint(0, 300)}{rng.choice('.x')}") for t in range(700)]
    got = result(spark, rows)[1]
    left = damaged(rows)
    seen, letters = set(), ""
    for _, _, role, text in left:
        cut = text.rstrip(SPACE)[-1:] not in (".", "!", "?")
        letters += "-" if not text or (role, text) in seen else role[0].upper() if cut else role[0]
        seen.add((role, text))
    (cost, audit), = cr._agenda(letters, 0, True).values()
    assert (got[5], got[6]) == (cost, audit)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    damage = cr.damage(frame)
    turns = cr.repaired_turns(damage, cr.repairs(damage)).orderBy("place").collect()
    assert [t["place"] for t in turns] == list(range(len(turns)))
    assert "".join(t["edit"] for t in turns) == audit.replace("D", "")
    initials = "".join(t["role"][0] for t in turns)
    assert initials.removeprefix("s") == "ua" * (len(initials) // 2)
    assert hashlib.sha256("\n".join(f"{t['role']}:{t['text']}" for t in turns).encode()).hexdigest() == got[7]


def test_many_copies_and_one_long_text(spark):
    rows = [(1, 2, "user", "Same.")] * 400 + [(1, 3, "assistant", "word " * 200_000 + ".")]
    got = result(spark, rows)[1]
    copies = damaged(rows)
    n = sum(r[2] == "user" for r in copies)
    assert got[2] == n - len({r[2:] for r in copies if r[2] == "user"})
    assert got[6].count("D") >= got[2]


def test_no_conversations(spark):
    assert result(spark, []) == {}


def test_blocks_join_like_one_agenda(monkeypatch):
    rng = random.Random(2)
    for _ in range(60):
        letters = "".join(rng.choice("suaxeSUAXE-") for _ in range(rng.randint(0, 14)))
        monkeypatch.setattr(cr, "BLOCK", 48)
        whole = cr.goal(cr.lightest([(c, 1) for c in letters], True))
        monkeypatch.setattr(cr, "BLOCK", rng.randint(1, 4))
        assert cr.goal(cr.lightest([(c, 1) for c in letters], False)) == whole
