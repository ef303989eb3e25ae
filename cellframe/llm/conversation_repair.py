"""Repair of conversations as lightest derivations of weighted deductions.

A conversation is a row of letters: the initial of each turn's role, and whether the turn
must go. An item ``[i, p, j, q]`` says that the turns ``i`` to ``j`` can be edited so that
the wanted roles ``(s?(ua)+)?`` get from state ``p`` to state ``q``; its weight is the pair
(cost, audit), where the audit is the text of the edits' initials. Edits extend an item by
a turn or an insertion, and two items that meet make a longer one. Both functions are
superior and monotone: an extension never weighs less, and keeps the order of two weights
(audits of one item and one cost never begin with one another, as every insertion costs
something). So Knuth's agenda, popped by weight, finalises each item once, and stops when
the goal is popped.

Whole conversations are one agenda. Turns are dealt over tasks by ranges of conversation
and turn, so a conversation of any length is cut at the ranges' bounds; each part gives
its items for every pair of states, and the parts are joined by the same deduction.
Only the turns' letters and digests move for that. Texts move twice: once to find each
first occurrence, combined before the shuffle, and once to write the repaired turns.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import query, table

# What edits cost, and the wanted role by state: 0 nothing yet, 1 behind
# a system turn, 2 behind a user turn, 3 behind an assistant turn.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPTED = (0, 3)
ROLES = {"u": "user", "a": "assistant"}

# Fixed value: the characters that count as white space.
SPACE = " \t\n\x0b\x0c\r"

# Turns that one agenda takes; longer parts are joined from such blocks.
BLOCK = 48

# Letters of turns that must go, whose role is empty (it gives no initial), and of other roles.
FORCED, NAMELESS, OTHER = "-", "e", "x"

REPAIRS = ("conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, script string")


# --- deductions -----------------------------------------------------------------------

def _deductions(letters: str, i: int, q: int) -> Iterator[tuple[int, str, int, int]]:
    """``weight, edit, j, r`` of every item that one edit makes of ``[i, q]``."""
    for role in "ua":
        if role in STEPS[q]:
            yield INSERT, "I", i, STEPS[q][role]
    if i == len(letters):
        return
    letter = letters[i]
    yield DELETE, "D", i + 1, q
    if letter == FORCED:
        return
    more = TRUNCATED if letter.isupper() else 0
    if letter.lower() == NAMELESS:
        yield more, "K", i + 1, q
    if letter.lower() in STEPS[q]:
        yield more, "K", i + 1, STEPS[q][letter.lower()]
    for role in "ua":
        if role in STEPS[q]:
            yield REROLE + more, "R", i + 1, STEPS[q][role]


def _agenda(letters: str, start: int, whole: bool) -> dict[int, tuple[int, str]]:
    """The lightest (cost, audit) from ``start`` to each state behind all letters.

    With ``whole`` only the goal: the first accepted state that is finalised.
    """
    agenda, final = [(0, "", 0, start)], {}
    while agenda:
        cost, audit, i, q = heapq.heappop(agenda)
        if (i, q) in final:
            continue
        final[i, q] = cost, audit
        if whole and i == len(letters) and q in ACCEPTED:
            return {q: (cost, audit)}
        for weight, edit, j, r in _deductions(letters, i, q):
            if (j, r) not in final:
                heapq.heappush(agenda, (cost + weight, audit + edit, j, r))
    return {q: final[len(letters), q] for q in range(4) if (len(letters), q) in final}


def _script(letters: str, audit: str) -> str:
    """The audit without the edits of turns that had to go."""
    kept, i = [], 0
    for edit in audit:
        if edit == "I":
            kept.append(edit)
            continue
        if letters[i] != FORCED:
            kept.append(edit)
        i += 1
    return "".join(kept)


@lru_cache(1 << 15)
def _block(letters: str, whole: bool) -> dict[tuple[int, int], tuple[int, str, str]]:
    """``(p, q): (cost, audit, script)`` of a block of turns."""
    if letters and not letters.strip(FORCED):
        # However many: all go first, as their audit is the least, then come insertions.
        cost, audit = DELETE * len(letters), "D" * len(letters)
        return {(p, q): (cost + more, audit + behind, script)
                for (p, q), (more, behind, script) in _block("", False).items()}
    return {(p, q): (cost, audit, _script(letters, audit))
            for p in ((0,) if whole else range(4)) for q, (cost, audit) in _agenda(letters, p, whole).items()}


def _joined(left: dict, right: dict) -> dict:
    """Items ``[i, p, k, q]`` and ``[k, q, j, r]`` make ``[i, p, j, r]``; the lightest stays."""
    out: dict = {}
    for (p, q), (cost, audit, script) in left.items():
        for (q2, r), (cost2, audit2, script2) in right.items():
            if q2 == q and ((p, r) not in out or cost + cost2 <= out[p, r][0]):
                made = cost + cost2, audit + audit2, script + script2
                if (p, r) not in out or made < out[p, r]:
                    out[p, r] = made
    return out


def _all_joined(parts: list[dict]) -> dict:
    while len(parts) > 1:
        parts = [_joined(*parts[k:k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0]


def lightest(runs: list[tuple[str, int]], whole: bool) -> dict[tuple[int, int], tuple[int, str, str]]:
    """Items of turns given as runs of ``(letter, copies)``."""
    parts, block = [], ""
    for letter, n in runs:
        if n > BLOCK:
            parts += [_block(block, False)] * bool(block) + [_block(letter * n, False)]
            block = ""
            continue
        block += letter * n
        if len(block) >= BLOCK:
            parts.append(_block(block, False))
            block = ""
    if not parts:
        return _block(block, whole)
    return _all_joined(parts + [_block(block, False)] * bool(block))


def goal(items: dict) -> tuple[int, str, str]:
    """The lightest item from the start to an accepted state."""
    return min(item for (p, q), item in items.items() if p == 0 and q in ACCEPTED)


# --- rows -----------------------------------------------------------------------------

def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def _digest(*columns: str) -> Column:
    """128 bits of a SHA-256 of columns, each led by its length."""
    parts = [part for c in columns for part in (F.octet_length(c).cast("string"), F.lit(":"), F.col(c))]
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the CRC-32 of ``conv_id:turn`` modulo 20, a NULL counting as one space.

    0 takes the row out (``present`` is false), 1 empties its text, 2 removes ``.``, ``!``
    and ``?``, 3 gives it twice, 4 makes it a user's. The rest stays as it is.
    """
    kind = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn"))) % 20
    rows = conversations.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), kind.alias("_kind"))
    copies = F.when(F.col("_kind") == 3, 2).otherwise(1)
    return rows.select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
        .alias("text"),
        (F.col("_kind") != 0).alias("present"), copies.cast("bigint").alias("copies"))


def _entries(rows: DataFrame) -> DataFrame:
    """One narrow row per different turn: letter, whether it is the first of its kind, copies."""
    body = F.rtrim("text", F.lit(SPACE))
    blank = body == ""
    last = F.right(body, F.lit(1))
    marked = rows.select(
        "conv_id", "turn", "present", F.left("role", F.lit(1)).alias("initial"), _digest("role", "text").alias("digest"),
        blank.alias("blank"), (~blank & ~last.isin(".", "!", "?")).alias("cut"), "copies")
    entries = marked.groupBy("conv_id", "turn", "present", "initial", "digest", "blank", "cut").agg(F.sum("copies").alias("copies"))
    # NULL sorts before all turns.
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = entries.where("present AND NOT blank").groupBy("conv_id", "digest").agg(F.min(place).alias("first"))
    first = first.select(F.col("conv_id").alias("_id"), F.col("digest").alias("_digest"), "first")
    seen = entries.join(first, F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    return seen.select("conv_id", "turn", "present", "initial", "digest", "blank", "cut", "copies",
                       place.eqNullSafe(F.col("first")).alias("first"))


class _Part:
    """What a run of one conversation's turns in a task comes to."""

    def __init__(self, row: dict):
        self.conv_id, self.turn, self.digest = row["conv_id"], row["turn"], row["digest"]
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.initials, self.low, self.high, self.last_turn, self.runs = None, None, None, None, []

    def add(self, row: dict) -> None:
        if not row["present"]:
            return
        n, initial, turn = row["copies"], row["initial"], row["turn"]
        if self.initials is None:
            self.initials = [initial, initial]
        else:
            self.illegal += self.initials[1] + initial not in ("su", "ua", "au")
            self.initials[1] = initial
        self.illegal += n - 1
        if turn is not None:
            self.turns += turn != self.last_turn
            self.low, self.high, self.last_turn = turn if self.low is None else self.low, turn, turn
        if row["blank"] or not row["first"]:
            self.blank += n * row["blank"]
            self.duplicate += n * (not row["blank"])
            self.runs.append((FORCED, n))
            return
        letter = initial if initial in ("s", "u", "a") else OTHER if initial else NAMELESS
        self.runs.append((letter.upper() if row["cut"] else letter, 1))
        self.truncated += row["cut"]
        if n > 1:
            self.duplicate += n - 1
            self.runs.append((FORCED, n - 1))

    def row(self, whole: bool) -> dict:
        items = [{"p": p, "q": q, "cost": c, "audit": a, "script": s} for (p, q), (c, a, s) in lightest(self.runs, whole).items()]
        first, last = self.initials or (None, None)
        return {"conv_id": self.conv_id, "known": self.turn is not None, "turn": self.turn, "digest": self.digest,
                "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
                "turns": self.turns, "low": self.low, "high": self.high, "first": first, "last": last, "items": items}


_PART = ("conv_id {id}, known boolean, turn {turn}, digest binary, blank long, duplicate long, truncated long, "
         "illegal long, turns long, low {turn}, high {turn}, first string, last string, "
         "items array<struct<p:int,q:int,cost:long,audit:string,script:string>>")


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def _parts(schema: str):
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, inner = None, [], False
        for batch in batches:
            for row in batch.to_pylist():
                if part is None or row["conv_id"] != part.conv_id:
                    if part is not None:
                        made.append(part.row(inner))
                    # The first and the last conversation of a range may go on outside it.
                    inner, part = part is not None, _Part(row)
                part.add(row)
                if len(made) >= 2000:
                    yield pa.RecordBatch.from_pylist(made, arrow)
                    made = []
        if part is not None:
            made.append(part.row(False))
        if made:
            yield pa.RecordBatch.from_pylist(made, arrow)

    return run


def _merged(conv_id, rows: list[dict]) -> dict:
    """The parts of one conversation, at most one per range, as its repair."""
    rows = sorted(rows, key=lambda r: (r["known"], r["turn"] or 0, r["digest"]))
    out = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal")}
    some = [r for r in rows if r["first"] is not None]
    out["illegal"] += sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(some, some[1:]))
    turned = [r for r in rows if r["low"] is not None]
    turns = sum(r["turns"] for r in turned) - sum(a["high"] == b["low"] for a, b in zip(turned, turned[1:]))
    out["gaps"] = turned[-1]["high"] - turned[0]["low"] + 1 - turns if turned else 0
    out["cost"], out["audit"], out["script"] = goal(_all_joined([
        {(i["p"], i["q"]): (i["cost"], i["audit"], i["script"]) for i in r["items"]} for r in rows]))
    return {"conv_id": conv_id, **out}


def _merging(schema: str):
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([_merged(r["conv_id"], r["parts"]) for r in batch.to_pylist()], arrow)

    return run


def repairs(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, script`` per conversation.

    ``rows`` has ``conv_id, turn, role, text, present, copies`` as ``damage`` gives them.
    Turns are taken in order of ``turn`` (NULL first); turns of one number in order of their
    digests, equal ones beside one another. Rows that are not ``present`` only name their
    conversation; one without other rows costs nothing. Turns count as integers. ``script``
    is the audit without the deletions that blank and repeated turns need.
    """
    types = dict(rows.dtypes)
    names = {"id": types["conv_id"], "turn": types["turn"]}
    order = ["conv_id", "turn", "digest"]
    # Keys of the range are the whole order, so a part begins where another ends.
    ranged = _entries(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    parts = ranged.mapInArrow(_parts(_PART.format(**names)), _PART.format(**names))
    # A range gives a conversation one part, so no list is longer than there are ranges.
    lists = parts.groupBy("conv_id").agg(F.collect_list(F.struct(*[c for c in parts.columns if c != "conv_id"])).alias("parts"))
    return lists.mapInArrow(_merging(REPAIRS.format(**names)), REPAIRS.format(**names))


# --- repaired turns -------------------------------------------------------------------

def _with_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's repair followed by its different turns that need not go, in order.

    One text per conversation, role and text is moved, however many copies there are.
    """
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    kept = rows.where("present").where(F.rtrim("text", F.lit(SPACE)) != "")
    first = kept.groupBy("conv_id", "role", "text").agg(F.min(place).alias("place")).select(
        "conv_id", "place", "role", "text", _digest("role", "text").alias("digest"))
    both = found.select("*", F.lit(0).alias("kind")).unionByName(
        first.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "place", "digest")


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict | None, tuple | None]]:
    """``(repair, None)`` where a conversation begins, then ``(None, (edit, role, text))`` of its turns."""
    state, script, at = 0, "", 0

    def inserted():
        nonlocal state, at
        while script[at:at + 1] == "I":
            role = "u" if "u" in STEPS[state] else "a"
            state, at = STEPS[state][role], at + 1
            yield None, ("I", ROLES[role], "")

    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                yield from inserted()
                state, script, at = 0, row["script"], 0
                yield row, None
                continue
            yield from inserted()
            edit, at = script[at], at + 1
            if edit == "D":
                continue
            if edit == "K":
                role = row["role"]
                state = STEPS[state][role[0]] if role else state
            else:
                role = ROLES["u" if "u" in STEPS[state] else "a"]
                state = STEPS[state][role[0]]
            yield None, (edit, role, row["text"])
    yield from inserted()


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(arrow.names, row)) for row in rows], arrow)


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id, place, edit, role, text`` of the repaired conversations, place from 0."""
    schema = f"conv_id {dict(rows.dtypes)['conv_id']}, place long, edit string, role string, text string"
    arrow = _arrow(schema)

    def run(batches):
        conv, place, made = None, 0, []
        for repair, turn in _replayed(batches):
            if repair is not None:
                conv, place = repair["conv_id"], 0
                continue
            made.append((conv, place, *turn))
            place += 1
            if len(made) >= 500:
                yield _batch(made, arrow)
                made = []
        if made:
            yield _batch(made, arrow)

    return _with_turns(rows, found).mapInArrow(run, schema)


def with_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repairs with ``repaired_sha256``, the SHA-256 of the repaired ``role:text`` lines.

    One hash over a conversation can only be made in order; its turns stream through one
    task, which holds the hash and a batch of turns.
    """
    schema = (REPAIRS + ", repaired_sha256 string").format(id=dict(rows.dtypes)["conv_id"])
    arrow = _arrow(schema)

    def run(batches):
        open_row, sums, lines, made = None, None, 0, []
        for repair, turn in _replayed(batches):
            if repair is not None:
                if open_row is not None:
                    made.append(open_row | {"repaired_sha256": sums.hexdigest()})
                open_row, sums, lines = {name: repair[name] for name in arrow.names[:-1]}, hashlib.sha256(), 0
                if len(made) >= 2000:
                    yield pa.RecordBatch.from_pylist(made, arrow)
                    made = []
                continue
            _, role, text = turn
            sums.update(("\n" * (lines > 0) + f"{role}:{text}").encode())
            lines += 1
        if open_row is not None:
            made.append(open_row | {"repaired_sha256": sums.hexdigest()})
        if made:
            yield pa.RecordBatch.from_pylist(made, arrow)

    return _with_turns(rows, found).mapInArrow(run, schema)


@query("op13_conversation_repair")
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired.

    NULL ``conv_id`` is a conversation of its own; NULL turns come first and count in no gap;
    NULL roles and texts are one space. Repeated rows are duplicates. A conversation with
    no rows left has zeros, an empty audit and the hash of the empty text. An empty table
    gives no rows; other columns play no part.
    """
    rows = damage(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return with_digests(rows, repairs(rows)).drop("script")
