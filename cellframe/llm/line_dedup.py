"""Near-duplicate lines by a segment-partition edit-distance join, in SQL functions.

A line of at least ``MIN_CHARS`` characters takes part; two such lines link when their
edit distance is at most what the shorter one allows: one edit per ``CHARS_PER_EDIT``
characters, from 1 to ``MOST_EDITS``. Cut a line that allows ``e`` edits into ``e + 1``
segments: one of them occurs unchanged in any line it links to, near its own place. So
every line is indexed by its segments, and probes the segments of lines as long as
itself or a few characters shorter at the few places that can matter.

Lines that link with none are left out of that join beforehand, as they have dozens of
probes each. An edit changes at most three pairs of neighbouring words. So of any
``3 * edits + 1`` distinct pairs of a line one is in every line it links to, and under one
order of all pairs two such lines share one among their first ``3 * edits + 1``. The order
puts long pairs first, which few lines share. A line with so many pairs goes on if it shares
one of its first with a line about as long; lines with fewer pairs always go on.

Candidates must agree in a 64-bit signature of their words (one edit flips at most
three bits of it), which keeps lines that only share one segment apart inside the join,
and are verified with a banded bit-parallel edit distance of what lies between their
common start and end.

Equal lines are brought together first, by hash and with partial aggregation, so a
line that fills a third of the corpus is one row in all later steps. Only hashes move before
lines are left out; the texts of the others are read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import COMPILED_METHODS, session_settings
from .common import Scratch, components, query, table, texts

MIN_CHARS = 20
CHARS_PER_EDIT, MOST_EDITS = 16, 4
TOUCHED = 3  # word pairs that one edit changes at most: where two words become one


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``at`` (document, version of its text, line number) and ``line`` of lines taking part."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("version"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select("doc_id", "version", "line_no", F.trim("line").alias("line")).where(F.char_length("line") >= min_chars)


def _classes(max_edits: int | None) -> list[tuple[int, int | None, int]]:
    """``least, end, edits``: the lengths of lines that allow so many edits; a given number holds for all."""
    if max_edits is not None:
        return [(0, None, max_edits)]
    least = [0, *(CHARS_PER_EDIT * edits for edits in range(2, MOST_EDITS + 1))]
    return list(zip(least, [*least[1:], None], range(1, MOST_EDITS + 1), strict=True))


def _within(length: Column, least: int, end: int | None) -> Column:
    return (length >= least) if end is None else (length >= least) & (length < end)


def _allowed(length: Column, max_edits: int | None) -> Column:
    return F.coalesce(*(F.when(_within(length, least, end), edits) for least, end, edits in _classes(max_edits)))


def _segments(lines: DataFrame, max_edits: int | None) -> DataFrame:
    """A row per segment of a line that indexes it (``own``) or that it probes with: ``h, own, id, n, sig``.

    ``code`` has the line in UTF-32, where a character's place needs no walk from the start.
    """
    places, most = [], _classes(max_edits)[-1][2]
    for shorter in range(most + 1):
        cases = F
        for least, end, edits in _classes(max_edits):
            if shorter <= edits:
                found = [f"named_struct('shorter', {shorter}, 'parts', {edits + 1}, 'i', {i}, 'shift', {shift})" for i in range(edits + 1)
                         for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + edits - i) + 1)]
                cases = cases.when(_within(F.col("n") - shorter, least, end), F.expr(f"array({', '.join(found)})"))
        places.append(F.coalesce(cases, F.expr("filter(array(named_struct('shorter', 0, 'parts', 0, 'i', 0, 'shift', 0)), x -> false)")))
    rows = lines.select("id", "n", "sig", "code", F.explode(F.concat(*places)).alias("at"))
    rows = rows.select("id", "n", "sig", "code", "at.*", (F.col("n") - F.col("at.shorter")).alias("length"))
    # The last ``length % parts`` segments are one longer.
    part = F.expr("""substring(code, 4 * (i * CAST(length div parts AS INT) + greatest(0, i - parts + length % parts) + shift) + 1,
      4 * (CAST(length div parts AS INT) + CASE WHEN i >= parts - length % parts THEN 1 ELSE 0 END))""")
    return rows.select(F.xxhash64("length", "i", part).alias("h"), F.expr("shorter = 0 AND shift = 0").alias("own"), "id", "n", "sig")


def _signature() -> Column:
    return F.expr("aggregate(split(line, ' '), 0L, (bits, word) -> bits ^ shiftleft(1L, CAST(xxhash64(word) & 63 AS INT)))")


def _first_pairs(needed: Column) -> Column:
    """Of ``words``, the hashes of the ``needed`` first distinct pairs, or of all; their upper bits put long ones first."""
    pairs = F.expr("""transform(slice(words, 1, size(words) - 1), (word, i) ->
      shiftleft(CAST(63 - least(63, octet_length(word) + octet_length(words[i + 1])) AS BIGINT), 57)
      | shiftrightunsigned(xxhash64(word, words[i + 1]), 7))""")
    return F.slice(F.sort_array(F.array_distinct(pairs)), F.lit(1), needed)


def edit_distance_at_most(left: str, right: str, edits: int) -> Column:
    """Whether the edit distance of two text columns is at most ``edits``.

    Bit ``b`` of a word of ``2 * edits + 2`` bits stands for one cell of the band
    around the diagonal. Per character of ``right`` the vertical differences of the
    band are updated with a few logical operations and one addition (Hyyrö 2003); the
    distance follows the band's lower edge, then the last row. NULL gives NULL.
    """
    width = 2 * edits + 2
    full, top = (1 << width) - 1, 1 << (width - 1)
    start = ((1 << (edits + 1)) - 1) << (width - edits - 1)
    equal = " | ".join(
        f"CASE WHEN get(p, i + {edits - (width - 1 - bit)}) = get(t, i) THEN {1 << bit}L ELSE 0L END" for bit in range(width))
    step = f"""transform(array({equal}), eq ->
      transform(array(((((eq & s.vp) + s.vp) & {full}L) ^ s.vp) | eq | s.vn), d0 ->
        transform(array(s.vn | (~(d0 | s.vp) & {full}L)), hp -> named_struct(
          'vp', (d0 & s.vp) | (~(shiftrightunsigned(d0, 1) | hp) & {full}L),
          'vn', shiftrightunsigned(d0, 1) & hp,
          'd', s.d + CASE
            WHEN i < size(p) - {edits} THEN CASE WHEN d0 & {top}L = 0 THEN 1 ELSE 0 END
            WHEN hp & shiftrightunsigned({top}L, i - size(p) + {edits} + 1) <> 0 THEN 1
            WHEN d0 & s.vp & shiftrightunsigned({top}L, i - size(p) + {edits} + 1) <> 0 THEN -1
            ELSE 0 END))[0])[0])[0]"""
    walk = f"""aggregate(sequence(0, size(t) - 1),
      named_struct('vp', {start}L, 'vn', 0L, 'd', {edits}), (s, i) -> {step}, s -> s.d <= {edits})"""
    chars = f"transform(array(named_struct('p', split({left}, ''), 't', split({right}, ''))), x -> {walk})[0]"
    walk_on = chars.replace("get(p,", "get(x.p,").replace("get(t,", "get(x.t,").replace("size(p)", "size(x.p)").replace("size(t)", "size(x.t)")
    return F.expr(f"""CASE WHEN abs(char_length({left}) - char_length({right})) > {edits} THEN false
      WHEN least(char_length({left}), char_length({right})) <= {edits}
        THEN levenshtein({left}, {right}) <= {edits} ELSE {walk_on} END""")


def _common_start(left: str, right: str) -> str:
    """How many characters two texts share from their start on, a power of two after the other."""
    return f"""aggregate(transform(sequence(0, 20), i -> shiftleft(1, 20 - i)), 0, (p, w) ->
      CASE WHEN p + w <= least(char_length({left}), char_length({right}))
        AND substring({left}, p + 1, w) = substring({right}, p + 1, w) THEN p + w ELSE p END)"""


def _between(pairs: DataFrame) -> DataFrame:
    """``line_a`` and ``line_b`` without their common start and end, which leaves their edit distance as it is."""
    for _ in range(2):
        pairs = pairs.withColumn("same", F.expr(_common_start("line_a", "line_b")))
        for line in ("line_a", "line_b"):
            pairs = pairs.withColumn(line, F.reverse(F.expr(f"substring({line}, same + 1)")))
    return pairs.drop("same")


def line_classes(docs: DataFrame, min_chars: int = MIN_CHARS, max_edits: int | None = None) -> DataFrame:
    """The repeated lines: ``doc_id, version, line_no, first`` (doc_id, version, line_no).

    Lines are compared without spaces around them. A number ``max_edits`` holds for
    lines of any length; by default it follows the length. ``first`` is the earliest line,
    by document id and line number, of those reachable over links; the first line
    itself gives no row. Shorter lines, empty texts and NULL texts give none; rows
    that repeat an id and text count as one; an empty table gives an empty result.
    """
    # Every step is written before the next one starts, so its shuffle files can go when it has ended.
    with session_settings(docs.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", **COMPILED_METHODS}):
        return _line_classes(texts(docs), min_chars, max_edits)


def _line_classes(docs: DataFrame, min_chars: int, max_edits: int | None) -> DataFrame:
    files = Scratch(docs.sparkSession, "line-dedup")
    lines = _lines(docs, max(min_chars, _classes(max_edits)[-1][2] + 1))
    place, key = F.struct("doc_id", "version", "line_no"), F.unhex(F.md5("line")).alias("key")
    needed = TOUCHED * _allowed(F.col("n"), max_edits) + 1
    prepared = lines.select(place.alias("at"), key, F.char_length("line").alias("n"), F.split("line", " ").alias("words"))
    prepared = prepared.select("at", "key", "n", _first_pairs(needed).alias("pairs"))
    firsts = prepared.groupBy("key").agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("times"),
                                         F.first("n").alias("n"), F.first("pairs").alias("pairs"))
    firsts = files.store(firsts.withColumn("id", F.monotonically_increasing_id()), "firsts")

    # Lines that may link.
    enough = F.size("pairs") >= needed
    paired = [firsts.where(enough if side == "a" else F.lit(True)).select(F.explode("pairs").alias("h"), "id", "n").alias(side)
              for side in ("a", "b")]
    near = F.abs(F.col("a.n") - F.col("b.n")) <= _allowed(F.least("a.n", "b.n"), max_edits)
    going = paired[0].join(paired[1], F.expr("a.h = b.h AND a.id <> b.id") & near, "left_semi").select("id")
    going = files.store(firsts.where(~enough).select("id").unionByName(going).distinct().join(
        firsts.select("id", "at"), "id"), "going")
    found = _lines(docs.join(going.select("at.doc_id").distinct(), "doc_id", "left_semi"), min_chars)
    found = files.store(found.select(place.alias("at"), "line").join(going, "at").select("id", "line").distinct(), "found")

    coded = found.select("id", F.char_length("line").alias("n"), _signature().alias("sig"), F.encode("line", "UTF-32").alias("code"))
    segments = _segments(coded, max_edits)
    allowed = _allowed(F.col("a.n"), max_edits)
    condition = (F.expr("a.h = b.h AND (a.n < b.n OR a.n = b.n AND a.id < b.id)") & (F.col("b.n") - F.col("a.n") <= allowed)
                 & (F.bit_count(F.col("a.sig").bitwiseXOR(F.col("b.sig"))) <= 3 * allowed))
    pairs = segments.where("own").alias("a").join(segments.alias("b"), condition)
    pairs = files.store(pairs.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct(), "pairs")
    both = pairs
    for side in ("a", "b"):
        both = both.join(found.select(F.col("id").alias(side), F.col("line").alias(f"line_{side}")), side)
    shorter = F.least(F.char_length("line_a"), F.char_length("line_b"))
    # Spark's own bounded distance is compiled and sorts out most candidates.
    both = both.where(F.coalesce(*(F.when(_within(shorter, least, end), F.levenshtein("line_a", "line_b", edits) >= 0)
                                   for least, end, edits in _classes(max_edits))))
    # Written, as a filter would compute what lies between again for each of its uses.
    both = files.store(_between(both.withColumn("edits", _allowed(shorter, max_edits))), "between")
    linked = F.coalesce(*(F.when(F.col("edits") == edits, edit_distance_at_most("line_a", "line_b", edits))
                          for _, _, edits in _classes(max_edits)))
    edges = files.store(both.where(linked).select("a", "b"), "edges")
    files.drop("going", "found", "pairs", "between")

    # The earliest line names its class.
    members = firsts.join(components(edges).withColumnRenamed("node", "id"), "id", "left").where("times > 1 OR component IS NOT NULL")
    members = members.select("key", "at", F.coalesce("component", "id").alias("component"))
    earliest = members.groupBy("component").agg(F.min("at").alias("first"))
    classes = files.store(members.join(earliest, "component").select("key", "first"), "classes")
    files.drop("firsts", "edges")
    return lines.select("doc_id", "version", "line_no", key).join(classes, "key").where(place != F.col("first")).select(
        "doc_id", "version", "line_no", "first").distinct()


def removed_lines(docs: DataFrame, min_chars: int = MIN_CHARS, max_edits: int | None = None) -> DataFrame:
    """``doc_id, version, removed``: the repeated lines of each text, with their first lines."""
    entry = F.struct("line_no", F.col("first.doc_id").alias("first_doc"), F.col("first.line_no").alias("first_line"))
    return line_classes(docs, min_chars, max_edits).groupBy("doc_id", "version").agg(
        F.array_sort(F.collect_list(entry)).alias("removed"))  # no longer than the text


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, max_edits: int | None = None) -> DataFrame:
    """The documents, same columns, without the lines that repeat an earlier one.

    A text keeps its other lines as they are; where none is left it is empty. A column
    ``n_chars`` is counted again. NULL texts and rows without an id stay as they are.
    """
    removed = removed_lines(docs, min_chars, max_edits).alias("gone")
    joined = docs.alias("doc").join(removed, (F.col("doc.doc_id").cast("bigint") == F.col("gone.doc_id"))
                                    & (F.xxhash64(F.col("doc.text").cast("string")) == F.col("gone.version")), "left")
    kept = F.expr("array_join(filter(split(doc.text, '\n'), (line, i) -> NOT array_contains(gone.removed.line_no, i)), '\n')")
    whole = F.col("gone.removed").isNull()
    changed = {"text": F.when(whole, F.col("doc.text")).otherwise(kept)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(whole, F.col("doc.n_chars")).otherwise(F.char_length(kept)).cast(docs.schema["n_chars"].dataType)
    return joined.select(*[changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


@query("op2_line_dedup")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, and which of them repeat which earlier line."""
    docs = table(spark, sf_dir, "documents")
    counts = texts(docs).select("doc_id", F.xxhash64("text").alias("version"),
                                F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"))
    return counts.join(removed_lines(docs), ["doc_id", "version"], "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.col("removed.line_no").alias("removed_lines"), F.col("removed.first_doc").alias("first_docs"),
        F.col("removed.first_line").alias("first_lines"))
