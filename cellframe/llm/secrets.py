"""Secret scans: patterns, and strings that surrounding text and known words cannot explain.

Patterns give the base spans. Besides, every long string that follows a sensitive word
closely is a candidate, also where only ``=`` or the joints of a name part it from that
word: with a zstandard dictionary of the commonest words around such places, and in names
at such places, in all documents, its surroundings are compressed without it and with it. The
bytes it adds, per character, are its novelty; strings that hardly compress are
reported as ``novel``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, stored, table, texts

# The base patterns, in the order in which kinds are listed.
PATTERNS = (
    ("assign", re.compile(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]{16,}")),
)
_WORDS_OF_ASSIGN = ("password", "passwd", "secret", "token", "api")
SENSITIVE = ("key", "secret", "token", "passw", "credential", "auth", "bearer", "private", "signature", "session")
KINDS = ("assign", "access", "hex", "novel")

REACH, AROUND = 40, 160
DICTIONARY_WORDS = 2048
MIN_NOVELTY = 0.88  # random strings cost 0.89 to 1.0, names of known words 0.3 to 0.8
NAME_PARTS = 3  # different strings that hold a part of a name at least
_SENSITIVE = re.compile("|".join(SENSITIVE), re.IGNORECASE | re.ASCII)
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
# Behind a sensitive word: the rest of a name up to "=", or else joints.
_ASSIGNED = re.compile(rf"[A-Za-z0-9_.-]{{0,{REACH - 1}}}(=+)")
_JOINTS = re.compile(r"[/_.-]+")
LEAST = 16


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``kind, start, end`` of the base matches, by start and then kind as listed."""
    lower = text.lower()
    found = []
    if any(word in lower for word in _WORDS_OF_ASSIGN):
        found += [("assign", *m.span()) for m in PATTERNS[0][1].finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in PATTERNS[1][1].finditer(text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in PATTERNS[2][1].finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _joint_words(text: str, words: list[tuple[int, int]]) -> list[list[int]]:
    """The ends of sensitive words, those that only joints part from one another together."""
    chains: list[list[int]] = []
    for k, (start, end) in enumerate(words):
        before = words[k - 1][1] if k else -1
        joint = _JOINTS.match(text, before, start) if k else None
        if k and (start == before or (joint and joint.end() == start)):
            chains[-1].append(end)
        else:
            chains.append([end])
    return chains


def _behind(text: str, end: int, last: int, pattern: re.Pattern, group: int) -> int | None:
    """Where the value begins that a sensitive word, a pattern and at least ``LEAST`` characters make."""
    found = pattern.match(text, end, last)
    if found is None:
        return None
    start = min(found.end(), last - LEAST)  # the value may begin with some of the pattern's own characters
    return start if start > found.start(group) else None


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, str]]:
    """``start, end, surroundings`` of long strings close behind a sensitive word, outside base spans.

    Runs of ``LEAST`` characters or more that a secret may have are listed once. Each gives
    itself, if a word ends at most ``REACH`` characters before it, the part behind the first
    word and ``=`` in it, and the part behind its first chain of words and joints. So a text
    has at most three candidates a run, and takes time in line with its length.
    """
    lower = text.lower()
    if not any(word in lower for word in SENSITIVE):
        return []
    words = [m.span() for m in _SENSITIVE.finditer(text)]
    chains = _joint_words(text, words)
    seen: dict[tuple[int, int], None] = {}
    at = chain = 0
    for run in _RUN.finditer(text):
        first, last = run.span()
        while at < len(words) and words[at][1] <= first:
            at += 1
        if at and words[at - 1][1] >= first - REACH:
            seen[first, last] = None
        assigned = joined = None
        # A word that ends where the run begins stands before it, but "=" or a joint may follow.
        for k in range(max(0, at - 1), len(words)):
            end = words[k][1]
            if end >= last or assigned is not None:
                break
            if end >= first:
                assigned = _behind(text, end, last, _ASSIGNED, 1)
        while chain < len(chains) and chains[chain][-1] < first:
            chain += 1
        for own in chains[chain:]:
            if own[0] >= last or joined is not None:
                break
            for end in reversed(own):
                if first <= end < last and joined is None:
                    joined = _behind(text, end, last, _JOINTS, 0)
        for start in (assigned, joined):
            if start is not None:
                seen[start, last] = None
    starts, furthest = [a for _, a, _ in base], list(accumulate((b for *_, b in base), max))

    def outside(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return not before or furthest[before - 1] <= start

    return [(a, b, text[max(0, a - AROUND):a] + "\n" + text[b:b + AROUND]) for a, b in seen if outside(a, b)]


def novelty(candidate: str, surroundings: str, compressor: zstandard.ZstdCompressor) -> float:
    """The compressed bytes that a candidate adds to its surroundings, per character."""
    context = surroundings.encode()
    added = len(compressor.compress(context + candidate.encode())) - len(compressor.compress(context))
    return added / len(candidate)


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_SPAN = "array<struct<kind:string,start:int,end:int>>"
_CANDIDATES = "array<struct<start:int,end:int,text:string,around:string>>"


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, spans, base`` of every row with an id: all spans, and the base ones.

    Whole texts are scanned; NULL counts as empty. Repeated rows get equal results; an
    empty table gives an empty result; other columns are ignored. Offsets are code
    points, ends exclusive.
    """
    def first(batches):
        for batch in batches:
            base = [base_spans(text or "") for text in batch["text"]]
            more = [[(a, b, text[a:b], around) for a, b, around in candidates(text, own)] if text else []
                    for text, own in zip(batch["text"], base, strict=True)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "base": [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in own] for own in base],
                                "more": [[dict(zip(("start", "end", "text", "around"), s, strict=True)) for s in own] for own in more]})

    scanned = stored(texts(docs).mapInPandas(first, f"doc_id long, base {_SPAN}, more {_CANDIDATES}"), "scanned")
    near = scanned.select(F.explode("more.around").alias("around")).select(
        F.explode(F.split("around", r"[^A-Za-z0-9_]+")).alias("word")).where("char_length(word) BETWEEN 3 AND 64")
    # Parts of names in the strings themselves, each string counted once: copies of a secret make no word common.
    parts = scanned.select(F.explode("more.text").alias("text")).distinct().select(
        "text", F.explode(F.array_distinct(F.split("text", "[^A-Za-z]+"))).alias("word")).where("char_length(word) BETWEEN 3 AND 12")
    parts = parts.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= NAME_PARTS)
    counted = near.groupBy("word").agg(F.count(F.lit(1)).alias("n")).unionByName(parts)
    common = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(DICTIONARY_WORDS)
    words = [r["word"] for r in common.collect()]  # the size of the dictionary
    # zstandard finds the end of a dictionary most cheaply: the commonest words come last.
    primer = " ".join(reversed(words)).encode() or b"key = "

    def judge(batches):
        data = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        compressor = zstandard.ZstdCompressor(level=9, dict_data=data, write_content_size=False, write_dict_id=False)
        for batch in batches:
            spans = []
            for base, more in zip(batch["base"], batch["more"], strict=True):
                novel = [{"kind": "novel", "start": c["start"], "end": c["end"]} for c in more
                         if novelty(c["text"], c["around"], compressor) >= MIN_NOVELTY]
                spans.append(sorted([*base, *novel], key=lambda s: (s["start"], KINDS.index(s["kind"]), s["end"])))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "spans": spans, "base": batch["base"]})

    return scanned.mapInPandas(judge, f"doc_id long, spans {_SPAN}, base {_SPAN}")


def digests(found: DataFrame) -> DataFrame:
    """Counts by base kind, a hash of the base spans and the text of all spans."""
    def text(column: str):
        return F.expr(f"array_join(transform({column}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")

    def count(kind: str):
        return F.expr(f"CAST(size(filter(base, s -> s.kind = '{kind}')) AS BIGINT)").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


@query("op9_secrets")
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(scan(table(spark, sf_dir, "documents")))
