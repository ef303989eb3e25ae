"""Line dedup and the n-gram Jaccard join against brute force."""

import random
import re
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from cellframe.llm import line_dedup, ngram_jaccard
from cellframe.llm.common import components


def smallest_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingle_sets(docs, size=5):
    out = defaultdict(frozenset)
    for doc, text in docs:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        out[doc] |= frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()
    return out


def expected_components(docs):
    sets = shingle_sets(docs)
    links = [(a, b) for a, b in combinations(sorted(sets), 2)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    top = smallest_reachable(sets, links)
    return {doc: (len(s), top[doc]) for doc, s in sets.items()}


def near_copies(seed, n):
    rng = random.Random(seed)
    bases = [[f"w{rng.randrange(40)}" for _ in range(rng.choice((3, 8, 60)))] for _ in range(8)]
    passage = [f"p{k}" for k in range(30)]
    docs = []
    for doc in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice((0, 1, 1, 2, 4))):
            words[rng.randrange(len(words))] = f"e{rng.randrange(9)}"
        docs.append((doc, " ".join(passage + words if rng.random() < 0.3 else words)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    docs = near_copies(seed, 250)
    found = ngram_jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert {r[0]: (r[1], r[2]) for r in found.collect()} == expected_components(docs)


def test_one_group_of_many_near_copies_emits_few_pairs(spark):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(200)]
    docs = [(doc, " ".join(w if rng.random() > 0.004 else f"x{rng.randrange(10 ** 6)}" for w in base)) for doc in range(400)]
    found = {r[0]: r[2] for r in ngram_jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found == {doc: c for doc, (_, c) in expected_components(docs).items()}


def test_near_duplicates_of_odd_rows(documents, no_documents):
    found = {r[0]: (r[1], r[2]) for r in ngram_jaccard.near_duplicates(documents).collect()}
    assert set(found) == set(range(11))
    assert found[0] == (0, 0) and found[1] == (0, 1) and found[2] == (0, 2) and found[3] == (1, 3)
    assert found[4] == found[5] == (5, 4)
    assert ngram_jaccard.near_duplicates(no_documents).count() == 0


def test_near_duplicates_of_the_given_documents(spark, rows_of):
    docs = rows_of("documents", "doc_id, text")
    found = ngram_jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r[0]: (r[1], r[2]) for r in found.collect()} == expected_components(docs)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_bit_parallel_distance(spark, edits):
    rng = random.Random(edits)
    rows = []
    for _ in range(800):
        a = [rng.choice("abé") for _ in range(rng.randint(0, 12))]
        b = list(a)
        for _ in range(rng.randint(0, edits + 1)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randint(0, 1)] = rng.choice((["a"], ["b"], []))
        rows.append(("".join(a), "".join(b)))
    pairs = spark.createDataFrame(rows, "a string, b string")
    differ = pairs.where(line_dedup.edit_distance_at_most("a", "b", edits) != (F.levenshtein("a", "b") <= edits))
    assert differ.collect() == []


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def expected_lines(docs, min_chars, edits):
    lines = {(doc, no): line.strip(" ") for doc, text in docs for no, line in enumerate((text or "").split("\n")) if text is not None}
    lines = {at: line for at, line in lines.items() if len(line) >= min_chars}
    links = [(a, b) for a, b in combinations(sorted(lines), 2)
             if abs(len(lines[a]) - len(lines[b])) <= edits and distance(lines[a], lines[b]) <= edits]
    top = smallest_reachable(lines, links)
    return {at: first for at, first in top.items() if at != first}


@pytest.mark.parametrize("edits", [1, 2])
def test_line_classes_equal_brute_force(spark, edits):
    rng = random.Random(edits)
    bases = ["".join(rng.choice("abcd ") for _ in range(rng.randint(4, 14))) for _ in range(12)]

    def line():
        text = list(rng.choice(bases))
        for _ in range(rng.choice((0, 0, 1, 2))):
            at = rng.randrange(len(text) + 1)
            text[at:at + rng.randint(0, 1)] = rng.choice((["a"], ["é"], [" "], []))
        return "".join(text)

    docs = [(doc, "\n".join(line() for _ in range(rng.randint(0, 4)))) for doc in range(60)]
    found = line_dedup.line_classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), 5, edits)
    got = {(r["doc_id"], r["line_no"]): (r["first"]["doc_id"], r["first"]["line_no"]) for r in found.collect()}
    assert got == expected_lines(docs, 5, edits)


def test_edits_grow_with_the_length_of_a_line(spark):
    rng = random.Random(9)

    def allowed(n):
        return min(max(n // 16, 1), 4)

    docs = []
    for doc, n in enumerate([20, 24, 31, 32, 33, 47, 48, 49, 63, 64, 65, 66, 70, 90, 150, 300] * 2):
        base = "".join(rng.choice("abcdefghij ") for _ in range(n - 2))
        texts = [f"x{base}x"]
        for _ in range(5):
            text = list(texts[0])
            for _ in range(rng.randint(1, allowed(n) + 1)):
                at = rng.randrange(1, len(text) - 1)
                text[at:at + rng.randint(0, 1)] = rng.choice((["K"], ["é"], ["L"], []))
            texts.append("".join(text))
        docs.append((doc, "\n".join(texts)))
    lines = {(doc, no): line for doc, text in docs for no, line in enumerate(text.split("\n")) if len(line) >= 20}
    links = [(a, b) for a, b in combinations(sorted(lines), 2) if a[0] % 16 == b[0] % 16 or a[0] == b[0]
             if abs(len(lines[a]) - len(lines[b])) <= 4
             and distance(lines[a], lines[b]) <= allowed(min(len(lines[a]), len(lines[b])))]
    expected = {at: first for at, first in smallest_reachable(lines, links).items() if at != first}
    found = line_dedup.line_classes(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {(r["doc_id"], r["line_no"]): (r["first"]["doc_id"], r["first"]["line_no"]) for r in found.collect()} == expected
    word = "one changed word in tion ntoush lyonen and further words of the same line"
    docs = spark.createDataFrame([(1, word), (2, word.replace("tion", "er"))], "doc_id long, text string")
    assert line_dedup.line_classes(docs).count() == 1


def test_lines_without_near_copies_stay_out_of_the_segment_join(spark, monkeypatch):
    rng = random.Random(11)
    lines = [" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(30)) for _ in range(100)]
    docs = spark.createDataFrame([*enumerate(lines), (100, lines[0][:40] + "X" + lines[0][42:])], "doc_id long, text string")
    probing, segments = [], line_dedup._segments
    monkeypatch.setattr(line_dedup, "_segments", lambda lines, edits: probing.append(lines.count()) or segments(lines, edits))
    found = line_dedup.line_classes(docs).collect()
    assert [(r["doc_id"], r["first"]["doc_id"]) for r in found] == [(100, 0)]
    assert probing == [2]


def test_lines_of_many_and_of_few_words_equal_brute_force(spark):
    rng = random.Random(12)
    lines = []
    for words in (4, 7, 8, 10, 11, 13, 14, 15, 18):  # around the numbers of words that are enough
        base = " ".join("".join(rng.choice("abc") for _ in range(rng.randint(3, 6))) for _ in range(words))
        for _ in range(5):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                at = rng.randrange(1, len(text) - 1)
                text[at:at + rng.randint(0, 1)] = rng.choice(([" "], ["x"], [], [text[at]]))
            lines.append("".join(text))
    lines = [line for line in lines if len(line) >= 20]

    def allowed(n):
        return min(max(n // 16, 1), 4)

    links = [(a, b) for a, b in combinations(range(len(lines)), 2) if abs(len(lines[a]) - len(lines[b])) <= 4
             and distance(lines[a], lines[b]) <= allowed(min(len(lines[a]), len(lines[b])))]
    expected = {doc: first for doc, first in smallest_reachable(range(len(lines)), links).items() if doc != first}
    found = line_dedup.line_classes(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    assert {r["doc_id"]: r["first"]["doc_id"] for r in found.collect()} == expected


def test_common_start_and_end_are_left_out_of_the_distance(spark):
    rng = random.Random(13)
    rows = [("", ""), ("", "é"), ("aaa", "aa"), ("abab", "ab"), ("same", "same"), ("abcXdef", "abcYdef"), ("x" * 300 + "é", "x" * 300)]
    for _ in range(200):
        text = [rng.choice("abé ") for _ in range(rng.randint(0, 40))]
        other = list(text)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(other) + 1)
            other[at:at + rng.randint(0, 1)] = rng.choice((["a"], ["é"], []))
        rows.append(("".join(text), "".join(other)))
    frame = line_dedup._between(spark.createDataFrame([(*row, *row) for row in rows], "a string, b string, line_a string, line_b string"))
    for a, b, left, right in frame.collect():
        assert distance(left, right) == distance(a, b) and (not left or not right or (left[0] != right[0] and left[-1] != right[-1]))


def test_line_dedup_runs_no_python(documents, plan):
    frame = line_dedup.removed_lines(documents)
    assert not re.search("Python|Pandas|Arrow", plan(frame))


def test_repeated_lines_go(spark, documents, no_documents):
    line = "This line is long enough to take part."
    docs = spark.createDataFrame(
        [(1, f"{line}\nshort\n{line}", 7), (2, f"short\n  {line[:-1]}!", 8), (3, None, 9), (None, line, 1)], "doc_id long, text string, n_chars int")
    kept = {r["doc_id"]: (r["text"], r["n_chars"]) for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert kept == {1: (f"{line}\nshort", len(line) + 6), 2: ("short", 5), 3: (None, 9), None: (line, 1)}
    kept = line_dedup.drop_repeated_lines(documents)
    assert kept.columns == documents.columns and kept.count() == documents.count()
    assert [r["text"] for r in kept.where("doc_id = 5").collect()] == [""]
    assert line_dedup.drop_repeated_lines(no_documents).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(200, 200), (7, None)]
    links += [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(30)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    real = [(a, b) for a, b in links if b is not None and a != b]
    assert found == smallest_reachable({n for link in real for n in link}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
