"""Decontamination and secret scans against brute force; the pipeline's stages."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from cellframe.llm import fm_decontaminate as fm
from cellframe.llm import queries, secrets
from cellframe.llm.common import stored

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected_contamination(docs, items, window=10):
    owners = {}
    for name, text in items:
        own = words(text)
        for k in range(max(1, len(own) - window + 1) if own else 0):
            owners.setdefault(tuple(own[k:k + window]), set()).add(str(name))
    out = {}
    for doc, text in docs:
        own, hit, names = words(text), set(), set()
        for length in {len(w) for w in owners}:
            for k in range(len(own) - length + 1):
                if tuple(own[k:k + length]) in owners:
                    hit.update(range(k, k + length))
                    names |= owners[tuple(own[k:k + length])]
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out[doc] = len(own), len(hit), len(names), digest, bool(hit)
    return out


@pytest.mark.parametrize("block_bytes", [fm.BLOCK_BYTES, 300])
def test_contamination_equals_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(fm, "BLOCK_BYTES", block_bytes)
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    docs = [(k, text(rng.randint(0, 200))) for k in range(120)] + [(200, None), (201, ""), (202, "a, " * 3000), (203, "É a É")]
    items = [(f"i{k}", text(rng.choice((0, 3, 5, 12, 14)))) for k in range(50)] + [("x", None), ("i1", "a b"), (None, "a"), ("é", "É A")]
    frame = spark.createDataFrame([(*d, "t") for d in docs], "doc_id long, text string, items string")
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id string, text string, doc_id int")
    expected = expected_contamination(docs, [i for i in items if i[0] is not None])
    got = {r[0]: tuple(r)[1:] for r in fm.digests(fm.contamination(frame, bench)).collect()}
    assert got == expected
    kept = {r["doc_id"] for r in fm.drop_contaminated(frame, bench).collect()}
    assert kept == {doc for doc, found in expected.items() if not found[-1]}


def test_contamination_of_odd_rows(spark, documents, no_documents):
    bench = spark.createDataFrame([("i", "a line THAT is"), ("j", "")], "item_id string, text string")
    rows = [(r["doc_id"], r["starts"], r["ends"]) for r in fm.contamination(documents, bench).collect()]
    assert len(rows) == 12 and sorted(r for r in rows if r[1]) == [(4, [0], [4]), (4, [0], [4]), (5, [0], [4])]
    assert fm.contamination(no_documents, bench).count() == 0
    assert fm.contamination(documents, bench.where("false")).where("size(starts) > 0").count() == 0
    assert fm.drop_contaminated(documents, bench).count() == documents.count() - 3


def test_index_finds_and_locates_every_pattern():
    rng = np.random.default_rng(1)
    for top, n in ((2, 300), (5, 500), (40, 200)):
        codes = np.append(rng.integers(1, top + 1, n), 0)
        index = fm.FMIndex(codes)
        assert fm.suffix_array(codes).tolist() == sorted(range(n + 1), key=lambda k: codes[k:].tolist())
        for length in (1, 2, 5):
            patterns = rng.integers(1, top + 2, (30, length))
            low, high = index.find(patterns, np.full(30, length))
            for pattern, a, b in zip(patterns, low, high, strict=True):
                real = [k for k in range(n - length + 1) if (codes[k:k + length] == pattern).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == real


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def expected_base(text):
    text = text or ""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_base_spans_equal_brute_force(spark, rows_of):
    rng = random.Random(8)
    bits = ["token", "Secret", "API_KEY", "apikey", "paſſword", "toKen", '"', "'", " ", ":", "=", "0123456789abcdef", "AKIA", "ABCDEFGHIJKLMNOP",
            "xyz_12345678", "\n", "é", "deadbeef"]
    docs = [(k, "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))) for k in range(600)] + rows_of("documents", "doc_id + 1000, text")
    found = secrets.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    texts = dict(docs)
    for r in found:
        assert [tuple(s) for s in r["base"]] == expected_base(texts[r["doc_id"]])
        assert [tuple(s) for s in r["spans"] if s["kind"] != "novel"] == expected_base(texts[r["doc_id"]])
    assert len(found) == len(docs)


def test_novel_strings_in_sensitive_places(spark, documents, no_documents):
    random_key = "Zx9Kq2LmP0vTr8YwB3nH"
    docs = [(1, f"é my credential is {random_key} and more"), (2, f"my colour is {random_key} and more"),
            (3, "session key_key_key_key_key_key1 key_key_key_key_key_key1 key_key_key_key_key_key1"), (4, f'token = "{random_key}"')]
    rows = {r["doc_id"]: r["spans"] for r in secrets.digests(secrets.scan(spark.createDataFrame(docs, "doc_id long, text string"))).collect()}
    assert rows == {1: "novel:19:39", 2: "", 3: "", 4: "assign:0:30"} or rows == {1: "novel:19:39", 2: "", 3: "", 4: "assign:0:29"}
    odd = {r["doc_id"]: r["spans"] for r in secrets.digests(secrets.scan(documents)).collect()}
    assert odd[0] == odd[1] == "" and odd[10].startswith("assign:4:") and "hex:13:33" in odd[10]
    assert secrets.scan(no_documents).count() == 0


@pytest.mark.parametrize("before, value", [
    ("AWS_SECRET_ACCESS_KEY=", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzQ4v8LkT2a"), ("secret_key=", "Zx9Kq2LmP0vTr8YwB3nHc5Jd"),
    ("auth=", "Zx9Kq2LmP0vTr8YwB3nHc5Jd"), ("https://a.example/?signature=", "Zx9Kq2LmP0vTr8YwB3nHc5Jd"),
    ("client-secret-", "Zx9Kq2LmP0vTr8YwB3nHc5Jd"), ("client-secret-key-", "Zx9Kq2LmP0vTr8YwB3nHcg=="),
    ("auth:", "Zx9Kq2LmP0vTr8YwB3nHc5Jd"), ("auth=", "ZxKqLmPvTrYwBnHcJdGsQe"), ("session_id=", "8305917264401958372615")])
def test_unquoted_assignments_are_found(spark, before, value):
    docs = spark.createDataFrame([(1, f"é {before}{value}\nnext line")], "doc_id long, text string")
    [row] = secrets.digests(secrets.scan(docs)).collect()
    start = len(before) + 2
    assert f"novel:{start}:{start + len(value)}" in row["spans"] or f"hex:{start}:{start + len(value)}" in row["spans"]


def long_strings(text):
    """Values of at least 16 characters close behind sensitive words, one by one."""
    allowed = "A-Za-z0-9+/_.=-"
    ends = [m.end() for m in re.finditer("|".join(secrets.SENSITIVE), text, re.I | re.A)]
    out = set()
    for run in re.finditer(f"[{allowed}]{{16,}}", text):
        first, last = run.span()
        if any(first - secrets.REACH <= e <= first for e in ends):
            out.add((first, last))
        inside = [e for e in ends if first <= e < last]
        for e in inside:
            if m := re.compile(r"[A-Za-z0-9_.-]{0,39}=+([A-Za-z0-9+/_.=-]{16,})").match(text, e, last):
                out.add(m.span(1))
                break
        words = "|".join(secrets.SENSITIVE)
        for e in inside:
            if m := re.compile(rf"(?:[/_.-]*(?:{words}))*[/_.-]+([A-Za-z0-9+/_.=-]{{16,}})", re.I | re.A).match(text, e, last):
                out.add(m.span(1))
                break
    return out


def test_candidates_equal_a_search_from_every_word():
    rng = random.Random(4)
    bits = ["key", "Secret", "token", "auth", "=", "==", "-", "_", "/", ".", " ", ":", "x", "abcdefgh", "0123456789abcdefXYZ", "\n", "é"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 25)))
        assert {(a, b) for a, b, _ in secrets.candidates(text, [])} == long_strings(text), text


@pytest.mark.parametrize("part", ["key ", "key", "key=", "key-a", "key==", "secret_", "a", "key=" + "a" * 20 + " ", "token: "])
def test_candidates_take_time_in_line_with_the_text(part):
    text = part * (1_000_000 // len(part))
    began = time.perf_counter()
    found = secrets.candidates(text, [])
    assert time.perf_counter() - began < 8
    assert sum(b - a for a, b, _ in found) <= 3 * len(text)


def test_planted_secrets_and_other_long_strings(spark):
    """Of secrets of known kinds nearly all are found, of names few (measured: 1.0 and 0.17)."""
    rng = random.Random(12)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    make = lambda n, of=letters: "".join(rng.choice(of) for _ in range(n))
    forms = ["client_secret: {}", "session-key={}", "my credential is {} now", "Authorization: Bearer {}", "private_key=\"{}\"", "signature={}&x=1"]
    planted = [f.format(make(rng.randint(20, 40))) for f in forms * 20]
    words = "value of the main page name for every user and item in this list that was".split()
    name = lambda: "_".join(rng.choice(words) for _ in range(rng.randint(4, 7)))
    harmless = [f.format(name()) for f in forms * 20]
    docs = [(k, f"Some text before. {t}\nAnd some after.") for k, t in enumerate(planted + harmless)]
    rows = secrets.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    found = {r["doc_id"] for r in rows if r["spans"]}
    recall = len(found & set(range(120))) / 120
    alarms = len(found - set(range(120))) / 120
    assert recall >= 0.95 and alarms <= 0.2, (recall, alarms)


def test_all_are_registered():
    assert {name.partition("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_near_duplicates_go_row_by_row(spark):
    import corpus_pipeline as pipeline

    same, other = " ".join(f"w{k}" for k in range(40)), " ".join(f"v{k}" for k in range(40))
    near = same + " end"
    rows = [(1, same), (1, same), (2, same), (2, other), (3, same), (4, near), (None, same), (5, ""), (6, ""), (7, None)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, n_chars long")
    kept = pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(((r[0], r[1]) for r in kept.collect()), key=repr) == sorted(
        [(1, same), (2, other), (None, same), (5, ""), (6, ""), (7, None)], key=repr)
    assert pipeline.near_duplicates(spark, docs.where("false"), "").count() == 0


def test_pipeline_keeps_columns_and_packs(spark):
    import corpus_pipeline as pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs
    for _, stage in pipeline.STAGES[:-1]:
        after = stored(stage(spark, before, sf_dir), "test")
        assert after.columns == columns and after.count() <= before.count()
        before = after
    rows = pipeline.run(spark, sf_dir).collect()
    assert 0 < len({r["doc_id"] for r in rows}) <= docs.count()
    assert pipeline.ORACLE_SQL is None and [name for name, _ in pipeline.STAGES][-1] == "best_fit_packing"
