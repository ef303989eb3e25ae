"""Classifiers and rules: held-out accuracy, exact search, counts against brute force."""

import math
import pickle
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cellframe.llm import labelled, quality_gam, quality_rules, toxicity
from cellframe.llm.common import word_hashes

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.mark.parametrize("scores, label, divisor, fold, least", [
    (quality_gam.quality_scores, "quality", 3, 1, 0.95), (toxicity.toxicity_scores, "toxic", 5, 0, 0.9)])
def test_held_out_accuracy(tables, scores, label, divisor, fold, least):
    docs, labels = tables
    truth = {r["doc_id"]: r[label] for r in labels.collect()}
    rows = scores(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % divisor == fold) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    judged = [r["predicted"] == truth[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(judged) / len(judged) >= least


@pytest.mark.parametrize("scores", [quality_gam.quality_scores, toxicity.toxicity_scores])
def test_scores_of_odd_rows(tables, documents, no_documents, scores):
    labels = tables[1]
    rows = {r["doc_id"]: r["score"] for r in scores(documents, labels).collect()}
    assert set(rows) == set(range(11)) and rows[0] == rows[1]
    assert scores(no_documents, labels).count() == 0
    assert scores(documents, labels.where("false")).count() == 12


def test_examples_are_bounded_and_outside_the_fold(spark, tables):
    docs, labels = tables
    few = labelled.examples(docs, labels, "toxic", 5, 0, 50).collect()
    assert len(few) == 50 and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in few)
    odd = spark.createDataFrame([(1, 0), (1, 1), (2, None), (3, 2), (None, 1), (4, 1), (4, 1)], "doc_id long, toxic int")
    assert {r["doc_id"] for r in labelled.examples(docs, odd, "toxic", 1, -1).collect()} == {4}


def test_search_equals_comparing_all_examples():
    rng = np.random.default_rng(1)
    bags = [{int(t): int(rng.integers(1, 4)) for t in rng.choice(40, rng.integers(0, 6), replace=False)} for _ in range(500)]
    index = toxicity.Index([b"%d" % k for k in range(40)], range(500), bags, rng.integers(0, 2, 500))
    dense = np.zeros((len(index.vectors), 40))
    for row, (terms, weights) in zip(dense, index.vectors, strict=True):
        row[terms] = weights
    for bag in bags[:150]:
        if bag:
            terms, weights = index.vector(bag)
            cosines = dense[:, terms] @ weights
            best = np.sort(cosines[cosines > 0])[::-1][:toxicity.NEIGHBOURS]
            places, values = index.search(terms, weights)
            assert np.allclose(values, best) and np.allclose(cosines[places], values)


@pytest.mark.parametrize("block, first, few", [(4, 1, 0), (16, 2, 3), (512, 6, 24)])
def test_blocks_are_left_out_and_nothing_is_lost(monkeypatch, block, first, few):
    """Examples of a few kinds: blocks of other kinds are never visited, and the nearest are those of a whole search."""
    for name, value in (("BLOCK", block), ("FIRST_BLOCKS", first), ("FEW", few), ("COMMON_SHARE", 0.2)):
        monkeypatch.setattr(toxicity, name, value)
    rng = np.random.default_rng(5)
    bags = []
    for k in range(600):
        own = rng.choice(80, rng.integers(3, 12), replace=False) + 100 * (k // 100)
        bags.append({int(t): int(rng.integers(1, 4)) for t in (*own, 600 + int(rng.integers(0, 40)), 650)})
    index = toxicity.Index([b"%d" % k for k in range(651)], range(600), bags, rng.integers(0, 2, 600))
    index = pickle.loads(pickle.dumps(index))
    dense = np.zeros((600, 651))
    for row, (terms, weights) in zip(dense, index.vectors, strict=True):
        row[terms] = weights
    tally = Counter()
    asked = [index.vector(bag) for bag in bags[:120]]
    for skips in (None, list(range(120))):
        for k, ((terms, weights), (places, values, _)) in enumerate(zip(asked, index.search_all(asked, skips=skips, tally=tally), strict=True)):
            cosines = dense[:, terms] @ weights
            if skips:
                cosines[k] = -1
            assert np.allclose(values, np.sort(cosines)[::-1][:toxicity.NEIGHBOURS]) and np.allclose(cosines[places], values)
    assert tally["visited"] <= tally["blocks"]
    if block < 512:
        assert tally["visited"] < 0.6 * tally["blocks"]


def test_toxic_held_out_rows_are_found(tables):
    docs, labels = tables
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = [r for r in toxicity.toxicity_scores(docs, labels).collect() if r["held_out"] and r["doc_id"] in truth]
    toxic = [r["predicted"] for r in rows if truth[r["doc_id"]] == 1]
    clean = [r["predicted"] for r in rows if truth[r["doc_id"]] == 0]
    assert sum(toxic) >= 0.7 * len(toxic) and sum(clean) <= 0.05 * len(clean), (sum(toxic), len(toxic), sum(clean), len(clean))


def test_an_id_with_two_texts_gives_one_example_every_time(spark):
    rows = [(1, "first text", "x"), (1, "second text", "y"), (2, None, "z")]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    found = {tuple(labelled.examples(spark.createDataFrame(order, "doc_id long, text string, y string").repartition(n), labels, "toxic", 1, -1)
                   .orderBy("doc_id").collect()) for order in (rows, rows[::-1]) for n in (1, 3)}
    assert len(found) == 1


def test_rare_words_of_examples_are_searched(spark):
    """A word that one example holds, and that says nothing about the label, still finds this example."""
    ids = [k for k in range(60) if zlib.crc32(str(k).encode()) % 5]
    docs = [(k, f"common text word{k} name{k}") for k in ids] + [(1000, f"word{ids[7]} other"), (1001, "unseen"), (1002, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in ids], "doc_id long, toxic int")
    index = toxicity.build_index(frame, labels)
    assert set(index.vocabulary) == {w.encode() for k in ids for w in ("common", "text", f"word{k}", f"name{k}")}
    rows = {r["doc_id"]: r for r in toxicity.toxicity_scores(frame, labels).collect()}
    assert rows[1000]["evidence"] == [ids[7]] and rows[1001]["evidence"] == rows[1002]["evidence"] == []
    assert all(rows[k]["evidence"][0] == k for k in ids)


def test_fit_learns_an_interaction():
    rng = np.random.default_rng(2)
    x = np.zeros((4000, len(quality_gam.FEATURES)))
    x[:, :2] = rng.normal(size=(4000, 2))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality_gam.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.9
    assert quality_gam.fit(x[:0], y[:0]).score(x[:1])[0] == 0.5


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered), failed


def test_rules_equal_brute_force(spark, tables, documents, no_documents):
    docs, labels = tables
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = quality_rules.apply_rules(docs, labels).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:7] == brute_counts(texts[r["doc_id"]])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= quality_rules.THRESHOLD)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["kept"] for r in rows if truth.get(r["doc_id"]) == 1 and not r["base_failed"])
    assert sum(r["kept"] for r in rows if truth.get(r["doc_id"]) == 0) <= 2
    odd = {r["doc_id"]: tuple(r)[1:7] for r in quality_rules.apply_rules(documents, labels).collect()}
    assert odd == {r["doc_id"]: brute_counts(r["text"]) for r in documents.where("doc_id IS NOT NULL").collect()}
    assert quality_rules.apply_rules(no_documents, labels).count() == 0
    assert quality_rules.apply_rules(documents, labels.where("false")).where("score <> 0").count() == 0


def test_all_trusted_rows_are_counted(spark):
    docs = spark.range(20_200).selectExpr("id AS doc_id", "concat('word', id) AS text")
    rows = quality_rules.apply_rules(docs, docs.selectExpr("doc_id", "1 AS quality"))
    assert rows.where("abs(score) > 1e-12").count() == 0 and rows.count() == 20_200


def test_log_ratio_equals_counting_by_hand():
    target, corpus = np.array([3, 1, 0]), np.array([4, 4, 2])
    expected = [math.log((t + 1) / 7) - math.log((c + 1) / 13) for t, c in zip(target, corpus, strict=True)]
    assert np.allclose(quality_rules.log_ratios(target, corpus), expected)


def test_word_hashes_depend_on_the_word_alone():
    text = "a bb  a\tccc\nbb \x0b é a".encode()
    words, hashes = re.findall(rb"[^\x20\x09-\x0D]+", text), word_hashes(text)
    assert len(words) == len(hashes) == 7
    assert len(set(hashes.tolist())) == len(set(words)) == len(set(zip(words, hashes.tolist(), strict=True)))
    assert len(word_hashes(b"")) == len(word_hashes(b" \n")) == 0


def test_packed_buckets_come_back():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 500):
        buckets = rng.integers(0, quality_rules.BUCKETS, n)
        assert quality_rules.unpacked(quality_rules.packed(buckets)).tolist() == sorted(buckets.tolist())
    ends = np.array([0, 0, 127, 128, 16383, 16384, quality_rules.BUCKETS - 1])
    assert quality_rules.unpacked(quality_rules.packed(ends)).tolist() == ends.tolist()


def test_trusted_counts_equal_counts_of_trusted_texts(spark, documents):
    ids = spark.createDataFrame([(4,), (6,), (7,), (99,)], "doc_id long")
    docs = quality_rules.texts(documents)
    trusted = quality_rules.gram_counts(docs.join(ids, "doc_id", "left_semi"))
    assert trusted.sum() > 0 and (quality_rules.trusted_counts(docs, ids) == trusted).all()
    assert quality_rules.trusted_counts(docs, ids.where("false")).sum() == 0
