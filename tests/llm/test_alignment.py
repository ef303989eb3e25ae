"""Token alignment against whole texts, token by token."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cellframe.llm import token_alignment as ta

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    alphabet = ta.byte_level_alphabet()
    spell = {n: bytes(alphabet.get(c, 0) for c in t) for t, n in a.get_vocab().items()}

    def piece(k):
        p = b.id_to_piece(k)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p[:3] == "<0x" else p.replace("▁", " ").encode()

    def tokens(text):
        """``[(id, end), ...]`` of both sides, or nothing."""
        if not text:
            return [], []
        x = [(k, spell[k]) for k in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(k, piece(k)) for k in b.encode(text)]
        if b"".join(t for _, t in x) != (" " + text).encode() or b"".join(t for _, t in y) != (" " + text).encode():
            return [], []
        sides = []
        for side in (x, y):
            end, out = 0, []
            for k, t in side:
                end += len(t)
                out.append((k, end))
            sides.append(out)
        return tuple(sides)

    return tokens


def expected(libraries, docs):
    count, per = Counter(), []
    for doc, text in docs:
        a, b = libraries(text)
        pairs = [(x, y) for x, e in a for y, f in b if e == f] if len(a) < 400 else [
            (dict((f, y) for y, f in b), x, e) for x, e in a]
        if len(a) >= 400:
            at = dict((f, y) for y, f in b)
            pairs = [(x, at[e]) for x, e in a if e in at]
        count.update(pairs)
        cuts = sorted({e for _, e in a} & {f for _, f in b})
        rows, low = [], 0
        for cut in cuts:
            rows.append(",".join(str(k) for k, e in a if low < e <= cut) + "|" + ",".join(str(k) for k, e in b if low < e <= cut))
            low = cut
        per.append((doc, len(a), len(b), len(cuts), pairs, hashlib.sha256(";".join(rows).encode()).hexdigest() if a else ""))
    most = Counter()
    for (x, y), n in count.items():
        most[y] = max(most[y], n)
    return sorted((doc, na, nb, ng, len(p), digest, sum(count[q] == most[q[1]] for q in p), sum(count[q] for q in p))
                  for doc, na, nb, ng, p, digest in per)


def odd_texts(rng):
    parts = ["Hello", "wörld", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0", "　", "▁", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "'s", "don't", "1234",
             "é", "日本語", "🙂", "\x00", "\x1c", "\x85", "...", "a", "I'll", "_", "Ａ", "﻿", "x" * 30, " ", "zebra"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(400)]


def test_alignment_equals_whole_texts(spark, libraries):
    rng = random.Random(6)
    texts = [None, "", " ", "\n", "▁", "<|endoftext|> in text", "word " * 500, *odd_texts(rng)]
    docs = list(enumerate(texts)) + [(3, "again"), (7, "again")]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs] + [(None, "no id", "x", 1)], "doc_id long, text string, pairs string, n long")
    got = sorted(tuple(r) for r in ta.digests(frame, A, B).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum").collect())
    want = expected(libraries, docs)
    wrong = [(g, w, docs[g[0]]) for g, w in zip(got, want) if g != w]
    assert not wrong[:3] and len(got) == len(want)


def test_given_documents(spark, libraries, rows_of):
    docs = [(d, t) for d, t in rows_of("documents", "doc_id, text")][:60]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(tuple(r) for r in ta.digests(frame, A, B).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum").collect())
    assert got == expected(libraries, docs)


def test_no_documents(spark, no_documents):
    assert ta.digests(no_documents, A, B).collect() == []


def test_forgetting_changes_nothing(libraries):
    rng = random.Random(8)
    texts = odd_texts(rng)
    few, many = ta.Aligner(A, B, most=5), ta.Aligner(A, B)
    for low in range(0, 400, 50):
        assert list(few.documents(texts[low:low + 50])) == list(many.documents(texts[low:low + 50]))


def test_products_equal_dense_ones():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = (rng.random((rng.integers(1, 9), 7)) < 0.4, rng.random((rng.integers(1, 9), 7)) < 0.4)
        sparse = [ta.Rows.incidence(np.nonzero(m)[1], np.concatenate([[0], np.cumsum(m.sum(axis=1))]), 7) for m in (a, b)]
        product = sparse[0].times(sparse[1].transposed())
        dense = np.zeros((len(a), len(b)), int)
        dense[product.row_numbers(), product.columns] = product.values
        assert (dense == a.astype(int) @ b.astype(int).T).all()


def test_links_share_bytes_or_groups(spark):
    frame = spark.createDataFrame([(1, "unaligned tokenizations"), (2, None)], "doc_id long, text string")
    over, group = (ta.links(frame, A, B, kind).toPandas() for kind in ("overlap", "group"))
    tokens = ta.Tokens(A, B)
    assert over["weight"].sum() == len(" unaligned tokenizations")
    shared = set(zip(group["a"], group["b"]))
    assert set(zip(over["a"], over["b"])) <= shared
    a, b = tokens.encode_whole("unaligned tokenizations")
    ga, gb = ta.groups(np.cumsum(tokens.a_sizes[a]), np.cumsum(tokens.b_sizes[b]))
    assert shared == {(i, j) for i in range(len(ga)) for j in range(len(gb)) if ga[i] == gb[j]}
