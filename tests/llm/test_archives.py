"""Packing, token files and archives: exact round trips."""

import base64
import hashlib
import io
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cellframe.llm import packing, rans_tokens, tokens, warc
from cellframe.llm.files import fresh_file, open_file
from cellframe.scratch import scratch_dir

BYTE, WORD = packing.default_tokenizer(), rans_tokens.default_tokenizer()


@pytest.mark.parametrize("path, drops", [(BYTE, False), (WORD, True)])
def test_encoder_equals_the_library(path, drops):
    rng = random.Random(4)
    letters = " \n\t'  　abcÉé1,!|\x01\x0b\x1ćs"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["".join(rng.choice(" \nab's|") for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["a  b\n\n c \n", "  ", "x's <|endoftext|> y  <|endoftext|>z", "<|startoftext|>a", None, "long " * 4000]
    whole, encoder = Tokenizer.from_file(path), tokens.Encoder(path, drops, most=500)
    for low in range(0, len(texts), 300):
        for text, ids in zip(texts[low:low + 300], encoder.encode(texts[low:low + 300]), strict=True):
            assert whole.encode(text or "", add_special_tokens=False).ids == ids.tolist()


@pytest.mark.parametrize("name,drops", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_signs_and_capitals_ask_the_library_for_no_known_word(name, drops):
    path = public_tokenizers.path(name)
    whole, encoder, asked = Tokenizer.from_file(path), tokens.Encoder(path, drops, most_parts=400), []
    rng = random.Random(3)
    words = ["Straße", "über", "word", "Word", "it's", "ªx", "ÿes", "a1b", "x_y", "Ünïté", "e\u0301t", "ΣΑΣ", "<|endoftext|>", "l'été"]
    signs = ["", ",", "***", ".)", "'s", "'S,", "_", "…", "\u0338", "<|", "<|endoftext|>", "=\u0338", "7"]
    texts = [" ".join(rng.choice(["", "(", "'"]) + rng.choice(words) + rng.choice(signs) for _ in range(20)) for _ in range(200)]
    for low in range(0, len(texts), 50):
        for text, ids in zip(texts[low:low + 50], encoder.encode(texts[low:low + 50]), strict=True):
            assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text
    encoder = tokens.Encoder(path, drops)
    encoder.encode(["a newword newer"])
    ask = encoder._ids
    encoder._ids = lambda texts: asked.extend(texts) or ask(texts)
    encoder.encode(["a newword, newer*** newword*** newer,"] + ["a NEWWORD***"] * drops)
    assert not any("newword" in text.lower() or "newer" in text for text in asked)


def check_sequences(rows, length=packing.LENGTH):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length
    return len(sequences)


def test_pack_places_every_piece_once(spark, documents, no_documents):
    rows = packing.pack(documents, BYTE, with_ids=True).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect() if r["doc_id"] is not None}
    whole, parts = Tokenizer.from_file(BYTE), defaultdict(list)
    check_sequences(rows)
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        parts[r["doc_id"]].append((r["piece"], r["start"], np.frombuffer(r["ids"], "<u4")))
    for doc, text in texts.items():
        own = sorted(parts.pop(doc), key=lambda p: p[0])
        own = own[::2] if doc == 4 else own  # a repeated row
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        assert np.concatenate([p[2] for p in own]).tolist() == ids
        assert [p[0] for p in own] == list(range(len(own))) and all(len(p[2]) == 2048 for p in own[1:])
        assert [p[1] for p in own] == np.cumsum([0, *(len(p[2]) for p in own)])[:-1].tolist()
    assert not parts
    assert packing.pack(no_documents, BYTE).count() == 0


@pytest.mark.parametrize("sizes, slack", [([1100], 0), ([1100, 900, 30], 0.06), (list(range(1, 2049)), 0.06), ([2048], 0), ([1], 0)])
def test_tree_of_rounds_packs_tightly(spark, sizes, slack):
    rng = random.Random(6)
    items = [(k, rng.choice(sizes)) for k in range(2500)]
    rows = packing.pack_pieces(spark.createDataFrame(items, "doc_id long, length long").repartition(20), fan=3).collect()
    assert sorted((r["doc_id"], r["length"]) for r in rows) == items
    least = len(set(packing.best_fit([size for _, size in items])[0].tolist()))
    assert check_sequences(rows) <= least * (1 + slack) + 1


def test_best_fit_takes_the_fullest_bin():
    bins, offsets = packing.best_fit([6, 5, 3, 4, 2], 10)
    assert bins.tolist() == [0, 1, 1, 0, 1] and offsets.tolist() == [0, 0, 5, 6, 8]
    assert packing.best_fit([], 10)[0].tolist() == []


@pytest.mark.parametrize("n, top", [(1, 1), (2, 9), (63, 5), (65_536, 1), (70_001, 3), (150_000, 49_408), (3000, 3000)])
def test_token_file_round_trip(spark, n, top):
    ids = np.minimum(np.random.default_rng(n).zipf(1.2, n), top).astype(np.uint32)
    path, stream = fresh_file(scratch_dir(spark, "test"), "rans")
    sizes = [n // 3, 0, n - n // 3]
    with stream:
        rans_tokens.write_file(stream, list(zip((5, 6, 2 ** 60), sizes, strict=True)), ids)
    reader = rans_tokens.Reader(open_file(path))
    read = list(reader.read())
    assert [d for d, _ in read] == [5, 6, 2 ** 60] and [len(i) for _, i in read] == sizes
    assert np.concatenate([i for _, i in read]).tolist() == ids.tolist()
    last = len(reader.checkpoints) - 1  # any block alone
    assert reader.block(last).tolist() == ids[last * rans_tokens.BLOCK:].tolist()


def test_damaged_token_file_is_noticed(spark):
    path, stream = fresh_file(scratch_dir(spark, "test"), "rans")
    with stream:
        rans_tokens.write_file(stream, [(1, 5000)], np.arange(5000, dtype=np.uint32) % 700)
    data = bytearray(open_file(path).read())
    place = int(rans_tokens.Reader(open_file(path)).checkpoints[0]["place"])
    for at in (place + 9, len(data) - 20):
        bad = bytearray(data)
        bad[at] ^= 1
        other, stream = fresh_file(scratch_dir(spark, "test"), "rans")
        with stream:
            stream.write(bytes(bad))
        with pytest.raises(ValueError, match="damaged"):
            list(rans_tokens.Reader(open_file(other)).read())


def test_token_files_of_odd_rows(spark, documents, no_documents, monkeypatch):
    rows = rans_tokens.read_token_files(rans_tokens.write_token_files(documents, WORD, scratch_dir(spark, "test"))).collect()
    whole, start, expected = Tokenizer.from_file(WORD), 0, []
    for r in sorted((r for r in documents.collect() if r["doc_id"] is not None), key=lambda r: r["doc_id"]):
        ids = np.array(whole.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        expected.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, rows)) == expected
    empty = rans_tokens.write_token_files(no_documents, WORD, scratch_dir(spark, "test"))
    assert rans_tokens.read_token_files(empty).count() == 0


def test_archive_round_trip(spark):
    pages = [(1, "u\r\nx: y", None), (2, None, ""), (3, "v", "a"), (2 ** 60 + 1, "v", "a"), (2 ** 60 + 1, "v", "a"), (None, "z", "q"),
             (5, "ü", "é\r\n\r\n" * 60_000), (6, "w", "<p>" + "x" * 3)]
    frame = spark.createDataFrame([(*p, "t", 0) for p in pages], "page_id long, url string, html string, record_type string, path int")
    archives = warc.write_warc(frame.repartition(3), scratch_dir(spark, "test"))
    largest = {}
    for page, _, html in pages:
        if page is not None:
            largest[html or ""] = max(page, largest.get(html or "", page))
    expected = []
    for page, url, html in pages:
        if page is not None:
            data, top = (html or "").encode(), largest[html or ""]
            expected.append((page, None if url is None else url.replace("\r\n", "%0D%0A"), len(data),
                             base64.b32encode(hashlib.sha1(data).digest()).decode(),
                             *(("response", None, data) if page == top else ("revisit", top, None))))
    got = [(*tuple(r)[:6], None if r["payload"] is None else bytes(r["payload"])) for r in warc.read_warc(archives).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert archives.agg({"records": "sum"}).first()[0] == len(expected)
    none = warc.write_warc(frame.where("false"), scratch_dir(spark, "test"))
    assert warc.read_warc(none).count() == 0


def test_reader_checks_what_it_reads():
    whole = b"".join(warc.page_record(k, "u", bytes([65 + k]) * 70_000 * k, None) for k in range(4))
    assert [len(warc.parsed_page(h, b)[-1]) for h, b in warc.read_records(io.BytesIO(whole))] == [0, 70_000, 140_000, 210_000]
    with pytest.raises(ValueError, match="ends within"):
        list(warc.read_records(io.BytesIO(whole[:-5])))
    good = zlib.decompress(warc.page_record(1, "u", b"payload", None), 31)
    for bad in (good.replace(b"payload", b"Payload"), good.replace(b"\r\n\r\n", b"\r\n", 1), good[:-6], good + b"x"):
        packer = zlib.compressobj(wbits=31)
        with pytest.raises((ValueError, KeyError)):
            list(warc.read_records(io.BytesIO(packer.compress(bad) + packer.flush())))
