"""BPE and token files against the tokenizers library."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, repair
from tidemark.llm.common import text_bytes

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = [
    *" \n\t\r\x0b\x1c\x1f\x85\xa0 　​﻿̀\0\x7fab1_-!é²½中",
    *["  ", "'s", "'S", "'ll", "'re", "''", "The", "x9", "...", "\U0001f600", "hahaha", "aaaaaaa"],
    *["<|endoftext|>", "<|end", "İ", "Ⅷ"],
]
EDGES = ["", " ", "  ", "a", "a " * 3000, "a" * 20000, " a", "a ", "'s's", "x'sx", "<|endoftext|>" * 3]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts(count, seed):
    rng = random.Random(seed)
    return EDGES + ["".join(rng.choices(ALPHABET, k=rng.randint(0, 14))) for _ in range(count)]


def rows_of(encoder, some):
    ids, offsets = encoder.encode(*text_bytes(pa.array(some, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]


@pytest.mark.parametrize("make", [bpe.encoder, repair.library_encoder])
def test_ids_equal_the_library(library, make):
    some = texts(20000, 1)
    want = [library.encode(t, add_special_tokens=False).ids for t in some]
    assert rows_of(make(PATH), some) == want
    assert rows_of(make(PATH), some) == want  # from the table


@pytest.mark.parametrize("make", [bpe.encoder, repair.library_encoder])
def test_words_of_two_letters_keep_their_ids(library, make):
    """Thue-Morse words and their complements have equal plain polynomial hashes."""
    some = []
    for size in (1024, 2048, 4096, 8192):
        word = "".join("ab"[k.bit_count() % 2] for k in range(size))
        some += [word, word.translate(str.maketrans("ab", "ba"))]
    assert rows_of(make(PATH), some) == [library.encode(t, add_special_tokens=False).ids for t in some]


def test_full_table_begins_anew(library):
    own = bpe.TextEncoder(bpe.spelling(PATH).encode_words, bpe.spelling(PATH).special)
    own.table.slots = 64
    own.table.clear()
    some = texts(200, 2)
    for t in some:
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([t])], ["id", "text"])
        if len(set(t)) > 12:
            continue
        for _, ids, _ in own.encode_batches([batch]):
            assert ids.tolist() == library.encode(t, add_special_tokens=False).ids


def test_decode_is_lossy_as_the_library(library):
    own = bpe.spelling(PATH)
    rng = random.Random(3)
    rows = [[rng.randrange(50257) for _ in range(rng.randint(0, 9))] for _ in range(3000)]
    flat = np.array([i for r in rows for i in r], np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    want = [library.decode(r, skip_special_tokens=False) for r in rows]
    assert own.decode(flat, offsets) == want


def test_frames(spark, docs_of, library):
    rows = [(3, "Two words"), (3, "Two words"), (1, None), (2, ""), (None, "x" * 9000)]
    out = bpe.decode(bpe.encode(docs_of(rows), PATH), PATH).collect()
    assert sorted((r["id"] or -1, r["text"]) for r in out) == sorted(
        (i or -1, t or "") for i, t in rows
    )
    assert all(r["ids"] == library.encode(r["text"], add_special_tokens=False).ids for r in out)
    assert bpe.decode(bpe.encode(docs_of([]), PATH), PATH).collect() == []


def test_replaced_pairs_expand_again():
    rng = np.random.default_rng(4)
    for size in (0, 1, 40, 5000, 60000):
        for top in (2, 30, 50000):
            ids = rng.integers(0, top, size)
            ids[size // 2 :] = ids[: size - size // 2]
            block = repair.Block(*repair.store(ids))
            assert np.array_equal(block.ids(), ids)
            for _ in range(5):
                a, b = sorted(rng.integers(0, size + 1, 2))
                assert np.array_equal(block.ids(a, b), ids[a:b])


def test_repetition_gets_rules():
    ids = np.tile(np.arange(7), 3000)
    sequence, rules, base = repair.replace_pairs(ids)
    assert len(sequence) < len(ids) / 4 and base == 7
    assert repair.expansion_lengths(rules, base).max() > 2


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(5)
    many = [np.zeros(5000, np.int64), np.repeat(rng.integers(0, 9, 900), rng.integers(1, 30, 900)), rng.integers(0, 40, 30000)]
    for ids in many:
        sequence, rules, base = repair.replace_pairs(ids)
        assert np.array_equal(repair.expand(sequence, rules, base), ids)
        counts, at = {}, 0
        pairs = list(zip(sequence.tolist(), sequence[1:].tolist(), strict=False))
        while at < len(pairs):
            a, b = pairs[at]
            counts[a, b] = counts.get((a, b), 0) + 1
            at += 2 if a == b and at + 1 < len(pairs) and pairs[at + 1] == (a, a) else 1
        assert max(counts.values(), default=0) < repair.LEAST


def test_words_like_the_separator(library):
    """New words go to the library between special tokens: parts of such a token stay words."""
    assert repair.separator(library) == "<|endoftext|>"
    parts = ["<|endoftext|", "|endoftext|>", "<|", "|>", "endoftext", "<|endof", "<", ">", "a<|endoftext|>b", " ", "  \n ", "\n"]
    rng = random.Random(8)
    some = ["".join(rng.choices(parts, k=rng.randint(1, 6))) for _ in range(400)] + parts
    own = repair.library_encoder(PATH)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(some))), pa.array(some)], ["id", "text"])
    for rows, ids, ends in own.encode_batches([batch]):
        for k, a, b in zip(rows.to_pylist(), ends[:-1], ends[1:], strict=True):
            assert ids[a:b].tolist() == library.encode(some[k], add_special_tokens=False).ids


def test_files(spark, docs_of, library, tmp_path):
    rows = [(5, "five"), (1, None), (3, "a" * 5000), (3, "b c"), (2, ""), (9, "nine" * 40000)]
    path = str(tmp_path / "ids")
    repair.write_ids(docs_of(rows), PATH, 2, path)
    found = repair.read_ids(spark, path).orderBy("start").collect()
    want = sorted(((i, t or "") for i, t in rows))
    at = 0
    for row, (i, text) in zip(found, want, strict=True):
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [2], "<u4").tobytes()
        assert (row["id"], row["start"]) == (i, at)
        assert zlib.crc32(row["ids"]) == zlib.crc32(ids)
        at += len(ids) // 4
    empty = str(tmp_path / "none")
    repair.write_ids(docs_of([]), PATH, 2, empty)
    assert repair.read_ids(spark, empty).collect() == []
