"""Op 11 against the tokenizers library."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from taskloom.llm import bpe, entries
from taskloom.llm.encode import vocabulary_path

PARTS = ["a", "b", "the", "\xe9", "中", "՘", "꟎", " ", "  ", "\n", "\t", "'s", "'ll", "'", "1", "\xb2", "٣", "\U0001f600", "\U000107bb", "<|endoftext|>", "<|", "\xa0", "　", "\x1c", "\x85", "​", "A", "un", "ing", ".", "!!", "\x00", "﻿", "ſ", "K"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path(bpe.VOCABULARY))


@pytest.mark.parametrize("window", [7, 1 << 20])
def test_ids_equal_the_library(library, monkeypatch, window):
    monkeypatch.setattr(bpe, "WINDOW", window)
    pairs, draw = bpe.byte_pairs(bpe.VOCABULARY), random.Random(window)
    for _ in range(4000):
        text = "".join(draw.choice(PARTS) for _ in range(draw.randint(0, 40)))
        assert pairs.encode_text(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_classes_of_characters(library):
    pairs = bpe.byte_pairs(bpe.VOCABULARY)
    for c in (*range(1, 0xD800, 7), *range(0xE000, 0x20000, 11), 0x558, 0x88F, 0xA7CE, 0x10940):
        text = f"a{chr(c)}1 {chr(c)}?"
        assert pairs.pieces(text) == [text[x:y] for _, (x, y) in library.pre_tokenizer.pre_tokenize_str(text)], hex(c)


def test_small_cache(library):
    pairs, draw = bpe.BytePairs(bpe.VOCABULARY, cached_runs=20), random.Random(3)
    for _ in range(300):
        text = " ".join("".join(draw.choice("aeinst") for _ in range(draw.randint(1, 9))) for _ in range(30))
        assert pairs.encode_text(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_query(spark, tmp_path, library):
    """Nulls, empty and very long texts, ties, repeated rows, a clashing column, no rows."""
    texts = ["Plain words, it's 12 o'clock.", None, "", "  \n ", "ab" * 30_000, "word " * 60_000, "x<|endoftext|>y", "x<|endoftext|>y", "na\xefve \U0001f600՘"]
    rows = [(k if k != 3 else None, t, "c") for k, t in enumerate(texts)] + [(7, texts[7], "c")]
    spark.createDataFrame(rows, "doc_id long, text string, ids string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, entries.op11_bpe_round_trip(spark, str(tmp_path)).collect()), key=str)
    want = []
    for k, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((k, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_decode_of_any_ids(spark, library):
    draw = random.Random(5)
    lists = [[draw.randrange(50257) for _ in range(draw.randint(0, 12))] for _ in range(200)] + [[128, 999_999, 220], []]
    rows = spark.createDataFrame([*enumerate(lists), (-1, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in bpe.decode(rows).collect()}
    assert got.pop(-1) is None
    assert got == {k: library.decode(ids, skip_special_tokens=False) for k, ids in enumerate(lists)}
