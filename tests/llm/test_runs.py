"""Op 13 against a plain search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from taskloom.llm import entries, runs


def plain_runs(words, least=24, exponent=3):
    out, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if end > at and length >= max(least, exponent * q):
                out.setdefault((at, length), q)  # ascending q: the least period stays
            at = end + 1
    return sorted((s, length, q) for (s, length), q in out.items())


def noisy_text(draw):
    words = [draw.choice("abcdefgh") for _ in range(draw.randint(0, 60))]
    for _ in range(draw.randint(0, 4)):
        unit = [draw.choice("abc") for _ in range(draw.randint(1, 14))]
        body = (unit * 30)[: draw.randint(1, 130)]
        at = draw.randint(0, len(words))
        words[at:at] = body
        if draw.random() < 0.3:
            words += words[at : at + draw.randint(0, 60)]
    return words


@pytest.mark.parametrize("least,exponent", [(24, 3), (6, 3), (4, 2), (10, 4)])
def test_runs_equal_plain_search(least, exponent, monkeypatch):
    draw = random.Random(least)
    monkeypatch.setattr(runs, "TREE_WORDS", 150)
    monkeypatch.setattr(runs, "LOOKS", 100)
    for _ in range(150):
        texts = [noisy_text(draw) for _ in range(draw.randint(1, 5))]
        codes = np.array([ord(w) for t in texts for w in t], np.int64)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        got = list(zip(*(x.tolist() for x in runs.find_runs(codes, bounds, least, exponent))))
        assert got == [(s + int(b), length, q) for t, b in zip(texts, bounds) for s, length, q in plain_runs(t, least, exponent)]


def test_long_stretches():
    codes = np.concatenate([np.zeros(100_000, np.int64), np.arange(1, 50), np.tile(np.arange(100, 107), 30_000)])
    assert [x.tolist() for x in runs.find_runs(codes, np.array([0, len(codes)]))] == [[0, 100_049], [100_000, 210_000], [1, 7]]


def digests(key, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = 1 if key is None else zlib.crc32(str(key).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if found else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (key, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows, ties, a clashing column, no rows."""
    draw = random.Random(2)
    texts = [None, "", " \t\n", "na\xefve " * 50, "a b " * 40 + "c d " * 40 + "x"] + [" ".join(noisy_text(draw)) for _ in range(60)]
    rows = [(k, t, "c") for k, t in enumerate(texts)] + [(4, texts[4], "c"), (None, texts[4], "c")]
    spark.createDataFrame(rows, "doc_id long, text string, runs string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in entries.op13_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((digests(k, t) for k, t, _ in rows), key=str)
    assert runs.run_digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    long = " ".join(["alpha beta"] * 60_000 + [f"w{k}" for k in range(60_000)])
    got = runs.periodic_runs(spark.createDataFrame([(1, long)], "doc_id long, text string")).first()
    assert [tuple(r) for r in got.runs] == [(0, 120_000, 2)] and got.n_words == 180_000 and got.collapsed.split()[:3] == ["alpha", "beta", "w0"]
