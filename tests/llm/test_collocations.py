"""Op 12 against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from taskloom.llm import collocations, entries


def plain(rows, least=30, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 5):
                for k in range(len(words) - m + 1):
                    counts[lang][tuple(words[k : k + m])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        most = Counter()
        for p, a in found.items():
            for m in range(2, len(p)):
                for k in range(len(p) - m + 1):
                    most[p[k : k + m]] = max(most[p[k : k + m]], a)
        kept = []
        for p, a in found.items():
            if 100 * most[p] < 80 * a or not most[p]:
                score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, k + 1, p.decode(), -a, left, right, totals[lang], -score) for k, (score, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def corpus(draw, n):
    words = ["a", "b", "c", "to", "a\x01", "De", "de", "l'\xe9t\xe9", "中", "x" * 40, "\xa0", "\x1c"] + [f"w{k}" for k in range(40)]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "!", ";:"]
    fixed = ["once upon a time", "New York City hall", "alpha beta"]
    rows = []
    for k in range(n):
        text = "".join(draw.choice(fixed if draw.random() < 0.2 else words[: draw.choice([4, 12, 52])]) + draw.choice(ends) for _ in range(draw.randint(0, 60)))
        rows.append((k, draw.choice([text, text, text, "", None]), draw.choice(["en", "en", "en", "fr", None, "und"])))
    return rows


def test_query(spark, tmp_path):
    """Nulls, empty texts, null and clashing languages, ties, repeated rows, a clashing column."""
    rows = corpus(random.Random(1), 4000)
    rows += rows[:50] + [(9000, "Again and " * 40_000, "fr"), (None, "once upon", "en")]
    spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, key string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, entries.op12_collocations(spark, str(tmp_path)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))
    assert len(got) > 60 and got == plain(rows)


def test_small_parts(spark, monkeypatch):
    """Runs of keys that cross partitions, tasks that count often, few places."""
    monkeypatch.setattr(collocations, "KEYS_HELD", 50)
    monkeypatch.setattr(collocations, "PARTITION_KEYS", 200)
    rows = corpus(random.Random(2), 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = sorted(map(tuple, collocations.collocations(spark, docs, least=3, top=40, salts=3).collect()))
    assert got == plain(rows, 3, 40)
    assert collocations.collocations(spark, docs.limit(0)).collect() == []


def test_products_beyond_64_bits(spark):
    f = 9_000_000_000_000
    packed = lambda *ids: b"".join(k.to_bytes(4, "big") for k in ids)
    phrases = spark.createDataFrame([(packed(1, 2), f)], "key binary, f long")
    words = spark.createDataFrame([("en", "a", f + 1, 1), ("en", "b", f + 2, 2)], "lang string, word string, f long, id long")
    row = collocations.scored_phrases(spark, phrases, words).first()
    assert (row.a, row.l, row.r, row.score) == (f, f + 1, f + 2, 2_000_000 * f // (2 * f + 3))


def test_radix_order():
    draw = np.random.default_rng(3)
    keys = draw.integers(0, 1 << 32, (5000, 4)).astype(np.uint32)
    keys[:2500] = keys[:2500] % 3
    assert (keys[collocations.radix_order(keys)] == keys[np.lexsort(keys.T[::-1])]).all()
