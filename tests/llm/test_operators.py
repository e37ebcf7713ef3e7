"""The training-data operators against brute force, on small tables with nulls, ties, repeats and clashing columns."""

import collections
import gzip
import hashlib
import io
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from taskloom.llm import bitplane, editcount, induced, jaccard, lines, packing, pll, quality, suffix, tiling, warc
from taskloom.llm.components import connected_components
from taskloom.llm.encode import Encoder, vocabulary_path

VOCABULARY = "word_bpe_49k.json"
RND = random.Random(3)
WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "École", "naïve", "x***", "12", "it's"]


def prose(n):
    return " ".join(RND.choice(WORDS) + RND.choice(["", "", ".", ","]) + str(RND.randrange(40)) for _ in range(n))


LONG = prose(80)
PARTS = LONG.split(" ")
TEXTS = [
    None, "", "   \n ", "one two", "one two", LONG, LONG, " ".join(PARTS[:40] + ["changed"] + PARTS[41:]), prose(3) + "\n" + LONG[:300] + "\n" + prose(30), prose(400), "a b c d e " * 40,
    "a b c d e f g h i j k l\n" * 5, "<|endoftext|> x\x0by\x1cz é", "tie tie tie", prose(60) + " " + " ".join(PARTS[20:60]),
]
ROWS = [(k, t) for k, t in enumerate(TEXTS)] + [(5, LONG), (None, "no id here"), (40, " ".join(PARTS))]
EXTRA = ["lang", "start", "key", "l", "place", "places", "t1", "length", "salt", "rank", "root", "group", "v_doc_id", "g_doc_id", "c_doc_id", "r_doc_id", "_row", "v_row", "c_row", "g_row", "r_row", "n_lines", "path", "h", "w"]


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame([(i, t, *["en"] * len(EXTRA)) for i, t in ROWS], schema).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def token_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path(VOCABULARY)).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_library():
    encoder = Encoder(VOCABULARY, cached_runs=20)
    for _ in range(3):
        texts = [t for _, t in ROWS] + [prose(50)]
        ids, sizes = encoder.encode_batch(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [token_ids(t) for t in texts]


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_bitplane_round_trip(planes):
    docs = [(k, np.array([RND.randrange(1 << RND.choice([1, 8, 17, 32])) for _ in range(n)], np.uint32)) for k, n in enumerate([0, 1, 5, 700, 0, 64])] + [(None, np.zeros(3, np.uint32))]
    out = io.BytesIO()
    bitplane.write_file(out, docs, 64, planes)
    back = list(bitplane.read_documents(out))
    assert [b[0] for b in back] == [d[0] for d in docs]
    assert all((x[1] == y[1]).all() for x, y in zip(docs, back))
    assert all((bitplane.read_one(out, k) == d[1]).all() for k, d in enumerate(docs))


def test_op1(spark, docs, empty):
    got = bitplane.bitplane_tokens(spark, docs).collect()
    want, start = [], 0
    for i, t in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = token_ids(t) + [2]
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1]) == want
    assert bitplane.bitplane_tokens(spark, empty).count() == 0


def test_op2(spark, docs, empty):
    got = pll.pseudo_likelihood(spark, docs, frequent=30).collect()
    assert sorted(r.n_words for r in got) == sorted(len((t or "").encode().split()) for _, t in ROWS)
    assert all((r.mean_pll is None) == (r.n_words == 0) for r in got)
    assert pll.pseudo_likelihood(spark, empty).count() == 0


def test_op2_gives_each_word_its_own_probability(spark, monkeypatch):
    monkeypatch.setattr(pll, "SIZE", 3)  # number 1: the word of the vocabulary, number 2: all others
    counts = spark.createDataFrame([(b"top", 9), (b"rare", 6), (b"seldom", 2)], "word binary, n long")
    known = pll.vocabulary(counts, 1)
    shares = {r.h: r.share for r in pll.word_shares(counts, known, 1).collect()}
    assert sorted(np.exp(list(shares.values()))) == pytest.approx([2 / 8, 6 / 8])
    monkeypatch.undo()
    texts = ["top " * 40, *["rare"] * 6, "seldom"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    monkeypatch.setattr(pll, "word_shares", lambda *_: spark.createDataFrame([(h, float(k)) for k, h in enumerate(sorted(shares), 1)], "h long, share double"))
    more = {r.doc_id: r.pll for r in pll.pseudo_likelihood(spark, table, frequent=1).collect()}
    monkeypatch.setattr(pll, "word_shares", lambda *_: spark.createDataFrame([], "h long, share double"))
    less = {r.doc_id: r.pll for r in pll.pseudo_likelihood(spark, table, frequent=1).collect()}
    assert more[0] == less[0] and sorted({round(more[k] - less[k]) for k in (1, 7)}) == [1, 2]


def test_op2_learns_and_sums():
    net = pll.Network(seed=1)
    line, at = pll.padded([np.array([7, 9, 11, 13] * 300), np.array([5])], 2)
    p, before = net.parameters, net.log_likelihood(line, at).sum()
    k = 4
    h = np.tanh(sum(p["near"][j][line[at[k] + d]] for j, d in enumerate(net.places)))
    word = line[at[k]]
    first, second = p["classes"] @ h + p["class_bias"], p["inside"] @ h + p["inside_bias"][word // 64]
    plain = first[word // 64] - np.log(np.exp(first).sum()) + second[word % 64] - np.log(np.exp(second).sum())
    assert abs(net.log_likelihood(line, at[k : k + 1])[0] - plain) < 1e-4
    net.start_training()
    for _ in range(30):
        net.learn(line, at)
    assert net.log_likelihood(line, at).sum() > before / 4
    shuffled, spots = pll.padded([np.array([13, 7, 7, 11] * 5)], 2)
    good, places = pll.padded([np.array([7, 9, 11, 13] * 5)], 2)
    assert net.log_likelihood(good, places).mean() > net.log_likelihood(shuffled, spots).mean()


def test_tiling_finds_reordered_passages(spark):
    item = prose(30)
    w = item.split()
    moved = prose(20) + " " + "".join(c.upper() if c.isascii() else c for c in " ".join(w[15:] + ["between", "them"] + w[:15])) + " " + prose(9)
    docs = spark.createDataFrame([(1, moved), (2, prose(100)), (3, None), (4, ""), (5, "one two three"), (None, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(10, item), (11, "one two"), (12, None), (13, ""), (None, item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.covered_words, r.n_tiles) for r in tiling.tile_coverage(spark, docs, bench).collect()}
    assert got == {(1, 10): (30, 2), (5, 11): (2, 1), (None, 10): (30, 1)}
    blocks = tiling.tile_coverage(spark, docs, bench, most_items_bytes=20).collect()
    assert {(r.doc_id, r.item_id): (r.covered_words, r.n_tiles) for r in blocks} == got
    assert tiling.tile_coverage(spark, docs.where("false"), bench).count() == tiling.tile_coverage(spark, docs, bench.where("false")).count() == 0


def plain_tiling(a, b, least):
    """Greedy string tiling: again and again the longest common run of unmarked words, the first of equals, is marked."""
    free_a, free_b, tiles = [True] * len(a), [True] * len(b), []
    least = max(1, min(least, len(a)))
    while True:
        best = (least - 1, 0, 0)
        for p in range(len(a)):
            for t in range(len(b)):
                n = 0
                while p + n < len(a) and t + n < len(b) and free_a[p + n] and free_b[t + n] and a[p + n] == b[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        n, p, t = best
        if n < least:
            return tiles
        tiles.append((p, t, n))
        free_a[p : p + n] = free_b[t : t + n] = [False] * n


def test_tiles_equal_plain_greedy_tiling():
    for k in range(3000):
        a, b = (np.array([RND.randrange(2 + k % 3) for _ in range(RND.randrange(0, 40 if k % 10 == 0 else 14))], np.uint64) for _ in range(2))
        least = RND.randrange(1, 5)
        assert tiling.greedy_tiles(a, b, least) == plain_tiling(a.tolist(), b.tolist(), least)


@pytest.mark.parametrize("salt_rows", [1, 3, 1000])
def test_op4(spark, docs, empty, salt_rows):
    got = packing.pack_documents(spark, docs, capacity=64, salt_rows=salt_rows).collect()
    want = collections.Counter()
    for i, t in ROWS:
        ids = token_ids(t) + [0]
        for k, s in enumerate(range(0, len(ids), 64)):
            want[i, k, s, len(ids[s : s + 64]), crc(ids[s : s + 64])] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack_documents(spark, empty).count() == 0


def test_fullest_subset_is_the_fullest():
    for _ in range(150):
        have = sorted({RND.randrange(1, 30): RND.randrange(1, 4) for _ in range(RND.randrange(1, 6))}.items(), reverse=True)
        room = RND.randrange(0, 60)
        sums = {0}
        for length, count in have:
            sums = {s + k * length for s in sums for k in range(count + 1)}
        chosen = packing.fullest(have, room)
        assert sum(a * b for a, b in chosen) == max(s for s in sums if s <= room)
        assert all(b <= dict(have)[a] for a, b in chosen)


def brute_repeats(texts, n):
    seen = collections.Counter(t[k : k + n] for t in texts for k in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - n + 1):
            if seen[t[k : k + n]] > 1:
                gone[k : k + n] = True
        out.append((len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def test_op5(spark, docs, empty):
    for length, gram in ((200, 64), (32, 8)):
        got = suffix.remove_repeats(spark, docs, length, gram, shard_bytes=2000, memory=1 << 12).collect()
        want = brute_repeats([(t or "").encode() for _, t in ROWS], length)
        assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
    assert suffix.remove_repeats(spark, empty).count() == 0


def test_op5_refuses_texts_beyond_its_places(monkeypatch):
    monkeypatch.setattr(suffix, "PLACE_BITS", 10)
    with pytest.raises(ValueError):
        suffix.find_anchors([b"x" * 1025], 32, 8)
    assert len(suffix.find_anchors([b"x" * 1024], 32, 8)[0])


def test_induced_sorting(tmp_path):
    for _ in range(150):
        n, symbols = RND.choice([0, 1, 2, 3, 20, 200]), RND.choice([1, 2, 4, 200])
        text = np.array([RND.randrange(symbols) for _ in range(n)], np.uint8)
        options = {"folder": str(tmp_path), "memory": RND.choice([64, 1 << 20]), "base_case": RND.choice([0, 5, 1 << 20])}
        order = np.concatenate([p for p, _ in induced.suffixes_descending(text, 250, **options)] or [np.empty(0, int)])
        assert order.tolist() == sorted(range(n), key=lambda k: bytes(text[k:]), reverse=True)
        limit = RND.choice([1, 3, 9])
        seen = collections.Counter(bytes(text[k : k + limit]) for k in range(n - limit + 1))
        assert induced.repeated_positions(text, limit, **options).tolist() == [k <= n - limit and seen[bytes(text[k : k + limit])] > 1 for k in range(n)]


def shingle_set(text, n=5):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = (text or "").translate(table).encode().split()
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def test_op6(spark, docs, empty):
    base = [prose(n) for n in (6, 9, 14, 30, 120, 500)]
    rows = list(ROWS)
    for k in range(60):
        w = RND.choice(base).split(" ")
        for _ in range(RND.randrange(0, 1 + len(w) // 12)):
            w[RND.randrange(len(w))] = RND.choice(["new", "NEW", "other"])
        rows.append((100 + k, " ".join(w)))
    got = jaccard.jaccard_components(spark, spark.createDataFrame(rows, "doc_id long, text string"), entries_per_bucket=300).collect()
    named = [(i, shingle_set(t)) for i, t in rows if i is not None]
    sets = [s for _, s in named]
    root = components(range(len(named)), lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]))
    least = {}
    for k, r in root.items():
        least[r] = min(least.get(r, 1 << 60), named[k][0])
    want = collections.Counter((named[k][0], len(sets[k]), least[r] if sets[k] else named[k][0]) for k, r in root.items()) + collections.Counter([(None, 1, None)])
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert jaccard.jaccard_components(spark, empty).count() == 0
    assert jaccard.keep_one(spark, docs).columns == docs.columns


def test_pigeonhole_loses_no_pair():
    scheme = jaccard.Scheme(3, 4)
    for _ in range(300):
        n = RND.choice([1, 2, 3, 4, 5, 8, 13, 30, 70, 200])
        a = np.unique(np.array([RND.getrandbits(64) for _ in range(n)], np.uint64))
        cut = RND.randrange(0, 1 + len(a) // 4)
        b = np.unique(np.concatenate([a[cut:], np.array([RND.getrandbits(64) for _ in range(RND.randrange(0, 1 + len(a) // 6))], np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 4 * common < 3 * (len(a) + len(b) - common):
            continue
        owner, sig, flags = jaccard.emit([a, b], scheme, a[:3], jaccard.short_of_segments([a, b], scheme) | 63)
        by = collections.defaultdict(int)
        for o, s, f in zip(owner.tolist(), sig.tolist(), flags.tolist()):
            by[s, o] |= f
        assert any((by[s, 0] | by[s, 1]) & 3 == 3 for s in {s for s, _ in by} if by.get((s, 0)) and by.get((s, 1)))


def char_set(line, width=5):
    return {line[k : k + width] for k in range(max(1, len(line) - width + 1))}


def test_op7(spark, docs, empty):
    stem = [prose(n) for n in (3, 12, 40)]
    rows = [(None, stem[1]), (1, None), (2, ""), (3, stem[0] + "\n\n" + stem[1]), (4, stem[2])]
    rows += [(10 + k, stem[2].replace(stem[2].split(" ")[k], "changed", 1) + "\n" + prose(8) + "\n" + stem[0]) for k in range(1, 30, 3)]
    table = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, places string")
    got = {r.doc_id: r for r in lines.dedupe_lines(spark, table).collect()}
    places = sorted(((i is not None, i or 0), k, x) for i, t in rows for k, x in enumerate((t or "").split("\n")) if x.strip())
    sets = [char_set(x) for _, _, x in places]
    root = components(range(len(places)), lambda a, b: 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]))
    stays = {places[r][:2] for r in root.values()}
    for i, t in rows:
        left = [x for k, x in enumerate((t or "").split("\n")) if not x.strip() or ((i is not None, i or 0), k) in stays]
        assert got[i].text == (None if t is None else "\n".join(left)), i
    assert lines.dedupe_lines(spark, docs).columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    assert lines.dedupe_lines(spark, empty).count() == 0


def test_op7_takes_shingles_at_every_character(spark):
    rnd = random.Random(9)
    stem = [" ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=4)) for _ in range(n)) for n in (14, 14, 16, 70)]
    rows = [x.replace(x.split(" ")[k], "#" + x.split(" ")[k][1:], 1) for x in stem for k in (0, 5, 9)] + stem
    rows += ["東京都の天気は晴れのち曇りで午後からは北の風がやや強く吹くでしょう" + x for x in ("。", "！")] + ["abcd", "abce"]
    table = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id for r in lines.dedupe_lines(spark, table).where("n_removed = 0").collect()}
    sets = [char_set(x) for x in rows]
    root = components(range(len(rows)), lambda a, b: 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]))
    assert got == set(root.values()) and len(got) < len(rows)


def test_op7_covers_long_words(spark):
    rnd = random.Random(10)
    ends = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=60)) for _ in range(4)]
    rows = ["https://www." + x for x in ends] + ["http://nowww." + x for x in ends]
    table = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert {r.doc_id for r in lines.dedupe_lines(spark, table).where("n_removed = 0").collect()} == {0, 1, 2, 3}


def test_op8(spark, docs, empty):
    got = editcount.count_under_edits(spark, docs).collect()
    want = collections.Counter()
    for i, t in ROWS:
        raw = (t or "").encode()
        edits = editcount.scrub_edits(raw)
        after = raw
        for s, e, new in reversed(edits):
            after = after[:s] + new + after[e:]
        want[i, len(token_ids(t)), len(edits), len(token_ids(after.decode()))] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_edits, r.n_tokens_after) for r in got) == want
    assert editcount.count_under_edits(spark, empty).count() == 0


def test_tree_under_random_edits():
    encoder = Encoder(VOCABULARY)
    count = lambda x: int(encoder.encode_batch([x])[1][0])
    for _ in range(60):
        text = bytearray(RND.choice([b"", b"  ", b"ab cd  efg\n\nh i'll x*** 12 "]) + b"word " * RND.randrange(4))
        tree = editcount.CountTree(bytes(text), count)
        for _ in range(8):
            s = RND.randrange(len(text) + 1)
            e = RND.randrange(s, min(len(text), s + 9) + 1)
            new = RND.choice([b"", b" ", b"x", b"new words here", b"\n", b"end "])
            tree.edit(s, e, new)
            text[s:e] = new
            assert tree.text() == bytes(text) and tree.length == len(text) and tree.total == count(text.decode())


def brute_counts(text):
    w = (text or "").encode().split()
    grams = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    hit = {x for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for x in range(k, k + 5)}
    seen, dup = set(), 0
    for x in (text or "").split("\n"):
        if x.encode().split():
            dup += x in seen
            seen.add(x)
    return len(w), sum(len(x.decode()) for x in w), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(hit)


def test_op9(spark, docs, empty):
    labels = spark.createDataFrame([(5, 1), (None, 1), (7, None), (99, 0)], "doc_id long, quality int")
    got = quality.judge(spark, docs, labels).collect()
    want = collections.Counter()
    for i, t in ROWS:
        c = brute_counts(t)
        bad = c[0] < 10 or 100 * c[4] > 20 * c[0]
        want[i, *c, bad, not bad] += 1  # too few labels for any cutoff
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in got) == want
    assert quality.judge(spark, empty, labels).count() == 0
    assert quality.keep_good(spark, docs, labels).columns == docs.columns


def test_cutoffs_hold_their_risk(spark):
    good = [(f"good {k} " + prose(20), 1) for k in range(1500)]
    bad = [("bad" + " ".join(x + "***" for x in prose(20).split()), 0) for k in range(200)]
    rows = [(k, t, "en") for k, (t, _) in enumerate(good + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, q) for k, (_, q) in enumerate(good + bad)], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in quality.judge(spark, docs, labels).collect()}
    assert sum(not got[k] for k in range(1500)) <= 0.03 * 1500 and not any(got[k] for k in range(1500, 1700))
    assert quality.binomial_tail(0, 10, 0.1) == pytest.approx(0.9**10) and quality.binomial_tail(10, 10, 0.1) == pytest.approx(1.0)


def test_op10(spark, tmp_path):
    big = "<p>" + "x" * 120 + "é</p>"
    rows = [(3, "u3", big), (1, "u1", big), (2, "u 2\r\n", big), (4, None, None), (5, "u5", ""), (6, "u6", "short"), (7, "u7", "short"), (None, "n", big), (1, "u1", big), (8, "u8", big + "!")]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, digest string")
    got = collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_pages(spark, pages).collect())
    want = collections.Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        again = h == big and i != 1
        want[i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", 1 if again else None] += 1
    assert got == want
    assert warc.archive_pages(spark, pages.where("false")).count() == 0
    manifest = warc.write_archives(spark, pages, f"{tmp_path}/archives")
    back = collections.Counter((r.page_id, bytes(r.payload)) for r in warc.resolve_revisits(spark, manifest).collect())
    assert back == collections.Counter((i, (h or "").encode()) for i, _, h in rows)
    assert warc.resolve_revisits(spark, manifest.where("false")).count() == 0
    record = gzip.compress(warc.build_record(9, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), None, "2024-01-01T00:00:00Z"))
    (head, block), = warc.read_records(io.BytesIO(record))
    assert head["warc-type"] == "response" and block.endswith(b"abc")


def test_components(spark):
    edges = [(RND.randrange(60), RND.randrange(60)) for _ in range(40)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    real = {frozenset(e) for e in edges if None not in e and e[0] != e[1]}
    nodes = sorted({x for e in real for x in e})
    assert got == components(nodes, lambda a, b: frozenset((a, b)) in real)
    assert connected_components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, t, "en", "s", len(t or "")) for i, t in ROWS] + [(200 + k, prose(60), "de", "s", 1) for k in range(10)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(rows[-1][1].split(" ")[5:40]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
    kept = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}
    assert {200 + k for k in range(9)} <= kept and 209 not in kept and 6 not in kept and 40 not in kept
