"""Near duplicates, suffixes and lines against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from corpus_pipeline import near_stage
from tessera.llm import near_dedup, shared, suffix_dedup
from tessera.llm.graph import components
from tessera.llm.line_dedup import remove_boilerplate
from tessera.llm.near_dedup import near_duplicates, shingle_set
from tessera.llm.suffix_dedup import anchors, common_prefix, front_code, front_decode, kept_bytes, merge, removal_digests
from tests.llm.fixtures import blank, documents, empty, prose, rows

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sets(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < size else [tuple(words[k : k + size]) for k in range(len(words) - size + 1)])


def brute_components(docs, size=3, least=85):
    """id -> smallest reachable id, of documents (id, text)."""
    have: dict[int, list] = {}
    for i, t in docs:
        if i is not None:
            have.setdefault(i, []).append(sets(t, size))
    root = {i: i for i in have}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(have)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= least * len(x | y) for x in have[a] for y in have[b]):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in ids}


def check(spark, docs, df, **options):
    want = brute_components([(r[0], r[1]) for r in docs], options.get("size", 3), options.get("similarity", 85))
    got = near_duplicates(df, **options).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.component_id == (want[r.doc_id] if r.doc_id is not None else None)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    return got


def test_awkward_documents(spark):
    got = check(spark, rows(), documents(spark))
    n = {r.doc_id: r.n_shingles for r in got}
    assert n[4] == n[5] == n[6] == 0 and n[7] == n[8] == 1
    assert {r.doc_id for r in got if r.component_id == 1} == {1, 2, 3}
    assert {r.doc_id for r in got if r.component_id == 7} == {7, 8}
    assert near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize(("options", "few"), [({}, 32), ({"size": 5, "similarity": 80, "collections": 14}, 32), ({}, 1), ({}, 4)])
def test_chains_of_edits(spark, monkeypatch, options, few):
    """Also where all shared shingles, or some, count as frequent, and every class as large."""
    monkeypatch.setattr(near_dedup, "FEW_HOLDERS", few)
    monkeypatch.setattr(near_dedup, "HOT_COPIES", 1 if few < 32 else 1000)
    r = random.Random(5)
    docs = []
    for family in range(6):
        words = prose(family, 90).split(" ")
        for _ in range(14):
            words = list(words)
            words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"  # each close to the one before it
            docs.append((len(docs), " ".join(words)))
        docs.append((len(docs), docs[-1][1]))
    r.shuffle(docs)
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    check(spark, docs, df, **options)


def test_one_id_with_two_texts(spark):
    docs = [(1, prose(1, 50)), (2, prose(1, 50)), (2, prose(9, 50)), (3, prose(9, 50))]
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 1)}


@pytest.mark.parametrize("turn", [False, True])
def test_one_id_with_near_copies_of_two_texts(spark, turn):
    """Both texts of id 2 have a near copy, and each is the smallest of its class."""
    a, b = prose(1, 200), prose(9, 200)
    docs = [(2, a), (2, b), (3, a + " and more"), (4, b + " and more"), (5, prose(7, 200))]
    df = spark.createDataFrame(docs[::-1] if turn else docs, "doc_id long, text string").coalesce(1)
    assert {(r.doc_id, r.component_id) for r in near_duplicates(df).collect()} == {(2, 2), (3, 2), (4, 2), (5, 5)}
    # id 2 stands for one class only, its other text belongs to a class of id 1
    docs = [(2, a), (2, b), (1, b), (3, a + " and more"), (5, prose(7, 200))]
    df = spark.createDataFrame(docs[::-1] if turn else docs, "doc_id long, text string").coalesce(1)
    assert {(r.doc_id, r.component_id) for r in near_duplicates(df).collect()} == {(1, 1), (2, 1), (3, 1), (5, 5)}


def test_near_stage_leaves_one_row_of_an_id(spark):
    a, b = prose(1, 200), prose(9, 200)
    docs = [(2, a), (2, a), (2, b), (2, " "), (3, a + " and more"), (3, None), (5, prose(7, 200)), (None, a), (None, a)]
    df = spark.createDataFrame([(*d, "en", "s", 0) for d in docs], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in near_stage(spark, df, "").collect()), key=repr)
    assert got == sorted([(2, min(a, b)), (2, " "), (3, None), (5, docs[6][1]), (None, a), (None, a)], key=repr)


def test_shingle_sets_have_the_right_sizes():
    for _, t, *_ in rows():
        for size in (3, 5):
            assert len(shingle_set(t, size)) == len(sets(t, size))


def test_components_of_a_path_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100), (201, 200), (200, 201), (None, 7), (55, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_removed(docs, match):
    """Bytes, removed, spans and digest of each (id, text), in order of ids, nulls last."""
    seen, out = set(), []
    for i, t in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - match + 1):
            if b[p : p + match] in seen:
                gone[p : p + match] = b"\1" * match
            else:
                seen.add(b[p : p + match])
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


_ORDER = lambda r: (r[0] is None, r[0] or 0, r[2], r[4])


def test_suffixes_of_awkward_documents(spark):
    # of equal rows either may be the one read first: they are alike
    got = [tuple(r) for r in removal_digests(documents(spark)).collect()]
    assert sorted(got, key=_ORDER) == sorted(brute_removed([(r[0], r[1]) for r in rows()], 100), key=_ORDER)
    assert removal_digests(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_suffixes_of_repetitive_documents(spark, seed):
    r = random.Random(seed)
    pieces = ["".join(r.choice("ab ") for _ in range(r.randint(3, 40))) for _ in range(12)] + ["ä" * 9, "a" * 30]
    docs = [(k, "".join(r.choice(pieces) for _ in range(r.randint(0, 30)))) for k in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for match, gram in ((20, 8), (31, 31)):
        got = [tuple(x) for x in removal_digests(df, match=match, gram=gram, bucket_bytes=2000).collect()]
        assert sorted(got, key=_ORDER) == sorted(brute_removed(docs, match), key=_ORDER)


@pytest.mark.parametrize("hot", [1, 2, 10**6])
def test_common_grams_in_different_surroundings(spark, monkeypatch, hot):
    """A phrase in every document, and passages of several lengths in many."""
    monkeypatch.setattr(suffix_dedup, "HOT_BUCKETS", hot)
    r = random.Random(hot)
    word = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    phrase, passages = word(30), [word(n) for n in (45, 60, 70, 90, 200)]
    docs = [(k, word(r.randint(0, 90)) + phrase + word(r.randint(0, 60)) + r.choice(passages) + word(r.randint(0, 400))) for k in range(60)]
    docs += [(60, passages[4] * 3), (61, word(5000)), (62, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for match, gram in ((60, 24), (61, 25), (100, 40)):
        got = [tuple(x) for x in removal_digests(df, match=match, gram=gram, bucket_bytes=1000).collect()]
        assert sorted(got, key=_ORDER) == sorted(brute_removed(docs, match), key=_ORDER)


def test_every_window_lies_in_one_block(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 150)
    texts = [b"", b"a" * 40, prose(1, 60).encode(), b"b" * 120, prose(2, 200).encode(), b"", b"c" * 151, b"d" * 149, b"e" * 100]
    got = []
    for first, at, block, ends in suffix_dedup._blocks(texts, 100):
        assert len(block) <= 150 + 99
        begin = np.concatenate([[0], ends])
        for low, high in zip(*anchors(block, ends, 100, 40)[2:], strict=True):
            d = int(np.searchsorted(ends, low, side="right"))
            got += [(first + d, at + s - int(begin[d])) for s in range(low, high + 1)]
    assert sorted(got) == [(d, s) for d, t in enumerate(texts) for s in range(len(t) - 99)]


def test_a_text_of_several_blocks(spark):
    long = prose(6, 160_000)
    docs = [(1, "start " + long[400_000:401_000]), (2, long + " and again " + long[900_000:1_000_000]), (3, long[1_040_000:1_060_000])]
    assert len(long) > 2 * suffix_dedup.BLOCK_BYTES // 2
    got = [tuple(x) for x in removal_digests(spark.createDataFrame(docs, "doc_id long, text string")).collect()]
    assert sorted(got, key=_ORDER) == sorted(brute_removed(docs, 100), key=_ORDER)


def test_long_texts_need_little_more_than_themselves():
    import tracemalloc

    text = (prose(5, 40_000).encode() * 200)[:50_000_000]
    tracemalloc.start()
    try:
        n = sum(len(anchors(block, ends, 100, 40)[0]) for _, _, block, ends in suffix_dedup._blocks([b"x" * 10, text, b""], 100))
        peak = tracemalloc.get_traced_memory()[1]
        assert n > 1_000_000 and peak < 300_000_000
        tracemalloc.reset_peak()
        assert len(near_dedup.word_hashes(text)) == len(text.split()) and tracemalloc.get_traced_memory()[1] < 1_000_000_000
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_word_hashes_in_blocks(block):
    for text in (b"", b" ", b"a", b"one two  three ", b" \n" + prose(3, 50).encode(), b"x" * 200 + b" " + b"y" * 64):
        got = near_dedup.word_hashes(text, block)
        assert got.tolist() == near_dedup.word_hashes(text).tolist() and len(got) == len(text.split())
        words = text.split()
        assert len(set(got.tolist())) == len(set(words)) and all((a == b) == (x == y) for a, x in zip(got, words, strict=True) for b, y in zip(got, words, strict=True))


def test_every_window_has_one_anchor():
    texts = [prose(3, 80).encode(), b"a" * 300, b"short", b"", prose(4, 50).encode()]
    g, at, low, high = anchors(b"".join(texts), np.cumsum([len(t) for t in texts]), 100, 40)
    starts = [s for a, b in zip(low, high, strict=True) for s in range(a, b + 1)]
    ends = np.cumsum([len(t) for t in texts])
    want = [s for t, e in zip(texts, ends, strict=True) for s in range(e - len(t), e - 99)]
    assert starts == want
    assert all(a <= x and x + 40 <= a + 100 and b <= x for x, a, b in zip(at, low, high, strict=True))


def test_loser_tree_merges_with_shared_prefixes():
    r = random.Random(4)
    for k in (0, 1, 2, 3, 7, 8):
        runs = [sorted("".join(r.choice("ab") for _ in range(r.randint(0, 12))).encode() for _ in range(r.randint(0, 30))) for _ in range(k)]
        got = list(merge([front_decode(*front_code(run)) for run in runs]))
        assert [s for s, _, _ in got] == sorted(s for run in runs for s in run)
        for (a, _, _), (b, h, _) in zip(got, got[1:], strict=False):
            assert h == common_prefix(a, b, 0)
    assert common_prefix(b"x" * 70 + b"a", b"x" * 70 + b"b", 3) == 70


def test_kept_bytes():
    assert kept_bytes(b"abcdef", [(0, 2), (3, 4)]) == b"cef" and kept_bytes(b"", []) == b""


def brute_lines(docs, least):
    sites, first = {}, {}
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is None, docs[k][0] or 0, k))
    for k in order:
        i, text, site = docs[k]
        for at, line in enumerate((text or "").split("\n")):
            word = line.strip(" \t\n\x0b\x0c\r")
            if word:
                sites.setdefault(word, set()).add(site)
                first.setdefault(word, (k, at))
    out = []
    for k, (i, text, _) in enumerate(docs):
        lines = (text or "").split("\n")
        words = [x.strip(" \t\n\x0b\x0c\r") for x in lines]
        gone = [bool(w) and len(sites[w] - {None}) >= least and first[w] != (k, at) for at, w in enumerate(words)]
        left = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out.append((i, left if text is not None else None, sum(map(bool, words)), sum(gone)))
    return out


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_lines(spark, monkeypatch, broadcast):
    monkeypatch.setattr(shared, "BROADCAST_ROWS", broadcast)
    r = random.Random(8)
    stock = [f"line {k}" for k in range(30)] + ["", "  ", " line 1 ", "lïne\t"]
    docs = [(k, "\n".join(r.choice(stock) for _ in range(r.randint(0, 9))), r.choice([None, *[f"s{x}" for x in range(6)]])) for k in range(60)]
    docs += [(60, None, "s1"), (61, "line 2\nline 2", "s1")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "'x' AS n_lines", "'y' AS _at", "'z' AS sites", "'w' AS _r", "'v' AS _gone")
    for least in (2, 4, 6):
        got = remove_boilerplate(df, min_sites=least)
        assert {"_at", "sites", "_r", "_gone"} <= set(got.columns)
        assert sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()) == sorted(brute_lines(docs, least))
    every = remove_boilerplate(df, min_sites=4, keep_first=False).agg({"n_removed": "sum"}).first()[0]
    assert every > remove_boilerplate(df, min_sites=4).agg({"n_removed": "sum"}).first()[0]


def test_lines_of_awkward_documents(spark):
    got = remove_boilerplate(documents(spark, extra=False), min_sites=2).collect()
    assert len(got) == len(rows())
    kept = {r.doc_id: r for r in got}
    assert kept[1].text and not kept[1].n_removed and kept[3].n_removed == 1 and kept[None].text == "" and kept[4].text is None
    assert remove_boilerplate(empty(spark)).count() == 0
    assert blank(kept[6].text)


@pytest.mark.parametrize("count", [1, 3, 50, 5000])
def test_even_labels(spark, count):
    labels = shared.even_labels(spark, count)
    assert len(labels) == len(set(labels)) == count
    if count < shared.MAX_LABELS:
        df = spark.createDataFrame([(x,) for x in labels], "x int").repartition(count, "x")
        assert df.selectExpr("spark_partition_id() AS p").distinct().count() == count


def test_hashing_a_bucket_holds_little_besides_it():
    import tracemalloc

    texts = [prose(k, 300).encode() for k in range(50)] * 40
    size = sum(map(len, texts))
    assert size > 3_000_000
    tracemalloc.start()
    try:
        found = [(block, *anchors(block, ends, 100, 40)) for _, _, block, ends in suffix_dedup._blocks(texts, 100)]
        assert sum(len(f[1]) for f in found) > size // 50 and tracemalloc.get_traced_memory()[1] < 3 * size + 30_000_000
    finally:
        tracemalloc.stop()


def test_rows_cut_some_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CUT_ROWS", 3)
    shared = prose(9, 40)
    docs = [(k, None if k % 7 == 0 else prose(100 + k, 10) + shared + prose(200 + k, k)) for k in range(40)]
    got = [tuple(x) for x in removal_digests(spark.createDataFrame(docs, "doc_id long, text string")).collect()]
    assert sorted(got, key=_ORDER) == sorted(brute_removed(docs, 100), key=_ORDER)
