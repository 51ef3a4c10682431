"""Byte-level BPE against tiktoken, packing against the tokenizer, bounds against brute force."""

import base64
import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.byte_bpe import Vocabulary, cut, encode_chunk, encode_here, ids_of, round_trip_digests, stitch
from tessera.llm.packing import CAPACITY, ChunkIds, best_fit_decreasing, lower_bound, pack, tokenise
from tests.llm.fixtures import documents, empty, prose, rows

VOCABULARY = Vocabulary(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
WORDS = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY.rank_file, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def by_chunks(text, chunk, overlap):
    spans = cut(text, chunk, overlap)
    done = []
    for k, (s, e) in enumerate(spans):
        head = spans[k - 1][1] - s if k else 0
        tail = spans[k + 1][0] - s if k + 1 < len(spans) else e - s
        ids, marks, offsets = encode_chunk(text[s:e], head, tail, k + 1 == len(spans), VOCABULARY)
        done.append((s, ids, np.array(marks), np.array(offsets)))
    return len(spans), stitch(done)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["word", "don't", "we'll", "'s", " ", "  ", "\n", "\n\n ", "12", "3", "!?", "'", "é", "日本", "　", "...", " a", "Ab"]), max_size=120))
def test_chunks_join_to_the_whole(parts):
    text = "".join(parts)
    import tiktoken

    enc = VOCABULARY.load()
    assert isinstance(enc, tiktoken.Encoding)
    assert by_chunks(text, 20, 12)[1] == enc.encode_ordinary(text)


def test_long_texts_are_cut(encoding):
    text = prose(7, 3000)
    n, ids = by_chunks(text, 500, 40)
    assert n > 20 and ids == encoding.encode_ordinary(text)
    assert by_chunks("x" * 5000, 500, 40)[0] == 1


def test_round_trip(spark, encoding):
    got = round_trip_digests(documents(spark), VOCABULARY, chunk_chars=1000, overlap_chars=50).collect()
    want = []
    for i, text, *_ in rows():
        ids = encoding.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    assert round_trip_digests(empty(spark), VOCABULARY).count() == 0
    assert ids_of(documents(spark).filter("doc_id = 7"), VOCABULARY).first()["ids"] == encoding.encode_ordinary("Two words")


@pytest.mark.parametrize("text", [" " * 5_000_000 + "a", "\n" * 1_500_000 + " x" + " " * 1_200_000, "a" * 5_000_000, "日本語、" * 1_250_000, "日" * 1_000_000])
def test_long_runs(text):
    """Runs that the library's own pattern engine can't split, and texts without ASCII white space."""
    import regex

    spans = cut(text, 8192, 256)
    assert (len(spans) > 500) == ("、" in text)
    want = [i for m in regex.finditer(P.PATTERN, text) for i in VOCABULARY.load()._encode_single_piece(m.group())]
    assert encode_here(text, VOCABULARY, 8192, 256) == want
    assert VOCABULARY.load().decode_bytes(want).decode() == text


def test_repeated_rows_and_long_runs_in_spark(spark, encoding):
    long = prose(8, 20_000)
    texts = [(1, long), (1, long), (1, long + "!"), (2, " " * 1_200_000 + "a"), (None, long), (None, long), (3, "x1" * 30_000)]
    got = round_trip_digests(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), VOCABULARY).collect()
    assert len(got) == len(texts)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted((r.doc_id or 0, r.decoded_sha256) for r in got) == sorted((i or 0, sha(t)) for i, t in texts)
    ids = {r.ids_sha256 for r in got if r.decoded_sha256 == sha(long)}
    assert ids == {sha(" ".join(map(str, encoding.encode_ordinary(long))))}


def test_pieces(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    want = []
    for i, text, *_ in rows():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want += [(i, k, s, len(ids[s : s + CAPACITY]), zlib.crc32(np.array(ids[s : s + CAPACITY], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), CAPACITY))]
    packed = pack(tokenise(documents(spark), WORDS)).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed), key=order) == sorted(want, key=order)
    check_sequences(packed)
    assert pack(tokenise(empty(spark), WORDS)).count() == 0


def check_sequences(packed):
    by = {}
    for r in packed:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= CAPACITY
    return len(by)


def test_exchange_rounds_save_sequences(spark):
    r = random.Random(3)
    items = [(k, 0, 0, r.randint(500, 1100), k) for k in range(600)]
    df = spark.createDataFrame(items, "doc_id long, piece int, start long, length long, ids_crc32 long")
    many = check_sequences(pack(df, partition_pieces=40, rounds=0).collect())
    few = check_sequences(pack(df, partition_pieces=40).collect())
    assert lower_bound(np.array([i[3] for i in items]), CAPACITY) <= few < many


def test_loosest_bins_meet_at_the_end(spark):
    """Four pieces fill a bin: every part leaves one loose bin, and one round doesn't join them all."""
    items = [(k, 0, 0, CAPACITY // 4, k) for k in range(602)]
    df = spark.createDataFrame(items, "doc_id long, piece int, start long, length long, ids_crc32 long")
    packed = pack(df, partition_pieces=5, rounds=1).collect()
    assert sorted(r.doc_id for r in packed) == list(range(602)) and check_sequences(packed) == 151


def test_exchanges_go_on_until_none_saves_a_bin(spark):
    """Many parts, each with a gap of its own; all rows state the bound, which the packing comes close to."""
    r = random.Random(11)
    items = [(k, 0, 0, r.choice((300, 690, 700, 900, 1100, 1350)), k) for k in range(1500)]
    df = spark.createDataFrame(items, "doc_id long, piece int, start long, length long, ids_crc32 long")
    done = {n: pack(df, partition_pieces=30, rounds=n).collect() for n in (0, 1, None)}
    used = {n: check_sequences(rows) for n, rows in done.items()}
    least = lower_bound(np.array([i[3] for i in items]), CAPACITY)
    assert {x.least_sequences for rows in done.values() for x in rows} == {least}
    assert least <= used[None] <= used[1] < used[0]
    assert all(sorted(x.doc_id for x in rows) == list(range(1500)) for rows in done.values())


def test_other_tokenizers_encode_whole_texts(tmp_path):
    import json

    from tokenizers import Tokenizer

    from tessera.llm.packing import WholeIds, load

    assert isinstance(load(WORDS), ChunkIds)
    told = json.load(open(WORDS, encoding="utf-8"))
    told["normalizer"]["normalizers"].pop()  # no lower-casing
    other = str(tmp_path / "other.json")
    json.dump(told, open(other, "w", encoding="utf-8"))
    assert isinstance(load(other), WholeIds)
    for text in ("Don't SHOUT, please. <|endoftext|> ok", "", "ÄÖ  ü"):
        want = Tokenizer.from_file(other).encode(text, add_special_tokens=False).ids
        assert np.frombuffer(load(other).packed(text.encode()), "<u4").tolist() == want


def test_chunk_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    known = ChunkIds(tokenizer, 50)  # small: generations turn over
    for _, text, *_ in rows():
        for t in (text or "", (text or "").replace("\n", " "), "Wow!, no. a.b, .. x,y. <|STARTOFTEXT|> " + (text or "")[:500]):
            assert np.frombuffer(known.packed(t.encode()), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=7))
def test_lower_bound_is_below_the_best_packing(sizes):
    capacity = 12
    n, bound = best_fit_decreasing(np.array(sizes), capacity)[2], lower_bound(np.array(sizes), capacity)
    best = next(
        k for k in range(1, len(sizes) + 1)
        if any(all(sum(s for s, b in zip(sizes, place, strict=True) if b == x) <= capacity for x in range(k)) for place in itertools.product(range(k), repeat=len(sizes)))
    )
    assert bound <= best <= n


def test_bounds_beat_the_sum():
    assert lower_bound(np.array([7, 7, 7]), 12) == 3
    assert lower_bound(np.array([5, 5, 5, 5, 5]), 12) == 3
    assert lower_bound(np.zeros(0, int), 12) == 0
