"""The quality classifier against plain Python: statistics, votes, label model, scorer and verdicts."""

import math
import random
import re
from bisect import bisect_right
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm.quality_classifier import BINS, FEW_WORDS, SLOTS, STATISTICS, VOTES_BAD, VOTES_GOOD, classify, label_model
from tests.llm.fixtures import blank, documents, prose, rows

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SYMBOLS, STOPS, SPACES = set(b"#*$%&|<>@^_~=+/\\{}[]"), set(b".,;:?"), set(b" \t\n\x0b\x0c\r")


def plain_statistics(text: bytes) -> list[float]:
    words = WORD.findall(text)
    n = len(words)
    upper, lower = sum(65 <= b < 91 for b in text), sum(97 <= b < 123 for b in text)
    visible = sum(map(len, words))
    bars = [i for i, b in enumerate(text) if b == 124]
    return [
        sum(b in SYMBOLS for b in text) / n, upper / max(upper + lower, 1), text.count(b"!") / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / (n - 1) if n > 1 else 0.0,
        len(set(words)) / n**0.9 if n > FEW_WORDS else 1.0, sum(b in STOPS for b in text) / n, visible / n,
        sum(i == 0 or text[i - 1] in SPACES for i in bars) / n if bars else 0.0,
        1 - (upper + lower + sum(b >= 128 for b in text)) / visible, sum(w[-1] in SYMBOLS or w[-1:] == b"!" for w in words) / n,
    ]


def plain_votes(at: list[int], n: int) -> str:
    out = ""
    for s, b in zip(STATISTICS, at, strict=True):
        v = "0" if b in VOTES_BAD[s] else "1" if b in VOTES_GOOD.get(s, ()) else "2"
        if n < FEW_WORDS and (v == "1" or s in ("distinct", "stops", "repeats", "unlettered")) or (n < 5 and s == "capitals"):
            v = "2"
        out += v
    return out


def plain_model(patterns: dict[str, int]) -> dict[str, float]:
    total = sum(patterns.values())
    good = {p: 0.1 if "0" in p else 0.9 for p in patterns}
    for _ in range(100):
        fresh = {}
        tables = []
        for sign in (1, 0):
            mass = {p: n * (good[p] if sign else 1 - good[p]) for p, n in patterns.items()}
            share = []
            for k in range(len(next(iter(patterns)))):
                seen = [0.5 + sum(m for p, m in mass.items() if p[k] == v) for v in "012"]
                share.append([x / sum(seen) for x in seen])
            tables.append(((sum(mass.values()) + 1) / (total + 2), share))
        for p in patterns:
            a, b = (math.log(prior) + sum(math.log(share[k][int(v)]) for k, v in enumerate(p)) for prior, share in tables)
            fresh[p] = 1 / (1 + math.exp(min(50, max(-50, b - a))))
        moved = max(abs(fresh[p] - good[p]) for p in patterns)
        if moved < 1e-9:
            break
        good = fresh
    return good


def plain_features(text: bytes, at: list[int]) -> dict[int, float]:
    mask = (1 << 32) - 1
    grams = Counter()
    for a, b, c in zip(text, text[1:], text[2:], strict=False):
        h = ((a * 0x9E3779B1 & mask) ^ (b * 0x85EBCA77 & mask) ^ (c * 0xC2B2AE3D & mask)) * 0x27D4EB2F & mask
        grams[h >> 20] += 1
    total = sum(grams.values())
    out = {k: math.sqrt(n / total) for k, n in grams.items()}
    for k, b in enumerate(at):
        slot = (k * 2654435761 + b * 40503 + 97) % SLOTS
        out[slot] = out.get(slot, 0) + 1
    return out


def plain_fit(examples: list[tuple[dict[int, float], float]]) -> list[float]:
    w, m, v = ([0.0] * (SLOTS + 1) for _ in range(3))
    for t in range(1, 151):
        g = [1e-4 * x for x in w]
        for x, y in examples:
            z = w[SLOTS] + sum(w[k] * a for k, a in x.items())
            d = (1 / (1 + math.exp(-max(-30, min(30, z)))) - y) / len(examples)
            g[SLOTS] += d
            for k, a in x.items():
                g[k] += d * a
        for k, d in enumerate(g):
            m[k] = 0.9 * m[k] + 0.1 * d
            v[k] = 0.999 * v[k] + 0.001 * d * d
            w[k] -= 0.1 * (m[k] / (1 - 0.9**t)) / (math.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return w


def plain_examples(texts: list[str | None]) -> tuple[dict, dict]:
    known = {}
    for text in {t for t in texts if not blank(t)}:
        raw = text.encode()
        at = [bisect_right(BINS[s], x) for s, x in zip(STATISTICS, plain_statistics(raw), strict=True)]
        n = len(WORD.findall(raw))
        known[text] = (plain_features(raw, at), plain_votes(at, n), n)
    posterior = plain_model(Counter(known[t][1] for t in texts if t in known))
    return known, posterior


def judge(known, weights):
    out = {}
    for text, (x, votes, n) in known.items():
        z = weights[SLOTS] + sum(weights[k] * a for k, a in x.items())
        score = 1 / (1 + math.exp(-max(-50, min(50, z))))
        out[text] = (score, score >= 0.5 or (n < FEW_WORDS and "0" not in votes))
    return out


def mixed(seed: int) -> list[str | None]:
    r = random.Random(seed)
    junk = ["BUY NOW!!! " * r.randint(3, 40), "#$%& | " * 30, "spam spam spam " * 20, "x | y | z " * 30, "1234 5678 " * 30]
    return [prose(100 * seed + k, r.randint(3, 80)) for k in range(16)] + junk + [t for _, t, *_ in rows() if t is None or len(t) < 3000]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_python(spark, seed):
    texts = mixed(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in classify(df).collect()}
    known, posterior = plain_examples(texts)
    model = label_model(dict(Counter(known[t][1] for t in texts if t in known)))
    assert set(model) == set(posterior) and all(abs(model[p] - posterior[p]) < 1e-6 for p in model)
    # each row has its own id, so that equal texts are examples of their own
    want = judge(known, plain_fit([(known[t][0], posterior[known[t][1]]) for t in texts if t in known]))
    for k, t in enumerate(texts):
        score, kept = want.get(t, (0.0, False))
        assert abs(got[k].score - score) < 0.02, (t, got[k].score, score)
        assert got[k].kept == kept or abs(score - 0.5) < 0.02
    assert any(g.kept for g in got.values()) and not all(g.kept for g in got.values())


@pytest.mark.parametrize("ident", [None, 0, 7, 123456789])
def test_one_id_for_all_documents(spark, ident):
    """The sample can't be empty, and rows that repeat id and text don't crowd it."""
    texts = [prose(k, 60) for k in range(30)] * 2 + [prose(99, 60)] * 300
    df = spark.createDataFrame([(ident, t) for t in texts], "doc_id long, text string").repartition(5)
    got = classify(df, sample=20).collect()
    assert len(got) == len(texts) and sum(r.kept for r in got) > 300


def test_sample_and_result_repeat(spark):
    df = documents(spark).unionByName(documents(spark).withColumn("doc_id", F.col("doc_id") + 100))
    first = sorted((r.doc_id or 0, r.score) for r in classify(df, sample=8).collect())
    again = sorted((r.doc_id or 0, r.score) for r in classify(df.repartition(7), sample=8).collect())
    assert len(first) == len(again) and all(abs(a[1] - b[1]) < 1e-9 for a, b in zip(first, again, strict=True))
