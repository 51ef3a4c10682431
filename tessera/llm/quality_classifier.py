"""Quality classifier without hand-made labels: a label model and a hashed linear scorer.

Overlapping heuristic labellers vote on every document: good, bad, or no vote. Expectation
maximisation over the counts of all vote patterns estimates each labeller's accuracy and every
pattern's posterior. A bounded sample of documents, those of the smallest hashes of id and text,
labelled with their posteriors, trains a logistic scorer on hashed features: byte trigrams and binned
statistics. The scorer then judges every document. To the driver come the counts of vote patterns
(at most 3 to the number of labellers) and the scorer's weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from tessera.llm.near_dedup import word_hashes
from tessera.llm.shared import WHITESPACE

SLOTS = 4096
#: The scorer is fitted on so many different documents, or on all if there are fewer.
SAMPLE_DOCUMENTS = 6000
EM_ROUNDS = 100
FIT_ROUNDS = 150
THRESHOLD = 0.5
GOOD, BAD, NONE = 1, 0, 2
#: Below so many words most labellers don't vote.
FEW_WORDS = 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>@^_~=+/\\{}[]")] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:?")] = True
_SPACE = np.zeros(256, bool)
_SPACE[list(WHITESPACE.encode())] = True
STATISTICS = ("symbols", "capitals", "exclamations", "repeats", "distinct", "stops", "length", "bars", "unlettered", "endings")
#: Upper ends of the bins of each statistic; a labeller votes bad or good in the bins named below.
BINS = {
    "symbols": (0.005, 0.05, 0.2, 0.5),
    "capitals": (0.1, 0.2, 0.4, 0.7),
    "exclamations": (0.01, 0.05, 0.15, 0.5),
    "repeats": (0.01, 0.05, 0.15, 0.4),
    "distinct": (0.1, 0.25, 0.35, 0.5),
    "stops": (0.005, 0.03, 0.4, 0.7),
    "length": (2.0, 3.0, 9.0, 15.0),
    "bars": (0.005, 0.05, 0.15, 0.4),
    "unlettered": (0.05, 0.1, 0.18, 0.35),
    "endings": (0.02, 0.1, 0.3, 0.6),
}
VOTES_BAD = {"symbols": (3, 4), "capitals": (3, 4), "exclamations": (3, 4), "repeats": (3, 4), "distinct": (0, 1), "stops": (0, 4), "length": (0, 4), "bars": (3, 4),
             "unlettered": (3, 4), "endings": (3, 4)}
#: Nothing unusual in one respect says little, so most labellers only vote against a text.
VOTES_GOOD = {"stops": (2,), "length": (2,)}


def statistics(text: bytes) -> tuple[np.ndarray, int]:
    """The statistics in order, and the number of words."""
    raw = np.frombuffer(text, np.uint8)
    words = word_hashes(text)
    n = len(words)
    if not n:
        return np.zeros(len(STATISTICS)), 0
    count = np.bincount(raw, minlength=256)
    letters = count[65:91].sum() + count[97:123].sum()
    alone = np.flatnonzero(raw == 124)
    before = np.where(alone > 0, raw[alone - 1], 32)
    last = raw[~_SPACE[raw] & np.append(_SPACE[raw[1:]], True)]
    visible = len(raw) - count[_SPACE].sum()
    values = (
        count[_SYMBOL].sum() / n,
        count[65:91].sum() / max(letters, 1),
        count[33] / n,
        (words[1:] == words[:-1]).mean() if n > 1 else 0.0,
        len(np.unique(words)) / n ** 0.9 if n > FEW_WORDS else 1.0,
        count[_STOP].sum() / n,
        visible / n,
        _SPACE[before].sum() / n if len(alone) else 0.0,
        1 - (letters + count[128:].sum()) / visible,
        (_SYMBOL[last] | (last == 33)).sum() / n,
    )
    return np.array(values), n


def bins(values: np.ndarray) -> list[int]:
    return [int(np.searchsorted(BINS[s], v, side="right")) for s, v in zip(STATISTICS, values, strict=True)]


def votes(at: list[int], n_words: int) -> str:
    """A digit for each labeller. Short texts get only votes against them."""
    out = []
    for s, b in zip(STATISTICS, at, strict=True):
        vote = BAD if b in VOTES_BAD[s] else GOOD if b in VOTES_GOOD.get(s, ()) else NONE
        if n_words < FEW_WORDS and (vote == GOOD or s in ("distinct", "stops", "repeats", "unlettered")):
            vote = NONE
        if n_words < 5 and s == "capitals":  # one capital is much of it
            vote = NONE
        out.append(vote)
    return "".join(map(str, out))


def hashed_features(text: bytes, at: list[int]) -> np.ndarray:
    """A vector of SLOTS: root frequencies of byte trigrams, and a one for each statistic's bin."""
    raw = np.frombuffer(text, np.uint8).astype(np.uint32)
    out = np.zeros(SLOTS, np.float32)
    if len(raw) >= 3:
        h = (raw[:-2] * np.uint32(0x9E3779B1) ^ raw[1:-1] * np.uint32(0x85EBCA77) ^ raw[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
        grams = np.bincount(h >> np.uint32(20), minlength=SLOTS)
        out += np.sqrt(grams / grams.sum()).astype(np.float32)
    for k, b in enumerate(at):
        out[(k * 2654435761 + b * 40503 + 97) % SLOTS] += 1
    return out


def label_model(patterns: dict[str, int], rounds: int = EM_ROUNDS) -> dict[str, float]:
    """Probability that a document of each vote pattern is good.

    Dawid and Skene's model of two classes in which a labeller may also not vote; how often it
    votes at all is learned for each class. It starts from whether anything speaks against a text.
    """
    if not patterns:
        return {}
    names = sorted(patterns)
    vote = np.array([[int(c) for c in p] for p in names])
    weight = np.array([patterns[p] for p in names], float)
    post = np.where((vote == BAD).any(axis=1), 0.1, 0.9)
    onehot = np.stack([vote == v for v in (BAD, GOOD, NONE)], axis=2).astype(float)
    for _ in range(rounds):
        logs = []
        for p in (post, 1 - post):
            mass = weight * p
            share = np.einsum("p,plv->lv", mass, onehot) + 0.5
            share /= share.sum(axis=1, keepdims=True)
            logs.append(np.log((mass.sum() + 1) / (weight.sum() + 2)) + np.einsum("plv,lv->p", onehot, np.log(share)))
        fresh = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -50, 50)))
        if np.abs(fresh - post).max() < 1e-9:
            break
        post = fresh
    return dict(zip(names, post.tolist(), strict=True))


def fit(features: np.ndarray, target: np.ndarray, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Weights and intercept of a logistic scorer of soft targets, by Adam on all rows."""
    x = np.hstack([features, np.ones((len(features), 1), np.float32)])
    w, m, v = (np.zeros(x.shape[1], np.float32) for _ in range(3))
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - target).astype(np.float32) / len(x) + np.float32(1e-4) * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w.astype(np.float64)


def _read(batch: pa.RecordBatch, column: str) -> Iterator[tuple[bytes, list[int], int]]:
    for text in batch.column(column).cast(pa.binary()).to_pylist():
        text = text or b""
        values, n = statistics(text)
        yield text, bins(values), n


def train(docs: DataFrame, id_col: str, text_col: str, sample: int) -> np.ndarray:
    """The scorer's weights, or no weights if no document has words."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), text.cast("string").alias("_text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [votes(at, n) if n else None for _, at, n in _read(batch, "_text")]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["pattern"])

    counted = rows.mapInArrow(vote, "pattern string").filter("pattern is not null").groupBy("pattern").count()
    patterns = {r["pattern"]: r["count"] for r in counted.collect()}
    if not patterns:
        return np.zeros(0)
    posterior = label_model(patterns)
    # eight bytes of each document are grouped, then as many as the sample are broadcast
    held = rows.filter(F.col("_text").rlike(r"[^\x20\x09-\x0D]")).withColumn("_hash", F.xxhash64("_id", "_text"))
    least = held.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")).orderBy("_hash").limit(sample).select("_hash")
    chosen = held.join(F.broadcast(least), "_hash", "left_semi").dropDuplicates(["_hash"])

    def feature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, target = [], []
            for t, at, n in _read(batch, "_text"):
                if n:
                    found.append(hashed_features(t, at).astype(np.float16).tobytes())
                    target.append(posterior[votes(at, n)])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(target, pa.float64())], names=["x", "y"])

    def solve(table: pa.Table) -> pa.Table:
        x = np.frombuffer(b"".join(table.column("x").to_pylist()), np.float16).reshape(-1, SLOTS).astype(np.float32)
        y = table.column("y").to_numpy()
        order = np.lexsort((x @ np.arange(SLOTS, dtype=np.float32), y))  # the same sum whatever the order of arrival
        return pa.table({"w": [fit(x[order], y[order]).tobytes()]})

    rated = chosen.mapInArrow(feature, "x binary, y double").withColumn("one", F.lit(1))
    fitted = rated.groupBy("one").applyInArrow(solve, "w binary").collect()
    return np.frombuffer(fitted[0]["w"], np.float64)


def classify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE_DOCUMENTS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """All rows and columns, and score (0 to 1) and kept; columns of those names are replaced.

    A text is kept if its score reaches the threshold; one of few words, which says little to the
    scorer, also if no labeller speaks against it. Null and blank texts score 0 and aren't kept. Rows without an id take part like others. Equal
    texts get equal scores. An empty table stays empty.
    """
    weights = train(docs, id_col, text_col, sample)
    plain = docs.drop("score", "kept")
    at = plain.columns.index(text_col)
    schema = to_arrow_schema(plain.schema)
    out = pa.schema([*schema, pa.field("score", pa.float64()), pa.field("kept", pa.bool_())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, kept = [], []
            for t, b, n in _read(batch.rename_columns([str(i) for i in range(batch.num_columns)]), str(at)):
                if not n or not len(weights):
                    scores.append(0.0)
                    kept.append(False)
                    continue
                z = float(hashed_features(t, b) @ weights[:-1] + weights[-1])
                scores.append(float(1 / (1 + np.exp(-np.clip(z, -50, 50)))))
                kept.append(scores[-1] >= threshold or (n < FEW_WORDS and str(BAD) not in votes(b, n)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array(kept, pa.bool_())], schema=out)

    return plain.mapInArrow(judge, from_arrow_schema(out))
