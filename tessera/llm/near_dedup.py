"""Near-duplicate documents by MinHash with tensored banding.

Two small collections, A and B, of m combined minhashes each give m * m table keys (A_i, B_j) from
2 * m * rows minhashes, where plain banding would compute m * m * 2 * rows. A pair that shares an
A_i and a B_j shares a table. Documents with equal shingle sets are one node. In every table the
members are linked to the smallest one; those candidates are confirmed on the full sets. Members
of one table that are then still in different components are linked to the member that has the
fewest shingles of its own, and what is left is compared across components: of two texts that are alike
enough the first few shingles of each, rarest first, have one in common. If it is a rare one they meet
at it, where few others are; if it is frequent, almost all of either text is, and only such texts
meet in their tables, where the rare shingles in common and the frequent ones of either can be enough. So
no link between two components goes unseen, while a bucket of n copies costs about n checks and
not n squared, and one of n unrelated texts none.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tessera.llm.graph import components
from tessera.llm.shared import by_slices, drop_table, join_small, let, write_table

SHINGLE_WORDS = 3
SIMILARITY = 85
COLLECTIONS = 10
ROWS = 3
#: Shingles of at most so many documents are compared one by one where a bound is wanted; any number is exact.
FEW_HOLDERS = 32
#: Classes of more copies are joined without being dealt by class.
HOT_COPIES = 1000

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


#: Bytes that are hashed at once; what is held besides grows with the words only.
HASH_BYTES = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n + 1:
        size = 1 << (n + 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base & (1 << 64) - 1, _U)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=_U)
    return _POWERS[0], _POWERS[1]


def word_hashes(text: bytes, block: int = HASH_BYTES) -> np.ndarray:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ in order."""
    raw = np.frombuffer(text, np.uint8)
    if not len(raw):
        return np.zeros(0, _U)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    del inside, edge
    up, down = _powers(min(len(raw), block))
    # sums of bytes times powers of the base up to each start and end, a block at a time
    before, after, scale = (np.zeros(len(starts), _U) for _ in range(3))
    carry = _U(0)
    for at in range(0, len(raw), block):
        part = raw[at : at + block]
        sums = np.zeros(len(part) + 1, _U)
        np.cumsum(_BYTE[part] * up[: len(part)], out=sums[1:])
        sums = sums * _U(pow(_BASE, at, 1 << 64)) + carry
        s, e = (np.searchsorted(x, [at, at + len(part)]) for x in (starts, ends))
        before[s[0] : s[1]] = sums[starts[s[0] : s[1]] - at]
        scale[s[0] : s[1]] = down[starts[s[0] : s[1]] - at] * _U(pow(_INVERSE, at, 1 << 64))
        after[e[0] : e[1]] = sums[ends[e[0] : e[1]] - at]
        carry = sums[-1]
    if len(ends) and ends[-1] == len(raw):
        after[-1] = carry
    return mix((after - before) * scale + (ends - starts).astype(_U))


def shingle_set(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of word shingles; A-Z lower-cased; fewer words: one of them all."""
    words = word_hashes((text or "").encode().lower())
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    out = np.full(n, min(len(words), size), _U)
    for k in range(min(size, len(words))):
        out = mix(out * _U(0x9E3779B97F4A7C15) + words[k : k + n])
    return np.unique(out)


def _coefficients(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=_U) * _U(0xA24BAED4963EE407)) | _U(1)


def sketch(shingles: np.ndarray, collections: int, rows: int) -> np.ndarray:
    """2 * collections combined minhashes."""
    a = _coefficients(2 * collections * rows)
    low = np.full(len(a), ~_U(0), _U)
    for s in range(0, len(shingles), 4096):
        np.minimum(low, np.multiply.outer(a, shingles[s : s + 4096]).min(axis=1), out=low)
    out = np.zeros(2 * collections, _U)
    for k in range(rows):
        out = mix(out * _U(0x9E3779B97F4A7C15) + low.reshape(2 * collections, rows)[:, k])
    return out


def _sketches(docs: DataFrame, size: int, collections: int, rows: int) -> DataFrame:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("sketch", pa.list_(pa.int64())), ("mark", pa.int64())]
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, found = [], [], []
        for text in batch.column(1).to_pylist():
            s = shingle_set(text, size)
            counts.append(len(s))
            digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            found.append(sketch(s, collections, rows).view(np.int64))
        flat = np.concatenate(found) if found else np.zeros(0, np.int64)
        at = np.arange(0, len(flat) + 1, 2 * collections, dtype=np.int32)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(at, pa.array(flat)), batch.column(2)],
            schema=schema,
        )

    return docs.mapInArrow(by_slices(run), from_arrow_schema(schema))


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, similarity: int) -> DataFrame:
    """The pairs (u, v) whose full shingle sets are alike enough. texts: (node, text), a row each."""
    blob = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingle_set(t, size).tobytes() for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], schema=blob)

    def verify(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column("su"), batch.column("sv"), strict=True):
            p, q = (np.frombuffer(s.as_buffer(), _U) for s in (x, y))
            both = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(100 * both >= similarity * (len(p) + len(q) - both))
        return batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    ends = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    found = write_table(texts.join(ends, "node", "left_semi").mapInArrow(by_slices(sets), "node long, shingles binary"), "sets")
    pairs = pairs.join(found.toDF("u", "su"), "u").join(found.toDF("v", "sv"), "v")
    out = write_table(pairs.mapInArrow(by_slices(verify), "u long, v long"), "confirmed")
    drop_table(found)
    return out


def _exploded(texts: DataFrame, size: int) -> DataFrame:
    """(node, shingle) of texts (node, text)."""

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingle_set(t, size).view(np.int64) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"])

    return texts.mapInArrow(by_slices(sets), "node long, shingles array<long>").select("node", F.explode("shingles").alias("shingle"))


def _own(texts: DataFrame, size: int) -> DataFrame:
    """(node, own): how many of its shingles no other node has; nodes without any are left out."""
    holders = _exploded(texts, size).groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"))
    return holders.filter("n = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own"))


def _held(texts: DataFrame, size: int, few: int) -> DataFrame:
    """(node, rare, often): its shingles that two to ``few`` nodes have, rarest first, and how many more have."""
    seen = write_table(_exploded(texts, size), "shingles")
    holders = seen.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rare = F.array_sort(F.collect_list(F.when(F.col("n") <= few, F.struct("n", "shingle"))))
    rare, often = F.transform(rare, lambda s: s["shingle"]), F.count(F.when(F.col("n") > few, 1))
    some = seen.join(holders, "shingle").groupBy("node").agg(rare.alias("rare"), often.alias("often"))
    every = texts.select("node").join(some, "node", "left")
    return every.select("node", F.coalesce("rare", F.array().cast("array<long>")).alias("rare"), F.coalesce("often", F.lit(0)).alias("often"))


def _joined(reached: DataFrame, links: DataFrame) -> DataFrame:
    """The components once links (u, v) between their nodes are added."""
    if links.isEmpty():
        return reached
    place = lambda x, to: reached.select(F.col("node").alias(x), F.col("component").alias(to))
    ends = links.join(place("u", "cu"), "u", "left").join(place("v", "cv"), "v", "left")
    merged = components(ends.select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")))
    merged = merged.withColumnRenamed("component", "to")
    known = reached.join(merged.withColumnRenamed("node", "component"), "component", "left")
    known = known.select("node", F.coalesce("to", "component").alias("component"))
    fresh = merged.join(reached, "node", "left_anti").select("node", F.col("to").alias("component"))
    return write_table(known.unionByName(fresh), "reached")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    similarity: int = SIMILARITY,
    collections: int = COLLECTIONS,
    rows: int = ROWS,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    Null or blank texts have empty sets and link with nothing. Rows that share an id count as
    linked when they have words and are each returned. A row without an id is kept, with a null
    component. Other columns are ignored; an empty table gives an empty result.

    With the default sizes a pair at similarity 0.85 is missed with probability 1.5e-4, one at
    0.9 with 4e-6.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("mark", F.xxhash64("text"))
    seen = write_table(_sketches(docs, size, collections, rows), "sketches")
    full = seen.filter("n_shingles > 0 and doc_id is not null")
    # a node is a class of equal shingle sets, numbered once: an id may have several classes
    of = ["digest", "n_shingles"]
    least = F.min(F.struct("doc_id", "mark", "sketch")).alias("least")
    nodes = full.groupBy(*of).agg(least, F.count(F.lit(1)).alias("n")).select(*of, "n", "least.*")
    nodes = write_table(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    # copies of the few large classes meet their node without being dealt by it
    hot = write_table(nodes.filter(F.col("n") > HOT_COPIES).select(*of, "node"), "hot")
    ids = full.select("doc_id", *of)
    cold = join_small(ids, hot.select(*of), of, "left_anti").join(nodes.filter(F.col("n") <= HOT_COPIES).select(*of, "node"), of)
    copies = cold.unionByName(join_small(ids, hot, of, "inner"))
    copies = write_table(copies.select("doc_id", "node").distinct(), "copies")
    # a collection value that no other node has can be in no shared table
    values = nodes.select("node", F.posexplode("sketch").alias("k", "value"))
    shared = values.groupBy("k", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k", "value")
    live = values.join(shared, ["k", "value"], "left_semi").groupBy("node").agg(F.collect_set("k").alias("ks"))
    first = F.filter("ks", lambda k: k < collections)
    second = F.filter("ks", lambda k: k >= collections)
    keyed = (
        nodes.join(live, "node")
        .withColumn("i", F.explode(first))
        .withColumn("j", F.explode(second))
        .select(F.xxhash64("i", "j", F.col("sketch")[F.col("i")], F.col("sketch")[F.col("j")]).alias("key"), "node", "n_shingles")
    )
    buckets = keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    tables = write_table(keyed.join(buckets.select("key", "low"), "key"), "tables")
    # mark tells the texts of one id apart
    texts = docs.join(nodes.select("doc_id", "mark", "node"), ["doc_id", "mark"]).select("node", "text").dropDuplicates(["node"])
    star = write_table(tables.filter("node <> low").select(F.col("low").alias("u"), F.col("node").alias("v")).distinct(), "star")
    links = _confirmed(star, texts, size, similarity)
    # ids that occur with several texts join those texts' classes
    several = copies.groupBy("doc_id").agg(F.min("node").alias("u"), F.max("node").alias("high")).filter("u < high")
    ties = copies.join(several, "doc_id").filter("node <> u").select("u", F.col("node").alias("v"))
    reached = components(links.unionByName(ties))

    # what is left: candidate pairs between components. Each table key starts with a value of A, so
    # candidates also meet at that value alone, in rows for m keys instead of m * m
    def mixed(members: DataFrame, reached: DataFrame) -> DataFrame:
        """Rows of keys with several components: key, node, ..., c, main; main: one of them."""
        placed = members.join(reached.withColumnRenamed("component", "c"), "node", "left").withColumn("c", F.coalesce("c", "node"))
        keys = placed.groupBy("key").agg(F.min("c").alias("main"), F.max("c").alias("top")).filter("main < top")
        return placed.join(keys.select("key", "main"), "key")

    open_ = write_table(mixed(tables.select("key", "node"), reached).select("node").distinct(), "open")
    own = _own(texts.join(open_, "node", "left_semi").select("node", "text"), size)
    shared = F.col("n_shingles") - F.coalesce("own", F.lit(0))
    members = nodes.join(open_, "node", "left_semi").join(own, "node", "left").withColumn("common", shared)
    members = members.select("node", "n_shingles", "common", "sketch", F.explode(F.sequence(F.lit(0), F.lit(collections - 1))).alias("i"))
    members = write_table(members.withColumn("key", F.xxhash64("i", F.get("sketch", F.col("i")))), "members")
    fields = ("node", "n_shingles", "common", "sketch", "c")
    # their intersection is at most what either shares with anyone
    enough = ((100 + similarity) * F.least("a_common", "b_common")) >= (similarity * (F.col("a_n_shingles") + F.col("b_n_shingles")))
    pair = [F.least("a_node", "b_node").alias("u"), F.greatest("a_node", "b_node").alias("v")]
    near = mixed(members.drop("sketch", "i"), reached)
    hub = near.groupBy("key").agg(F.max(F.struct("common", "node", "n_shingles", "c")).alias("hub"))
    hub = hub.select("key", *[F.col(f"hub.{x}").alias(f"a_{x}") for x in fields if x != "sketch"])
    spokes = near.select("key", *[F.col(x).alias(f"b_{x}") for x in fields if x != "sketch"]).join(hub, "key")
    spokes = spokes.filter(enough & (F.col("a_c") != F.col("b_c"))).select(*pair).distinct()
    spokes = write_table(spokes.join(star, ["u", "v"], "left_anti"), "spokes")
    reached = _joined(reached, _confirmed(spokes, texts, size, similarity))

    still = write_table(mixed(members, reached), "open")
    left = texts.join(still.select("node").distinct(), "node", "left_semi").select("node", "text")
    held = _held(left, size, FEW_HOLDERS)
    # of two texts that are alike enough, the first shingles of each, rarest first, have one in common
    first_ones = F.col("n_shingles") - F.ceil(similarity * F.col("n_shingles") / F.lit(100)) + 1
    alone = F.col("n_shingles") - F.size("rare") - F.col("often")
    info = still.groupBy("node", "n_shingles", "c").agg(F.first("sketch").alias("sketch")).join(held, "node")
    info = write_table(info.withColumn("prefix", F.slice("rare", 1, F.greatest(first_ones - alone, F.lit(0)).cast("int"))), "info")
    equal = F.zip_with("a_sketch", "b_sketch", lambda x, y: x == y)
    table = let(equal, lambda e: F.array_contains(F.slice(e, 1, collections), F.lit(True)) & F.array_contains(F.slice(e, collections + 1, collections), F.lit(True)))
    side = lambda x: info.select(F.explode("prefix").alias("shingle"), *[F.col(f).alias(f"{x}_{f}") for f in ("node", "n_shingles", "c", "sketch")])
    sized = (100 * F.least("a_n_shingles", "b_n_shingles")) >= (similarity * F.greatest("a_n_shingles", "b_n_shingles"))
    rare_pairs = side("a").join(side("b"), "shingle").filter((F.col("a_node") < F.col("b_node")) & (F.col("a_c") != F.col("b_c")) & sized & table).select(*pair)
    # or that shingle is frequent, and then so are most of either text: these meet in their tables
    heavy = info.filter(100 * F.col("often") >= similarity * F.col("n_shingles")).select("node", "rare", "often")
    still = write_table(still.drop("common").join(heavy, "node"), "heavy")
    still = mixed(still.drop("c", "main"), reached)
    fields = ("node", "n_shingles", "sketch", "c", "rare", "often")
    a = still.filter("c <> main").select("key", "main", "i", *[F.col(x).alias(f"a_{x}") for x in fields])
    b = still.select("key", *[F.col(x).alias(f"b_{x}") for x in fields])
    apart = (F.col("a_c") != F.col("b_c")) & ((F.col("b_c") == F.col("main")) | (F.col("a_node") < F.col("b_node")))
    # their intersection is at most the rare shingles that both have and the frequent ones of either
    within = F.size(F.array_intersect("a_rare", "b_rare")) + F.least("a_often", "b_often")
    within = ((100 + similarity) * within) >= (similarity * (F.col("a_n_shingles") + F.col("b_n_shingles")))
    # only where they share a table, and only at the first value of A that they share: each pair once
    once = let(
        equal,
        lambda e: (F.array_position(F.slice(e, 1, collections), F.lit(True)) == F.col("i") + 1)
        & F.array_contains(F.slice(e, collections + 1, collections), F.lit(True)),
    )
    heavy_pairs = a.join(b, (a["key"] == b["key"]) & apart & once & within & sized).select(*pair)
    across = rare_pairs.unionByName(heavy_pairs).distinct()
    across = across.join(star.unionByName(spokes), ["u", "v"], "left_anti")
    reached = _joined(reached, _confirmed(write_table(across, "across"), texts, size, similarity))
    for done in (tables, open_, members, info, star, spokes, nodes, hot):
        drop_table(done)
    ends = copies.join(reached, "node", "left").select("doc_id", F.coalesce("component", "node").alias("to"))
    roots = ends.groupBy("to").agg(F.min("doc_id").alias("component"))
    place = ends.groupBy("doc_id").agg(F.min("to").alias("to")).join(roots, "to").select("doc_id", "component")
    out = seen.select("doc_id", "n_shingles").join(place, "doc_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
