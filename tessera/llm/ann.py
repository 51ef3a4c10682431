"""Approximate nearest neighbours by cross-polytope hashing.

Three rounds of random signs and a Hadamard transform rotate a unit vector; its hash is the signed
axis nearest to the result. A cell of a table is a chain of such hashes, as many as it takes that a
query can visit the cells it should (two up to tens of millions of vectors). A query visits its best cells of all tables
together, those whose axes lie nearest to it; the number falls with the root of the vectors, so that it meets
about their root of them. A vector that it meets in more cells than an unrelated one would is a candidate.

Vectors lie in blocks. What a query met in a block goes there as ids, and the block ranks the
candidates by exact distance and hands on only the nearest. Queries that have too few candidates, and all of
a length with few vectors or with norms that differ, which cells of directions can't tell apart, are compared with every
vector of their length, block by block.

Of equal vectors only the smallest ids can be among the nearest, so no more copies than that are
indexed, and equal queries are searched once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tessera.llm.shared import write_table

TABLES = 64
#: Cells that a query visits in all tables together, at most.
PROBES = 8192
NEAREST = 10
ROTATIONS = 3
SEED = 20240229
#: Vectors of a block, and queries that a block gets at once.
CELL_VECTORS = 4096
#: Lengths with at most so many vectors are searched exactly: fewer comparisons than cells to visit.
FEW_VECTORS = 1024
#: Lengths whose norms deviate from their mean by more than this share (standard deviation) are searched exactly too.
NORM_SPREAD = 0.05
#: How often a query meets an unrelated vector on average: so often among MEETINGS_AT vectors, less among more, with their root.
MEETINGS, MEETINGS_AT, MEETINGS_POWER = 0.5, 2048, 0.5
#: Axes of each hash that a query's cells are made of.
AXES = {1: 128, 2: 24, 3: 12}


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the normalised Hadamard matrix of their length, a power of two."""
    n, d = x.shape
    x = x.copy()
    h = 1
    while h < d:
        pairs = x.reshape(n, d // (2 * h), 2, h)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        total = low + high
        np.subtract(low, high, out=high)
        low[...] = total
        h *= 2
    return x / np.sqrt(d)


def rotations(dim: int, tables: int) -> np.ndarray:
    """Signs for each table and round, the same wherever they are drawn."""
    width = 1 << max(0, dim - 1).bit_length()
    return np.random.default_rng([SEED, dim]).choice([-1.0, 1.0], (tables, ROTATIONS, width))


def axes_of(vectors: np.ndarray, tables: int):
    """For each of ``tables`` rotations the products of each unit vector with all signed axes."""
    dim = vectors.shape[1]
    signs = rotations(dim, tables)
    unit = np.zeros((len(vectors), signs.shape[2]))
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit[:, :dim] = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    for t in range(tables):
        y = unit
        for s in signs[t]:
            y = hadamard(y * s)
        yield np.concatenate([y, -y], axis=1)


def signed_axes(vectors: np.ndarray, count: int, tables: int) -> np.ndarray:
    """(vectors, tables, count): the nearest signed axes of each unit vector, nearest first."""
    found = [np.argsort(-both, axis=1, kind="stable")[:, :count] for both in axes_of(vectors, tables)]
    return np.stack(found, axis=1).astype(np.int32)


def plan(dim: int, n: int, probes: int, tables: int) -> tuple[int, int, int]:
    """(hashes of a cell, cells to visit, cells to meet a candidate in) among n vectors.

    As few hashes as let a query visit no more cells than ``probes``. An unrelated vector is met
    ``mean`` times on average.
    """
    axes = 2 << max(0, dim - 1).bit_length()
    mean = MEETINGS * min(1.0, MEETINGS_AT / max(n, 1)) ** MEETINGS_POWER
    hashes = 1
    while hashes < 8 and mean * axes ** (hashes + 1) <= probes * 1.001:
        hashes += 1
    cells = axes**hashes
    visits = int(min(probes, np.ceil(mean * cells), tables * cells))
    return hashes, visits, 2 + int(2 * visits / cells) if visits >= 1024 else 1


def home_cells(vectors: np.ndarray, hashes: int, tables: int) -> np.ndarray:
    """(vectors, tables): the cell of each vector, the table's number in front."""
    out = np.empty((len(vectors), tables), np.int64)
    for i, both in enumerate(axes_of(vectors, tables * hashes)):
        t, h = divmod(i, hashes)
        out[:, t] = (out[:, t] if h else t) * both.shape[1] + both.argmax(axis=1)
    return out


def best_cells(vectors: np.ndarray, hashes: int, visits: int, tables: int) -> np.ndarray:
    """(vectors, visits): the cells of all tables whose axes have the greatest sums of products with each vector."""
    scores, cells = [], []
    for i, both in enumerate(axes_of(vectors, tables * hashes)):
        t, h = divmod(i, hashes)
        count = min(both.shape[1], AXES.get(hashes, 8))
        order = np.argsort(-both, axis=1, kind="stable")[:, :count]
        value = np.take_along_axis(both, order, axis=1)
        score = (score[:, :, None] + value[:, None, :]).reshape(len(vectors), -1) if h else value
        cell = (cell[:, :, None] * both.shape[1] + order[:, None, :]).reshape(len(vectors), -1) if h else order + t * both.shape[1]
        if h + 1 == hashes:
            scores.append(score)
            cells.append(cell)
    score, cell = np.concatenate(scores, axis=1), np.concatenate(cells, axis=1)
    best = np.argpartition(-score, min(visits, score.shape[1]) - 1, axis=1)[:, :visits]
    return np.take_along_axis(cell, best, axis=1)


_CELLS = pa.schema([("id", pa.int64()), ("dim", pa.int32()), ("block", pa.int32()), ("parts", pa.int32()), ("hits", pa.int32()), ("cells", pa.list_(pa.int64()))])


def _with_cells(vectors: DataFrame, asking: bool, probes: int, tables: int) -> DataFrame:
    """id, dim, block, parts, and hits, the cells that make a candidate. vectors has n, the size of the index."""

    def run(batches):
        for batch in batches:
            sizes = list(zip(batch.column("dim").to_pylist(), batch.column("n").to_pylist(), strict=True))
            for dim, n in sorted(set(sizes)):
                part = batch.filter(pa.array([s == (dim, n) for s in sizes]))
                values = part.column("vector").flatten().to_numpy().reshape(-1, dim)
                hashes, visits, hits = plan(dim, n, probes, tables)
                if asking:
                    cells = [c for at in range(0, len(values), 32) for c in best_cells(values[at : at + 32], hashes, visits, tables)]
                else:
                    cells = [c for at in range(0, len(values), 1024) for c in home_cells(values[at : at + 1024], hashes, tables)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ("id", "dim", "block", "parts")], pa.array([hits] * len(values), pa.int32()), pa.array(cells, _CELLS.field("cells").type)],
                    schema=_CELLS,
                )

    return vectors.select("id", "vector", "dim", "n", "block", "parts").mapInArrow(run, from_arrow_schema(_CELLS))


def meetings(index: DataFrame, asking: DataFrame, probes: int, tables: int) -> DataFrame:
    """(dim, block, part, qid, hits, ids): the ids that a query met in a block, once for each cell."""
    cell = ["dim", "cell"]
    there = _with_cells(index, False, probes, tables).select("dim", "block", "id", F.explode("cells").alias("cell"))
    there = there.groupBy("dim", "block", "cell").agg(F.collect_list("id").alias("ids"))  # at most a block's vectors
    visits = _with_cells(asking, True, probes, tables).select("dim", "parts", "hits", F.col("id").alias("qid"), F.explode("cells").alias("cell"))
    part = F.pmod(F.xxhash64("qid"), F.col("parts")).cast("int").alias("part")
    met = there.join(visits.hint("merge"), cell).groupBy("dim", "block", "qid", "parts", "hits").agg(F.flatten(F.collect_list("ids")).alias("ids"))
    return met.select("dim", "block", part, "qid", "hits", "ids")


def _near(qid: int, x: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    away = np.sqrt(((points - x) ** 2).sum(axis=1))
    near = np.lexsort((ids, away))[: k + 1]
    return np.full(len(near), qid), ids[near], away[near]


_FOUND = pa.schema([("qid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _matrix(table: pa.Table) -> np.ndarray:
    values = table.column("vector").combine_chunks().flatten().to_numpy()
    return values.reshape(table.num_rows, -1)


def _ranked(blocks: DataFrame, asks: DataFrame, key: list[str], k: int) -> DataFrame:
    """(qid, vec_id, score) of each block's nearest to each query: of its ids if asks has any, else of all."""
    listed = "ids" in asks.columns

    def search(have: pa.Table, ask: pa.Table) -> pa.Table:
        if not have.num_rows or not ask.num_rows:
            return _FOUND.empty_table()
        order = np.argsort(have.column("id").to_numpy(), kind="stable")
        points, ids = _matrix(have)[order], have.column("id").to_numpy()[order]
        out = []
        lists = zip(ask.column("ids"), ask.column("hits").to_pylist(), strict=True) if listed else iter(lambda: (None, 0), None)
        for q, x, (met, hits) in zip(ask.column("id").to_pylist(), _matrix(ask), lists, strict=False):
            if met is None:
                out.append(_near(q, x, points, ids, k))
                continue
            found, often = np.unique(met.values.to_numpy(), return_counts=True)
            found = found[often >= hits]
            first, last = np.searchsorted(ids, found), np.searchsorted(ids, found, side="right")
            at = np.concatenate([np.arange(a, b) for a, b in zip(first, last, strict=True)]) if len(found) else np.zeros(0, int)
            out.append(_near(q, x, points[at], ids[at], k))
        return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], schema=_FOUND)

    return blocks.groupBy(*key).cogroup(asks.groupBy(*key)).applyInArrow(search, from_arrow_schema(_FOUND))


def _sound(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    df = df.select(F.col(id_col).cast("long").alias("id"), v.alias("vector")).filter("id is not null and vector is not null")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.filter(finite & F.exists("vector", lambda x: x != 0)).withColumn("dim", F.size("vector"))


def prepared(vectors: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(index, asked, asking): the vectors that can be among the nearest, the queries, and one for each query vector;
    index and asking with n, the index's size, and where they are dealt."""
    least = Window.partitionBy("vector").orderBy("id")
    indexed = _sound(vectors, id_col, vector_col).distinct().withColumn("_copy", F.row_number().over(least)).filter(F.col("_copy") <= k + 1)
    indexed = write_table(indexed.select("id", "vector", "dim"), "vectors")
    asked = write_table(_sound(queries, id_col, vector_col).distinct(), "asked")
    classes = asked.groupBy("vector", "dim").agg(F.min("id").alias("id"))
    pieces = F.ceil(F.count(F.lit(1)) / F.lit(CELL_VECTORS)).cast("int")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    spread = F.try_divide(F.stddev_pop(norm), F.avg(norm))
    sizes = indexed.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), pieces.alias("blocks"), spread.alias("spread"))
    sizes = sizes.join(classes.groupBy("dim").agg(pieces.alias("parts")), "dim")
    sizes = write_table(sizes, "sizes")  # a row for each length
    dealt = lambda by: F.pmod(F.xxhash64("id"), F.col(by)).cast("int")
    index = write_table(indexed.join(sizes, "dim").withColumn("block", dealt("blocks")), "index")
    asking = write_table(classes.join(sizes, "dim").withColumn("part", dealt("parts")).withColumn("block", F.lit(0)), "asking")
    return index, asked, asking


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEAREST,
    tables: int = TABLES,
    probes: int = PROBES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each query, its own id excepted.

    A query gets all candidates if there are fewer than k, and k otherwise. The result is exact up to
    FEW_VECTORS vectors of a length, and where their norms differ (NORM_SPREAD).

    queries has the same columns as vectors. Null and zero vectors, and those with a null or
    non-finite component, take no part; vectors meet only others of their length. Null ids take no
    part; rows that share an id and a vector count once. Ties go to the smaller id. Empty tables
    give an empty result. Other columns are ignored.
    """
    index, asked, asking = prepared(vectors, queries, id_col, vector_col, k)
    many = (F.col("n") > FEW_VECTORS) & F.coalesce(F.col("spread") <= NORM_SPREAD, F.lit(False))
    key = ["dim", "block", "part"]
    spread: Column = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    blocks = index.withColumn("part", spread).select(*key, "id", "vector")
    met = write_table(meetings(index.filter(many), asking.filter(many), probes, tables), "meetings")
    asks = met.join(asking.select(F.col("id").alias("qid"), "vector"), "qid").select(*key, F.col("qid").alias("id"), "vector", "hits", "ids")
    best = Window.partitionBy("qid").orderBy("score", "vec_id")
    top = lambda df: df.withColumn("_at", F.row_number().over(best)).filter(F.col("_at") <= k + 1).drop("_at")
    found = write_table(top(_ranked(blocks, asks, key, k)), "found")

    # one more than k, as a query's own id can be among them
    counts = found.groupBy("qid").agg(F.count(F.lit(1)).alias("n_found"))
    short = asking.join(counts, F.col("id") == F.col("qid"), "left")
    short = short.filter(~many | (F.coalesce("n_found", F.lit(0)) <= k)).select("id", "vector", "dim", "part", "blocks")
    short = write_table(short, "short")
    every = short.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*key, "id", "vector")
    asked_of = short.select("dim", "part").distinct()
    exact = _ranked(blocks.join(asked_of, ["dim", "part"], "left_semi"), every, key, k)
    found = top(found.join(short.select(F.col("id").alias("qid")), "qid", "left_anti").unionByName(exact))
    owner = asked.join(asking.select("vector", F.col("id").alias("qid")), "vector").select(F.col("id").alias("query_id"), "qid")
    rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        owner.join(found, "qid")
        .filter("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(rank))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def compared(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST) -> DataFrame:
    """(qid, n, met, compared): of n vectors how many a query meets and is compared with, for measurements."""
    index, _, asking = prepared(vectors, queries, id_col, vector_col, k)
    each = meetings(index, asking, PROBES, TABLES).select("qid", "hits", F.explode("ids").alias("id")).groupBy("qid", "hits", "id").agg(F.count(F.lit(1)).alias("often"))
    counts = each.groupBy("qid").agg(F.sum("often").alias("met"), F.count_if(F.col("often") >= F.col("hits")).alias("compared"))
    return asking.select(F.col("id").alias("qid"), "n").join(counts, "qid", "left").fillna(0)
