"""Best-fit packing with certified bin counts.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt evenly over partitions by
a hash; each partition runs best-fit decreasing on exact sizes. Dual-feasible functions give a
lower bound of what any packing of the partition's pieces needs: equal counts certify it.
Partitions with a gap give the pieces of their bins that aren't full to an exchange, which deals
them out anew to other partners and packs them again; exchanges go on for as long as they save bins. At the
end the pieces of the loosest bin of every partition meet in one more. Each row says how many sequences the
lengths of all pieces certify as the least, so what is left open can be seen.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tessera.llm.shared import drop_table, write_table

CAPACITY = 2048
#: Pieces of one partition of the packing.
PARTITION_PIECES = 100_000
#: Distinct chunks that a worker remembers the ids of, in each of two generations.
REMEMBERED = 700_000
_STOP = re.compile(rb"(?<=[a-z])([.,])(?=[ \n])")
_LOADED: dict = {}
#: Bytes as the characters that byte-level vocabularies show them by: visible ones as they are.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SHOWN = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


class ChunkIds(dict):
    """Packed ids of white-space-free chunks of UTF-8, by the tokenizer on the first sight of each.

    The tokenizer drops white space and no token, composition or lower-casing reaches across an
    ASCII space, so a text's ids are its chunks' ids in a row. A full stop or comma between a
    letter and white space is a token of its own and becomes a chunk; ASCII letters are lower-cased
    first, unless a special token could come of it. Words of Latin letters alone are one pre-token,
    composed already, and go straight to the merges. When the young generation is full it becomes the old one, so
    frequent chunks stay and memory is bounded.
    """

    def __init__(self, tokenizer, limit: int):
        super().__init__()
        self.encode = lambda s: np.array(tokenizer.encode(s, add_special_tokens=False).ids, "<u4").tobytes()
        self.merge = tokenizer.model.tokenize
        self.limit, self.old = limit, {}

    def packed(self, text: bytes) -> bytes:
        if b"<|" not in text:
            text = text.lower()
        return b"".join(map(self.__getitem__, _STOP.sub(rb" \1", text).split()))

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            word = chunk.decode()
            if word.isalpha() and max(word) < "\u0130":
                shown = word.lower().encode().decode("latin-1").translate(_SHOWN)
                ids = b"".join([t.id.to_bytes(4, "little") for t in self.merge(shown)])
            else:
                ids = self.encode(word)
        if len(chunk) <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[chunk] = ids
        return ids


#: How a tokenizer normalises and splits that ChunkIds stands in for.
_CHUNKED = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


class WholeIds:
    """Packed ids of whole texts, by a tokenizer of any kind."""

    def __init__(self, tokenizer):
        self.encode = tokenizer.encode

    def packed(self, text: bytes) -> bytes:
        return np.array(self.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()


def load(tokenizer_file: str) -> ChunkIds | WholeIds:
    """By chunks where the tokenizer splits as ChunkIds takes for granted, else by whole texts."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file)
    with open(tokenizer_file, encoding="utf-8") as file:
        told = json.load(file)
    model = told["model"]
    plain = model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
    special = all(t["content"].startswith("<|") and not t["normalized"] for t in told["added_tokens"])
    if plain and special and all(told[k] == v for k, v in _CHUNKED.items()):
        return ChunkIds(tokenizer, REMEMBERED)
    return WholeIds(tokenizer)


def tokenise(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32.

    A null or empty text is the end id alone; null ids stay null and rows that share an id give
    pieces of their own. An empty table has no pieces.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    )

    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_file not in _LOADED:
            _LOADED[tokenizer_file] = load(tokenizer_file)
        known = _LOADED[tokenizer_file]
        for batch in batches:
            rows = []
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                packed = known.packed(text or b"") + end
                for k, s in enumerate(range(0, len(packed), 4 * capacity)):
                    part = packed[s : s + 4 * capacity]
                    rows.append((ident, k, s // 4, len(part) // 4, zlib.crc32(part)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
                )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(pieces, from_arrow_schema(schema))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """bin and offset of each piece, and the number of bins.

    Bins with the same room are interchangeable, so they are kept in one stack for each room and
    a bit set tells which rooms occur: the tightest fit is its lowest bit from the length up.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            stack = stacks[room]
            at = stack.pop()
            if not stack:
                rooms ^= 1 << room
        else:
            room, at, n = capacity, n, n + 1
        bins[i], offsets[i] = at, capacity - room
        left = room - size
        if left:
            if not stacks[left]:
                rooms |= 1 << left
            stacks[left].append(at)
    return bins, offsets, n


def lower_bound(lengths: np.ndarray | dict[int, int], capacity: int) -> int:
    """lengths: of the pieces, or how many pieces have each. The best of two families of dual-feasible functions: no packing has fewer bins.

    Family one drops pieces under a threshold and counts those above capacity minus threshold as
    whole bins. Family two rounds lengths to multiples of capacity / (k + 1), down unless exact.
    """
    if not len(lengths):
        return 0
    if isinstance(lengths, dict):
        count = np.zeros(capacity + 1, np.int64)
        count[list(lengths)] = list(lengths.values())
    else:
        count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    number = np.concatenate([[0], np.cumsum(count)])  # number[s]: pieces under s
    mass = np.concatenate([[0], np.cumsum(count * np.arange(capacity + 1))])
    low = np.arange(1, capacity // 2 + 1)
    whole = number[-1] - number[capacity - low + 1]
    middle = mass[capacity - low + 1] - mass[low]
    best = int(np.max(whole + -(-middle // capacity)))
    best = max(best, -(-int(mass[-1]) // capacity))
    sizes = np.arange(capacity + 1, dtype=np.int64)
    for k in range(1, 41):
        scaled = (k + 1) * sizes
        # times k * capacity, to stay in whole numbers
        value = np.where(scaled % capacity == 0, k * sizes, (scaled // capacity) * capacity)
        best = max(best, -(-int((value * count).sum()) // (k * capacity)))
    return best


_PACKED = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
     ("part", pa.int64()), ("bin", pa.int64()), ("offset", pa.int64()), ("fill", pa.int64()), ("loosest", pa.bool_()),
     ("gap", pa.int64()), ("bins", pa.int64())]
)
_PIECE = ["doc_id", "piece", "start", "length", "ids_crc32"]


def _pack(pieces: DataFrame, parts: int, capacity: int, turn: int = 0) -> DataFrame:
    """Deals pieces over parts by a hash, another each turn, and packs each part."""

    def one(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = group.column("length").to_numpy()
        bins, offsets, n = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths, minlength=n).astype(np.int64)
        gap = n - lower_bound(lengths, capacity)
        more = {"bin": bins, "offset": offsets, "fill": fill[bins], "loosest": bins == int(np.argmin(fill)),
                "gap": np.full(len(lengths), gap), "bins": np.full(len(lengths), n)}
        return pa.table([group.column(f.name) if f.name not in more else pa.array(more[f.name], f.type) for f in _PACKED], schema=_PACKED)

    dealt = pieces.select(*_PIECE, F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(turn)), F.lit(parts)).alias("part"))
    return dealt.groupBy("part").applyInArrow(one, from_arrow_schema(_PACKED))


def _count(df: DataFrame) -> tuple[int, int]:
    """(pieces, bins) of packed rows."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("offset") == 0, 1)).alias("bins")).first()
    return row["n"], row["bins"]


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    partition_pieces: int = PARTITION_PIECES,
    rounds: int | None = None,
) -> DataFrame:
    """Pieces with sequence_id and offset, and least_sequences, the bound of all pieces together; every
    sequence is filled gaplessly from 0. rounds: of exchanges, at most; by default as many as save bins.

    A third of all pieces being alike doesn't skew a partition: pieces are dealt by a hash of
    document and piece. Repeated rows are packed as often as they occur. An empty table stays
    empty.
    """
    pieces = write_table(pieces.select(*_PIECE), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    least = lower_bound(counts, capacity)
    parts = max(1, -(-sum(counts.values()) // partition_pieces))
    packed = write_table(_pack(pieces, parts, capacity), "packed")
    drop_table(pieces)
    settled: list[DataFrame] = []
    turn, going = 0, parts > 1 and rounds != 0
    while going:
        going = rounds is None or turn + 1 < rounds
        loose = (F.col("fill") < capacity) & ((F.col("gap") > 0) | F.col("loosest"))
        pool = packed.filter(loose)
        n, bins = _count(pool)
        if bins < 2:
            break
        turn += 1
        fewer = max(1, -(-n // partition_pieces))
        again = write_table(_pack(pool, fewer, capacity, turn), "packed")
        if _count(again)[1] >= bins:
            drop_table(again)
            break
        settled.append(_numbered(packed.filter(~loose), turn))
        packed, parts = again, fewer
        going = going and parts > 1
    # the loosest bins of the parts that are left: one bin a part, so they fit in one partition
    loose = (F.col("fill") < capacity) & F.col("loosest")
    if parts > 1 and rounds != 0:
        pool = packed.filter(loose)
        bins = _count(pool)[1]
        if bins > 1:
            again = write_table(_pack(pool, 1, capacity), "packed")
            if _count(again)[1] < bins:
                settled.append(_numbered(packed.filter(~loose), turn + 1))
                packed = again
            else:
                drop_table(again)
    out = _numbered(packed, 0)
    for more in settled:
        out = out.unionByName(more)
    return out.withColumn("least_sequences", F.lit(least).cast("long"))


def _numbered(packed: DataFrame, turn: int) -> DataFrame:
    number = F.lit(turn).cast("long") * F.lit(1 << 52) + F.col("part") * F.lit(1 << 20) + F.col("bin")
    return packed.select(*_PIECE, number.alias("sequence_id"), "offset")
