"""Byte-level BPE encoding and decoding by overlapping chunks.

Every text is cut into overlapping chunks; each is pre-tokenised and encoded from its own start. The
pattern looks only forward, so as soon as two neighbouring chunks share one pre-token boundary they
agree from there on: the stitching step takes the first boundary that both have in their overlap and
concatenates the ids on either side. Every overlap is laid around a settled place, one that is a
boundary whatever came before (white space after a visible character, punctuation after a letter or
digit, a digit after an ASCII letter), so a common boundary always exists. Text without such a place,
a run of blanks or of letters, is one pre-token or few and stays in one chunk of any length.

The chunks of a text of at most ``spread_chars`` are encoded where it is read; those of a longer one
are dealt out as rows of their own.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS = 8_192
OVERLAP_CHARS = 256
#: Chunks of longer texts are dealt out to other tasks.
SPREAD_CHARS = 32_768
#: The library's pattern engine gives up on runs of about a million blanks; from so many on texts are split by another.
BLANKS = 65_536
#: The pattern looks at most this far beyond the end of what it matches.
LOOKAHEAD = 3

_ENCODERS: dict = {}


@dataclass(frozen=True)
class Vocabulary:
    """Where the ranks are and how texts are split; loaded once in each worker."""

    rank_file: str
    pattern: str

    def load(self):
        if self not in _ENCODERS:
            import tiktoken

            with open(self.rank_file, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            _ENCODERS[self] = tiktoken.Encoding(
                "ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={}
            )
        return _ENCODERS[self]


_SETTLED = re.compile(r"[^\s](?=[ \t\r\n])|[^\W_](?=[!-/:-@\[-^`{-~\u3001-\u3003\uff01\uff0c\uff1a\uff1b\uff1f])|[A-Za-z](?=[0-9])")
_BLANKS = re.compile(r"(?<!\s)\s{%d}" % BLANKS)


def encode_text(text: str, vocabulary: Vocabulary) -> list[int]:
    """The ids of a text that isn't cut."""
    enc = vocabulary.load()
    if len(text) < BLANKS or not _BLANKS.search(text):
        return enc.encode_ordinary(text)
    import regex

    return [i for m in regex.finditer(vocabulary.pattern, text) for i in enc._encode_single_piece(m.group())]


def cut(text: str, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """[start, end) of overlapping chunks; each overlap holds a settled boundary."""
    out, start = [], 0
    while len(text) - start > chunk + overlap:
        at = _SETTLED.search(text, start + chunk)
        if at is None or at.end() + overlap >= len(text):
            break
        settled = at.end()
        out.append((start, settled + overlap))
        start = max(start + chunk, settled - overlap)
    out.append((start, len(text)))
    return out


def pre_token_ends(text: str, pattern: str, last: bool) -> list[int]:
    import regex

    ends = [m.end() for m in regex.finditer(pattern, text)]
    return ends if last else [e for e in ends if e <= len(text) - LOOKAHEAD]


def encode_chunk(text: str, head: int, tail: int, last: bool, vocabulary: Vocabulary):
    """ids from the chunk's start, and (boundary, ids before it) in its two overlaps.

    head: where the chunk before ends; tail: where the next one starts, or the length.
    """
    ends = [0, *pre_token_ends(text, vocabulary.pattern, last)]
    marks = [e for e in ends if e <= head or e >= tail]
    ids: list[int] = []
    offsets, before = [], 0
    for e in marks:
        ids += encode_text(text[before:e], vocabulary)
        offsets.append(len(ids))
        before = e
    if last:
        ids += encode_text(text[before:], vocabulary)
    return ids, marks, offsets


def stitch(chunks: list[tuple[int, list[int], np.ndarray, np.ndarray]]) -> list[int]:
    """chunks: (start, ids, marks, offsets) in order. The ids of the whole text."""
    parts, begin = [], 0
    for (start, ids, marks, offsets), following in zip(chunks, [*chunks[1:], None], strict=True):
        if following is None:
            parts.append(ids[begin:])
            break
        mine = {start + int(m): int(o) for m, o in zip(marks, offsets, strict=True)}
        then = {following[0] + int(m): int(o) for m, o in zip(following[2], following[3], strict=True)}
        common = min(mine.keys() & (then.keys() - {following[0]}))
        parts.append(ids[begin : mine[common]])
        begin = then[common]
    return [i for part in parts for i in part]


def _ends(spans: list[tuple[int, int]], k: int) -> tuple[int, int, bool]:
    """Of chunk k, seen from its start: where the one before ends and the next one starts; whether it is the last."""
    start, end = spans[k]
    head = spans[k - 1][1] - start if k else 0
    last = k + 1 == len(spans)
    return head, (end if last else spans[k + 1][0]) - start, last


def encode_here(text: str, vocabulary: Vocabulary, chunk: int, overlap: int) -> list[int]:
    """The ids of a text, all chunks in this task."""
    spans = cut(text, chunk, overlap)
    if len(spans) == 1:
        return encode_text(text, vocabulary)
    chunks = [(s, *encode_chunk(text[s:e], *_ends(spans, k), vocabulary)) for k, (s, e) in enumerate(spans)]
    return stitch(chunks)


def encode_documents(
    docs: DataFrame,
    vocabulary: Vocabulary,
    finish: Callable[[list[int]], dict],
    result_schema: pa.Schema,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
    spread_chars: int = SPREAD_CHARS,
) -> DataFrame:
    """One row per input row: the id and what ``finish`` makes of the ids of the whole text.

    Null texts count as empty, null ids stay null; rows that share an id stay apart, and those that
    share the text too each give a row. Texts may be of any length, in one run of blanks or letters too.
    An empty table gives an empty result. Other columns of the input are ignored.
    """
    from pyspark.sql.pandas.types import from_arrow_schema

    names = result_schema.names
    out_schema = pa.schema([pa.field("_id", pa.int64()), *result_schema])
    spark_schema = from_arrow_schema(out_schema)
    base = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [finish(encode_here(t, vocabulary, chunk_chars, overlap_chars)) for t in batch.column("_text").to_pylist()]
            columns = [pa.array([f[n] for f in found], result_schema.field(n).type) for n in names]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *columns], schema=out_schema)

    piece_schema = pa.schema(
        [("_a", pa.int64()), ("_b", pa.int64()), ("_id", pa.int64()), ("_k", pa.int32()), ("_start", pa.int64()),
         ("_head", pa.int32()), ("_tail", pa.int32()), ("_last", pa.bool_()), ("_text", pa.string())]
    )

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *key, ident, text in zip(*(batch.column(c).to_pylist() for c in ("_a", "_b", "_id", "_text")), strict=True):
                spans = cut(text, chunk_chars, overlap_chars)
                rows = [(*key, ident, k, s, *_ends(spans, k), text[s:e]) for k, (s, e) in enumerate(spans)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), piece_schema, strict=True)],
                    schema=piece_schema,
                )

    coded_schema = pa.schema(
        [("_a", pa.int64()), ("_b", pa.int64()), ("_id", pa.int64()), ("_k", pa.int32()), ("_start", pa.int64()),
         ("_ids", pa.binary()), ("_marks", pa.binary()), ("_offsets", pa.binary())]
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = lambda x: np.asarray(x, np.uint32).tobytes()
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                ids, marks, offsets = encode_chunk(r["_text"], r["_head"], r["_tail"], r["_last"], vocabulary)
                rows.append((r["_a"], r["_b"], r["_id"], r["_k"], r["_start"], pack(ids), pack(marks), pack(offsets)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), coded_schema, strict=True)],
                    schema=coded_schema,
                )

    def join_up(group: pa.Table) -> pa.Table:
        every = group.to_pylist()
        chunks = {r["_k"]: r for r in every}  # rows that repeat id and text share the key and have equal chunks
        rows = [chunks[k] for k in sorted(chunks)]
        copies = len(every) // len(rows)
        unpack = lambda x: np.frombuffer(x, np.uint32)
        found = finish(
            stitch([(r["_start"], unpack(r["_ids"]).tolist(), unpack(r["_marks"]), unpack(r["_offsets"])) for r in rows])
        )
        return pa.Table.from_pydict({"_id": [rows[0]["_id"]] * copies, **{n: [found[n]] * copies for n in names}}, schema=out_schema)

    fits = F.length("_text") <= spread_chars
    held = [F.col("_id"), F.col("_text")]  # a key by content: the same after a lost executor
    small = base.filter(fits).select("_id", "_text").mapInArrow(short, spark_schema)
    large = (
        base.filter(~fits)
        .select(F.xxhash64(*held).alias("_a"), F.xxhash64(F.lit(1), *held).alias("_b"), *held)
        .mapInArrow(cut_up, from_arrow_schema(piece_schema))
        .repartition("_a", "_b", "_k")
        .mapInArrow(code, from_arrow_schema(coded_schema))
        .groupBy("_a", "_b")
        .applyInArrow(join_up, spark_schema)
    )
    return small.unionByName(large).withColumnRenamed("_id", id_col)


def ids_of(docs: DataFrame, vocabulary: Vocabulary, **options) -> DataFrame:
    """id and ids array<int> of every row."""
    return encode_documents(docs, vocabulary, lambda ids: {"ids": ids}, pa.schema([("ids", pa.list_(pa.int32()))]), **options)


def decode_ids(ids: list[int], vocabulary: Vocabulary) -> bytes:
    """The concatenated bytes of the ids' tokens."""
    return vocabulary.load().decode_bytes(ids)


def round_trip_digests(docs: DataFrame, vocabulary: Vocabulary, **options) -> DataFrame:
    """n_tokens, the SHA-256 of the ids in decimal and that of the decoded bytes."""
    schema = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    decimal: dict[int, str] = {}

    def finish(ids: list[int]) -> dict:
        if not decimal:
            decimal.update((i, str(i)) for i in range(vocabulary.load().max_token_value + 1))
        return {
            "n_tokens": len(ids),
            "ids_sha256": hashlib.sha256(" ".join([decimal[i] for i in ids]).encode()).hexdigest(),
            "decoded_sha256": hashlib.sha256(decode_ids(ids, vocabulary)).hexdigest(),
        }

    return encode_documents(docs, vocabulary, finish, schema, **options)
