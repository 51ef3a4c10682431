"""Exact substring removal by a distributed, common-prefix-aware merge sort of suffixes.

Every byte that a string of ``match`` bytes covers is removed if that string also starts earlier.
Sorting all suffixes of a corpus would move a hundred times its size, so the suffix array is
sparse: only suffixes at anchors are sorted. The anchor of a window of ``match`` bytes is the
position of its smallest hash of ``gram`` bytes, the leftmost of equals. Equal windows have their
anchors at the same place, so windows that repeat meet at the anchors' suffixes and none is lost.

1. Documents are dealt into buckets. A bucket finds its anchors; their gram hashes are counted over
   all buckets, and anchors whose gram occurs once are dropped.
2. A bucket sorts the suffixes of the others. A suffix carries the bytes that its windows cover:
   those from the anchor on, a separator that UTF-8 doesn't use, and those before the anchor.
   Equal suffixes are settled at once, all but the earliest; the rest leave as sorted,
   front-coded runs, dealt by gram.
   Suffixes of a gram that many buckets hold are dealt by more than the gram: windows that reach
   further behind the anchor than before it by the bytes behind, the others by the bytes before.
3. A loser tree merges the runs of a partition. It keeps the length of the prefix that each loser
   shares with the string that beat it, so known prefixes are never compared again, and it yields
   each suffix with the prefix it shares with the one before. Runs of suffixes that share the gram
   are resolved to windows; the longest prefix that a suffix shares with a neighbour bounds which
   of its windows can occur elsewhere, the others are never looked at.
4. Documents meet their marked spans.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from tessera.llm.near_dedup import _BYTE, _powers, mix
from tessera.llm.shared import MAX_LABELS, even_labels, freeing, shuffle_partitions

MATCH_BYTES = 100
GRAM_BYTES = 40
BUCKET_BYTES = 16 << 20
#: Documents are hashed together up to so many bytes; hashing holds about a hundred times as much for a moment.
BLOCK_BYTES = 1 << 17
#: So many texts are cut at once.
CUT_ROWS = 256
#: A gram in so many buckets is split by the bytes around it.
HOT_BUCKETS = 16
#: Not a byte of UTF-8.
SEPARATOR = b"\xff"
_U = np.uint64


def anchors(block: bytes, ends: np.ndarray, match: int, gram: int) -> tuple[np.ndarray, ...]:
    """(gram hash, anchor, first and last start of its windows) of the documents in block.

    ends: where each document ends in it. Windows lie within documents.
    """
    raw = np.frombuffer(block, np.uint8)
    none = np.zeros(0, np.int64)
    if len(raw) < match:
        return none.view(_U), none, none, none
    up, down = _powers(len(raw))
    sums = np.zeros(len(raw) + 1, _U)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
    g = mix((sums[gram:] - sums[:-gram]) * down[: len(raw) - gram + 1])
    least = (g & _U(0xFFFFFFFF00000000)) | np.arange(len(g), dtype=_U)
    width, want = 1, match - gram + 1
    while width < want:
        step = min(width, want - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    starts = np.arange(len(least))
    within = ends[np.searchsorted(ends, starts, side="right")] - starts >= match
    starts, at = starts[within], (least[within] & _U(0xFFFFFFFF)).astype(np.int64)
    if not len(starts):
        return none.view(_U), none, none, none
    turn = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(turn[1:], len(at)) - 1
    return g[at[turn]], at[turn], starts[turn], starts[last]


def _blocks(texts: list[bytes], match: int) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first document, where the block starts in it, block, ends of documents in it), each of about BLOCK_BYTES.

    A longer document is cut into pieces that overlap by match - 1 bytes, so that each of its windows lies in one.
    """
    first, held, limit = 0, 0, BLOCK_BYTES
    joined = lambda last: (first, 0, b"".join(texts[first:last]), np.cumsum([len(t) for t in texts[first:last]]))
    for i, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield joined(i)
            first, held = i, 0
        if len(t) > limit:
            for at in range(0, len(t) - match + 1, limit):
                piece = t[at : at + limit + match - 1]
                yield i, at, piece, np.array([len(piece)])
            first = i + 1
            continue
        held += len(t)
    if first < len(texts):
        yield joined(len(texts))


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the prefix that a and b share, given that the first ``known`` bytes are equal."""
    n = min(len(a), len(b))
    at = known
    while at < n:
        x, y = a[at : at + 32], b[at : at + 32]
        if x != y:
            m = min(len(x), len(y))
            differ = int.from_bytes(x[:m], "little") ^ int.from_bytes(y[:m], "little")
            return at + (((differ & -differ).bit_length() - 1) >> 3 if differ else m)
        at += 32
    return n


def front_code(run: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """(shared prefix lengths, rest lengths, rests) of a sorted run."""
    shared, rest, before = [], [], b""
    for s in run:
        h = common_prefix(before, s, 0)
        shared.append(h)
        rest.append(s[h:])
        before = s
    pack = lambda x: np.array(x, "<u4").tobytes()
    return pack(shared), pack([len(r) for r in rest]), b"".join(rest)


def front_decode(shared: bytes, lengths: bytes, rests: bytes) -> Iterator[tuple[bytes, int]]:
    """(string, prefix shared with the one before) in order."""
    at, before = 0, b""
    for h, n in zip(np.frombuffer(shared, "<u4").tolist(), np.frombuffer(lengths, "<u4").tolist(), strict=True):
        before = before[:h] + rests[at : at + n]
        at += n
        yield before, h


def merge(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[bytes, int, int]]:
    """(string, prefix shared with the string yielded before, run) of sorted runs, in order.

    A loser tree. For each waiting string the prefix that it shares with the last winner is
    known: of two, the one that shares more comes first and the other's knowledge stays right;
    only strings that share equally much are compared, from there on.
    """
    k = 1 << max(0, (len(runs) - 1).bit_length())
    heads: list[bytes | None] = [None] * k
    known = [0] * k
    for r, run in enumerate(runs):
        heads[r], known[r] = next(run, (None, 0))
        known[r] = 0

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); what the loser shares with the winner is kept in known."""
        x, y = heads[a], heads[b]
        if x is None:
            return b, a
        if y is None:
            return a, b
        h = known[a]
        if h != known[b]:
            return (a, b) if h > known[b] else (b, a)
        h = common_prefix(x, y, h)
        if x[h:] <= y[h:]:
            known[b] = h
            return a, b
        known[a] = h
        return b, a

    losers = [0] * k
    level = list(range(k))
    while len(level) > 1:
        half = len(level) // 2
        pairs = [play(level[2 * i], level[2 * i + 1]) for i in range(half)]
        for i, (_, lost) in enumerate(pairs):
            losers[half + i] = lost
        level = [won for won, _ in pairs]
    won = level[0]
    while heads[won] is not None:
        yield heads[won], known[won], won
        heads[won], known[won] = next(runs[won], (None, 0))
        node = (won + k) >> 1
        while node:
            won, losers[node] = play(won, losers[node])
            node >>= 1


class Suffix:
    """A context in the merge: its bytes, which of them precede the anchor, and its place."""

    __slots__ = ("before", "place", "reach", "right")

    def __init__(self, key: bytes, reach: int, place: tuple):
        self.right, _, self.before = key.partition(SEPARATOR)
        self.reach, self.place = reach, place


def repeated_windows(group: list[Suffix], match: int) -> Iterator[tuple[tuple, int, int]]:
    """(place, start, end) of the spans covered by windows that an earlier place has too.

    group: distinct contexts of one gram. place: (id, content, row, first start, bucket).
    """
    seen: set[bytes] = set()
    for s in sorted(group, key=lambda s: s.place):
        context = s.before + s.right
        # a window with t bytes before the anchor needs match - t shared bytes from it on
        most = min(len(s.before) - (match - min(s.reach, len(s.right))), len(context) - match)
        open_from = open_to = -1
        for j in range(most + 1):
            window = context[j : j + match]
            if window in seen:
                if open_from < 0:
                    open_from = j
                open_to = j + match
            else:
                seen.add(window)
                if open_from >= 0 and j >= open_to:
                    yield s.place, open_from, open_to
                    open_from = -1
        if open_from >= 0:
            yield s.place, open_from, open_to


def _spans(marks: np.ndarray) -> list[tuple[int, int]]:
    """Union of [start, end) pairs."""
    out: list[list[int]] = []
    for s, e in marks[np.argsort(marks[:, 0], kind="stable")].tolist():
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


_GRAMS = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("grams", pa.binary()), ("hot", pa.binary())])
_RUNS = pa.schema(
    [("part", pa.int32()), ("bucket", pa.int32()), ("shared", pa.binary()), ("lengths", pa.binary()), ("rests", pa.binary()),
     ("places", pa.binary()), ("marks", pa.binary())]
)
_MARKS = pa.schema([("bucket", pa.int32()), ("marks", pa.binary())])
#: Bits of a gram hash that are counted; equal ones of unequal grams cost work, not correctness.
_GRAM_BITS = 48


def _pack48(h: np.ndarray) -> bytes:
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack48(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8").astype(_U)


def _places(raw: bytes) -> Iterator[list[int]]:
    """Rows of four integers, some at a time."""
    rows = np.frombuffer(raw, "<i8").reshape(-1, 4)
    for at in range(0, len(rows), 1024):
        yield from rows[at : at + 1024].tolist()


def _texts(table: pa.Table) -> list[bytes]:
    return [x or b"" for x in table.column("_text").cast(pa.binary()).to_pylist()]


def remove_repeats(
    docs: DataFrame,
    finish: Callable[[bytes, list[tuple[int, int]]], dict],
    result_schema: pa.Schema,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
    match: int = MATCH_BYTES,
    gram: int = GRAM_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """A row for each input row: the id, the carried columns and what ``finish`` makes of the
    text's bytes and its removed spans.

    Null texts are empty and lose nothing. Of rows that share an id, the one of the smaller content
    hash counts as earlier; rows without an id count as the last. Texts may be of any length: what is
    hashed at once is bounded. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    parts = max(shuffle_partitions(spark), -(-size // bucket_bytes))
    held = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), *[F.col(c).alias(f"_carry_{c}") for c in carry])
    # rows are named by their content: the same in every branch of the plan and after a lost executor
    content = [F.xxhash64(F.lit(k), *held.columns).alias(n) for k, n in enumerate(("_a", "_b"))]
    labels = even_labels(spark, parts)
    bucket = F.pmod("_a", F.lit(parts)).cast("int")
    if parts <= MAX_LABELS:
        bucket = F.get(F.split(F.lit(",".join(map(str, labels))), ",").cast("array<int>"), bucket)
    dealt = held.select("*", *content).withColumn("bucket", bucket)

    def in_order(table: pa.Table) -> pa.Table:
        """A bucket's rows in an order that depends on their content only; a row's place is its number."""
        return table.sort_by([("_id", "ascending"), ("_a", "ascending"), ("_b", "ascending")])

    def bucket_anchors(texts: list[bytes]) -> Iterator[tuple]:
        for first, at, block, ends in _blocks(texts, match):
            yield first, at, block, ends, *anchors(block, ends, match, gram)

    def count_grams(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        found = [f[4] for f in bucket_anchors(_texts(table))]
        h = np.unique(np.concatenate(found) >> _U(64 - _GRAM_BITS)) if found else np.zeros(0, _U)
        to = (h % _U(parts)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        h, to = h[order], to[order]
        at = np.flatnonzero(np.diff(to, prepend=-1))
        rows = [(labels[int(to[s])], bucket, _pack48(h[s:e]), None) for s, e in zip(at, [*at[1:], len(h)], strict=True)] if len(h) else []
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_GRAMS)], schema=_GRAMS)

    def in_several(table: pa.Table) -> pa.Table:
        rows = [_unpack48(x) for x in table.column("grams").to_pylist()]
        every = np.sort(np.concatenate(rows))
        gram_of, often = np.unique(every, return_counts=True)
        twice, hot = gram_of[often > 1], gram_of[often >= HOT_BUCKETS]
        chosen = lambda of: pa.array([_pack48(r[np.isin(r, of, assume_unique=True)]) for r in rows], pa.binary())
        return pa.Table.from_arrays(
            [table.column("part").combine_chunks(), table.column("bucket").combine_chunks(), chosen(twice), chosen(hot)], schema=_GRAMS
        )

    def sorted_runs(table: pa.Table, common: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _RUNS.empty_table()
        bucket = table.column("bucket")[0].as_py()
        table = in_order(table.select(["_id", "_a", "_b", "_text"]))
        ids = [(1 << 63) - 1 if i is None else i for i in table.column("_id").to_pylist()]
        content = table.column("_a").to_pylist()
        texts = _texts(table)
        del table
        unpacked = lambda name: np.sort(np.concatenate([np.zeros(0, _U), *[_unpack48(x) for x in common.column(name).to_pylist()]]))
        elsewhere, hot = unpacked("grams"), unpacked("hot")
        found = list(bucket_anchors(texts))
        del texts
        every = np.sort(np.concatenate([np.zeros(0, _U), *[f[4] for f in found]]) >> _U(64 - _GRAM_BITS))
        here = np.unique(every[1:][every[1:] == every[:-1]])
        often = np.union1d(elsewhere, here)
        first_at: dict[bytes, tuple] = {}
        marks: list[tuple[int, int, int]] = []
        half = (match - gram) // 2
        found.reverse()
        while found:  # a block goes when its suffixes are taken
            first, at, block, ends, g, x, low, high = found.pop()
            h = g >> _U(64 - _GRAM_BITS)
            keep = np.isin(h, often)
            doc = np.searchsorted(ends, x[keep], side="right")
            begin = np.concatenate([[0], ends])[doc] - at
            for part, split, d, b, a, s, e in zip(
                (h[keep] % _U(parts)).tolist(), np.isin(h[keep], hot).tolist(), doc.tolist(), begin.tolist(), x[keep].tolist(),
                low[keep].tolist(), high[keep].tolist(), strict=True,
            ):
                turns = [(part, s, e)]
                if split:
                    # windows with at most half the rest before the anchor share more bytes behind it, the others before it
                    turn = max(s, a - half)
                    turns = [(crc32(block[a : a + match - half]) % parts, turn, e)] if turn <= e else []
                    if s < turn:
                        turns.append((crc32(block[a - half - 1 : a + gram]) % parts, s, min(e, turn - 1)))
                for to, s, e in turns:
                    key = block[a : e + match] + SEPARATOR + block[s:a]
                    place = (to, ids[first + d], content[first + d], first + d, s - b)
                    if first_at.setdefault(key, place) is not place:
                        marks.append((first + d, s - b, e + match - b))
        # a gram in one bucket only needs no merge beyond it, but takes the same way
        by_part: dict[int, list[bytes]] = {}
        for key in sorted(first_at):
            by_part.setdefault(first_at[key][0], []).append(key)
        out = []
        for part, run in by_part.items():
            places = np.array([first_at.pop(key)[1:] for key in run], "<i8").tobytes()
            out.append((labels[part], bucket, *front_code(run), places, None))
        if marks:
            out.append((labels[bucket % parts], bucket, None, None, None, None, np.array(marks, "<i8").tobytes()))
        return pa.Table.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(_RUNS)], schema=_RUNS)

    def merged(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        runs = [r for r in rows if r["rests"] is not None]
        own = [_places(r["places"]) for r in runs]
        marks: dict[int, list[tuple[int, int, int]]] = {}

        def settle(group: list[Suffix]) -> None:
            if len(group) > 1:
                for (_, _, row, start, bucket), s, e in repeated_windows(group, match):
                    marks.setdefault(bucket, []).append((row, start + s, start + e))

        group: list[Suffix] = []
        before = b""
        for key, shared, run in merge([front_decode(r["shared"], r["lengths"], r["rests"]) for r in runs]):
            place = (*next(own[run]), runs[run]["bucket"])
            if shared == len(key) == len(before):
                last = group[-1]
                late, early = (place, last.place) if place > last.place else (last.place, place)
                last.place = early
                marks.setdefault(late[4], []).append((late[2], late[3], late[3] + len(key) - 1))
                continue
            if shared < gram:
                settle(group)
                group = []
            elif group:
                group[-1].reach = max(group[-1].reach, shared)
            group.append(Suffix(key, shared, place))
            before = key
        settle(group)
        out = [(r["bucket"], r["marks"]) for r in rows if r["marks"] is not None]
        out += [(b, np.array(m, "<i8").tobytes()) for b, m in marks.items()]
        return pa.Table.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(_MARKS)], schema=_MARKS)

    carried = [f for f in to_arrow_schema(dealt.schema) if f.name.startswith("_carry_")]
    out_schema = pa.schema(
        [pa.field(id_col, pa.int64()), *[f.with_name(f.name.removeprefix("_carry_")) for f in carried], *result_schema]
    )

    def cut(table: pa.Table, marked: pa.Table) -> pa.Table:
        spans: dict[int, list[tuple[int, int]]] = {}
        if marked.num_rows and table.num_rows:
            every = np.concatenate([np.frombuffer(m, "<i8").reshape(-1, 3) for m in marked.column("marks").to_pylist()])
            every = every[np.argsort(every[:, 0], kind="stable")]
            at = np.flatnonzero(np.diff(every[:, 0], prepend=-1))
            for s, e in zip(at, [*at[1:], len(every)], strict=True):
                spans[int(every[s, 0])] = _spans(every[s:e, 1:])
        table = in_order(table)
        chunks: list[list[pa.Array]] = [[] for _ in result_schema]
        for at in range(0, table.num_rows, CUT_ROWS):
            found = [finish(t, spans.get(row, [])) for row, t in enumerate(_texts(table.slice(at, CUT_ROWS)), at)]
            for chunk, n in zip(chunks, result_schema, strict=True):
                chunk.append(pa.array([f[n.name] for f in found], n.type))
        columns = [pa.chunked_array(chunk, n.type) for chunk, n in zip(chunks, result_schema, strict=True)]
        return pa.Table.from_arrays([table.column("_id"), *[table.column(f.name) for f in carried], *columns], schema=out_schema)

    # a task for each bucket, however many there are
    dealt = dealt.repartition(parts, "bucket")
    by = lambda df, name: df.repartition(parts, name).groupBy(name)
    grams = dealt.groupBy("bucket").applyInArrow(freeing(count_grams), from_arrow_schema(_GRAMS))
    common = by(grams, "part").applyInArrow(freeing(in_several), from_arrow_schema(_GRAMS))
    runs = dealt.groupBy("bucket").cogroup(by(common, "bucket")).applyInArrow(freeing(sorted_runs), from_arrow_schema(_RUNS))
    marks = by(runs, "part").applyInArrow(freeing(merged), from_arrow_schema(_MARKS))
    return dealt.groupBy("bucket").cogroup(by(marks, "bucket")).applyInArrow(freeing(cut), from_arrow_schema(out_schema))


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for s, e in spans:
        out.append(text[at:s])
        at = e
    return b"".join([*out, text[at:]])


def removal_digests(docs: DataFrame, **options) -> DataFrame:
    """n_bytes, n_removed, n_spans and the SHA-256 of the remaining bytes of every document."""
    import hashlib

    schema = pa.schema([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def finish(text: bytes, spans: list[tuple[int, int]]) -> dict:
        left = kept_bytes(text, spans)
        digest = hashlib.sha256(left).hexdigest()
        return {"n_bytes": len(text), "n_removed": len(text) - len(left), "n_spans": len(spans), "kept_sha256": digest}

    return remove_repeats(docs, finish, schema, **options)
