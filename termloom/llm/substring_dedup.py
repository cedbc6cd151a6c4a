"""Substring dedup by sliding sentence spans.

A text is cut into sentences after words with an end mark and at line ends. A long sentence, and what two texts run together
without an end mark, is cut further after words whose hash is divisible by ``CUT``, but for the ``GAP`` words next to either end; so
a passage is cut alike wherever it stands, save for a few words at its edges. Every run of ``SPAN`` consecutive sentences, or of
as many more as make ``LEAST`` words, is hashed (lower-cased A-Z, white space made one space); a run's first place is the one in the
row of least id, earliest in the text. Runs are the same if 96 bits of hash are: of 10^12 runs some 10^-5 pairs agree by chance. Sentences covered by any other place of a run are removed. Each removed sentence has
an equal one at an earlier place, so some copy always stays.

Of each run a task hands on its first place among some thousand rows; its other places there are removed whatever comes from
other tasks, so a hot run has no more places than there are such groups of rows. Places travel packed, a few bytes each, and
meet by ranges of hashes; only those that have an earlier one become rows again. Text is shuffled once, to meet its removals.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.common import Carried, row_key
from termloom.runtime import settle, table

SPAN = 4
LEAST = 15
CUT = 4
GAP = 2
#: Runs that a task holds before it hands them on.
HELD = 500_000
#: Hashes meet by so many ranges, a power of two.
BUCKETS = 1024
#: Words whose kind a worker remembers.
REMEMBERED = 500_000
_MARKS = (b".", b"!", b"?", "。".encode())
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_MIX, _MIX_MORE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Kinds(dict):
    """Word to 2 if it ends a sentence, 1 if a long one may be cut after it, else 0."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        kind = 2 if word.endswith(_MARKS) else int(xxhash.xxh32_intdigest(word) % CUT == 0)
        self[word] = kind
        return kind


_KINDS = _Kinds()


def sentences(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """The lower-cased words, and where sentences begin among them, with the number of words at the end."""
    words: list[bytes] = []
    lines = [0]
    for line in text.lower().split(b"\n"):
        words += line.split()
        lines.append(len(words))
    n = len(words)
    if not n:
        return words, np.zeros(1, dtype=np.int64)
    kind = np.fromiter(map(_KINDS.__getitem__, words), dtype=np.int8, count=n)
    ends = kind == 2
    ends[np.array(lines[1:], dtype=np.int64)[np.diff(lines) > 0] - 1] = True
    ends[-1] = True
    at = np.arange(n)
    before = np.maximum.accumulate(np.where(ends, at, -1))  # the last end at or before each word
    after = np.minimum.accumulate(np.where(ends, at, n)[::-1])[::-1]
    cuts = ends | ((kind == 1) & (at - before > GAP) & (after - at >= GAP))
    return words, np.concatenate(([0], np.flatnonzero(cuts) + 1))


def runs(words: list[bytes], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, 32 more bits of hash, first sentence and number of sentences of each run."""
    m = len(starts) - 1
    empty = np.empty(0, dtype=np.int64)
    if m < SPAN:
        return empty, empty.astype(np.uint32), empty, empty
    cuts = starts.tolist()
    digest = xxhash.xxh64_intdigest
    own = np.fromiter((digest(b" ".join(words[a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)), dtype=np.uint64, count=m)
    first = np.arange(m - SPAN + 1)
    h, more = np.zeros(len(first), dtype=np.uint64), np.zeros(len(first), dtype=np.uint64)

    def add(at: np.ndarray | slice, sentence: np.ndarray) -> None:
        for mixed, by in ((h, _MIX), (more, _MIX_MORE)):
            x = (mixed[at] ^ own[sentence]) * by
            mixed[at] = x ^ (x >> np.uint64(29))

    for k in range(SPAN):
        add(slice(None), first + k)
    size = np.full(len(first), SPAN)
    while True:
        short = np.flatnonzero((starts[np.minimum(first + size, m)] - starts[first] < LEAST) & (first + size <= m))
        if not len(short):
            break
        longer = short[first[short] + size[short] < m]
        add(longer, first[longer] + size[longer])
        size[short] += 1  # beyond the text's end: no run
    whole = first + size <= m
    return h[whole].view(np.int64), (more[whole] >> np.uint64(32)).astype(np.uint32), first[whole], size[whole]


_PLACES = pa.struct([("i", pa.int32()), ("n", pa.int32())])
_MARKED = pa.schema(
    [("rid", pa.int64()), ("doc_id", pa.int64()), ("_k", pa.string()), ("again", pa.list_(_PLACES))]
    + [("bucket", pa.int32()), ("base", pa.int64()), ("size", pa.int32()), ("packed", pa.binary())]
)
_LATER = pa.schema([("rid", pa.int64()), ("i", pa.int32()), ("n", pa.int32())])


def pack(h: np.ndarray, ids: np.ndarray, *rest: np.ndarray) -> bytes:
    """Ascending hashes, another column of 64 bits and four of 32: differences, bytes of equal weight side by side, zstd."""
    columns = (np.diff(h, prepend=np.uint64(0)), ids.astype(np.int64), *(x.astype(np.uint32) for x in rest))
    return pa.compress(b"".join(x.view(np.uint8).reshape(len(x), -1).T.tobytes() for x in columns), codec="zstd", asbytes=True)


def unpack(packed: bytes, size: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(packed, decompressed_size=32 * size, codec="zstd", asbytes=True), dtype=np.uint8)
    h, ids = (np.ascontiguousarray(x.T).view(np.uint64).ravel() for x in raw[: 16 * size].reshape(2, 8, size))
    rest = (np.ascontiguousarray(x.T).view(np.uint32).ravel() for x in raw[16 * size :].reshape(4, 4, size))
    return [np.cumsum(h, dtype=np.uint64), ids.view(np.int64), *rest]


def _combined(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Of (rid, doc_id, key, runs) one record a row with the places that have an earlier one here, one a bucket with the other places."""
    rid, ids, keys, found = zip(*rows, strict=True)
    rid, doc_id = np.array(rid, dtype=np.int64), np.array([x or 0 for x in ids], dtype=np.int64)
    last = np.array([x is None for x in ids])
    order = np.lexsort((rid, doc_id, last))
    h, more, i, n = (np.concatenate([found[k][c] for k in order]) for c in range(4))
    row = np.repeat(order, [len(found[k][0]) for k in order])
    by = np.argsort(h.view(np.uint64), kind="stable")
    h, more, row, i, n = h.view(np.uint64)[by], more[by], row[by], i[by], n[by]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (more[1:] != more[:-1])  # equal runs that others part here meet in their bucket
    again = np.flatnonzero(~new)
    again = again[np.argsort(row[again], kind="stable")]
    offsets = np.concatenate(([0], np.cumsum(np.bincount(row[again], minlength=len(rid))))).astype(np.int32)
    places = pa.StructArray.from_arrays([pa.array(x[again].astype(np.int32)) for x in (i, n)], fields=list(_PLACES))
    own = [pa.array(rid), pa.array(ids, pa.int64()), pa.array(keys, pa.string()), pa.ListArray.from_arrays(pa.array(offsets), places)]
    yield pa.RecordBatch.from_arrays([*own, *(pa.nulls(len(rid), f.type) for f in list(_MARKED)[4:])], schema=_MARKED)
    if not len(h):
        return
    base = int(rid.min())
    h, more, row, i, n = h[new], more[new], row[new], i[new], n[new]
    at = rid[row] - base
    ids, at = doc_id[row] - at, 2 * at + last[row]  # ids in the order of rows become one value; a row without id is odd
    bucket = (h // np.uint64((1 << 64) // BUCKETS)).astype(np.int32)
    edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(h)]
    spans = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    packed = [
        pa.array(bucket[edges[:-1]]),
        pa.array([base] * len(spans), pa.int64()),
        pa.array([x.stop - x.start for x in spans], pa.int32()),
        pa.array([pack(h[x], ids[x], at[x], i[x], n[x], more[x]) for x in spans], pa.binary()),
    ]
    yield pa.RecordBatch.from_arrays([*(pa.nulls(len(spans), f.type) for f in list(_MARKED)[:4]), *packed], schema=_MARKED)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for b in batches:
        for rid, doc_id, key, text in zip(*(b.column(c) for c in ("rid", "doc_id", "_k", "_bytes")), strict=True):
            found = runs(*sentences(text.as_py() or b""))
            held.append((rid.as_py(), doc_id.as_py(), key.as_py(), found))
            size += len(found[0]) + 1
            if size >= HELD:
                yield from _combined(held)
                held, size = [], 0
    if held:
        yield from _combined(held)


def _meet(bucket: pa.Table) -> pa.Table:
    """The places of a bucket whose hash has an earlier one in it."""
    parts = []
    for base, size, packed in zip(*(bucket.column(c).to_pylist() for c in ("base", "size", "packed")), strict=True):
        h, ids, at, i, n, more = unpack(packed, size)
        row = (at >> 1).astype(np.int64)
        parts.append((h, (at & 1).astype(bool), ids + row, row + base, i, n, more))
    h, last, ids, rid, i, n, more = (np.concatenate(x) for x in zip(*parts, strict=True))
    by = np.argsort(h, kind="stable")
    same = h[by][1:] == h[by][:-1]
    by = by[np.concatenate((same, [False])) | np.concatenate(([False], same))]
    by = by[np.lexsort((rid[by], ids[by], last[by], more[by], h[by]))]
    later = by[1:][(h[by][1:] == h[by][:-1]) & (more[by][1:] == more[by][:-1])]
    return pa.table([rid[later], i[later].astype(np.int32), n[later].astype(np.int32)], schema=_LATER)


def cut(text: bytes, places: list[dict] | None) -> tuple[bytes, int, int, int, int]:
    """The text without the sentences of the runs at ``places`` (all runs if None); sentences and words, in all and removed.

    A sentence goes with the white space after it.
    """
    words, starts = sentences(text)
    gone = np.zeros(len(starts) - 1, dtype=bool)
    if places is None:
        _, _, first, size = runs(words, starts)
        places = [{"i": i, "n": n} for i, n in zip(first.tolist(), size.tolist(), strict=True)]
    for p in places:
        gone[p["i"] : p["i"] + p["n"]] = True
    if not gone.any():
        return text, len(gone), 0, len(words), 0
    at = [m.start() for m in _WORD.finditer(text)]
    edges = [0, *(at[s] for s in starts[1:-1].tolist()), len(text)]
    stay = b"".join(text[a:b] for a, b, g in zip(edges[:-1], edges[1:], gone.tolist(), strict=True) if not g)
    return stay, len(gone), int(gone.sum()), len(words), int(np.diff(starts)[gone].sum())


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        names = [n for n in b.schema.names if n not in ("_bytes", "_places", "_turn")]
        rows = zip(b.column("_bytes"), b.column("_places"), b.column("_turn"), strict=True)
        out = []
        for text, places, turn in rows:
            out.append(cut(text.as_py() or b"", (places.as_py() or []) if turn.as_py() == 1 else None))
        stay, n, removed, words, words_removed = zip(*out, strict=True) if out else ((),) * 5
        made = [pa.array([s.decode("utf-8", "replace") for s in stay], pa.string()), *(pa.array(x, pa.int64()) for x in (n, removed, words, words_removed))]
        yield pa.RecordBatch.from_arrays([*(b.column(x) for x in names), *made], [*names, *MADE])


MADE = ("text", "n_sentences", "n_removed", "n_words", "n_words_removed")


def removals(docs: DataFrame) -> DataFrame:
    """(_k, _places): for each row key the places of its runs that have an earlier one."""
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError(f"doc_id must be a whole number, not {docs.schema['doc_id'].dataType.simpleString()}")
    source = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "_k", F.col("text").cast("binary").alias("_bytes")
    )
    schema = "rid long, doc_id long, _k string, again array<struct<i: int, n: int>>, bucket int, base long, size int, packed binary"
    marked = settle(source.mapInArrow(_mark, schema), "runs")
    rows = marked.where("rid IS NOT NULL")
    packed = marked.where("bucket IS NOT NULL").select("bucket", "base", "size", "packed")
    later = packed.groupBy("bucket").applyInArrow(_meet, "rid long, i int, n int")
    every = later.union(rows.select("rid", F.explode("again").alias("f")).select("rid", "f.i", "f.n"))
    lists = every.groupBy("rid").agg(F.collect_list(F.struct("i", "n")).alias("_places"))
    keyed = rows.select("rid", "_k").join(lists, "rid", "left")
    # of rows equal in id and text the first has the list; the others lose all their runs, see dedup_substrings
    return keyed.groupBy("_k").agg(F.min_by("_places", "rid").alias("_places"))


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """Every row with ``text`` without its repeated sentences, and ``n_sentences``, ``n_removed``, ``n_words``,
    ``n_words_removed``.

    ``doc_id`` is a whole number of any width; another type is refused. Null text comes back empty, with no sentences; rows without ids come after all others in the order of first places. Of rows
    equal in id and text one counts as first, the others lose every sentence of a run. Texts of fewer than ``SPAN``
    sentences have no runs and stay. Empty tables give empty tables; extra columns pass through, those with a result's name
    give way to it.
    """
    carried = Carried(docs, "doc_id", "text")
    keyed = carried.frame.withColumn("_k", row_key(F.col("doc_id"), F.col("text")))
    turn = F.row_number().over(Window.partitionBy("_k").orderBy(F.lit(0)))
    own = {m.lower() for m in MADE}
    held = [h for h, n in zip(carried.held, carried.names, strict=True) if n.lower() not in own]
    met = (
        keyed.withColumn("_turn", turn)
        .join(removals(keyed), "_k", "left")
        .select(*held, F.col("text").cast("binary").alias("_bytes"), "_places", "_turn")
    )
    made = [T.StructField("text", T.StringType()), *(T.StructField(c, T.LongType()) for c in MADE[1:])]
    schema = T.StructType([*(f for f in met.schema if f.name in held), *made])
    return carried.back(met.mapInArrow(_cut, schema), *MADE)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
