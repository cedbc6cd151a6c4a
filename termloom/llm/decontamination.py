"""Benchmark decontamination by winnowing.

Of a text's word k-grams (k = 6) the least hash in each window of five consecutive ones is kept. Two texts that share
10 = k + w - 1 consecutive words share such a window and so its kept hash: every shared span of ten words leaves a
fingerprint inside each of its ten-word windows. Fingerprints of documents and of benchmark items are joined, and each is extended
to the up to five ten-word windows that hold it: the join's key is the fingerprint, its place in the window and the window's
words, so words are compared, not hashes, and a fingerprint that many items share meets none but equal windows. Items of fewer than ten words are one window; for
each of the at most nine such lengths that occur, all document n-grams are looked up.

Before documents' fingerprints are written they pass a bit table of ``BITS`` bits made of the items' fingerprints: its
size is fixed; a false hit costs a row, a benchmark too large for it costs a larger join, and neither changes a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import Carried
from termloom.runtime import settle, table

WINDOW = 10
K = 6
KEPT_OF = WINDOW - K + 1
SIDE = WINDOW - K
BITS = 23
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased A-Z, then runs of anything but ASCII outside digits and letters."""
    return (text or b"").translate(_WORDS).split()


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    """A signed 64-bit hash of each n-gram of word hashes; lengths don't mix."""
    m = max(0, len(h) - n + 1)
    g = np.full(m, n, dtype=np.uint64)
    for k in range(n):
        g = (g ^ h[k : k + m]) * _PRIME
        g ^= g >> np.uint64(29)
    return g.view(np.int64)


def winnow(g: np.ndarray) -> np.ndarray:
    """Places of k-gram hashes that are least in some window of ``KEPT_OF``, equals all kept."""
    m = len(g) - KEPT_OF + 1
    if m < 1:
        return np.empty(0, dtype=np.int64)
    least = g[:m].copy()
    for k in range(1, KEPT_OF):
        np.minimum(least, g[k : k + m], out=least)
    keep = np.zeros(len(g), dtype=bool)
    for k in range(KEPT_OF):
        keep[k : k + m] |= g[k : k + m] == least
    return np.flatnonzero(keep)


def _hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), dtype=np.uint64, count=len(words))


def _context(words: list[bytes], at: int, pad: str) -> str:
    """The k-gram at ``at`` and ``SIDE`` words on either side, absent ones as ``pad``."""
    lo, hi = at - SIDE, at + K + SIDE
    own = b" ".join(words[max(0, lo) : hi]).decode("utf-8", "surrogateescape")
    return " ".join([pad] * max(0, -lo) + [own] + [pad] * max(0, hi - len(words)))


_FOUND = pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("around", pa.string())]))
_FOUND_SQL = "array<struct<h: bigint, at: int, n: int, around: string>>"


def _marks(words: list[bytes], pad: str, lengths: list[int], table: np.ndarray | None) -> list[dict]:
    """Fingerprints of one text: kept k-grams with their context (n = 0), and whole n-grams of the given lengths."""
    h = _hashes(words)
    out = []
    for n in (0, *lengths):
        g = _grams(h, n or K)
        at = np.arange(len(g)) if n else winnow(g)
        if table is not None and len(at):
            slot = g[at].view(np.uint64) >> np.uint64(64 - BITS)
            at = at[(table[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        for i in at.tolist():
            around = b" ".join(words[i : i + n]).decode("utf-8", "surrogateescape") if n else _context(words, i, pad)
            out.append({"h": int(g[i]), "at": i, "n": n, "around": around})
    return out


def _marked(pad: str, lengths: list[int] | None, packed: bytes | None):
    """Rows with ``_bytes`` to rows with ``n_words`` and ``found``. For items ``lengths`` is None: each has its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if packed is None else np.frombuffer(packed, dtype=np.uint8)
        for b in batches:
            names = [n for n in b.schema.names if n != "_bytes"]
            counts, found = [], []
            for t in b.column("_bytes"):
                words = words_of(t.as_py())
                counts.append(len(words))
                own = lengths if lengths is not None else [len(words)] * (0 < len(words) < WINDOW)
                found.append(_marks(words, pad, own, bits))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in names), pa.array(counts, pa.int64()), pa.array(found, _FOUND)], [*names, "n_words", "found"]
            )

    return run


def _schema(df: DataFrame) -> str:
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != "_bytes"]
    return ", ".join([*fields, "n_words bigint", f"found {_FOUND_SQL}"])


def item_marks(benchmark: DataFrame) -> DataFrame:
    """(item_id, h, at, n, around) of every item, settled; null texts have none."""
    items = benchmark.select("item_id", F.col("text").cast("binary").alias("_bytes"))
    marked = items.mapInArrow(_marked("\x02", None, None), _schema(items))
    return settle(marked.select("item_id", F.explode("found").alias("f")).select("item_id", "f.*"), "item-marks")


def _bit_table(marks: DataFrame) -> bytes:
    """The bit table as bytes; it is gathered as at most 2 ** (BITS - 6) words of 64 bits, whatever the benchmark."""
    slot = F.shiftrightunsigned("h", 64 - BITS)
    words = marks.select(F.shiftright(slot, 6).alias("w"), F.expr("1L << cast(%s & 63 as int)" % f"shiftrightunsigned(h, {64 - BITS})").alias("b"))
    got = words.groupBy("w").agg(F.bit_or("b").alias("b")).collect()
    out = np.zeros(1 << (BITS - 6), dtype=np.int64)
    for r in got:
        out[r["w"]] = r["b"]
    return out.astype("<i8").tobytes()


def hits(docs: DataFrame, benchmark: DataFrame, *keep: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` as (_rid, keep..., n_words), settled, and (_rid, item, lo, hi): words lo to hi - 1 are an item's window."""
    marks = item_marks(benchmark)
    lengths = sorted(r["n"] for r in marks.select("n").where("n > 0").distinct().collect())  # nine at most
    source = docs.select(F.monotonically_increasing_id().alias("_rid"), *keep, F.col("text").cast("binary").alias("_bytes"))
    marked = settle(source.mapInArrow(_marked("\x01", lengths, _bit_table(marks)), _schema(source)), "document-marks")
    mine = _windows(marked.where(F.size("found") > 0).select("_rid", F.explode("found").alias("f")).select("_rid", "f.*"))
    theirs = _windows(marks)
    key = ["h", "n", "k", "words"]
    spans = settle(mine.join(theirs.select(*key).distinct(), key).select("_rid", *key, "lo", "hi"), "spans")
    owners = theirs.select(*key, F.col("item_id").cast("string").alias("item")).distinct()
    return marked.drop("found"), spans.join(owners, key).select("_rid", "item", "lo", "hi")


def _windows(marks: DataFrame) -> DataFrame:
    """Each mark with every window that holds it: ``k``, its place among them, ``words``, and the window's place ``lo`` to ``hi - 1``."""
    words = F.split("around", " ")
    held = F.array(*(F.array_join(F.slice(words, k + 1, WINDOW), " ") for k in range(KEPT_OF)))
    spread = marks.select("*", F.posexplode(F.when(F.col("n") > 0, F.array("around")).otherwise(held)).alias("k", "words"))
    lo = F.when(F.col("n") > 0, F.col("at")).otherwise(F.col("at") - SIDE + F.col("k"))
    placed = spread.withColumn("lo", lo).withColumn("hi", lo + F.when(F.col("n") > 0, F.col("n")).otherwise(WINDOW))
    return placed.where(~F.col("words").contains("\x01") & ~F.col("words").contains("\x02")).drop("around", "at")


def _covered(spans) -> F.Column:
    """Words inside sorted spans (lo, hi), each once."""
    step = lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["hi"] - F.greatest(s["lo"], a["end"]))).alias("n"), F.greatest(a["end"], s["hi"]).alias("end")
    )
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(spans, start, step, lambda a: a["n"].cast("long"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` of every row with ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``.

    Null and empty texts have no words and no hits; ``items_sha256`` is then the digest of the empty string. Items that are
    null or have no words occur nowhere. Items of equal text all count; an id that occurs twice counts once; a null item id
    makes hits but is not listed. Repeated rows each get a row; empty tables give empty or clean results. A column of ``keep``
    with a result's name gives way to it.
    """
    carried = Carried(docs.select("text", *keep), "text")
    carried.names, carried.held = carried.names[1:], carried.held[1:]
    rows, found = hits(carried.frame, benchmark, *carried.held)
    each = found.groupBy("_rid").agg(
        F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("spans"), F.array_sort(F.collect_set("item")).alias("items")
    )
    met = rows.join(each, "_rid", "left").select(
        *carried.held,
        "n_words",
        F.coalesce(_covered(F.col("spans")), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        F.col("spans").isNotNull().alias("contaminated"),
    )
    return carried.back(met, "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no item's window, columns as given, whatever their names."""
    carried = Carried(docs, "text")
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    keyed = carried.frame.withColumn("_digest", digest)
    dirty = decontaminate(keyed, benchmark, "_digest").where("contaminated").select("_digest").distinct()
    return carried.back(keyed.join(dirty, "_digest", "left_anti"))


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)
), m AS (
  SELECT dw.r, dw.i, dw.n, iw.item FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g
), p AS (
  SELECT r, count(DISTINCT hit) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS hit FROM m) GROUP BY r
), o AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  coalesce(items, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN o USING (r)
"""
