"""Benchmark decontamination by a broadcast hash set of normalised test n-grams.

Texts are lower-cased (A-Z) and cut into runs of digits, ASCII letters and
characters beyond ASCII.  Every run of :data:`WINDOW` words of a benchmark item
is a window; an item with fewer words is one window of its own length.  The
distinct windows, keyed by a 64-bit hash, are broadcast; each document hashes
its runs of words, and where a hash is known the words themselves are compared,
so a hash alone never marks anything.  Words inside a found window are hit and
can be removed, or the document with them.

The windows' size is measured first: a set beyond :data:`BROADCAST_BYTES` is
dealt into blocks by hash and the documents are scanned once for each block,
so no broadcast outgrows the bound however large the benchmark is.
Found windows are gathered by the text's SHA-256, so copies of one text share
their findings and neither ids nor nulls form a group.

Main path: DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, let, shared_table

WINDOW = 10
#: Measured size up to which windows are broadcast at once.
BROADCAST_BYTES = 48 << 20

_OUTSIDE = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_UPPER = range(0x41, 0x5B)
_FROM = "".join(map(chr, [*_OUTSIDE, *_UPPER]))
_TO = " " * len(_OUTSIDE) + "".join(chr(c + 32) for c in _UPPER)
#: One word with all that stands before it, and what follows the last word (Java regular expressions).
_PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TAIL = r"([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)\z"


def normal_words(text: Column) -> Column:
    """Lower-cased words of ``text``; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _FROM, _TO), " "), "")


def _digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def test_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct windows of all items: ``hash``, ``n`` (words), ``window`` (joined by spaces), ``items`` (ids as strings)."""
    items = benchmark.select(F.col(item).cast("string").alias("item"), normal_words(F.col(text)).alias("words")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - size, F.lit(0))
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, size))
    windows = items.select("item", F.explode(runs).alias("run"))
    return windows.groupBy("run").agg(F.collect_set("item").alias("items")).select(
        F.xxhash64("run").alias("hash"), F.size("run").alias("n"), F.array_join("run", " ").alias("window"), "items")


def find_windows(docs: DataFrame, windows: DataFrame, text: str = "text") -> DataFrame:
    """``digest`` of each text with a hit, ``hits`` (sorted places of its hit words, from 0) and ``items`` (sorted ids)."""
    windows = shared_table(windows, "windows")
    size = windows.agg(F.sum(64 + F.octet_length("window") + F.aggregate("items", F.lit(0), lambda a, x: a + 16 + F.octet_length(x))).alias("bytes"),
                       F.array_sort(F.collect_set("n")).alias("lengths")).first()
    lengths, blocks = size["lengths"], -(-(size["bytes"] or 0) // BROADCAST_BYTES)
    words = docs.select(_digest(F.col(text)).alias("digest"), normal_words(F.col(text)).alias("words"))

    def hashes(n: int) -> Column:
        runs = F.sequence(F.lit(1), F.size("words") - n + 1)
        return F.when(F.size("words") >= n, F.transform(runs, lambda i: F.xxhash64(F.slice("words", i, n))))

    empty = docs.sparkSession.createDataFrame([], "digest string, hits array<int>, items array<string>")
    if not lengths:
        return empty
    hashed = words.select("digest", "words", F.array(*[hashes(n) for n in lengths]).alias("by_length"))
    # One generator for the lengths that occur (at most WINDOW of them) and one for the places.  They are outer ones:
    # from others the optimizer infers a filter on the array's size, which would compute all hashes once more.
    placed = hashed.select("digest", "words", F.posexplode_outer("by_length").alias("k", "hashes")).select(
        "digest", "words", F.get(F.array(*map(F.lit, lengths)), F.col("k")).alias("n"), F.posexplode_outer("hashes").alias("at", "hash"))
    seen = F.array_join(F.slice("words", F.col("at") + 1, F.col("n")), " ")
    found = []
    for block in range(blocks):
        part = windows.where(F.pmod("hash", F.lit(blocks)) == block) if blocks > 1 else windows
        part = F.broadcast(part.withColumnsRenamed({"hash": "test_hash", "n": "test_n"}))
        match = (F.col("hash") == F.col("test_hash")) & (F.col("n") == F.col("test_n")) & (seen == F.col("window"))
        found.append(placed.join(part, match).select("digest", "at", "n", "items"))
    runs = reduce(DataFrame.unionByName, found).groupBy("digest").agg(F.collect_set(F.struct("at", "n")).alias("runs"), F.collect_set("items").alias("items"))
    inside = F.flatten(F.transform("runs", lambda r: F.sequence(r["at"], r["at"] + r["n"] - 1)))
    return runs.select("digest", F.array_sort(F.array_distinct(inside)).alias("hits"), F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", size: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """One row for each row of ``docs``: ``row`` (its columns ``keep``, or all), ``n_words``, ``hits`` (places) and ``items``.

    A null or empty text has no words and no hits; so has every text if the
    benchmark is empty or has no words.  Repeated rows are each returned.
    Items of one id count once; an item without an id marks words but is not
    named.  Columns of any name pass through inside ``row``.
    """
    # As a table of its own the findings have a known size, and their join with the documents can split a hot text.
    found = shared_table(find_windows(docs, test_windows(benchmark, item, text, size), text), "hits")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), _digest(F.col(text)).alias("digest"), F.size(normal_words(F.col(text))).alias("n_words"))
    return rows.join(found, "digest", "left").select(
        "row", F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("hits", F.array().cast("array<int>")).alias("hits"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def remove(docs: DataFrame, benchmark: DataFrame, whole: bool = False, text: str = "text", item: str = "item_id", size: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents (``whole``), or with the hit words and what stands before each cut out.

    Rows without a hit, null texts among them, come back as they are.
    """
    seen = scan(docs, benchmark, text, item, size)
    if whole:
        return seen.where(F.size("hits") == 0).select("row.*")

    def kept(hits: Column) -> Column:
        pieces = F.regexp_extract_all(F.col(f"row.`{text}`"), F.lit(_PIECE), 0)
        # Runs of words between two hits, as slices: linear in the words of the text.
        ends = F.concat(hits, F.array(F.col("n_words").cast("int")))
        gaps = F.transform(ends, lambda e, i: F.struct(F.when(i > 0, F.get(hits, i - 1) + 1).otherwise(0).alias("from"), e.alias("to")))
        return let(pieces, lambda p: F.flatten(F.transform(F.filter(gaps, lambda g: g["from"] < g["to"]),
                                                           lambda g: F.slice(p, g["from"] + 1, g["to"] - g["from"]))))

    clean = F.concat(F.array_join(kept(F.col("hits")), ""), F.regexp_extract(F.col(f"row.`{text}`"), _TAIL, 1))
    shown = F.when(F.size("hits") == 0, F.col(f"row.`{text}`")).otherwise(clean)
    return seen.select(*[shown.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of ``benchmark`` occurs in each text of ``documents``."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    seen = scan(documents(spark, sf_dir), benchmark, keep=["doc_id"])
    return seen.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
t AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM p),
s AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM t) WHERE len(w) >= n),
h AS (SELECT s.r, s.i, s.n, t.item_id FROM s JOIN t ON t.n = s.n AND t.g = array_to_string(s.w[s.i : s.i + s.n - 1], ' ')),
c AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS x FROM h) GROUP BY r),
m AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN m USING (r)
"""
