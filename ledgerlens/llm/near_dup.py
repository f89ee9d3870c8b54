"""MinHash near-duplicates with odd sketches.

One Arrow pass over the whole texts makes each document's set of distinct
5-word shingles and from it ``HASHES`` MinHash samples.  Groups of ``ROWS``
samples are the band keys that propose pairs; all samples together are folded
into an odd sketch, a bitmap of ``BITS`` parities, whose XOR population count
estimates high similarities precisely, so most false candidates fall before
any text is touched.  A second bitmap holds the parities of the set itself: two
of them never differ in more bits than their sets in shingles, so pairs of short
and middling texts under the threshold fall for certain and no link does.  What
remains is confirmed on the full shingle sets.

Equal sets are one node from the start.  Pairs come from
:func:`~ledgerlens.llm.common.link_groups`, which never makes the pairs inside
a group of copies and still loses no candidate between different components.
A pair at the threshold shares a band with probability 1 - 5e-7, and its sketch
passes with more than five standard deviations to spare.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import connected_components, documents, link_groups, member_filter, mix, passing, shared_table, text_batches

WORDS = 5
HASHES, ROWS = 512, 5
#: Pairs at the threshold that share no band.
MISSED = 5e-7
BITS = 2048
#: Links: at least this many hundredths of the union shared.
PERCENT = 85
#: The same for the pipeline's stage, whose links begin at a similarity of 0.8.
STAGE_PERCENT = 80
#: Sketches that estimate a similarity under PERCENT / 100 - SLACK propose no pair.  An estimate at the
#: threshold has a standard deviation of 0.0163, so SLACK is 5.2 of them: as rare a miss as that of the bands.
#: At another threshold it grows with the standard deviation.
SLACK = 0.085

#: Of all word hashes.
SEED = 0x5BD1E9955BD1E995
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts and the n + 1 borders between texts; ``fold`` lower-cases A-Z."""
    if fold:
        data = np.where((data >= 0x41) & (data <= 0x5A), data + 32, data).astype(np.uint8)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    begins[first] = inside[first]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    stops[last] = inside[last]
    at, to = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    if not len(at):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    # Words and what stands between them as one array without gaps; the words are its even places.
    borders = np.empty(2 * len(at) + 1, np.int64)
    borders[0:-1:2], borders[1::2], borders[-1] = at, to, to[-1]
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), 2 * len(at), [None, pa.py_buffer(borders), pa.py_buffer(np.ascontiguousarray(data))])
    coded = pieces.take(pa.array(np.arange(0, 2 * len(at), 2))).dictionary_encode()
    # Each distinct word is hashed by its bytes, with a seed; no arithmetic relation between words survives it.
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.as_buffer(), SEED) for w in coded.dictionary), np.uint64, len(coded.dictionary))
    return hashes[coded.indices.to_numpy()], np.searchsorted(at, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text back to back, and the n + 1 borders."""
    words, borders = word_hashes(data, offsets)
    scale = [mix(np.array([j + 1], np.uint64))[0] | np.uint64(1) for j in range(WORDS)]
    n = max(len(words) - WORDS + 1, 0)
    windows = np.zeros(n, np.uint64)
    for j in range(WORDS):
        windows += words[j: j + n] * scale[j]
    windows = mix(windows)
    sets = []
    for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
        if b - a >= WORDS:
            sets.append(np.unique(windows[a: b - WORDS + 1]))
        elif b > a:  # fewer words: the whole sequence, told apart from longer ones by its length
            short = words[a:b] * np.array(scale[: b - a], np.uint64)
            sets.append(mix(short.sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a)))
        else:
            sets.append(np.empty(0, np.uint64))
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), np.concatenate(([0], np.cumsum(sizes)))


def _samples(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash samples (HASHES x sets) of non-empty sets that begin at ``starts``."""
    random = np.random.default_rng(20240229)
    factors = random.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = random.integers(0, 1 << 63, HASHES, dtype=np.uint64)
    out = np.empty((HASHES, len(starts)), np.uint64)
    one = np.empty_like(values)
    for k in range(HASHES):
        np.multiply(values, factors[k], out=one)
        np.bitwise_xor(one, shifts[k], out=one)
        out[k] = np.minimum.reduceat(one, starts)
    return out


def _odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps (sets x BITS / 64, int64): each sample flips the bit that its hash names."""
    place = mix(samples + np.arange(HASHES, dtype=np.uint64)[:, None] * np.uint64(0xA24BAED4963EE407)) % np.uint64(BITS)
    sets = samples.shape[1]
    return _parities(np.arange(sets) * BITS + place.astype(np.int64), sets)


def _parities(flipped: np.ndarray, sets: int) -> np.ndarray:
    """Bitmaps (sets x BITS / 64, int64) of how often, odd or even, each bit is flipped."""
    flips = np.bincount(flipped.ravel(), minlength=sets * BITS) & 1
    return np.packbits(flips.astype(np.uint8).reshape(sets, BITS), axis=1, bitorder="little").view("<i8")


def _lists(values: np.ndarray) -> pa.ListArray:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(values).ravel().view(np.int64)))


def band_count(percent: float = PERCENT) -> int:
    """Bands of ``ROWS`` samples that a pair at ``percent`` misses with probability ``MISSED`` at most."""
    return int(np.ceil(np.log(MISSED) / np.log1p(-(percent / 100) ** ROWS)))


def sketches(docs: DataFrame, count: int) -> DataFrame:
    """doc_id, n_shingles, set_a and set_b (128 bits that stand for the set), bands and sketch (null for an empty set).

    ``sketch``: the odd sketch of the samples, the parities of the whole set and n_shingles.
    """
    kind = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_batches(batches, limit=4 << 20):
            values, borders = shingle_sets(data, offsets)
            sizes = np.diff(borders)
            full = np.flatnonzero(sizes)
            out = {"set_a": np.zeros(len(sizes), np.uint64), "set_b": np.zeros(len(sizes), np.uint64)}
            bands, odd = np.zeros((len(sizes), count), np.uint64), np.zeros((len(sizes), 2 * (BITS // 64) + 1), np.int64)
            if len(full):
                starts = borders[:-1][full]
                out["set_a"][full] = np.add.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), starts)
                out["set_b"][full] = np.add.reduceat(mix(values + np.uint64(0x14057B7EF767814F)), starts)
                samples = _samples(values, starts)
                for band in range(count):
                    key = np.full(len(full), band + 1, np.uint64)
                    for k in range(band * ROWS, band * ROWS + ROWS):
                        key = mix(key ^ samples[k])
                    bands[full, band] = key
                odd[full, :BITS // 64] = _odd_sketch(samples)
                of = np.repeat(np.arange(len(full)), sizes[full])
                odd[full, BITS // 64: -1] = _parities(of * BITS + (values % np.uint64(BITS)).astype(np.int64), len(full))
                odd[full, -1] = sizes[full]
            none = pa.array(sizes == 0)
            lists = [pc.if_else(none, pa.scalar(None, pa.list_(pa.int64())), _lists(x)) for x in (bands, odd)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(out["set_a"].view(np.int64)), pa.array(out["set_b"].view(np.int64)), *lists],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, kind)


def _full_sets(docs: DataFrame, wanted: Callable[[], np.ndarray]) -> DataFrame:
    """doc_id and the full set of shingle hashes, of documents that have one and that the filter ``wanted`` lets pass.

    The filter has a fixed size and is broadcast, so no text is shuffled; the few documents that it lets pass
    for nothing only cost their sets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted()
        present = (b.filter(pc.is_valid(b.column("doc_id"))) for b in batches)
        some = (b.filter(pa.array(passing(bits, mix(b.column("doc_id").to_numpy().view(np.uint64))))) for b in present)
        for rows, data, offsets in text_batches(some):
            values, borders = shingle_sets(data, offsets)
            lists = pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), lists], ["doc_id", "shingles"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, shingles array<long>").where("size(shingles) > 0")


def max_flips(percent: float = PERCENT) -> int:
    """XOR population count that stands for a similarity of ``percent`` / 100 less the slack."""
    slack = SLACK * np.sqrt(percent * (100 - percent) / (PERCENT * (100 - PERCENT)))
    apart = 2 * HASHES * (1 - max(percent / 100 - slack, 0))
    return int(np.ceil(BITS / 2 * (1 - np.exp(-2 * apart / BITS))))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Components of documents linked by 100 * intersection >= ``percent`` * union of their shingle sets.

    Takes doc_id and text and returns doc_id, n_shingles, component_id (the
    smallest doc_id reachable) and kept (doc_id = component_id).  Null or
    empty texts have no shingles and no links.  Rows with the same doc_id are
    one document with several texts: each row is returned and all share its
    links.  A null doc_id is never linked: its component is null and it is
    kept.  Other columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    found = shared_table(sketches(docs, band_count(percent)), "sketches")
    known = found.where("n_shingles > 0 and doc_id is not null")
    groups = shared_table(known.groupBy("n_shingles", "set_a", "set_b").agg(F.min("doc_id").alias("node")), "sets")
    # Rows of one doc_id with several texts stand in the groups of all of them.
    same = known.join(groups, ["n_shingles", "set_a", "set_b"])
    nodes = shared_table(same.where("doc_id = node").groupBy("node", "n_shingles", "set_a", "set_b")
                         .agg(F.min("bands").alias("keys"), F.min("sketch").alias("sig")).drop("n_shingles", "set_a", "set_b"), "nodes")
    limit = max_flips(percent)

    def near(a: str, b: str) -> Column:
        def apart(first: int) -> Column:
            return sum((F.bit_count(F.get(F.col(a), F.lit(i)).bitwiseXOR(F.get(F.col(b), F.lit(i)))) for i in range(first, first + BITS // 64)), F.lit(0))

        # Linked sets differ in so many shingles at most, and their parities in no more bits.
        last = F.lit(2 * (BITS // 64))
        sizes = F.get(F.col(a), last) + F.get(F.col(b), last)
        return (apart(0) <= limit) & ((100 + percent) * apart(BITS // 64) <= (100 - percent) * sizes)

    made: list[DataFrame] = []

    def verify(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
        if not made:
            made.append(shared_table(_full_sets(docs, member_filter(candidates.select("node"))), "full-sets"))
        left = made[0].select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
        right = made[0].select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
        common = F.size(F.array_intersect("sa", "sb")).cast("long")
        both = (pairs.join(left, "a").join(right, "b")
                .select("a", "b", common.alias("c"), (F.size("sa").cast("long") + F.size("sb")).alias("s")))
        return both.where(100 * F.col("c") >= percent * (F.col("s") - F.col("c"))).select("a", "b").distinct()

    linked = link_groups(nodes, near, verify)
    # The links of equal sets (row to its group's node) and, for a doc_id with several texts, between its groups.
    several = same.where("doc_id <> node").groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("n"))
    row = found.join(groups, ["n_shingles", "set_a", "set_b"], "left").join(linked, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")).alias("_c"))
    row = row.select("doc_id", "n_shingles", F.coalesce("_c", "doc_id").alias("component_id"))
    clash = several.where("lo <> hi")
    if not clash.isEmpty():
        own = shared_table(row.where("doc_id is not null").select(F.col("doc_id").alias("a"), F.col("component_id").alias("b")).distinct(), "own")
        merged = connected_components(own)
        row = row.join(merged, row["component_id"] == merged["node"], "left").select(
            "doc_id", "n_shingles", F.coalesce("component", "component_id").alias("component_id"))
    return row.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(documents(spark, sf_dir), PERCENT)


def keep_one(docs: DataFrame, percent: int = STAGE_PERCENT) -> DataFrame:
    """``docs`` with one document (the smallest doc_id, its rows once) of each component; documents without words stay."""
    kept = near_duplicates(docs, percent).where("kept").select(F.col("doc_id").alias("_id")).distinct()
    columns = docs.columns
    one = docs.where("doc_id is not null").dropDuplicates(["doc_id", "text"])
    return one.join(kept, one["doc_id"] == kept["_id"], "left_semi").select(columns).unionByName(docs.where("doc_id is null"))
