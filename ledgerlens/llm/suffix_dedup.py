"""Repeated 400-byte strings by merging Burrows-Wheeler transforms of shards.

Bytes of a text go if a string of ``LENGTH`` bytes covers them that also starts
anywhere else.  Two equal strings have the same smallest 32-byte hash, so a
text is cut into *runs*, stretches of string starts with one such anchor, and
only runs with the same anchor can share a string.  Runs with an anchor of
their own are done; equal runs of one anchor repeat as a whole and stand as
one; a group of copies of any size so comes down to its distinct runs.

The distinct runs of an anchor are compared by suffixes, of the places only that
a repeated string may hold: all its symbols occur twice.  In a task, runs form
two shards.  Each shard's suffixes are sorted on their own and give its
transform: for each suffix in order, the symbol before it.  A symbol is a
stretch of ``STRIDE`` bytes.  The transforms are then merged without sorting
suffixes again: the interleave of the two shards starts arbitrary and is
refined by one symbol per round, by moving every place stably to the bucket of
the symbol before it.  After h rounds the places whose suffixes share h symbols
form one block, so the blocks of LENGTH / STRIDE rounds are the intervals with
a common prefix of ``LENGTH`` bytes, and those with two or more places are the
repeats.  Anchors with very many distinct runs are salted over tasks; the
strings that a task has found distinct then meet once more by their hash.

Anchors and symbols are named by polynomial hashes of 32 and 20 bytes, too short
for such a polynomial's blind spots.  Whole runs are told apart by a seeded hash
of their bytes, and strings across tasks by their symbols' hashes, each mixed
with its place, since a polynomial over hundreds of bytes can be fooled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, mix, shared_table, text_batches

LENGTH, GRAM, STRIDE = 400, 32, 20
#: Distinct runs of an anchor in one task, and bytes merged at once (one larger anchor may exceed them).
PER_SALT, MERGED = 4096, 1 << 17

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Of the hashes of whole runs.
SEED = 0x27D4EB2F165667C5


class _Rolling:
    """Hashes of any stretch of a byte string from prefix sums of a polynomial modulo 2^64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power, inverse = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, _INVERSE, np.uint64)
        power[0] = inverse[0] = 1
        self.inverse = np.cumprod(inverse, dtype=np.uint64)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(data.astype(np.uint64) + np.uint64(1)) * np.cumprod(power, dtype=np.uint64)[:-1], dtype=np.uint64, out=self.total[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.total[stop] - self.total[start]) * self.inverse[start])

    def all(self, width: int) -> np.ndarray:
        """Of every stretch of ``width`` bytes."""
        n = len(self.total) - width
        return mix((self.total[width:] - self.total[:n]) * self.inverse[:n]) if n > 0 else np.empty(0, np.uint64)


def _slide(values: np.ndarray, width: int, op: np.ufunc, pad: int) -> np.ndarray:
    """``op`` (minimum or maximum) over each ``width`` values in a row, by prefix and suffix scans of blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.uint64(pad))
    padded[:n] = values
    table = padded.reshape(blocks, width)
    ahead = op.accumulate(table, axis=1).ravel()
    back = op.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[: n - width + 1], ahead[width - 1: n])


def runs_of(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor, start, windows, content, inner) of the runs of one text; ``inner``: the anchor occurs twice in the run."""
    if len(data) < LENGTH:
        return tuple(np.empty(0, t) for t in (np.uint64, np.int64, np.int64, np.uint64, bool))
    rolling, width = _Rolling(data), LENGTH - GRAM + 1
    grams = rolling.all(GRAM)
    low = _slide(grams, width, np.minimum, (1 << 64) - 1)
    start = np.concatenate(([0], np.flatnonzero(low[1:] != low[:-1]) + 1))
    windows = np.diff(np.append(start, len(low)))
    around = np.concatenate((np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)))
    at = np.flatnonzero(_slide(around, width, np.maximum, 0) == grams)  # the places of anchors
    same = np.flatnonzero(grams[at[1:]] == grams[at[:-1]])
    inner = np.zeros(len(start), bool)
    for first, second in zip(at[same].tolist(), at[same + 1].tolist(), strict=True):
        a, b = np.searchsorted(start, [second - width + 1, first + 1])
        a = max(a - 1, 0)
        hit = np.arange(a, b)
        hit = hit[(low[start[hit]] == grams[first]) & (start[hit] <= first) & (start[hit] + windows[hit] + width - 1 > second)]
        inner[hit] = True
    raw = memoryview(np.ascontiguousarray(data))
    content = [xxhash.xxh3_64_intdigest(raw[a:b], SEED) for a, b in zip(start.tolist(), (start + windows + LENGTH - 1).tolist(), strict=True)]
    return low[start], start, windows, np.array(content, np.uint64), inner


def string_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of every string of ``LENGTH`` bytes: its symbols' hashes, each mixed with its place, added up."""
    symbols = _Rolling(data).all(STRIDE)
    n = max(len(data) - LENGTH + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(LENGTH // STRIDE):
        out += mix(symbols[j * STRIDE: j * STRIDE + n] ^ mix(np.array([j + 1], np.uint64))[0])
    return out


def _stable_order(values: np.ndarray, limit: int) -> np.ndarray:
    """Stable order of integers from 0 to ``limit`` - 1, 16 bits at a time (numpy sorts those by radix)."""
    order = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    shift = 16
    while limit >> shift:
        order = order[np.argsort(((values >> shift) & 0xFFFF).astype(np.uint16)[order], kind="stable")]
        shift += 16
    return order


def _ranks(order: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense ranks of rows that ``order`` sorts by ``keys``, and their number."""
    new = np.zeros(len(order), bool)
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks, int(new.sum()) + 1 if len(order) else 0


def sort_shard(symbols: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The suffixes of a shard in order; suffix i is symbols[i] followed by suffix after[i] (doubling until distinct)."""
    limit = int(symbols.max(initial=0)) + 1
    ranks, distinct = _ranks(_stable_order(symbols, limit), symbols)
    step = after
    while distinct < len(symbols):
        second = ranks[step]
        order = _stable_order(second, distinct)
        order = order[_stable_order(ranks[order], distinct)]
        ranks, distinct = _ranks(order, ranks, second)
        step = step[step]
    order = np.empty(len(ranks), np.int64)
    order[ranks] = np.arange(len(ranks))
    return order


def merge_transforms(first: np.ndarray, second: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(interleave, block) of two shards' transforms after ``rounds`` refinements.

    ``first`` and ``second`` hold for each suffix in its shard's order the
    symbol before it.  The interleave says which shard each merged place takes
    its next suffix from, ``block`` numbers the places whose suffixes share
    ``rounds`` symbols.
    """
    which = np.concatenate((np.zeros(len(first), bool), np.ones(len(second), bool)))
    block = np.zeros(len(which), np.int64)
    symbols = np.empty(len(which), np.int64)
    limit = int(max(first.max(initial=0), second.max(initial=0))) + 1
    for _ in range(rounds):
        symbols[~which], symbols[which] = first, second
        order = _stable_order(symbols, limit)
        which, block, bucket = which[order], block[order], symbols[order]
        block = np.cumsum(np.concatenate(([False], (bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1]))))
    return which, block


def _chains(symbols: np.ndarray, possible: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, covered): the starts whose string can occur twice, and the places of their symbols.

    A string that occurs twice has only symbols that occur twice, among the symbols of such strings.  A symbol that
    occurs once has a cell of its own unless cells collide, which keeps a place too many and drops none.
    """
    steps, n = LENGTH // STRIDE, len(symbols)
    limit = 1 << min(n.bit_length() + 1, 21)
    starts, covered = possible, np.ones(len(possible), bool)
    for shift in (0, 21, 42):
        cells = ((symbols >> np.uint64(shift)) & np.uint64(limit - 1)).astype(np.int64)
        twice = np.zeros(len(possible), bool)
        twice[:n] = covered[:n] & (np.bincount(cells[covered[:n]], minlength=limit)[cells] >= 2)
        starts = starts & _along(twice, steps, False)
        covered = _along(starts, steps, True)
    return starts, covered


def _along(flags: np.ndarray, steps: int, back: bool) -> np.ndarray:
    """Whether the flags of a place and the ``steps`` - 1 symbols behind it all stand; with ``back``, any of it and those ahead."""
    def moved(x: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros(len(x), bool)
        if by < len(x):
            if back:
                out[by:] = x[: len(x) - by]
            else:
                out[: len(x) - by] = x[by:]
        return out

    out, power, done, width = None, flags, 0, 1
    while width <= steps:
        if steps & width:
            shifted = moved(power, done * STRIDE)
            out = shifted if out is None else (out | shifted if back else out & shifted)
            done += width
        shifted = moved(power, width * STRIDE)
        power = power | shifted if back else power & shifted
        width *= 2
    return out


def repeated_starts(texts: list[bytes], shard: np.ndarray) -> np.ndarray:
    """For the strings of ``LENGTH`` bytes in ``texts``, back to back by start: do they occur twice or more?

    Returns one flag per byte of the texts, each with one closing byte, joined.
    ``shard`` (0 or 1) puts each text into a shard.  Only the chains of symbols
    that some string may repeat are sorted and merged; each is closed by an end
    that is a symbol of its own.
    """
    sizes = np.array([len(x) + 1 for x in texts], np.int64)
    data = np.frombuffer(b"".join(x + b"\0" for x in texts), np.uint8)
    start = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(texts)), sizes)
    inside = np.arange(len(data)) - start[text]
    raw = _Rolling(data).all(STRIDE)
    starts, covered = _chains(raw, inside + LENGTH < sizes[text])
    places = np.flatnonzero(covered)
    out = np.zeros(len(data), bool)
    if not len(places):
        return out
    # The suffixes: first the places, then one end for each chain.
    number = np.empty(len(data), np.int64)
    number[places] = np.arange(len(places))
    behind = np.zeros(len(places), bool)
    behind[places >= STRIDE] = covered[places[places >= STRIDE] - STRIDE]
    ahead = covered[places + STRIDE]  # a closing byte, which no chain holds, stands there at the latest
    first, last = np.flatnonzero(~behind), np.flatnonzero(~ahead)
    first = first[np.lexsort((places[first], places[first] % STRIDE))]
    last = last[np.lexsort((places[last], places[last] % STRIDE))]
    ends = len(places) + np.arange(len(first))
    before, after = np.empty(len(places) + len(ends), np.int64), np.empty(len(places) + len(ends), np.int64)
    before[np.flatnonzero(behind)] = number[places[behind] - STRIDE]
    after[np.flatnonzero(ahead)] = number[places[ahead] + STRIDE]
    before[first], after[last], before[ends], after[ends] = ends, ends, last, first
    some = raw[places]
    ranks, _ = _ranks(np.argsort(some), some)
    symbols = np.concatenate((ranks + len(ends), np.arange(len(ends))))
    owner = shard[text[places]]
    owner = np.concatenate((owner, owner[first]))
    lists, transforms = [], []
    for k in (0, 1):
        own = np.flatnonzero(owner == k)
        local = np.empty(len(symbols), np.int64)
        local[own] = np.arange(len(own))
        order = own[sort_shard(symbols[own], local[after[own]])] if len(own) else own
        lists.append(order)
        transforms.append(symbols[before[order]])
    which, block = merge_transforms(transforms[0], transforms[1], LENGTH // STRIDE)
    merged = np.empty(len(symbols), np.int64)
    merged[~which], merged[which] = lists
    counts = np.bincount(block, minlength=len(symbols) + 1)
    twice = merged[counts[block] >= 2]
    out[places[twice[twice < len(places)]]] = True
    return out & starts


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): the texts that take part in a repeat (key, did, text), and their repeated spans.

    Spans (key, did, span_start, span_stop) are byte ranges, overlapping ones
    included.  A text is known by ``key`` (a hash of doc_id and text) and ``did``.
    """
    keyed = with_keys(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_batches(batches):
            found = [runs_of(data[a:b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)]
            doc = np.repeat(np.arange(len(found)), [len(x[0]) for x in found])
            parts = [np.concatenate([x[i] for x in found]) for i in range(5)]
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [rows.column("key").take(take), rows.column("did").take(take), pa.array(parts[0].view(np.int64)), pa.array(parts[1]),
                 pa.array(parts[2]), pa.array(parts[3].view(np.int64)), pa.array(parts[4])],
                ["key", "did", "anchor", "start", "windows", "content", "inner"])

    kind = "key long, did long, anchor long, start long, windows long, content long, inner boolean"
    runs = shared_table(keyed.mapInArrow(cut, kind), "runs")
    # Equal runs stand as one; what follows grows with distinct runs, not with copies.
    contents = runs.groupBy("anchor", "content", "windows").agg(F.count("*").alias("n"), F.max("inner").alias("inner"))
    contents = shared_table(contents, "run-contents")
    anchors = contents.groupBy("anchor").agg(F.count("*").alias("distinct"), F.sum("n").alias("total"))
    busy = shared_table(anchors.where("total > 1"), "anchors")
    marked = (contents.join(busy.select("anchor", "distinct"), "anchor", "left").withColumn("distinct", F.coalesce("distinct", F.lit(1)))
              .where("n > 1 or distinct > 1 or inner"))
    marked = shared_table(marked, "marked")
    hits = shared_table(runs.drop("inner").join(marked, ["anchor", "content", "windows"]), "run-hits")
    whole = hits.where("n > 1").select("key", "did", F.col("start").alias("span_start"), (F.col("start") + F.col("windows") + LENGTH - 1).alias("span_stop"))
    # One run of each content of the anchors with several contents, and runs that may repeat in themselves.
    open_ = hits.where("distinct > 1 or inner")
    one = open_.groupBy("anchor", "content", "windows").agg(
        F.min(F.struct("key", "did", "start")).alias("p"), F.min("n").alias("n"), F.min("distinct").alias("distinct"))
    one = one.select("anchor", "n", "distinct", "content", "windows", "p.*")
    salted = one.withColumn("salts", F.ceil(F.col("distinct") / PER_SALT).cast("int"))
    salted = salted.withColumn("salt", F.pmod("content", F.col("salts")).cast("int"))
    texts = shared_table(keyed.join(hits.select("key", "did").distinct(), ["key", "did"], "left_semi").dropDuplicates(["key", "did"]), "hit-texts")
    wanted = salted.groupBy("key", "did").agg(F.collect_list(F.struct("anchor", "salt", "salts", "n", "start", "windows")).alias("runs"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_batches(batches, limit=1 << 20):
            out = []
            for i, (key, did, found) in enumerate(zip(rows.column("key").to_pylist(), rows.column("did").to_pylist(), rows.column("runs").to_pylist(), strict=True)):
                own = data[offsets[i]: offsets[i + 1]]
                out += [(key, did, r["anchor"], r["salt"], r["salts"], r["n"], r["start"], own[r["start"]: r["start"] + r["windows"] + LENGTH - 1].tobytes()) for r in found]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), RUN.types, strict=True)], schema=RUN)

    pieces = texts.join(wanted, ["key", "did"]).select("key", "did", "text", "runs").mapInArrow(extract, RUN_KIND)
    placed = pieces.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            texts = [r["bytes"] for r in held]
            flags = repeated_starts(texts, np.arange(len(texts)) % 2)
            out, at = [], 0
            for r in held:
                n = len(r["bytes"])
                own = flags[at: at + n]
                at += n + 1
                if r["n"] < 2:
                    for a, b in zip(*(x.tolist() for x in _stretches(own)), strict=True):
                        out.append((r["key"], r["did"], r["start"] + a, r["start"] + b + LENGTH - 1, None, None, None))
                if r["salts"] > 1:  # strings that only other tasks can repeat; one row each for those met here
                    hashes = string_hashes(np.frombuffer(r["bytes"], np.uint8)).view(np.int64)
                    open_ = np.ones(len(hashes), bool) if r["n"] > 1 else ~own[: len(hashes)]
                    met = np.unique(hashes[own[: len(hashes)] & ~open_])
                    out += [(None, None, None, None, r["anchor"], h, r["salt"]) for h in met.tolist()]
                    single = np.flatnonzero(open_)
                    keep = (r["key"], r["did"]) if r["n"] < 2 else (None, None)
                    out += [(*keep, r["start"] + i, r["start"] + i + LENGTH, r["anchor"], h, r["salt"]) for i, h in zip(single.tolist(), hashes[single].tolist(), strict=True)]
            held.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), SPAN.types, strict=True)], schema=SPAN)

        last = None
        for batch in batches:
            for r in batch.to_pylist():
                if held and size >= MERGED and (r["anchor"], r["salt"]) != last:
                    yield from flush()
                    size = 0
                held.append(r)
                size += len(r["bytes"])
                last = (r["anchor"], r["salt"])
        if held:
            yield from flush()

    found = shared_table(placed.mapInArrow(compare, SPAN_KIND), "found")
    direct = found.where("anchor is null").select("key", "did", "span_start", "span_stop")
    loose = found.where("anchor is not null")
    met = loose.groupBy("anchor", "hash").agg(F.min("salt").alias("lo"), F.max("salt").alias("hi")).where("lo <> hi").select("anchor", "hash")
    across = loose.where("key is not null").join(met, ["anchor", "hash"]).select("key", "did", "span_start", "span_stop")
    return texts, whole.unionByName(direct).unionByName(across)


RUN = pa.schema([("key", pa.int64()), ("did", pa.int64()), ("anchor", pa.int64()), ("salt", pa.int32()), ("salts", pa.int32()), ("n", pa.int64()),
                 ("start", pa.int64()), ("bytes", pa.binary())])
RUN_KIND = "key long, did long, anchor long, salt int, salts int, n long, start long, bytes binary"
SPAN = pa.schema([("key", pa.int64()), ("did", pa.int64()), ("span_start", pa.int64()), ("span_stop", pa.int64()), ("anchor", pa.int64()),
                  ("hash", pa.int64()), ("salt", pa.int32())])
SPAN_KIND = "key long, did long, span_start long, span_stop long, anchor long, hash long, salt int"


def with_keys(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.xxhash64("doc_id", text).alias("key"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("did"), text.alias("text"))


def dedup_bytes(docs: DataFrame, kept_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the remaining bytes) of every row of ``docs``.

    A null text counts as empty; texts under 400 bytes lose nothing.  Repeated
    rows repeat each other's text, so both lose it.  A null doc_id is a
    document like any other.  Other columns are ignored; an empty table gives
    an empty result.
    """
    texts, spans = repeated_spans(docs)
    per_doc = spans.groupBy("key", "did").agg(F.collect_list(F.struct("span_start", "span_stop")).alias("spans"))  # at most a text's strings
    kind = "key long, did long, n_removed long, n_spans long, kept binary, kept_sha256 string"

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_batches(batches, limit=1 << 20):
            out = []
            for i, (key, did, found) in enumerate(zip(rows.column("key").to_pylist(), rows.column("did").to_pylist(), rows.column("spans").to_pylist(), strict=True)):
                own = data[offsets[i]: offsets[i + 1]]
                depth = np.zeros(len(own) + 1, np.int32)
                np.add.at(depth, [s["span_start"] for s in found], 1)
                np.add.at(depth, [s["span_stop"] for s in found], -1)
                gone = np.cumsum(depth[:-1]) > 0
                left = own[~gone].tobytes()
                out.append((key, did, int(gone.sum()), len(_stretches(gone)[0]), left if kept_text else None, hashlib.sha256(left).hexdigest()))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                             ["key", "did", "n_removed", "n_spans", "kept", "kept_sha256"])

    cut = shared_table(texts.join(per_doc, ["key", "did"]).select("key", "did", "text", "spans").mapInArrow(remove, kind), "cut")
    rows = with_keys(docs).select("key", "did", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("_whole"),
                                  *([F.col("text").cast("binary").alias("_text")] if kept_text else []))
    done = rows.join(cut, ["key", "did"], "left")
    zero = F.lit(0).cast("long")
    return done.select(F.when(F.col("did") != -(1 << 63), F.col("did")).alias("doc_id"), "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
                       F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "_whole").alias("kept_sha256"),
                       *([F.coalesce("kept", "_text").alias("kept")] if kept_text else []))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, removed bytes and spans, and the kept bytes' SHA-256 of every document."""
    return dedup_bytes(documents(spark, sf_dir))
