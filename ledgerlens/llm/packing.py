"""Best-fit packing by non-negative least squares over length patterns.

Only the histogram of piece lengths (at most ``capacity`` numbers) reaches the
driver.  There, patterns of up to three length classes that fill a sequence
are enumerated, their repeat counts are fitted to the class counts by
non-negative least squares, rounded down, and turned into *groups*: so many
sequences with the same list of exact lengths.  The pieces that no pattern
takes, the residuals, go best-fit, longest first, into the room the patterns
left and into new sequences; this too works on counts, not on pieces.  The
plan says for each length which ranks go to which sequences; Spark numbers the
pieces within their length (salted, so one very common length is no single
task) and joins the plan.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import documents, salted_rank, shared_table, text_batches

CAPACITY = 4096
END_ID = 1
#: Length classes of the fit; a class is capacity / CLASSES tokens wide.
CLASSES = 256
#: Pieces numbered by one task of a window.
PER_BUCKET = 200_000


def tokenize_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END_ID, ids: bool = False) -> DataFrame:
    """Token ids of whole texts with ``end`` appended, cut into pieces of at most ``capacity``.

    Returns doc_id, piece (from 0), start, length, ids_crc32 and, with
    ``ids``, the token ids.  A null or empty text is the single id ``end``.
    Repeated rows are documents of their own; other columns are ignored.
    """
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        for rows, data, offsets in text_batches(batches):
            flat, borders = tokens.with_end(*encode.encode(data, offsets), end)
            sizes = np.diff(borders)
            many = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), many)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
            start = piece * capacity
            length = np.minimum(sizes[doc] - start, capacity)
            at = borders[doc] + start
            raw = flat.astype("<u4").tobytes()
            crc = [zlib.crc32(raw[4 * a: 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            out = [rows.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                   pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if ids:
                ends = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, kind)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Active-set least squares: x >= 0 that minimises the norm of ``a @ x - b``."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    gram, target = a.T @ a, a.T @ b
    tolerance = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(rounds):
        gradient = np.where(free, -np.inf, target - gram @ x)
        j = int(np.argmax(gradient))
        if gradient[j] <= tolerance:
            break
        free[j] = True
        while True:
            on = np.flatnonzero(free)
            z = np.linalg.lstsq(gram[np.ix_(on, on)], target[on], rcond=None)[0]
            if z.min() > 0:
                x[:] = 0
                x[on] = z
                break
            low = on[z <= 0]
            old = x[low]
            step = float(np.min(old / np.maximum(old - z[z <= 0], 1e-300)))
            x[on] += step * (z - x[on])
            x[low[np.isclose(old + step * (z[z <= 0] - old), 0, atol=1e-9)]] = 0
            free &= x > 1e-12
            if not free.any():
                return x
    return x


def patterns(classes: int, present: np.ndarray) -> list[tuple[int, ...]]:
    """Lists of one to three present classes (1 to ``classes``) that add up to ``classes``, largest first."""
    have = set(present.tolist())
    found = [(classes,)] if classes in have else []
    for x in sorted(have, reverse=True):
        if x == classes:
            continue
        if classes - x in have and classes - x <= x:
            found.append((x, classes - x))
        for y in range(min(x, classes - x - 1), 0, -1):
            z = classes - x - y
            if z > y:
                break
            if y in have and z in have:
                found.append((x, y, z))
    return found


def plan(histogram: dict[int, int], capacity: int = CAPACITY, classes: int = CLASSES) -> tuple[pd.DataFrame, int]:
    """Where the pieces of each length go, and the number of sequences.

    Rows (length, from_rank, to_rank, sequence, offset): the pieces of
    ``length`` with rank r, from_rank < r <= to_rank, lie at ``offset`` in
    sequence ``sequence + r - from_rank - 1``.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("lengths must lie between 1 and the capacity")
    width = -(-capacity // classes)
    of = {n: -(-n // width) for n in left}
    counts = np.zeros(classes + 1)
    for n, c in left.items():
        counts[of[n]] += c
    shapes = patterns(-(-capacity // width), np.flatnonzero(counts))
    groups: list[list] = []  # [repeats, lengths]
    if shapes:
        a = np.zeros((classes + 1, len(shapes)))
        for j, shape in enumerate(shapes):
            for k in shape:
                a[k, j] += 1
        fitted = nnls(a, counts)
        room = counts.astype(np.int64)
        stock = {k: sorted((n for n in left if of[n] == k), reverse=True) for k in {*of.values()}}
        for j in np.argsort(-fitted, kind="stable"):
            shape = shapes[j]
            need = {k: shape.count(k) for k in shape}
            repeats = min(int(np.floor(fitted[j] + 1e-6)), *(int(room[k]) // m for k, m in need.items()))
            for k, m in need.items():
                room[k] -= repeats * m
            while repeats > 0:  # runs of sequences whose exact lengths agree
                taken = [stock[k][0] for k in shape]
                times = repeats
                for n in {*taken}:
                    times = min(times, left[n] // taken.count(n))
                if not times:  # a class's longest length ends inside one sequence: take each slot on its own
                    times, taken = 1, []
                    for k in shape:
                        n = stock[k][0]
                        taken.append(n)
                        left[n] -= 1
                        if not left[n]:
                            stock[k].pop(0)
                else:
                    for n in taken:
                        left[n] -= times
                    for k in {*shape}:
                        while stock[k] and not left[stock[k][0]]:
                            stock[k].pop(0)
                groups.append([times, taken])
                repeats -= times
    by_room: dict[int, list[int]] = {}
    for g, (_, taken) in enumerate(groups):
        by_room.setdefault(capacity - sum(taken), []).append(g)
    rooms = sorted(r for r in by_room if r)

    def put(g: int, room: int) -> None:
        if room and not by_room.get(room):
            bisect.insort(rooms, room)
            by_room[room] = []
        if room:
            by_room[room].append(g)

    for n in sorted((n for n, c in left.items() if c), reverse=True):
        count = left[n]
        while count:
            at = bisect.bisect_left(rooms, n)
            if at < len(rooms):
                room = rooms[at]
                g = by_room[room].pop()
                if not by_room[room]:
                    rooms.pop(at)
                repeats, taken = groups[g]
                each = room // n
                if count < each:
                    each = count
                times = min(repeats, count // each)
                if times < repeats:
                    groups.append([repeats - times, taken])
                    put(len(groups) - 1, room)
            else:
                each = min(capacity // n, count)
                times, taken, room = count // each, [], capacity
                groups.append([0, []])
                g = len(groups) - 1
            groups[g] = [times, [*taken, *[n] * each]]
            count -= times * each
            put(g, room - each * n)
    rank = dict.fromkeys(histogram, 0)
    out, sequence = [], 0
    for repeats, taken in groups:
        offset = 0
        for n in taken:
            out.append((n, rank[n], rank[n] + repeats, sequence, offset))
            rank[n] += repeats
            offset += n
        sequence += repeats
    return pd.DataFrame(out, columns=["length", "from_rank", "to_rank", "sequence", "offset"]), sequence


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces`` (doc_id, piece, length, ...), read several times.

    Every sequence holds at most ``capacity`` tokens without a gap.  No piece
    or an empty table gives no sequence.
    """
    spark = pieces.sparkSession
    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    where, _ = plan(histogram, capacity)
    total = sum(histogram.values())
    buckets = max(64, -(-total // PER_BUCKET))
    ranked = salted_rank(pieces, ["length"], ["doc_id", "piece"], F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)), "_rank")
    kind = "length long, from_rank long, to_rank long, sequence long, offset long"
    slots = spark.createDataFrame(where.astype("int64").values.tolist(), kind)
    # The plan's size depends on the capacity alone: a few rows for each length and class.
    slots = F.broadcast(slots) if len(where) <= 64 * capacity else slots
    placed = ranked.join(slots, (ranked["length"] == slots["length"]) & (F.col("_rank") > F.col("from_rank"))
                         & (F.col("_rank") <= F.col("to_rank"))).drop(slots["length"])
    return (placed.withColumn("sequence_id", F.col("sequence") + F.col("_rank") - F.col("from_rank") - 1)
            .drop("_rank", "from_rank", "to_rank", "sequence"))


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END_ID, ids: bool = False) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text) and pack the pieces into sequences of at most ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset,
    with ``ids`` also the token ids.
    """
    path = path or tokens.tokenizer_path("word_bpe_49k.json")
    return pack(shared_table(tokenize_pieces(docs, path, capacity, end, ids), "pieces"), capacity)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens; one row per piece."""
    return pack_documents(documents(spark, sf_dir)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
