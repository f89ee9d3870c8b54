"""Exact hard-negative mining over anchor-clustered shared lists.

Anchors are clustered by direction (spherical k-means fitted on a bounded
sample; every anchor goes to its nearest centre).  For a cluster with centre c
and widest member angle w, no member u can score more against a vector x than
|u| |x| cos(max(0, angle(x, c) - w)).  So the candidates are sorted by
|x| cos(...) once for the cluster, every member walks that one list, and stops
where its own |u| times the bound at the list's place can no longer enter any
of its answers.  What a walk returns is therefore exact, whatever the clusters.

Spark lays this out as a grid: parts of the anchors (some clusters, or a piece
of a large one) against blocks of candidates dealt by hash, one task cell each,
of bounded size.  A cell sorts its block once for each of its clusters and
returns a few rows for each member;
windows merge the cells.  Two rounds: first each anchor's positives, then, with
the positives' scores as score ranges, the negatives of every range at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_table

POSITIVES, NEGATIVES = 5, 5
#: Range of a negative's score, in percent of the positive's.
LOW, HIGH = 80, 100
ANCHORS_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
#: Rows of a cell at most: anchors (of several clusters, or part of a large one), candidates of a block.
ANCHOR_CELL, CANDIDATE_BLOCK = 512, 4096
#: Anchors of a cluster on average.
CLUSTER = 64
#: Centres at most, and anchors that they are fitted on at most.
CENTRES, SAMPLE = 256, 20_000
#: Candidates scored between two looks at the bound.
STRIDE = 256


def _matrix(lists: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Rows of integers, shorter ones filled with 0."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), max(int(sizes.max(initial=0)), width or 0)), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(size > 0, size, 1)


def fit_centres(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """``k`` unit centres of the rows by spherical k-means; always the same for the same rows."""
    rows = _unit(sample.astype(float))
    centres = rows[np.linspace(0, len(rows) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        nearest = np.argmax(rows @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        full = np.linalg.norm(sums, axis=1) > 0
        centres[full] = _unit(sums[full])
    return centres


class SharedList:
    """Candidates in the order of one cluster's bound, walked by its members."""

    def __init__(self, members: np.ndarray, candidates: np.ndarray, ids: np.ndarray):
        u, x = members.astype(float), candidates.astype(float)
        self.reach, size = np.linalg.norm(u, axis=1), np.linalg.norm(x, axis=1)
        middle = _unit(_unit(u).sum(axis=0, keepdims=True))[0]
        angle_u = np.arccos(np.clip(_unit(u) @ middle, -1, 1))
        angle_x = np.arccos(np.clip(_unit(x) @ middle, -1, 1))
        bound = size * np.cos(np.minimum(np.maximum(angle_x - angle_u.max(initial=0), 0), np.pi))
        self.order = np.lexsort((ids, -bound))
        # Angles near 0 are good to some 1e-8 only; the slack keeps the bound above any score.
        self.bound = bound[self.order] + 1e-6 * size.max(initial=0)
        exact = self.reach.max(initial=0) * size.max(initial=0) < 2 ** 52  # products and sums exact in doubles
        self.candidates = (x if exact else candidates)[self.order]
        self.members = u if exact else members

    def walk(self, open_until: Callable[[], np.ndarray], take: Callable[[int, np.ndarray, np.ndarray], None], live: np.ndarray) -> int:
        """Hand each live member its scores stride by stride until none can use the rest; the number of scores made.

        ``open_until()`` is each member's least score that could still enter its answers,
        ``take(member, places, scores)`` gets places of the sorted list.
        """
        made = 0
        for first in range(0, len(self.order), STRIDE):
            live = live[self.reach[live] * self.bound[first] + 0.5 >= open_until()[live]]
            if not len(live):
                break
            block = slice(first, min(first + STRIDE, len(self.order)))
            scores = self.members[live] @ self.candidates[block].T
            made += scores.size
            places = self.order[block]
            for i, m in enumerate(live):
                take(int(m), places, scores[i])
        return made


def _first(ids: np.ndarray, scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` of ``places`` by score descending, then id."""
    if len(places) > 4 * k:
        floor = np.partition(scores[places], len(places) - k)[len(places) - k]
        places = places[scores[places] >= floor]
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def ranged_search(members: np.ndarray, candidates: np.ndarray, ids: np.ndarray, allowed: Callable[[int], np.ndarray],
                  lows: np.ndarray, highs: np.ndarray, k: int) -> Iterator[tuple[int, int, int, int]]:
    """(member, range, place, score) of the first ``k`` allowed candidates in each score range of each member.

    ``lows`` and ``highs`` are members x ranges; a range with low > high is empty.
    """
    shared = SharedList(members, candidates, ids)
    need = np.where(lows > highs, np.iinfo(np.int64).max, lows)
    best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    masks: dict[int, np.ndarray] = {}

    def take(m: int, places: np.ndarray, scores: np.ndarray) -> None:
        if m not in masks:
            masks[m] = allowed(m)
        floor, top = need[m].min(), highs[m].max()
        use = (scores >= floor) & (scores <= top) & masks[m][places]
        if not use.any():
            return
        places, scores = places[use], scores[use].astype(np.int64)
        for r in range(lows.shape[1]):
            inside = (scores >= lows[m, r]) & (scores <= highs[m, r])
            if not inside.any():
                continue
            p, s = places[inside], scores[inside]
            if (m, r) in best:
                p, s = np.concatenate((best[m, r][0], p)), np.concatenate((best[m, r][1], s))
            keep = _first(ids[p], s, np.arange(len(p)), k)
            best[m, r] = p[keep], s[keep]
            if len(keep) == k:  # ties with the last one may still enter by a smaller id
                need[m, r] = max(need[m, r], s[keep[-1]])

    shared.walk(lambda: need.min(axis=1, initial=np.iinfo(np.int64).max), take, np.arange(len(members)))
    for (m, r), (places, scores) in best.items():
        for p, s in zip(places, scores, strict=True):
            yield m, r, int(p), int(s)


def _grid(anchors: DataFrame, candidates: DataFrame, cell: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``cell`` over every cluster part of ``anchors`` (``part``) and every block of ``candidates``."""
    parts = [r["part"] for r in anchors.select("part").distinct().collect()]  # some n / ANCHOR_CELL + CENTRES numbers
    blocks = -(-candidates.count() // CANDIDATE_BLOCK)
    spark = anchors.sparkSession
    if not parts or not blocks:
        return spark.createDataFrame([], schema)
    left = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = spark.createDataFrame([(p,) for p in parts], "part int")
    block = F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(blocks)).cast("int")
    right = candidates.withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(max(parts)))))
    if len(parts) <= max(parts):
        right = right.join(F.broadcast(rows), "part", "left_semi")
    return left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInArrow(cell, schema)


def _cell(found: Callable[[pa.Table, np.ndarray, pa.Table, np.ndarray], Iterator[tuple]], names: dict[str, pa.DataType]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A cell's function: ``found`` for each cluster of the anchors, as a table."""
    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        rows = []
        if a.num_rows and b.num_rows:
            dims = max(x.column("v").combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max(initial=0) for x in (a, b))
            members, candidates, cluster = _matrix(a.column("v"), dims), _matrix(b.column("v"), dims), a.column("cluster").to_numpy()
            for c in np.unique(cluster):
                some = np.flatnonzero(cluster == c)
                rows.extend(found(a.take(pa.array(some)), members[some], b, candidates))
        columns = list(zip(*rows, strict=True)) or [[] for _ in names]
        return pa.table({n: pa.array(c, t) for (n, t), c in zip(names.items(), columns, strict=True)})
    return cell


def _positive_cell(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def found(a: pa.Table, members: np.ndarray, b: pa.Table, candidates: np.ndarray) -> Iterator[tuple]:
        ids, labels, keys = b.column("vec_id").to_numpy(), b.column("label").to_numpy(), a.column("anchor").to_numpy()
        own, own_label = a.column("vec_id").to_numpy(), a.column("label").to_numpy()
        lowest = np.full((len(members), 1), np.iinfo(np.int64).min)
        for m, _, p, s in ranged_search(members, candidates, ids, lambda m: (labels == own_label[m]) & (ids != own[m]),
                                        lowest, np.full_like(lowest, np.iinfo(np.int64).max), k):
            yield int(keys[m]), int(ids[p]), s
    return _cell(found, {"anchor": pa.int64(), "positive_id": pa.int64(), "positive_score": pa.int64()})


def _negative_cell(k: int, low: int, high: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def found(a: pa.Table, members: np.ndarray, b: pa.Table, candidates: np.ndarray) -> Iterator[tuple]:
        ids, labels, keys = b.column("vec_id").to_numpy(), b.column("label").to_numpy(), a.column("anchor").to_numpy()
        own_label, scores = a.column("label").to_numpy(), _matrix(a.column("scores"))
        given = a.column("scores").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        # low * positive <= 100 * negative <= high * positive, in whole numbers.
        lows, highs = -((-low * scores) // 100), (high * scores) // 100
        lows[np.arange(scores.shape[1]) >= given[:, None]] = np.iinfo(np.int64).max
        for m, r, p, s in ranged_search(members, candidates, ids, lambda m: labels != own_label[m], lows, highs, k):
            yield int(keys[m]), r, int(ids[p]), s
    return _cell(found, {"anchor": pa.int64(), "place": pa.int32(), "negative_id": pa.int64(), "negative_score": pa.int64()})


def clustered(anchors: DataFrame) -> DataFrame:
    """``anchors`` (``anchor``, ``vec_id``, ``label``, ``v``) with ``cluster`` and ``part``.

    A part has at most some :data:`ANCHOR_CELL` rows: whole clusters, or a piece of one that is larger.
    """
    n = anchors.count()
    if not n:
        return anchors.withColumn("cluster", F.lit(0)).withColumn("part", F.lit(0))
    k = max(1, min(CENTRES, n // CLUSTER))
    if k > 1:
        drawn = anchors.orderBy(F.xxhash64("vec_id", "anchor"), "anchor").limit(SAMPLE).select("v").toArrow()
        centres = fit_centres(_matrix(drawn.column("v")), k)
    else:
        centres = np.zeros((1, 0))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            v = _matrix(rows.column("v"), centres.shape[1])[:, :centres.shape[1]].astype(float)
            yield rows.append_column("cluster", pa.array(np.argmax(v @ centres.T, axis=1).astype(np.int32)))

    schema = "anchor long, vec_id long, label int, v array<long>, cluster int"
    near = shared_table(anchors.select("anchor", "vec_id", "label", "v").mapInArrow(nearest, schema), "clusters")
    sizes = {r["cluster"]: r["count"] for r in near.groupBy("cluster").count().collect()}  # CENTRES rows at most
    first, part, room = {}, -1, 0
    for c in sorted(sizes):
        if sizes[c] > room:
            part, room = part + 1, max(ANCHOR_CELL, sizes[c])
        first[c] = (part, -(-sizes[c] // ANCHOR_CELL))
        part, room = part + first[c][1] - 1, room - sizes[c]
    spark = anchors.sparkSession
    places = spark.createDataFrame([(c, *p) for c, p in first.items()], "cluster int, first int, parts int")
    part = (F.col("first") + F.pmod(F.xxhash64("anchor"), F.col("parts"))).cast("int")
    return near.join(F.broadcast(places), "cluster").select("anchor", "vec_id", "label", "v", "cluster", part.alias("part"))


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; both inputs have ``vec_id``, ``label`` and ``v``.

    Scores are integer inner products (components beyond a shorter vector's end
    count as 0) and 100 times a score must fit 63 bits.  A row with the
    anchor's own vec_id is never its positive.  Anchors that agree in id, label
    and vector are one anchor; candidates that repeat an id count one by one.
    A positive with a negative score has no negatives, as its range is empty.
    No anchors, positives or rows in range give no rows.
    """
    kind = ["anchor", "vec_id", "label", "v"]
    named = shared_table(anchors.select("vec_id", "label", "v").distinct().withColumn("anchor", F.monotonically_increasing_id()).select(*kind), "anchors")
    parts = shared_table(clustered(named), "anchor-parts")
    rows = shared_table(vectors.select("vec_id", "label", "v"), "vectors")
    met = _grid(parts, rows, _positive_cell(positives), "anchor long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    first = met.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < positives)
    first = shared_table(first.select("anchor", F.col("place").cast("int").alias("place"), "positive_id", "positive_score"), "positives")
    scores = first.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    ranges = parts.join(scores.select("anchor", F.col("p.positive_score").alias("scores")), "anchor")
    found = _grid(shared_table(ranges, "ranges"), rows, _negative_cell(negatives, low, high),
                  "anchor long, place int, negative_id long, negative_score long")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return best.join(first, ["anchor", "place"]).join(named.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def labelled_vectors(table: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id, label and v, the components as floor(scale * x), of the rows without null or non-finite values in them."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    whole = F.transform(x, lambda e: F.floor(e * scale).cast("long"))
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = table.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("int").alias("label"), whole.alias("v"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every row whose vec_id is divisible by 100, over all embeddings."""
    vectors = labelled_vectors(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))
    return mine(vectors, vectors.where(F.col("vec_id") % ANCHORS_EVERY == 0))


ORACLE = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, c.r, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
      FROM v a JOIN v c ON a.r <> c.r WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor, anchor_id, r AS positive, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
             s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
      FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT * FROM n WHERE rank <= 5
"""
