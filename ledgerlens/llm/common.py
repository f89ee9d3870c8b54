"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: Characters that separate words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def shared_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage: a lost executor costs a re-read, never a re-run of
    the steps before, and later plans see true sizes.  The folder is swept
    together with the checkpoints beside it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    if not _scratch:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    was = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, was)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    _scratch[-1].append(table)
    return table


#: Spark removes the shuffle files of a query when it ends; they have no further reader, as each table is written by one query.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The tables of each open :func:`scratch` block, the innermost last.
_scratch: list[list[DataFrame]] = []


def free(*tables: DataFrame) -> None:
    """Delete tables that :func:`shared_table` wrote inside a :func:`scratch` block; nothing may read them later."""
    for table in tables:
        path = getattr(table, "_written_to", None)
        try:
            context = table.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
        except Exception:  # noqa: BLE001 - Spark Connect: the folder is swept with the checkpoints
            pass


@contextlib.contextmanager
def scratch() -> Iterator[Callable[[DataFrame], None]]:
    """A block at whose end the tables that :func:`shared_table` wrote in it go, and before them each query's shuffle files.

    Yields a function that names a table to keep; an outer block takes it over.
    """
    kept: list[DataFrame] = []
    _scratch.append([])
    try:
        yield kept.append
    finally:
        free(*[t for t in _scratch.pop() if not any(t is k for k in kept)])
        if _scratch:
            _scratch[-1].extend(kept)


def word_array(text: Column) -> Column:
    """All words (runs without :data:`SPACES`) of ``text``; null gives no words."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(spaced, " "), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once, however often ``body`` names it.

    A lambda variable holds the value, so no optimizer rule can copy the
    expression into the places that use it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def salted_rank(df: DataFrame, group: list[str], order: list, bucket: Column, name: str) -> DataFrame:
    """Add ``name``: the row's place (from 1) in its group, without one task per group.

    Rows are numbered inside (group, bucket) and the buckets' sizes are summed
    over the group, so a group of any size is spread over its buckets.  The
    group columns must not be null.  ``df`` is read twice.
    """
    keyed = df.withColumn("_bucket", bucket)
    sizes = keyed.groupBy(*group, "_bucket").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = keyed.withColumn("_place", F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy(*order)))
    joined = inside.join(offsets, [*group, "_bucket"])
    return joined.withColumn(name, F.col("_before") + F.col("_place")).drop("_bucket", "_before", "_place")


def connected_components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``) of every node in ``edges`` (``a``, ``b``); the component is its smallest node.

    Rounds of hooking and contraction, all as joins and aggregates: every
    node hooks to its smallest neighbour, chains are halved until flat, and
    the edges between the remaining roots go to the next round.  A hub's
    neighbours only meet in a ``min``, which is combined before the shuffle.
    """
    with scratch() as keep:
        edges = shared_table(edges.select("a", "b").where("a <> b").distinct(), "edges")
        label = shared_table(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
                             .select("node", F.col("node").alias("component")), "labels")
        while not edges.isEmpty():
            both = edges.union(edges.select("b", "a"))
            parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m"))
            parent = shared_table(parent.select("node", F.least("node", "_m").alias("up")), "parents")
            while True:
                above = parent.select(F.col("node").alias("up"), F.col("up").alias("_top"))
                jumped = parent.join(above, "up").select(
                    "node", F.col("_top").alias("up"), (F.col("up") != F.col("_top")).alias("_moved"))
                jumped = shared_table(jumped, "jumped")
                moved = not jumped.where("_moved").isEmpty()
                parent = jumped.drop("_moved")
                if not moved:
                    break
            up = parent.select(F.col("node").alias("component"), "up")
            label = shared_table(label.join(up, "component", "left").select("node", F.coalesce("up", "component").alias("component")), "labels")
            a, b = parent.select(F.col("node").alias("a"), F.col("up").alias("ua")), parent.select(F.col("node").alias("b"), F.col("up").alias("ub"))
            edges = edges.join(a, "a").join(b, "b").where("ua <> ub")
            edges = shared_table(edges.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), "edges")
        keep(label)
    return label


def link_groups(nodes: DataFrame, near: Callable[[str, str], Column],
                verify: Callable[[DataFrame, DataFrame], DataFrame], turns: int = 1, narrow: bool = False, known: DataFrame | None = None) -> DataFrame:
    """Components of the nodes that share a bucket and pass ``near`` and ``verify``; (``node``, ``component``).

    ``nodes`` has ``node``, ``sig`` and ``keys`` (an array with the node's
    bucket at each place; buckets of different places differ).
    ``near(sig_a, sig_b)`` is a cheap necessary condition and
    ``verify(pairs, candidates)`` keeps the true links of pairs (a, b);
    ``candidates`` are all nodes (``node``) that any pair can have.

    A bucket's hub is its member that most others share buckets with, by one
    order of all nodes (ties by hash).  First every node is held against the
    highest hub that it meets.  In each of ``turns`` more turns the buckets that
    still hold several components draw another hub by hash, for the members
    that are not joined with it yet.  That joins nearly all of a group of
    copies in turns + 1 pairs at most for each member.
    Then every pair of a bucket whose ends are still in different components
    is compared, inside the join and in the first bucket that both share, so
    no link that could join two components is lost and the pairs inside a
    group are never made.  Nodes without a link are not returned.  With
    ``narrow`` the keys do not travel with the members of open buckets; pairs
    found in several buckets are made distinct after ``near`` instead.
    ``known`` are components found before with other keys: pairs inside them are
    not compared again, and the result unites them with the new ones.
    """
    buckets = nodes.select(F.explode("keys").alias("key"), "node")
    keys = buckets.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1")
    left = nodes.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))

    def place(turn: int) -> Column:
        """One order of all nodes; the hub of a bucket is its last member."""
        drawn = F.xxhash64("node", F.lit(turn))
        return F.struct(drawn.alias("h"), "node", "component") if turn else F.struct("mass", drawn.alias("h"), "node", "component")

    def open_members(member: DataFrame, comp: DataFrame) -> DataFrame:
        """The members of buckets with several components."""
        labelled = member.drop("component").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
        whole = labelled.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).where("_lo <> _hi")
        return labelled.join(whole.select("key"), "key").select("key", "node", "mass", "component")

    with scratch() as keep:
        shared = shared_table(buckets.join(keys, "key"), "buckets")
        candidates = shared.select("node").distinct()
        mass = shared.groupBy("node").agg(F.sum("_n").alias("mass"))
        member = shared.select("key", "node").join(mass, "node").withColumn("component", F.col("node"))
        comp, links = known, None
        if known is not None:
            links = known.select(F.col("node").alias("a"), F.col("component").alias("b"))
            member = open_members(member, known)
        member = shared_table(member, "members")
        for turn in range(turns + 1):
            hubs = member.groupBy("key").agg(F.max(place(turn)).alias("hub"))
            met = member.join(hubs, "key").where(F.col("component") != F.col("hub.component"))
            star = met.groupBy("node").agg(F.max("hub").alias("hub")).select("node", F.col("hub.node").alias("hub"))
            star = star.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
            close = star.join(left, "a").join(right, "b").where(near("sig_a", "sig_b")).select("a", "b")
            close = shared_table(close, "pairs")
            new = shared_table(verify(close, candidates), "links")
            free(close)
            if links is None or not new.isEmpty():
                links = new if links is None else links.unionByName(new)
                comp = connected_components(links)
                before, member = member, shared_table(open_members(member, comp), "members")
                free(before)
        if narrow:
            open_ = shared_table(member.select("key", "node", "component").join(nodes.select("node", "sig"), "node"), "open")
            free(member)
            a = open_.select("key", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("sig").alias("sig_a"))
            b = open_.select("key", F.col("node").alias("b"), F.col("component").alias("cb"), F.col("sig").alias("sig_b"))
            rest = a.join(b, (a["key"] == b["key"]) & (F.col("ca") < F.col("cb")) & near("sig_a", "sig_b"))
            rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        else:
            open_ = shared_table(member.select("key", "node", "component").join(nodes.select("node", "sig", "keys"), "node"), "open")
            free(member)
            a = open_.select("key", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("sig").alias("sig_a"), F.col("keys").alias("ka"))
            b = open_.select("key", F.col("node").alias("b"), F.col("component").alias("cb"), F.col("sig").alias("sig_b"), F.col("keys").alias("kb"))
            first = F.get(F.filter(F.zip_with("ka", "kb", lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull()), F.lit(0))
            rest = a.join(b, (a["key"] == b["key"]) & (F.col("ca") < F.col("cb")) & near("sig_a", "sig_b") & (first == a["key"]))
            rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        rest = shared_table(rest, "pairs")
        free(open_)
        more = shared_table(verify(rest, candidates), "links")
        if not more.isEmpty():
            comp = connected_components(links.unionByName(more))
        keep(comp)
    return comp


def text_batches(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 8 << 20) -> Iterator[tuple]:
    """(rows, bytes, offsets) of runs of rows with at most ``limit`` bytes of text (or one longer row).

    ``rows`` is the record batch slice, ``bytes`` its texts back to back as
    uint8 (null as empty) and ``offsets`` their n + 1 borders.
    """
    for batch in batches:
        column = pc.fill_null(batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()), "")
        if not len(column):
            continue
        borders = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
        first = 0
        while first < len(column):
            last = int(np.searchsorted(borders, borders[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), len(column))
            yield (batch.slice(first, last - first), data[borders[first]: borders[last]],
                   borders[first: last + 1] - borders[first])
            first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (multiply and xor-shift), elementwise on uint64."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: Bits of a member filter, two of them set for each member; a power of two.
FILTER_BITS = 1 << 26


def probes(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each key in a filter; of a key only the low 40 bits are used."""
    low = key & np.uint64((1 << 40) - 1)
    return low & np.uint64(FILTER_BITS - 1), mix(low) & np.uint64(FILTER_BITS - 1)


def passing(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which keys a filter lets pass: all members, and few others."""
    one, two = ((bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1 for at in probes(key))
    return one & two


def filter_cells(key: np.ndarray) -> pa.RecordBatch:
    """(cell, mask) of both bits of each key."""
    at = np.concatenate(probes(key))
    mask = np.left_shift(np.int64(1), (at & np.uint64(31)).astype(np.int64))
    return pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(5)).astype(np.int32)), pa.array(mask)], names=["cell", "mask"])


def shared_filter(cells: DataFrame) -> Callable[[], np.ndarray]:
    """A filter from ``cells`` (``cell``, ``mask``), united by Spark and broadcast: :data:`FILTER_BITS` bits, whatever the number of members."""
    table = cells.groupBy("cell").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(FILTER_BITS // 32, "<u4")
    bits[table.column("cell").to_numpy()] = table.column("mask").to_numpy().astype("<u4")
    shared = cells.sparkSession.sparkContext.broadcast(bits.view(np.uint8))
    return lambda: shared.value


def member_filter(ids: DataFrame) -> Callable[[], np.ndarray]:
    """A filter over the ids (long, without nulls) in the one column of ``ids``, by their :func:`mix`."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            yield filter_cells(mix(rows.column(0).to_numpy().view(np.uint64)))

    return shared_filter(ids.mapInArrow(cells, "cell int, mask long"))
