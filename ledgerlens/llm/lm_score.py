"""Masked pseudo-likelihood of documents under a bidirectional window network.

The network sees the ``SIDE`` tokens on both sides of a hidden one and predicts
it: each context place has its own map from token vectors to the hidden layer,
tanh, then a softmax over all tokens, taken in two steps (the token's class,
then the token within its class), which costs twice the square root of a plain
one.  A document's score is the sum of the log-probabilities of all its tokens,
each given its neighbours.

Tokens are lower-cased words.  The ``CLASSES`` squared most frequent words of
the corpus, less one, are tokens; counts cover all documents.  Any other word is
the token for unknown words, and then spelled: its bytes follow a table of byte
pairs counted over all such words.  So every word has a probability of its own,
and the probabilities of all words sum to one.

Every place of every text trains once.  Texts are cut into pieces that carry the
neighbours of their first and last places; pieces are dealt by hash into
``ROUNDS`` rounds and into shards of bounded size.  In each round every shard
trains its own copy of the network on the round's pieces, in steps that take
places from all along their hash order, and the copies are averaged in a tree of
sums, each token's weights by how often the shard has used them.  Neither shards
nor orders depend on how the rows lie in tasks, so scores agree for any
partitioning up to the rounding of sums.  The network starts as the unigram model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, mix, shared_table, text_batches
from .langid import split_words

SIDE, CLASSES, HIDDEN = 2, 165, 16
TOKENS = CLASSES * CLASSES
#: Token of unknown words, and what stands beyond a text's ends.
UNKNOWN, PAD = 0, TOKENS
#: Places of a shard on average; of a piece at most; rounds; places of a step at most and steps of a shard at least; learning rate.
SHARD, PIECE, ROUNDS, BATCH, LEAST, RATE = 10 << 20, 4096, 2, 1 << 13, 320, 0.1
#: Shards whose copies are added up in one task of the tree, and tokens of a block of weights.
FAN, BLOCK = 64, 4096
BLOCKS = TOKENS // BLOCK + 2
#: Texts worked on at once (bytes), and counted words that a task holds back at most.
CHUNK, HELD = 6 << 20, 1_000_000
#: Neighbours' distances, and rows of a softmax that fit a processor's cache.
STEPS, ROWS = [*range(-SIDE, 0), *range(1, SIDE + 1)], 256


class Words:
    """The tokens' words, and the byte pairs by which other words are spelled."""

    def __init__(self, counts: dict[bytes, int], total: int, spelling: np.ndarray):
        self.known = pa.array(list(counts), pa.large_binary())
        # Every token may occur: unknown words take what the known ones leave, and half an occurrence each is added.
        seen = np.full(TOKENS, 0.5)
        seen[1: len(counts) + 1] += list(counts.values())
        seen[UNKNOWN] += max(total - sum(counts.values()), 0)
        self.prior = np.log(seen / seen.sum())
        # From each byte (256: the beginning) to each byte (256: the end).
        self.spelling = np.log((spelling + 0.5) / (spelling + 0.5).sum(axis=1, keepdims=True))

    def spelled(self, raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log-probability of the spelling of words, back to back in ``raw`` with their n + 1 borders."""
        first, last = ends[:-1], ends[1:]
        before = np.concatenate(([256], raw[:-1])).astype(np.int64) if len(raw) else np.empty(0, np.int64)
        before[first[first < last]] = 256
        sums = np.concatenate(([0.0], np.cumsum(self.spelling[before, raw.astype(np.int64)])))
        final = np.where(first < last, raw[np.maximum(last - 1, 0)] if len(raw) else 256, 256).astype(np.int64)
        return sums[last] - sums[first] + self.spelling[final, 256]


def _distinct_words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct lower-cased words as binary, each word's number, the n + 1 borders between texts)."""
    data = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data).astype(np.uint8)
    words, borders = split_words(data, offsets)
    coded = words.cast(pa.large_binary()).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), borders


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    slices = (b.slice(at, 512) for b in batches for at in range(0, len(b), 512))
    return text_batches(slices, limit=CHUNK)


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` (binary) and ``count`` of all lower-cased words; summed inside the tasks first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def flush() -> Iterator[pa.RecordBatch]:
            whole = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("count", "sum")])
            held.clear()
            yield from whole.rename_columns(["word", "count"]).select(["word", "count"]).to_batches(max_chunksize=100_000)

        for _, data, offsets in _chunks(batches):
            distinct, number, _ = _distinct_words(data, offsets)
            held.append(pa.table({"word": distinct.cast(pa.binary()), "count": pa.array(np.bincount(number, minlength=len(distinct)), pa.int64())}))
            if sum(t.num_rows for t in held) >= HELD:
                yield from flush()
        if held:
            yield from flush()

    counted = docs.select("text").mapInArrow(run, "word binary, count long")
    return counted.repartition("word").groupBy("word").agg(F.sum("count").alias("count"))


def vocabulary(docs: DataFrame) -> tuple[Words, int]:
    """The tokens of a corpus and its number of words."""
    counts = shared_table(count_words(docs), "lm-words")
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    top = counts.orderBy(F.desc("count"), "word").limit(TOKENS - 1).collect()  # as many as there are tokens
    known = {bytes(r["word"]): r["count"] for r in top}

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((257, 257))
        for b in batches:
            for word, n in zip(b.column("word").to_pylist(), b.column("count").to_pylist(), strict=True):
                if word not in known:
                    spelled = np.frombuffer(word, np.uint8)
                    np.add.at(table, (np.concatenate(([256], spelled)), np.concatenate((spelled, [256]))), n)
        cells = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(table.ravel()[cells].astype(np.int64))], names=["cell", "count"])

    spelling = np.zeros(257 * 257)
    for r in counts.mapInArrow(pairs, "cell int, count long").groupBy("cell").agg(F.sum("count").alias("count")).collect():  # 66,049 cells at most
        spelling[r["cell"]] = r["count"]
    return Words(known, total, spelling.reshape(257, 257)), total


def token_ids(data: np.ndarray, offsets: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens of all words, log-probability of each word's spelling, the n + 1 borders between texts)."""
    distinct, number, borders = _distinct_words(data, offsets)
    if not len(distinct):
        return np.empty(0, np.int64), np.empty(0), borders
    token = pc.fill_null(pc.index_in(distinct, value_set=words.known), UNKNOWN - 1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    ends = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset: distinct.offset + len(distinct) + 1]
    raw = np.frombuffer(distinct.buffers()[2] or b"", np.uint8)
    spelled = np.where(token == UNKNOWN, words.spelled(raw[ends[0]: ends[-1]], ends - ends[0]), 0.0)
    return token[number], spelled[number], borders


def contexts(ids: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """The 2 * SIDE neighbours of every place, ``PAD`` beyond the text's ends."""
    text = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
    out = np.full((len(ids), 2 * SIDE), PAD, np.int64)
    for c, step in enumerate(STEPS):
        here, there = (slice(-step, None), slice(None, step)) if step < 0 else (slice(None, -step), slice(step, None))
        same = text[here] == text[there]
        out[here, c] = np.where(same, ids[there], PAD)
    return out


# ------------------------------------------------------------------ the network

def start(words: Words) -> dict[str, np.ndarray]:
    """The unigram model: no weight looks at the context yet."""
    random = np.random.default_rng(11)
    prior = words.prior.reshape(CLASSES, CLASSES)
    mass = np.logaddexp.reduce(prior, axis=1)
    return {
        "vectors": (random.standard_normal((TOKENS + 1, HIDDEN)) * 0.3).astype(np.float32),
        "maps": (random.standard_normal((2 * SIDE, HIDDEN, HIDDEN)) * 0.3).astype(np.float32), "bias": np.zeros(HIDDEN, np.float32),
        "class_out": np.zeros((HIDDEN, CLASSES), np.float32), "class_prior": mass.astype(np.float32),
        # Weights of a token towards the hidden layer, and its prior, by class.
        "out": np.zeros((CLASSES, CLASSES, HIDDEN), np.float32), "prior": (prior - mass[:, None]).astype(np.float32),
    }


def _log_softmax_at(logits: np.ndarray, at: np.ndarray, small: bool) -> np.ndarray:
    """log softmax of each row at one column; ``logits`` is overwritten.  ``small``: their exponentials can't overflow."""
    if not small:
        logits -= logits.max(axis=1, keepdims=True)
    own = logits[np.arange(len(logits)), at]
    return own - np.log(np.exp(logits, out=logits).sum(axis=1))


def _bound(out: np.ndarray, prior: np.ndarray) -> float:
    """What no logit exceeds in size, as the hidden layer lies between -1 and 1."""
    return float((np.abs(out).sum(axis=-1) + np.abs(prior)).max())


def _stable_order(tokens: np.ndarray) -> np.ndarray:
    return np.argsort(tokens.astype(np.uint16), kind="stable")  # numpy sorts 16 bits by radix


def _stretches(ordered: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, first row, row behind the last) of each distinct value, ``ROWS`` rows at most."""
    cuts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1], [True]))) if len(ordered) else np.array([0])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        for first in range(a, b, ROWS):
            yield int(ordered[a]), first, min(first + ROWS, b)


def log_probabilities(net: dict, ids: np.ndarray, around: np.ndarray, chunk: int = 1 << 16) -> np.ndarray:
    """Of every token given its neighbours."""
    out = np.empty(len(ids))
    tables = np.einsum("tv,cvh->cth", net["vectors"], net["maps"])
    small = max(_bound(net["class_out"].T, net["class_prior"]), _bound(net["out"], net["prior"])) < 60
    for first in range(0, len(ids), chunk):
        # Places in the order of their tokens, so that each class is one stretch.
        order = _stable_order(ids[first: first + chunk])
        x, y = around[first: first + chunk][order], ids[first: first + chunk][order]
        h = np.broadcast_to(net["bias"], (len(x), HIDDEN)).copy()
        for c in range(2 * SIDE):
            h += tables[c][x[:, c]]
        np.tanh(h, out=h)
        kind, inside = np.divmod(y, CLASSES)
        score = np.empty(len(y))
        for a in range(0, len(y), ROWS):
            score[a: a + ROWS] = _log_softmax_at(h[a: a + ROWS] @ net["class_out"] + net["class_prior"], kind[a: a + ROWS], small)
        for k, a, b in _stretches(kind):
            score[a:b] += _log_softmax_at(h[a:b] @ net["out"][k].T + net["prior"][k], inside[a:b], small)
        out[first: first + chunk][order] = score
    return out


def _errors(logits: np.ndarray, at: np.ndarray, n: int, small: bool) -> np.ndarray:
    """Gradient of the mean (over ``n`` rows) cross-entropy by the logits, which are overwritten."""
    if not small:
        logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits *= np.float32(1 / n) / (logits @ np.ones((logits.shape[1], 1), np.float32))
    logits[np.arange(len(logits)), at] -= np.float32(1 / n)
    return logits


def train_copy(net: dict, ids: np.ndarray, places: np.ndarray) -> dict:
    """One pass of minibatch AdaGrad from ``net`` over ``places`` of ``ids``; each step takes places from all along them."""
    # A prior is the weight of one more hidden unit, which is always 1.
    own = {"vectors": net["vectors"].copy(), "maps": net["maps"].reshape(-1, HIDDEN).copy(), "bias": net["bias"].copy(),
           "classes": np.concatenate((net["class_out"], net["class_prior"][None]), axis=0), "out": np.concatenate((net["out"], net["prior"][:, :, None]), axis=2)}
    squares = {k: np.full(v.shape, 1e-2, np.float32) for k, v in own.items()}

    def step(name: str, grad: np.ndarray, at=...) -> None:
        squares[name][at] += grad * grad
        grad *= np.float32(RATE)
        grad /= np.sqrt(squares[name][at])
        own[name][at] -= grad

    steps = -(-len(places) // min(BATCH, max(len(places) // LEAST, BATCH // 32)))
    for number in range(steps):
        at = places[number::steps]
        at = at[_stable_order(ids[at])]
        y, n = ids[at].astype(np.int64), len(at)
        x = np.stack([ids[at + s] for s in STEPS], axis=1)
        kind, inside = np.divmod(y, CLASSES)
        seen = own["vectors"][x].reshape(n, 2 * SIDE * HIDDEN)
        h = np.ones((n, HIDDEN + 1), np.float32)
        h[:, :HIDDEN] = np.tanh(seen @ own["maps"] + own["bias"])
        small = max(np.abs(own["classes"]).sum(axis=0).max(), np.abs(own["out"]).sum(axis=2).max()) < 60  # exponentials can't overflow
        down = np.empty((n, HIDDEN), np.float32)
        classes, out = np.zeros_like(own["classes"]), np.zeros_like(own["out"])
        for a in range(0, n, ROWS):
            some = slice(a, a + ROWS)
            p = _errors(h[some] @ own["classes"], kind[some], n, small)
            down[some] = p @ own["classes"][:HIDDEN].T
            classes += h[some].T @ p
        for k, a, b in _stretches(kind):
            q = _errors(h[a:b] @ own["out"][k].T, inside[a:b], n, small)
            down[a:b] += (q @ own["out"][k])[:, :HIDDEN]
            out[k] += q.T @ h[a:b]
        down *= 1 - h[:, :HIDDEN] * h[:, :HIDDEN]
        back = (down @ own["maps"].T).reshape(-1, HIDDEN)
        flat = x.ravel()
        order = _stable_order(flat)
        ordered = flat[order]
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        rows = np.add.reduceat(back[order], first, axis=0)
        for name, grad, some in (("maps", seen.T @ down, ...), ("bias", down.sum(axis=0), ...), ("classes", classes, ...), ("out", out, ...), ("vectors", rows, ordered[first])):
            step(name, grad, some)
    return {"vectors": own["vectors"], "maps": own["maps"].reshape(net["maps"].shape), "bias": own["bias"],
            "class_out": own["classes"][:HIDDEN], "class_prior": own["classes"][HIDDEN], "out": own["out"][:, :, :HIDDEN], "prior": own["out"][:, :, HIDDEN]}


# ------------------------------------------------------------------ training on Spark

def _packed(net: dict, base: dict, ids: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(block, bytes) of what a copy has changed, times its weights, and the weights: sums of these are all that an average needs."""
    n = float(len(places))
    dense = np.concatenate([(net[k] - base[k]).ravel() for k in ("maps", "bias", "class_out", "class_prior")])
    yield -1, np.concatenate((dense * n, [n])).astype("<f4").tobytes()
    met = sum(np.bincount(ids[places + s], minlength=TOKENS + 1) for s in STEPS).astype(np.float32)
    aimed = np.repeat(np.bincount(ids[places] // CLASSES, minlength=CLASSES), CLASSES).astype(np.float32)
    vectors = (net["vectors"] - base["vectors"]) * met[:, None]
    outs = np.concatenate(((net["out"] - base["out"]).reshape(TOKENS, HIDDEN), (net["prior"] - base["prior"]).reshape(TOKENS, 1)), axis=1) * aimed[:, None]
    for at in range(0, TOKENS + 1, BLOCK):
        some = slice(at, at + BLOCK)
        if met[some].any() or aimed[some].any():
            yield at // BLOCK, np.concatenate([a[some].ravel() for a in (met, vectors, aimed, outs)]).astype("<f4").tobytes()


def _added(kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums (as doubles) of the blocks of one number; rows come sorted by it, and one block at a time is in memory."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.empty(0)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.astype("<f8").tobytes()], pa.binary())], names=["block", "sums"])

        for b in batches:
            for number, raw in zip(b.column("block").to_pylist(), b.column("sums"), strict=True):
                values = np.frombuffer(raw.as_buffer(), kind)
                if number != now:
                    if now is not None:
                        yield done()
                    now, total = number, np.zeros(len(values))
                total += values
        if now is not None:
            yield done()
    return run


def examples_of(docs: DataFrame, words: Words, shards: int) -> DataFrame:
    """All places: pieces of all texts with their ``round``, ``shard``, ``key`` and ``ids``.

    ``ids`` are 16-bit tokens, ``SIDE`` more at either end than the piece has
    places.  A text's copies differ in their doc_id and so lie in many shards.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in _chunks(batches):
            ids, _, borders = token_ids(data, offsets, words)
            raw = memoryview(np.ascontiguousarray(data))
            name = np.array([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], np.uint64)
            count = -(-np.diff(borders) // PIECE)
            text = np.repeat(np.arange(len(count)), count)
            if not len(text):
                continue
            number = np.arange(len(text)) - (np.cumsum(count) - count)[text]
            key = mix(name[text] + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            own = pc.fill_null(rows.column("doc_id"), 0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            dealt = mix(key ^ mix(own[text] + np.uint64(1)))
            ids = np.concatenate((np.full(SIDE, PAD), ids, np.full(SIDE, PAD))).astype("<i2")
            first = borders[text] + number * PIECE
            stop = np.minimum(first + PIECE, borders[text + 1])
            pieces = []
            for a, b, lo, hi in zip(first.tolist(), stop.tolist(), borders[text].tolist(), borders[text + 1].tolist(), strict=True):
                piece = ids[a: b + 2 * SIDE].copy()
                # Beyond the text's ends stand the neighbouring texts' tokens.
                piece[: max(lo - a + SIDE, 0)] = PAD
                piece[len(piece) - max(b + SIDE - hi, 0):] = PAD
                pieces.append(piece.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array((dealt % np.uint64(ROUNDS)).astype(np.int32)), pa.array((dealt // np.uint64(ROUNDS) % np.uint64(shards)).astype(np.int32)),
                 pa.array(dealt.view(np.int64)), pa.array(pieces, pa.binary())], names=["round", "shard", "key", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "round int, shard int, key long, ids binary")


def _places(sizes: np.ndarray) -> np.ndarray:
    """Where pieces of ``sizes`` tokens, back to back, have their own places."""
    ends = np.cumsum(sizes)
    own = np.ones(int(sizes.sum()), bool)
    for j in range(SIDE):
        own[ends - sizes + j] = False
        own[ends - 1 - j] = False
    return np.flatnonzero(own).astype(np.int32)


def _shard_copy(shared) -> Callable[[pa.Table], pa.Table]:
    """What a shard's copy has changed, from the broadcast network."""
    def copy(table: pa.Table) -> pa.Table:
        group = table.column("shard")[0].as_py() // FAN
        pieces = sorted(zip(table.column("key").to_pylist(), table.column("ids").to_pylist(), strict=True))
        ids = np.frombuffer(b"".join(x for _, x in pieces), "<i2")
        places = _places(np.array([len(x) // 2 for _, x in pieces], np.int64))
        base = shared.value
        blocks = list(_packed(train_copy(base, ids, places), base, ids, places))
        return pa.table({"group": pa.array([group] * len(blocks), pa.int32()), "block": pa.array([b for b, _ in blocks], pa.int32()),
                         "sums": pa.array([s for _, s in blocks], pa.binary())})
    return copy


def train(docs: DataFrame, words: Words, total: int) -> dict[str, np.ndarray]:
    """The averaged network after ``ROUNDS`` rounds; ``total``: the corpus's words."""
    spark = docs.sparkSession
    shards = max(1, -(-total // SHARD))
    dealt = shared_table(examples_of(docs, words, shards), "lm-examples")
    net = start(words)
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast(net)

        # A tree of sums: the copies of FAN shards first, then those sums.
        copies = shared_table(dealt.where(F.col("round") == turn).drop("round").groupBy("shard").applyInArrow(_shard_copy(shared), "group int, block int, sums binary"), "lm-copies")
        some = copies.select((F.col("group") * BLOCKS + F.col("block") + 1).alias("block"), "sums").repartition("block").sortWithinPartitions("block")
        some = some.mapInArrow(_added("<f4"), "block int, sums binary").select((F.col("block") % BLOCKS - 1).alias("block"), "sums")
        whole = some.repartition("block").sortWithinPartitions("block").mapInArrow(_added("<f8"), "block int, sums binary").collect()  # the network's size
        if not whole:
            continue
        net = {k: v.copy() for k, v in net.items()}
        for r in whole:
            sums = np.frombuffer(r["sums"], "<f8")
            if r["block"] == -1:
                mean, at = sums[:-1] / sums[-1], 0
                for k in ("maps", "bias", "class_out", "class_prior"):
                    net[k] += mean[at: at + net[k].size].reshape(net[k].shape).astype(np.float32)
                    at += net[k].size
                continue
            some = slice(r["block"] * BLOCK, min((r["block"] + 1) * BLOCK, TOKENS + 1))
            n, m = some.stop - some.start, min(some.stop, TOKENS) - some.start
            met, vectors, aimed, outs = np.split(sums, np.cumsum([n, n * HIDDEN, m]))
            net["vectors"][some] += (vectors.reshape(n, HIDDEN) / np.maximum(met, 1)[:, None]).astype(np.float32)
            mean = (outs.reshape(m, HIDDEN + 1) / np.maximum(aimed, 1)[:, None]).astype(np.float32)
            net["out"].reshape(TOKENS, HIDDEN)[some.start: some.start + m] += mean[:, :HIDDEN]
            net["prior"].reshape(TOKENS)[some.start: some.start + m] += mean[:, HIDDEN]
    return net


def score(docs: DataFrame, net: dict, words: Words) -> DataFrame:
    """doc_id, n_tokens, log_prob (summed) and mean_log_prob of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((net, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, words = shared.value
        for rows, data, offsets in _chunks(batches):
            ids, spelled, borders = token_ids(data, offsets, words)
            sums = np.concatenate(([0.0], np.cumsum(log_probabilities(net, ids, contexts(ids, borders)) + spelled)))
            total, sizes = sums[borders[1:]] - sums[borders[:-1]], np.diff(borders)
            mean = pa.array(total / np.maximum(sizes, 1), mask=sizes == 0)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(np.where(sizes > 0, total, 0.0)), mean],
                                             ["doc_id", "n_tokens", "log_prob", "mean_log_prob"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, log_prob double, mean_log_prob double")


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of ``docs`` under a network trained on them.

    A null or empty text has no tokens, log_prob 0 and a null mean.  Repeated
    rows get equal scores; a null doc_id is scored like any other; other
    columns, of any name, are ignored; texts of any length are scored whole;
    an empty table gives an empty result.
    """
    words, total = vocabulary(docs)
    return score(docs, train(docs, words, total), words)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-log-likelihood of every document."""
    return score_documents(documents(spark, sf_dir))
