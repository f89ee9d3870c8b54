"""Language identification of words and texts with a linear-chain conditional random field.

Every word's state is a language.  A word's emission scores are sums of learned
weights of its prefixes, suffixes, character n-grams and, for words of the
learned lexicon, the word itself; learned transitions tie neighbours together.
Training makes code-switched sequences from stretches of training documents of
different languages and follows the gradient of the conditional likelihood,
which forward-backward gives.  Prediction runs forward-backward over each whole
text and adds up the words' marginals.

Only a bounded sample trains the model: about ``PER_LANGUAGE`` documents of each
language, of each at most ``TRAIN_WORDS`` words from a place drawn by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, mix, text_batches, word_array

PER_LANGUAGE, TRAIN_WORDS = 300, 120
#: Hashed weights of affixes and n-grams; words of the lexicon need so many uses in the sample.
WEIGHTS, LEXICON_USES = 1 << 16, 3
AFFIXES, GRAMS = (1, 2, 3, 4), (1, 2, 3)
SEQUENCE, STRETCH, EPOCHS, RATE = 64, 16, 4, 0.5
UNKNOWN = "und"


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The words of the texts (lower-cased later) as one Arrow array, and the n + 1 borders between texts."""
    space = np.zeros(256, bool)
    space[[0x20, 9, 10, 11, 12, 13]] = True
    inside = ~space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside & (edge[:-1] | np.concatenate(([True], ~inside[:-1])))
    stops = inside & (edge[1:] | np.concatenate((~inside[1:], [True])))
    at, to = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    borders = np.searchsorted(at, offsets)
    lengths = to - at
    place = np.concatenate(([0], np.cumsum(lengths)))
    flat = data[inside]
    words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(place.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat)))
    return words, borders


def word_features(words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(feature, word of each feature, word hash, has a letter) of distinct words: hashed affixes and n-grams."""
    lower = pc.utf8_lower(words)
    letters = pc.match_substring_regex(words, r"\p{L}").to_numpy(zero_copy_only=False)
    lengths = np.diff(np.frombuffer(lower.buffers()[1], np.int64)[lower.offset: lower.offset + len(lower) + 1])
    raw = np.frombuffer(lower.buffers()[2] or b"", np.uint8)[: int(lengths.sum())].astype(np.uint64)
    start = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(len(raw)) - start[owner]
    left = lengths[owner] - inside
    features, owners = [], []
    whole = np.zeros(len(lengths), np.uint64)
    code = mix(raw + np.uint64(1))
    np.add.at(whole, owner, mix(code + inside.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    gram = np.zeros(len(raw), np.uint64)
    for n in range(1, max(*AFFIXES, *GRAMS) + 1):
        m = len(raw) - n + 1
        if m <= 0:
            break
        gram = mix(gram[:m] * np.uint64(0xD6E8FEB86659FD93) + code[n - 1:])
        fits = left[:m] >= n
        kinds = ([(1, fits)] if n in GRAMS else []) + ([(2, fits & (inside[:m] == 0)), (3, fits & (left[:m] == n))] if n in AFFIXES else [])
        for kind, on in kinds:
            at = np.flatnonzero(on)
            features.append((mix(gram[at] + np.uint64(kind * 97 + n)) % np.uint64(WEIGHTS)).astype(np.int64))
            owners.append(owner[at])
    if not features:
        return np.empty(0, np.int64), np.empty(0, np.int64), whole, letters
    features, owners = np.concatenate(features), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return features[order], owners[order], whole, letters


class Model:
    """Learned weights; ``languages`` in code-point order."""

    def __init__(self, languages: list[str], lexicon: np.ndarray):
        k = len(languages)
        self.languages, self.lexicon = languages, lexicon  # lexicon: sorted word hashes
        self.weights = np.zeros((WEIGHTS, k), np.float32)
        self.words = np.zeros((len(lexicon) + 1, k), np.float32)  # the last stands for words outside
        self.moves, self.first = np.zeros((k, k)), np.zeros(k)

    def entry(self, whole: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.lexicon, whole), max(len(self.lexicon) - 1, 0))
        return np.where(self.lexicon[at] == whole, at, len(self.lexicon)) if len(self.lexicon) else np.zeros(len(whole), np.int64)

    def emissions(self, features: np.ndarray, owners: np.ndarray, whole: np.ndarray, letters: np.ndarray) -> np.ndarray:
        out = np.empty((len(whole), len(self.languages)))
        for k in range(out.shape[1]):
            out[:, k] = np.bincount(owners, self.weights[features, k], minlength=len(whole))
        counts = np.maximum(np.bincount(owners, minlength=len(whole)), 1)
        out = out / np.sqrt(counts)[:, None] + self.words[self.entry(whole)]
        out[~letters] = 0  # a word without a letter speaks for no language
        return out


def marginals(scores: np.ndarray, borders: np.ndarray, moves: np.ndarray, first: np.ndarray, pairs: bool = False):
    """State probabilities of every word of many sequences by scaled forward-backward, all sequences in step.

    With ``pairs`` also the expected moves, summed over all sequences.
    """
    sizes = np.diff(borders)
    order = np.argsort(-sizes, kind="stable")
    start, sizes = borders[:-1][order], sizes[order]
    local = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
    step = np.exp(moves - moves.max())
    begin = np.exp(first - first.max())
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")  # sequences with a word at t
    forward = np.empty_like(local)
    state = None
    for t in range(steps):
        n = active[t]
        at = start[:n] + t
        state = (begin if t == 0 else state[:n] @ step) * local[at]
        state /= state.sum(axis=1, keepdims=True)
        forward[at] = state
    back = np.ones((len(sizes), len(moves)))
    expected = np.zeros_like(moves)
    out = np.empty_like(local)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = start[:n] + t
        both = forward[at] * back[:n]
        out[at] = both / both.sum(axis=1, keepdims=True)
        if t:
            seen = local[at] * back[:n]
            if pairs:
                before = forward[at - 1]
                norm = np.einsum("ni,ij,nj->n", before, step, seen)
                expected += np.einsum("ni,ij,nj->ij", before / norm[:, None], step, seen)
            new = seen @ step.T
            back[:n] = new / new.sum(axis=1, keepdims=True)
    return (out, expected) if pairs else out


def train(samples: list[tuple[str, list[str]]]) -> Model | None:
    """A model from (language, words) stretches; None without any."""
    samples = sorted((lang, words) for lang, words in samples if words)
    languages = sorted({lang for lang, _ in samples})
    if not languages:
        return None
    random = np.random.default_rng(7)
    parts = [(languages.index(lang), words[i: i + STRETCH]) for lang, words in samples for i in range(0, len(words), STRETCH)]
    order = random.permutation(len(parts))
    tokens, states, borders = [], [], [0]
    for p in order:
        state, words = parts[p]
        tokens += words
        states += [state] * len(words)
        if len(tokens) - borders[-1] >= SEQUENCE:
            borders.append(len(tokens))
    if borders[-1] < len(tokens):
        borders.append(len(tokens))
    coded = pa.array(tokens, pa.large_string()).dictionary_encode()
    features, owners, whole, letters = word_features(coded.dictionary)
    which, states, borders = coded.indices.to_numpy(), np.array(states), np.array(borders)
    uses = np.bincount(which, minlength=len(whole))
    model = Model(languages, np.unique(whole[(uses >= LEXICON_USES) & letters]))
    entry, k = model.entry(whole), len(languages)
    spans = np.searchsorted(owners, np.arange(len(whole) + 1))
    share = 1 / np.sqrt(np.maximum(np.diff(spans), 1))
    squares = [np.full(x.shape, 1e-3) for x in (model.weights, model.words, model.moves, model.first)]
    truth = np.eye(k)[states]
    batch = 64
    for _ in range(EPOCHS):
        for chunk in np.array_split(random.permutation(len(borders) - 1), max(1, (len(borders) - 1) // batch)):
            at = np.concatenate([np.arange(borders[c], borders[c + 1]) for c in chunk])
            sizes = np.array([borders[c + 1] - borders[c] for c in chunk])
            inner = np.concatenate(([0], np.cumsum(sizes)))
            used, local = np.unique(which[at], return_inverse=True)
            rows = np.concatenate([np.arange(spans[u], spans[u + 1]) for u in used])
            own = np.repeat(np.arange(len(used)), spans[used + 1] - spans[used])
            scores = model.emissions(features[rows], own, whole[used], letters[used])
            found, expected = marginals(scores[local], inner, model.moves, model.first, pairs=True)
            error = (truth[at] - found) * letters[which[at]][:, None]
            by_word = np.zeros((len(used), k))
            np.add.at(by_word, local, error)
            real = np.zeros((k, k))
            follows = np.setdiff1d(np.arange(len(at)), inner[:-1])
            np.add.at(real, (states[at[follows - 1]], states[at[follows]]), 1)
            grads = [np.zeros_like(model.weights), np.zeros_like(model.words), real - expected - 0.01 * model.moves,
                     (truth[at] - found)[inner[:-1]].sum(axis=0)]
            np.add.at(grads[0], features[rows], (by_word * share[used][:, None])[own].astype(np.float32))
            np.add.at(grads[1], entry[used], by_word.astype(np.float32))
            for value, grad, square in zip((model.weights, model.words, model.moves, model.first), grads, squares, strict=True):
                square += grad * grad
                value += (RATE * grad / np.sqrt(square)).astype(value.dtype)
    return model


def learn(docs: DataFrame) -> Model | None:
    """The model from rows of ``docs`` with a doc_id whose crc32 modulo 5 is not 0, a lang and a letter in the text."""
    known = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
                       & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    if not counts:
        return None
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 30))
    chosen = F.lit(False)
    for lang, n in sorted(counts.items()):
        chosen = chosen | ((F.col("lang") == lang) & (drawn < int(min(1.0, PER_LANGUAGE / n) * (1 << 30)) + 1))
    words = word_array(F.col("text"))
    some = known.where(chosen).select("doc_id", "lang", words.alias("words"))
    place = F.pmod(F.xxhash64("doc_id", F.lit("place")), F.greatest(F.size("words") - TRAIN_WORDS, F.lit(0)) + 1).cast("int")
    rows = some.select("doc_id", "lang", F.slice("words", place + 1, TRAIN_WORDS).alias("words")).collect()  # the bounded sample
    samples = [(r["lang"], [w for w in r["words"]]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["words"]))]
    return train([(lang, words) for lang, words in samples if any(c.isalpha() for w in words for c in w)])


def predict(docs: DataFrame, model: Model | None, words: bool = False) -> DataFrame:
    """doc_id, lang_pred and score (mean marginal of the language over words with a letter) of every row.

    Only the text is looked at.  A null text, one without a letter, or no
    model gives ``und`` and 0.  With ``words`` also word_langs, the most
    likely language of each word in order (null for words without a letter).
    """
    kind = "doc_id long, lang_pred string, score double" + (", word_langs array<string>" if words else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_batches(batches):
            n = len(offsets) - 1
            pred, score = [UNKNOWN] * n, np.zeros(n)
            labels: list = [[] for _ in range(n)]
            if model is not None:
                tokens, borders = split_words(data, offsets)
                coded = tokens.dictionary_encode()
                features, owners, whole, letters = word_features(coded.dictionary)
                which = coded.indices.to_numpy()
                found = marginals(model.emissions(features, owners, whole, letters)[which], borders, model.moves, model.first)
                speaks = letters[which] if len(which) else np.empty(0, bool)
                sums = np.concatenate((np.zeros((1, len(model.languages))), np.cumsum(found * speaks[:, None], axis=0)))
                total = sums[borders[1:]] - sums[borders[:-1]]
                count = np.concatenate(([0], np.cumsum(speaks)))
                count = count[borders[1:]] - count[borders[:-1]]
                best = total.argmax(axis=1)
                pred = [model.languages[b] if c else UNKNOWN for b, c in zip(best, count, strict=True)]
                score = np.clip(np.where(count > 0, total[np.arange(n), best] / np.maximum(count, 1), 0), 0, 1)
                if words:
                    top = found.argmax(axis=1)
                    labels = [[model.languages[top[i]] if speaks[i] else None for i in range(a, b)] for a, b in zip(borders[:-1], borders[1:], strict=True)]
            out = [rows.column("doc_id"), pa.array(pred, pa.string()), pa.array(score)]
            names = ["doc_id", "lang_pred", "score"]
            if words:
                out.append(pa.array(labels, pa.list_(pa.string())))
                names.append("word_langs")
            yield pa.RecordBatch.from_arrays(out, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, kind)


def identify(docs: DataFrame, words: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs``, from a model learned on its own training rows.

    A null doc_id is held out.  Repeated rows get equal rows; other columns
    are ignored; an empty table gives an empty result.
    """
    found = predict(docs, learn(docs), words)
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", *(["word_langs"] if words else []))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return identify(documents(spark, sf_dir))
