"""Batch text inference: prompts, a pluggable scorer, a Spark-native sentiment.

The reference enriches rows with model-backed SQL functions (a generic model
query, sentiment analysis, text generation).  No hosted model ships here, so
the model is an interface:

* ``scorer``: a callable ``Iterator[pd.Series] -> Iterator[pd.Series]`` run as
  an Arrow-batched iterator pandas UDF (a model loads once per task, not per
  row).  It is marked nondeterministic so Catalyst never re-runs or duplicates
  it.
* :func:`score_text` applies the rules that keep model calls cheap and
  correct: NULL prompts are not sent (NULL out), each distinct prompt is
  scored once (distinct -> score -> join back by hash and text), and callers
  cut ``ORDER BY ... LIMIT`` *before* scoring (Catalyst would otherwise place
  the limit above the UDF and score every row).

:func:`lexicon_sentiment` is the default sentiment model: whole-text tokens
matched against fixed word lists with higher-order array functions, entirely
JVM-side (no Python, no shuffle), labelling positive / negative / mixed /
neutral.  On the driver's invented prose it flags the insulting (toxic)
texts as negative and leaves most others neutral; it is a deterministic
stand-in, not a language model.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Scorer = Callable[[Iterator[pd.Series]], Iterator[pd.Series]]

# The default sentiment lexicon (lower-case English words).
POSITIVE_WORDS = (
    "good", "great", "excellent", "amazing", "awesome", "best", "love", "loved", "lovely",
    "friendly", "delicious", "tasty", "fresh", "fast", "clean", "nice", "perfect", "happy",
    "recommend", "wonderful", "fantastic", "pleasant", "helpful", "cozy", "favorite",
)
NEGATIVE_WORDS = (
    "bad", "poor", "terrible", "awful", "worst", "hate", "hated", "rude", "slow", "dirty",
    "cold", "stale", "bland", "overpriced", "disappointing", "disappointed", "horrible",
    "unfriendly", "never", "noisy", "burnt", "wrong", "late", "broken", "sad",
    "trash", "worthless", "idiot", "scum", "moron", "pathetic", "clown", "disgusting", "stupid", "loser",
)
TOKEN_SPLIT = "[^a-z]+"


def tokens(col: Column | str) -> Column:
    """Lower-case ASCII word tokens of the whole text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.split(F.lower(c), TOKEN_SPLIT)


def _count_in(words: Column, lexicon) -> Column:
    lex = F.array(*[F.lit(w) for w in lexicon])
    return F.size(F.filter(words, lambda w: F.array_contains(lex, w)))


def lexicon_counts(col: Column | str) -> tuple[Column, Column]:
    words = tokens(col)
    return _count_in(words, POSITIVE_WORDS), _count_in(words, NEGATIVE_WORDS)


def lexicon_sentiment(col: Column | str) -> Column:
    """positive / negative / mixed / neutral from lexicon hits; NULL text -> NULL.

    The label only depends on whether any positive / negative word occurs, so
    each text is tested with ``arrays_overlap`` (a hash-set probe per token)
    instead of counting matches word by word.  The token array is bound once
    through a one-element ``transform``: written as plain ``CASE WHEN``
    branches, Spark would split the whole text again for every branch.
    """
    c = F.col(col) if isinstance(col, str) else col
    pos_lex = F.array(*[F.lit(w) for w in POSITIVE_WORDS])
    neg_lex = F.array(*[F.lit(w) for w in NEGATIVE_WORDS])

    def label(words: Column) -> Column:
        pos = F.arrays_overlap(words, pos_lex)
        neg = F.arrays_overlap(words, neg_lex)
        return (F.when(pos & neg, "mixed").when(pos, "positive")
                .when(neg, "negative").otherwise("neutral"))

    labelled = F.transform(F.array(tokens(c)), label)
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(F.element_at(labelled, 1))


def iterator_udf(scorer: Scorer, out_type: T.DataType | str = "string"):
    """``scorer`` as an iterator pandas UDF (Arrow batches in, Series out), nondeterministic.

    NULLs are taken out of every batch before the scorer sees it and put back
    afterwards; a conditional around the call would not do, as Spark
    evaluates a Python function for all rows of a batch.
    """
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        masks: deque = deque()

        def present() -> Iterator[pd.Series]:
            for s in batches:
                there = s.notna()
                masks.append(there)
                yield s[there].reset_index(drop=True)

        for scored in scorer(present()):
            there = masks.popleft()
            out = pd.Series([None] * len(there), dtype=object)
            out[there.to_numpy()] = scored.to_numpy()
            yield out if there.size != there.sum() else scored
    return F.pandas_udf(run, out_type).asNondeterministic()


def score_text(df: DataFrame, col: str, scorer: Scorer, out: str,
               out_type: T.DataType | str = "string", dedupe: bool = True) -> DataFrame:
    """Add column ``out`` = ``scorer(df[col])``.

    NULL inputs give NULL without a model call.  With ``dedupe`` every distinct
    text is scored once and joined back on ``(xxhash64(text), text)``.  The
    input plan feeds three branches (texts to score, rows to join back, NULL
    rows); it is meant to be a cut-down prompt set (after ``LIMIT`` or a
    filter) -- persist or checkpoint an expensive input first.
    """
    udf = iterator_udf(scorer, out_type)
    if not dedupe:
        return df.withColumn(out, udf(F.col(col)))
    keyed = df.withColumn("__h", F.xxhash64(col))
    present = keyed.where(F.col(col).isNotNull())
    # The scored side carries its own column names, so the join condition is
    # never an ambiguous self-reference of ``keyed``.
    scored = (present.select(F.col("__h").alias("__sh"), F.col(col).alias("__st")).distinct()
              .withColumn(out, udf(F.col("__st"))))
    # Every present text has exactly one scored row, so an inner join keeps all
    # rows; NULL texts are added back with a NULL score.  (An outer join here
    # would let a later ``.limit()`` be pushed into an input that ends in
    # ORDER BY ... LIMIT, where Spark 4.1's optimizer then drops that top-k.)
    joined = present.join(scored, (F.col("__h") == F.col("__sh")) & (F.col(col) == F.col("__st")), "inner")
    cols = [F.col(f"`{c}`") for c in df.columns]
    missing = keyed.where(F.col(col).isNull()).select(*cols, F.lit(None).cast(udf.returnType).alias(out))
    return joined.select(*cols, F.col(out)).unionByName(missing)


# ------------------------------------------------------------------ default scorers

_WORD = re.compile(r"[^\W\d_]{4,}", re.UNICODE)


def keyword_generator(prefix: str = "") -> Scorer:
    """A deterministic stand-in for a text generator.

    For each prompt it returns ``prefix`` plus the word count and the three
    most frequent words (4+ letters) of the whole prompt.  Replace with a real
    model scorer of the same shape.
    """
    def gen(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = []
            for text in s:
                if text is None:
                    out.append(None)
                    continue
                words = [w.lower() for w in _WORD.findall(text)]
                top = ", ".join(w for w, _ in sorted(Counter(words).items(),
                                                      key=lambda kv: (-kv[1], kv[0]))[:3])
                out.append(f"{prefix}{len(text.split())} words; key terms: {top}")
            yield pd.Series(out)
    return gen


def lexicon_scorer() -> Scorer:
    """The lexicon sentiment as a pandas scorer (same labels as :func:`lexicon_sentiment`)."""
    pos, neg = set(POSITIVE_WORDS), set(NEGATIVE_WORDS)
    split = re.compile(TOKEN_SPLIT)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = []
            for text in s:
                if text is None:
                    out.append(None)
                    continue
                toks = split.split(text.lower())
                p = sum(t in pos for t in toks)
                n = sum(t in neg for t in toks)
                out.append("mixed" if p and n else "positive" if p else "negative" if n else "neutral")
            yield pd.Series(out)
    return score
