"""Quality rules as a learned decision list, with DataFrame functions only.

Every text becomes a few whole-text statistics in one pass of built-in
functions.  From the statistics of a bounded sample of labelled documents,
sequential covering learns rules that reject: grow a conjunction of threshold
conditions by information gain on two thirds of the sample, prune it from its
end on the other third, keep it while it is precise there, remove what it
covers, repeat.  The rules become one ordered Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, let, shared_table, word_array

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: At most so many labelled documents are learned from, chosen by hash; and so many flagged words.
SAMPLE, FLAGGED = 20_000, 256
#: Beside whole words, the first so many characters of longer words may be flagged, which catches inflected forms.
STEMS = (5, 6)
#: A rule holds at most so many conditions, and at least this share of the pruning rows that it covers are bad.
MAX_CONDITIONS, MIN_PRECISION, MIN_COVERED, MAX_RULES = 4, 0.97, 8, 32

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COUNTS = (*BASE, "n_lines", "n_letters", "n_upper", "n_digits", "n_marks", "n_distinct_words", "n_flagged")


def repeat_words(words: Column) -> Column:
    """Words that lie in a window of ``WINDOW`` words that the text has twice or more.

    Windows are told apart by 64-bit hashes.  Only a text with fewer distinct
    hashes than windows is looked at further: its hashes are sorted with their
    places, places next to an equal hash are kept and the words they cover
    counted from their gaps, so the work is n log n for a text of any length.
    """
    def hashed(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)]))

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            same = F.transform(s, lambda e, j: F.when(
                (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"]), e["i"]))
            return F.array_sort(F.filter(same, lambda i: i.isNotNull()))

        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(let(pairs, twice), start,
                           lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
                           lambda acc: acc["n"])

    none = F.lit(0).cast("long")
    return F.when(F.size(words) <= WINDOW, none).otherwise(
        let(hashed(words), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(h))))


def plain_word(word: Column) -> Column:
    """A word in lower case without what stands before its first or after its last ASCII letter or digit."""
    return F.trim(F.lower(word), F.lit("\"'.,;:!?()[]{}|#*$%&<>-_"))


def entries(plain: Column) -> Column:
    """What stands for a plain word in the list of flagged ones: itself, and its stems with a star."""
    stems = [F.when(F.length(plain) > n, F.concat(F.substring(plain, 1, n), F.lit("*"))) for n in STEMS]
    return F.array_compact(F.array(plain, *stems))


def is_flagged(plain: Column, flagged: list[str]) -> Column:
    whole = [x for x in flagged if not x.endswith("*")]
    out = plain.isin(whole) if whole else F.lit(False)
    for n in STEMS:
        stems = [x[:-1] for x in flagged if x.endswith("*") and len(x) == n + 1]
        if stems:
            out = out | ((F.length(plain) > n) & F.substring(plain, 1, n).isin(stems))
    return out


def statistics(text: Column, flagged: list[str]) -> Column:
    """A struct of :data:`COUNTS` (all long); a null text has no words and only zeros."""
    full = F.coalesce(text, F.lit(""))
    # Rare characters are found by a regular expression, which only makes what it finds; translate() makes every character anew.
    lines = F.filter(F.split(full, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def flagged_in(w: Column, distinct: Column) -> Column:
        """Occurrences of flagged words; most texts have none among their distinct words and are not looked at again."""
        found = F.filter(distinct, lambda x: is_flagged(plain_word(x), flagged))
        return let(found, lambda f: F.when(F.size(f) == 0, F.lit(0)).otherwise(F.size(F.filter(w, lambda x: F.array_contains(f, x)))))

    def counted(w: Column, distinct: Column) -> Column:
        names = {
            "n_words": F.size(w),
            "word_chars": F.length(F.array_join(w, "")),
            "n_symbols": F.regexp_count(full, F.lit(f"[{SYMBOLS}]")),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
            "n_repeat_words": repeat_words(w),
            "n_lines": F.size(F.split(full, "\n")),
            "n_letters": F.length(F.regexp_replace(full, "[^A-Za-z]+", "")),
            "n_upper": F.regexp_count(full, F.lit("[A-Z]")),
            "n_digits": F.regexp_count(full, F.lit("[0-9]")),
            "n_marks": F.regexp_count(full, F.lit("[.,;:!?]")),
            "n_distinct_words": F.size(distinct),
            "n_flagged": flagged_in(w, distinct) if flagged else F.lit(0),
        }
        return F.struct(*[names[c].cast("long").alias(c) for c in COUNTS])

    words = F.array_remove(F.split(full, r"[\x20\x09-\x0D]+"), "")
    return let(words, lambda w: let(F.array_distinct(w), lambda distinct: counted(w, distinct)))


#: What the rules look at: ratios of the counts, so that a long text is judged like a short one.
FEATURES = {
    "n_words": lambda c: c["n_words"],
    "symbols_per_word": lambda c: c["n_symbols"] / c["_words"],
    "dup_line_share": lambda c: c["n_dup_lines"] / c["_lines"],
    "repeat_share": lambda c: c["n_repeat_words"] / c["_words"],
    "chars_per_word": lambda c: c["word_chars"] / c["_words"],
    "upper_share": lambda c: c["n_upper"] / c["_letters"],
    "digit_share": lambda c: c["n_digits"] / c["_chars"],
    "marks_per_word": lambda c: c["n_marks"] / c["_words"],
    "words_per_line": lambda c: c["n_words"] / c["_lines"],
    "distinct_share": lambda c: c["n_distinct_words"] / c["_words"],
    "n_flagged": lambda c: c["n_flagged"],
    "flagged_share": lambda c: c["n_flagged"] / c["_words"],
}


def features(counts: dict) -> dict:
    """The rules' features from counts, as columns or as arrays."""
    def at_least_one(x):
        return F.greatest(x, F.lit(1)).cast("double") if isinstance(x, Column) else np.maximum(x, 1).astype(float)

    full = dict(counts) | {"_words": at_least_one(counts["n_words"]), "_lines": at_least_one(counts["n_lines"]),
                           "_letters": at_least_one(counts["n_letters"]), "_chars": at_least_one(counts["word_chars"])}
    return {name: make(full) for name, make in FEATURES.items()}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value >= threshold, else value < threshold
    threshold: float

    def holds(self, values):
        return values[self.feature] >= self.threshold if self.above else values[self.feature] < self.threshold


def _all(rule: list[Condition], values: dict, rows: int) -> np.ndarray:
    out = np.ones(rows, bool)
    for c in rule:
        out &= c.holds(values)
    return out


def _grow(values: dict, bad: np.ndarray, live: np.ndarray, steps: int = 24) -> list[Condition]:
    """Conditions by the greatest FOIL gain until none of the covered rows is good."""
    rule: list[Condition] = []
    while live.any() and len(rule) < MAX_CONDITIONS:
        p, n = int((bad & live).sum()), int((~bad & live).sum())
        if not p or not n:
            break
        best, gain = None, 1e-9
        for name, column in values.items():
            cuts = np.unique(np.concatenate((np.quantile(column[live], np.linspace(0, 1, steps)),
                                             np.quantile(column[live & bad], np.linspace(0, 1, steps)))))
            for cut in (cuts[1:] + cuts[:-1]) / 2:
                for above in (True, False):
                    on = live & Condition(name, above, float(cut)).holds({name: column})
                    p1, n1 = int((bad & on).sum()), int((~bad & on).sum())
                    if not p1:
                        continue
                    g = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
                    if g > gain:
                        best, gain = Condition(name, above, float(cut)), g
        if best is None:
            break
        rule.append(best)
        live = live & best.holds(values)
    return rule


def learn_rules(values: dict[str, np.ndarray], bad: np.ndarray) -> list[list[Condition]]:
    """An ordered list of rejecting rules by sequential covering; none from fewer than a few rows of either kind."""
    rows = len(bad)
    order = np.arange(rows) % 3  # rows come in hash order, so this split is random
    growing, pruning = order != 0, order == 0
    left = np.ones(rows, bool)
    rules: list[list[Condition]] = []

    def worth(rule: list[Condition]) -> tuple[float, int, int]:
        on = _all(rule, values, rows) & left
        p, n = int((on & bad & pruning).sum()), int((on & ~bad & pruning).sum())
        return (p - n) / max(p + n, 1), p, n

    while len(rules) < MAX_RULES and (left & growing & bad).sum() >= MIN_COVERED:
        rule = _grow(values, bad, left & growing)
        while len(rule) > 1 and worth(rule[:-1])[0] >= worth(rule)[0]:
            rule = rule[:-1]
        _, p, n = worth(rule)
        if not rule or p + n < MIN_COVERED / 2 or p < MIN_PRECISION * (p + n):
            break
        rules.append(rule)
        left &= ~_all(rule, values, rows)
    return rules


def decision(rules: list[list[Condition]], counts: dict[str, Column]) -> Column:
    """The number (from 1) of the first rule that holds, null if none does: one ordered CASE expression."""
    values = features(counts)
    out = None
    for i, rule in enumerate(rules, 1):
        hit = F.lit(True)
        for c in rule:
            hit = hit & c.holds(values)
        out = F.when(hit, F.lit(i)) if out is None else out.when(hit, F.lit(i))
    return F.lit(None).cast("int") if out is None else out


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """doc_id, text, toxic and bad (quality 0 or toxic) of at most ``limit`` labelled documents, chosen by the hash of doc_id.

    Rows with a null doc_id, null labels or contradicting ones are left out.
    """
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    known = known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.min("quality").alias("_q"), F.max("quality").alias("_q2"), F.min("toxic").alias("_t"), F.max("toxic").alias("_t2"))
    known = known.where("_q = _q2 and _t = _t2").select("_id", (F.col("_t") == 1).alias("toxic"), ((F.col("_q") == 0) | (F.col("_t") == 1)).alias("bad"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(limit)
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return some.join(F.broadcast(known), some["doc_id"] == known["_id"]).select("doc_id", "text", "toxic", "bad")  # at most SAMPLE pairs


def flagged_words(sample: DataFrame, limit: int = FLAGGED) -> list[str]:
    """Words and stems of the toxic sample that hardly any other document has: at most ``limit``, the most frequent first."""
    plain = F.transform(word_array(F.col("text")), plain_word)
    words = sample.select("toxic", F.explode(F.array_distinct(F.flatten(F.transform(plain, entries)))).alias("word"))
    counted = words.where(F.length("word") >= 3).groupBy("word").agg(F.count_if("toxic").alias("hits"), F.count_if(~F.col("toxic")).alias("others"))
    rows = sample.groupBy().agg(F.count_if("toxic").alias("toxic"), F.count_if(~F.col("toxic")).alias("other")).first()
    if not rows["toxic"]:
        return []
    ratio = (F.col("hits") / F.lit(float(rows["toxic"]))) / ((F.col("others") + 0.5) / F.lit(float(max(rows["other"], 1))))
    chosen = counted.where((F.col("hits") >= max(5, 0.005 * rows["toxic"])) & (ratio >= 20)).orderBy(F.desc("hits"), "word").limit(limit)
    return sorted(r["word"] for r in chosen.select("word").collect())


def learn(docs: DataFrame, labels: DataFrame) -> tuple[list[list[Condition]], list[str]]:
    """(rules, flagged words) from the labelled sample.

    What the base rules already reject is left out, so the list learns the rest.
    """
    sample = shared_table(labelled_sample(docs, labels), "labelled")
    flagged = flagged_words(sample)
    counts = sample.select("doc_id", "bad", statistics(F.col("text"), flagged).alias("s")).select("doc_id", "bad", "s.*")
    counts = shared_table(counts, "counts")  # else the filter and the sort's sampling would each make the statistics anew
    rows = counts.where(~base_failed(F.col)).orderBy(F.xxhash64("doc_id"), "doc_id", "bad").select("bad", *COUNTS).collect()  # numbers of at most SAMPLE documents
    if not rows:
        return [], flagged
    table = np.array([[int(x) for x in r] for r in rows], dtype=np.int64)
    return learn_rules(features(dict(zip(COUNTS, table[:, 1:].T, strict=True))), table[:, 0] == 1), flagged


def base_failed(c: Callable[[str], Column]) -> Column:
    return (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * c("n_words"))


def verdict(text: Column, rules: list[list[Condition]], flagged: list[str]) -> Column:
    """A struct of :data:`COUNTS`, base_failed, rule (the one that rejects, or null) and kept, as one expression.

    The statistics are bound to a variable, so a filter on the result that
    Spark moves below a projection does not evaluate them once per use.
    """
    def judged(s: Column) -> Column:
        few = base_failed(lambda c: s[c])
        rule = decision(rules, {c: s[c] for c in COUNTS})
        return F.struct(*[s[c].alias(c) for c in COUNTS], few.alias("base_failed"), rule.alias("rule"),
                        (~few & rule.isNull()).alias("kept"))

    return let(statistics(text, flagged), judged)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs``' doc_id and text with all :data:`COUNTS`, base_failed, rule (the one that rejects, or null) and kept.

    A null or empty text has no words and fails the base rules.  Every row of
    ``docs`` is judged on its own, repeated ones too; a null doc_id is judged
    like any other.  Without usable labels the base rules decide alone.  Other
    columns are ignored; an empty table gives an empty result.
    """
    rules, flagged = learn(docs, labels)
    return docs.select("doc_id", "text", verdict(F.col("text"), rules, flagged).alias("v")).select("doc_id", "text", "v.*")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    return judge(documents(spark, sf_dir), _labels(spark, sf_dir)).select("doc_id", *BASE, "base_failed", "kept", "rule")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the base rules and the learned list keep, with their columns."""
    rules, flagged = learn(docs, labels)
    return docs.where(verdict(F.col("text"), rules, flagged)["kept"])
