"""Batch scoring rules: NULL skipped, distinct inputs scored once, limit before scoring."""

import pandas as pd
from pyspark.sql import functions as F

from ledgerlens.operators.inference import lexicon_scorer, lexicon_sentiment, score_text
from ledgerlens.operators.ranking import top_k
from ledgerlens.operators.scored import ScoredTexts


def make_scorer():
    # Defined inside a function so it is pickled by value for the workers.
    def scorer(batches):
        for s in batches:
            yield s.map(lambda t: f"scored:{t}")
    return scorer


def test_null_prompt_gives_null_and_dedupes(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "id int, p string")
    out = score_text(df, "p", make_scorer(), "o")
    got = {r["id"]: r["o"] for r in out.collect()}
    assert got == {1: "scored:a", 2: "scored:a", 3: None, 4: "scored:b"}


def test_scorer_sees_each_distinct_text_once(spark, scratch):
    df = spark.createDataFrame([(i, "same" if i % 2 else "other") for i in range(50)], "id int, p string")
    seen_dir = scratch

    def recording(batches):
        import os
        import uuid
        for s in batches:
            with open(os.path.join(seen_dir, uuid.uuid4().hex), "w") as f:
                f.write("\n".join(s.tolist()))
            yield s.str.upper()

    score_text(df, "p", recording, "o").collect()
    import os
    texts = []
    for name in os.listdir(seen_dir):
        texts += [t for t in open(os.path.join(seen_dir, name)).read().split("\n") if t]
    assert sorted(texts) == ["other", "same"]


def test_limit_runs_before_scoring(spark):
    df = spark.range(1000).select(F.col("id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("p"))
    kept = top_k(df, 5, [F.desc("id")])
    out = score_text(kept, "p", make_scorer(), "o")
    assert out.count() == 5


def test_lexicon_labels(spark):
    texts = ["Great service, friendly staff", "Rude and slow service", "good but cold", "the the", None,
             "GOOD!!!"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(lexicon_sentiment("t")).collect()]
    assert got == ["positive", "negative", "mixed", "neutral", None, "positive"]
    py = next(lexicon_scorer()(iter([pd.Series(texts)]))).tolist()
    assert py == got


def _recording(folder):
    """A scorer that writes down every text that reaches it."""
    def scorer(batches):
        import os
        import uuid
        for s in batches:
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                f.write("".join(f"{t}\n" for t in s))
            yield s.str.upper() if len(s) else s.astype(object)
    return scorer


def _seen(folder):
    import os
    return sorted(t for name in os.listdir(folder) for t in open(os.path.join(folder, name)).read().split("\n") if t)


def test_nulls_never_reach_the_model(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, None)], "id int, p string").coalesce(1)
    got = {r["id"]: r["o"] for r in score_text(df, "p", _recording(scratch), "o", dedupe=False).collect()}
    assert got == {1: "A", 2: None, 3: "A", 4: None} and _seen(scratch) == ["a", "a"]
    nothing = df.where("p IS NULL")
    assert [r["o"] for r in score_text(nothing, "p", _recording(scratch), "o", dedupe=False).collect()] == [None, None]


def test_a_second_run_scores_unseen_texts_only(spark, scratch):
    import os
    calls = os.path.join(scratch, "calls")
    os.mkdir(calls)
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, "z"), (4, "a", "w")], "id int, p string, __text string")
    first = ScoredTexts(spark, f"{scratch}/store", _recording(calls))
    assert {r["id"]: r["o"] for r in first.score(df.drop("__text"), "p", "o").collect()} == {1: "A", 2: "B", 3: None, 4: "A"}
    assert _seen(calls) == ["a", "b"]
    again = ScoredTexts(spark, f"{scratch}/store", _recording(calls))          # another session's run
    more = spark.createDataFrame([(5, "b"), (6, "c"), (7, None)], "id int, p string")
    assert again.add(more, "p") == 1 and again.add(more, "p") == 0
    assert _seen(calls) == ["a", "b", "c"]
    assert {r["id"]: r["o"] for r in again.score(more, "p", "o").collect()} == {5: "B", 6: "C", 7: None}
    assert _seen(calls) == ["a", "b", "c"] and again.scores().count() == 3


def test_a_run_that_died_before_its_record_is_scored_again(spark, scratch):
    import os
    calls = os.path.join(scratch, "calls")
    os.mkdir(calls)
    df = spark.createDataFrame([("a",)], "p string")
    store = ScoredTexts(spark, f"{scratch}/store", _recording(calls))
    lost = store.unseen(df, "p").withColumn("__score", store.udf("__text"))
    lost.write.parquet(f"{scratch}/store/{store.table.NUMBER}=0")             # rows without a record
    assert store.scores().count() == 0
    assert store.add(df, "p") == 1 and store.scores().count() == 1
