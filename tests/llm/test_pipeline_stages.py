"""Every pipeline stage's rows against a plain version, and the learned verdicts on held-out labels."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from ledgerlens.llm import mixing, quality, tokens

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _texts():
    draw = np.random.default_rng(8)
    words = ["".join(chr(97 + c) for c in draw.integers(0, 26, draw.integers(3, 9))) for _ in range(600)]

    def line(n):
        return " ".join(words[k] for k in draw.integers(0, 600, n))

    shared, slogan = line(14), line(9)
    base = [line(30) for _ in range(8)]
    near = base[0].split()
    near[-1] = "changed"
    out = [(i, "\n".join([base[i], line(12), shared if i % 2 else line(15)]), "en", "abc"[i % 3]) for i in range(8)]
    out += [(20, base[1] + "\n" + shared.upper() + "!", "en", "a"), (21, slogan + "\n" + line(20) + "\n" + slogan, "de", "b"), (22, " ".join(near) + "\n" + line(40), "en", None)]
    copy = "\n".join([line(60), line(50)])
    out += [(30, copy, "fr", "a"), (31, copy, "fr", "b"), (None, copy, None, "c"), (None, line(25), None, "c")]
    out += [(40, "too short", "en", "a"), (41, None, "en", "a"), (42, "", "en", "b"), (43, "five words are said again " * 20, "en", "b")]
    return [(*r, 0 if r[1] is None else len(r[1])) for r in out]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage, the documents first."""
    at = str(tmp_path_factory.mktemp("corpus"))
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(_texts(), kind).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    docs = spark.read.parquet(f"{at}/documents.parquet")
    out = [docs.collect()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, at).write.parquet(f"{at}/stage-{i}")
        docs = spark.read.parquet(f"{at}/stage-{i}")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.append(docs.collect())
    out.append(corpus_pipeline.run(spark, at).collect())
    return out


def _bag(rows):
    return Counter(tuple(r) for r in rows)


def test_quality_rules_without_labels_are_the_base_rules(stages):
    def good(text):
        w = WORD.findall(text or "")
        seen = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        covered = {j for k in range(len(w) - 4) if seen[tuple(w[k:k + 5])] > 1 for j in range(k, k + 5)}
        return len(w) >= 10 and 100 * len(covered) <= 20 * len(w)
    assert _bag(stages[1]) == _bag(r for r in stages[0] if good(r["text"])) and 0 < len(stages[1]) < len(stages[0])


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_line_dedup_keeps_one_line_of_each_group(stages):
    import hashlib
    norm = lambda x: re.sub(r"[\W_]+", " ", x.lower()).strip()
    rows = sorted({(r["doc_id"] is None, r["doc_id"] or 0, hashlib.sha256(r["text"].encode()).digest()[:16], r["text"]) for r in stages[1]})
    places = [(k, i, norm(x)) for k, r in enumerate(rows) for i, x in enumerate(r[3].split("\n")) if norm(x)]
    up = list(range(len(places)))
    for b in range(len(places)):
        for a in range(b):
            x, y = places[a][2], places[b][2]
            longest = max(len(x), len(y))
            if abs(len(x) - len(y)) <= 0.2 * longest and _edits(x, y) <= 0.2 * longest + 1e-9:
                lo, hi = sorted((up[a], up[b]))
                up = [lo if u == hi else u for u in up]
    gone = {places[i][:2] for i in range(len(places)) if up[i] != i}
    text_of = {r[:2] + (r[3],): "\n".join(x for i, x in enumerate(r[3].split("\n")) if (k, i) not in gone) for k, r in enumerate(rows)}
    want = Counter()
    for r in stages[1]:
        text = text_of[r["doc_id"] is None, r["doc_id"] or 0, r["text"]]
        if text == r["text"] or WORD.search(text):
            want[r["doc_id"], text, r["lang"], r["source"], r["n_chars"]] += 1
    assert _bag(stages[2]) == want and len(gone) >= 6


def test_one_document_of_each_near_duplicate_group_stays(stages):
    def shingles(t):
        w = WORD.findall(t.translate(LOWER))
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    rows = [r for r in stages[2] if r["doc_id"] is not None]
    ids, sets = [r["doc_id"] for r in rows], [shingles(r["text"]) for r in rows]
    up = {i: i for i in ids}
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                lo, hi = sorted((up[ids[a]], up[ids[b]]))
                up = {k: lo if u == hi else u for k, u in up.items()}
    assert _bag(stages[3]) == _bag(r for r in stages[2] if r["doc_id"] is None or up[r["doc_id"]] == r["doc_id"])


def test_mixing_takes_each_row_as_often_as_the_sampling_says(stages):
    documents = pd.DataFrame([tuple(r) for r in stages[3]], columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64"})
    con = duckdb.connect()
    con.register("documents", documents)
    taken = con.execute(mixing.ORACLE).fetchall()
    want = Counter()
    for doc_id, size, _, _, words in taken:
        if words:
            want[doc_id, size] += words // size
    got = Counter((r["doc_id"], len(WORD.findall(r["text"]))) for r in stages[4])
    assert got == want and set(_bag(stages[4])) <= set(_bag(stages[3]))


def test_packing_places_every_piece_and_run_returns_the_same(stages):
    encode = tokens.encoder(tokens.tokenizer_path("word_bpe_49k.json")).tokenizer
    want = Counter()
    for r in stages[4]:
        ids = [*encode.encode(r["text"], add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            want[r["doc_id"], k // 4096, k, len(ids[k:k + 4096]), zlib.crc32(np.array(ids[k:k + 4096], "<u4").tobytes())] += 1
    for packed in stages[5:]:
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == want
        by = {}
        for r in packed:
            by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for s in by.values():
            ends = [0, *np.cumsum([n for _, n in sorted(s)]).tolist()]
            assert [o for o, _ in sorted(s)] == ends[:-1] and ends[-1] <= 4096


def test_learned_rules_hold_on_labels_they_have_not_seen(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    seen = labels.where("xxhash64(doc_id) % 3 <> 0")
    judged = quality.judge(docs, seen).join(labels.where("xxhash64(doc_id) % 3 = 0"), "doc_id")
    rows = judged.select("base_failed", "kept", ((labels["quality"] == 0) | (labels["toxic"] == 1)).alias("bad")).collect()
    by_rule = [r["bad"] for r in rows if not r["base_failed"] and not r["kept"]]
    good = [r["kept"] for r in rows if not r["bad"]]
    assert len(by_rule) >= 20 and sum(by_rule) >= 0.9 * len(by_rule)      # what the list rejects is bad
    assert sum(good) >= 0.9 * len(good)                                   # what is good stays
