"""Hard negatives, decontamination and collocations: SQL oracles, brute force and edge rows."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from ledgerlens.llm import decontam, negatives, phrases, registry

SF = "/root/testdata/sf0.001"
LINE = "one two three four five six seven eight nine ten eleven twelve"


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in registry.queries())
    assert numbers == list(range(1, 14))
    assert set(registry.queries()) | {"pipeline"} <= set(E.queries())
    assert set(registry.oracles()) <= set(registry.queries())


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_decontamination", "op13_collocations"])
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cursor = con.execute(registry.oracles()[name])
    columns = [d[0] for d in cursor.description]
    want = Counter(cursor.fetchall())
    got = Counter(tuple(r) for r in registry.queries()[name](spark, SF).select(*columns).collect())
    assert got == want and want


# ---------------------------------------------------------------- decontamination

def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def scan_by_hand(texts, items):
    grams = defaultdict(set)
    for item, text in items:
        w = words_of(text)
        n = min(len(w), 10)
        for i in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[i:i + n])].add(item)
    out = []
    for text in texts:
        w, hits, found = words_of(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hits |= set(range(i, i + n))
                    found |= {str(x) for x in grams[tuple(w[i:i + n])] if x is not None}
        out.append((len(w), sorted(hits), sorted(found)))
    return out


TEXTS = [
    None, "", " \n\t.", LINE, LINE, "X " + LINE.upper() + "; y", "one-two-three four\x00five six seven eight nine", "zwei Wörter", "ZWEI W\u00f6rter!",
    "zwei WÖRTER", LINE + " " + LINE, "a b c. " * 3 + LINE, "three four five six seven eight nine ten eleven twelve thirteen", ("pad word " * 4000) + LINE + (" tail" * 5000),
]
ITEMS = [(1, LINE), (2, "zwei Wörter"), (3, None), (4, ""), (10, LINE + " thirteen"), (None, "a b c"), (2, "b c a")]


@pytest.fixture(scope="module")
def spoiled(spark):
    kind = "doc_id long, text string, hits string, items int, row int, digest string, n_words int"
    return spark.createDataFrame([(i if i % 5 else None, t, "h", 3, None, "d", 4) for i, t in enumerate(TEXTS)], kind).cache()


@pytest.fixture(scope="module")
def tests(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, items string")


@pytest.mark.parametrize("bound", [decontam.BROADCAST_BYTES, 300])
def test_scan_equals_brute_force(spoiled, tests, monkeypatch, bound):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", bound)  # the small one cuts the windows into several blocks
    got = Counter((r["row"]["text"], r["n_words"], tuple(r["hits"]), tuple(r["items"])) for r in decontam.scan(spoiled, tests).collect())
    want = Counter((t, n, tuple(h), tuple(i)) for t, (n, h, i) in zip(TEXTS, scan_by_hand(TEXTS, ITEMS), strict=True))
    assert got == want


def test_hash_collisions_mark_nothing(spoiled, tests, monkeypatch):
    monkeypatch.setattr(decontam.F, "xxhash64", lambda *c: decontam.F.lit(7).cast("long") + 0 * decontam.F.size(c[0]))
    got = Counter((r["row"]["text"], tuple(r["hits"])) for r in decontam.scan(spoiled.where("length(text) < 200"), tests).collect())
    short = [t for t in TEXTS if t is not None and len(t) < 200]
    assert got == Counter((t, tuple(h)) for t, (_, h, _) in zip(short, scan_by_hand(short, ITEMS), strict=True))


def test_remove_cuts_the_hit_words(spark, spoiled, tests):
    clean = decontam.remove(spoiled, tests)
    assert clean.columns == spoiled.columns
    rows = clean.collect()
    assert len(rows) == len(TEXTS)
    want = Counter()
    for t, (_, hits, _) in zip(TEXTS, scan_by_hand(TEXTS, ITEMS), strict=True):
        if not hits:
            want[t] += 1
            continue
        piece = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
        parts = re.findall(f"{piece}*{piece.replace('[', '[^')}+", t)
        tail = re.search(f"{piece}*$", t)[0] if not t.endswith("\n") else ""
        want["".join(p for i, p in enumerate(parts) if i not in set(hits)) + tail] += 1
    assert Counter(r["text"] for r in rows) == want
    whole = decontam.remove(spoiled, tests, whole=True)
    assert Counter(r["text"] for r in whole.collect()) == Counter(t for t, (_, h, _) in zip(TEXTS, scan_by_hand(TEXTS, ITEMS), strict=True) if not h)


def test_empty_tables(spark, spoiled, tests):
    no_docs, no_items = spoiled.limit(0), tests.limit(0)
    assert decontam.scan(no_docs, tests).count() == 0
    assert [len(r["hits"]) for r in decontam.scan(spoiled, no_items).collect()] == [0] * len(TEXTS)
    assert decontam.remove(spoiled, no_items).count() == len(TEXTS)
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    none = spark.createDataFrame([], "vec_id long, label int, v array<long>")
    some = spark.createDataFrame([(1, 1, [1, 2])], none.schema)
    assert negatives.mine(none, none).count() == negatives.mine(some, none).count() == negatives.mine(some, some).count() == 0


# ---------------------------------------------------------------- collocations

def collocations_by_hand(rows, min_count, top):
    totals, counts = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            totals[lang] += len(w)
            counts.update((lang, tuple(w[i:i + n])) for n in (1, 2, 3) for i in range(len(w) - n + 1))
    big = {k: a for k, a in counts.items() if a >= min_count and len(k[1]) > 1}
    out = defaultdict(list)
    for (lang, p), a in big.items():
        if any(len(q) > len(p) and x == lang and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (x, q), b in big.items()):
            continue
        score, _, left, right = min((1000000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return Counter((lang, i + 1, p.decode(), -a, left, right, totals[lang], -s) for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


PROSE = [
    (None, "en"), ("", "en"), (" . ,\t;", None), ("New York. new york, NEW YORK; new\tyork new york", "en"), ("new york city" * 3, "en"),
    ("the new york city the new york city\nthe new york\vcity", "en"), ("é à é à é à", "fr"), ("é à é à", None), ("a b a b a b a b", "en"), ("a a a a a a", "de"), ("a a a a a a", "de"),
    ("x" * 70_000 + " y " + "long text " * 20_000, "en"), ("\u2003wide\u2003space wide", "en"),
]


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_collocations_equal_brute_force(spark, monkeypatch, shards):
    monkeypatch.setattr(phrases, "SHARDS", shards)
    rng = np.random.default_rng(5)
    made = [(" ".join(rng.choice(["ab", "cd", "ef", "gh", "ij.", "kl", "mn"], 40, p=[.3, .2, .2, .1, .1, .05, .05])), str(rng.choice(["en", "de"]))) for _ in range(60)]
    rows = PROSE + made
    docs = spark.createDataFrame([(t, lang, 1, "p") for t, lang in rows], "text string, lang string, count int, phrase string").repartition(6)
    got = Counter(tuple(r) for r in phrases.collocations(docs, min_count=4, top=25).collect())
    assert got == collocations_by_hand(rows, 4, 25)


def test_shards_lose_no_phrase(spark):
    """A phrase with its occurrences spread evenly over the shards, and one with all in a single text, both survive."""
    rows = [(f"filler{i} rare pair filler{i}b", "en") for i in range(10)] + [("dense couple, " * 10, "en")]
    counts, _ = phrases.phrase_counts(spark.createDataFrame(rows, "text string, lang string"))
    found = {r["phrase"]: r["count"] for r in counts.collect()}
    assert found["en\nrare pair"] == 10 and found["en\ndense couple"] == 10 and "en\npair filler1b" not in found


# ---------------------------------------------------------------- hard negatives

def mined_by_hand(rows, anchors, k=5):
    out = Counter()
    width = max((len(v) for _, _, v in rows), default=0)
    vec = [np.array([*v, *[0] * (width - len(v))], dtype=object) for _, _, v in rows]
    for a in anchors:
        scored = [(-int(sum(vec[a] * vec[j])), rows[j][0], j) for j in range(len(rows))]
        positives = sorted(x for x in scored if rows[x[2]][1] == rows[a][1] and x[1] != rows[a][0])[:k]
        for p, pid, _ in positives:
            inside = sorted(x[:2] for x in scored if rows[x[2]][1] != rows[a][1] and 80 * -p <= 100 * -x[0] <= 100 * -p)[:k]
            out.update((rows[a][0], pid, i + 1, nid, -p, -s) for i, (s, nid) in enumerate(inside))
    return out


@pytest.mark.parametrize("cell,cluster", [(512, 64), (7, 3)])
def test_negatives_equal_brute_force(spark, monkeypatch, cell, cluster):
    monkeypatch.setattr(negatives, "ANCHOR_CELL", cell)
    monkeypatch.setattr(negatives, "CLUSTER", cluster)
    monkeypatch.setattr(negatives, "CANDIDATE_BLOCK", 90)
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 3)), [int(x) for x in rng.integers(-40, 60, 6)]) for i in range(200)]
    rows += [(200 + i, i % 3, [9, 9, 9]) for i in range(90)]  # ties, shorter vectors
    rows += [(400, 1, [0, 0, 0, 0, 0, 0]), (401, 2, []), (402, 0, [-30] * 6)]
    vectors = spark.createDataFrame([(*r, "extra") for r in rows], "vec_id long, label int, v array<long>, anchor string")
    anchors = [i for i, r in enumerate(rows) if r[0] % 9 == 0 or r[0] >= 400]
    got = Counter(tuple(r) for r in negatives.mine(vectors, vectors.where("vec_id % 9 = 0 OR vec_id >= 400")).collect())
    assert got == mined_by_hand(rows, anchors)


def test_walk_stops_early_and_stays_exact():
    """The shared list is left before its end when the vectors are clustered, with the same answer as a full scan."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 32))
    near = lambda n: np.floor(256 * (centres[rng.integers(0, 12, n)] + 0.05 * rng.normal(size=(n, 32)))).astype(np.int64)
    candidates, members = near(5000), np.floor(256 * (centres[0] + 0.05 * rng.normal(size=(20, 32)))).astype(np.int64)
    ids = rng.permutation(5000)
    lows = np.full((20, 1), np.iinfo(np.int64).min)
    highs = np.full((20, 1), np.iinfo(np.int64).max)
    got = defaultdict(list)
    for m, _, p, s in negatives.ranged_search(members, candidates, ids, lambda m: np.ones(5000, bool), lows, highs, 5):
        got[m].append((-s, int(ids[p])))
    full = members @ candidates.T
    for m in range(20):
        assert sorted(got[m]) == sorted((-int(full[m, j]), int(ids[j])) for j in range(5000))[:5]
    shared = negatives.SharedList(members, candidates, ids)
    need = np.sort(full, axis=1)[:, -5]
    assert shared.walk(lambda: need, lambda *_: None, np.arange(20)) < 0.5 * full.size


def test_labels_and_unusable_vectors(spark):
    rows = [(7, 9, [0.5, 1.0]), (8, None, [1.0, 1.0]), (9, 1, None), (10, 1, [1.0, None]), (11, 1, [float("nan"), 1.0]), (12, 1, [float("inf"), 1.0]), (None, 1, [1.0, 1.0]), (-7, 3, [-0.1, 0.1])]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    assert sorted(tuple(r) for r in negatives.labelled_vectors(table).collect()) == [(-7, 4, [-26, 25]), (7, 0, [128, 256])]
