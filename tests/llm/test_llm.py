"""Edge rows for every operator, and results against brute force, SQL oracles, round trips and held-out accuracy."""

import hashlib
import re
import uuid
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from ledgerlens.llm import langid, line_dedup, lm_score, mixing, near_dup, packing, quality, suffix_dedup, token_files, tokens, topk
from ledgerlens.session import checkpoint_root

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
KIND = "doc_id long, text string, lang string, source string, n_chars long, length long, node string, a int"


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows and extra columns with clashing names."""
    long = " ".join(f"wort{i % 977}x{i}" for i in range(12_000))
    line = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, None, "en", "a", None), (2, "", "en", None, 0), (3, " \n\t", None, "a", 3), (4, line, "en", "a", 1), (4, line, "en", "a", 1),
        (5, line, "de", "b", 1), (6, long, "en", None, 9), (7, long + " tail", "en", "b", 9), (None, line, None, None, None), (8, "a b", "en", "a", 2),
        (9, (line + " ") * 60, "fr", "c", 5),
    ]
    return spark.createDataFrame([(*r, 7, "x", None) for r in rows], KIND)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], KIND)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


def duck(sql):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con.execute(sql).fetchall()


def test_packing(docs, edge, none, texts):
    encode = tokens.encoder(tokens.tokenizer_path("word_bpe_49k.json")).tokenizer
    rows = packing.pack_documents(docs).collect()
    want = {}
    for i, t in texts.items():
        ids = [*encode.encode(t, add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            want[(i, k // 4096)] = (k, len(ids[k:k + 4096]), zlib.crc32(np.array(ids[k:k + 4096], "<u4").tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    for pieces in (rows, packing.pack_documents(edge).collect()):
        by = {}
        for r in pieces:
            by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for s in by.values():
            at = 0
            for offset, length in sorted(s):
                assert offset == at
                at += length
            assert at <= 4096
        assert len(by) <= -(-sum(r["length"] for r in pieces) // 4096) * 1.02 + 1
    assert packing.pack_documents(none).count() == 0


@pytest.mark.parametrize("histogram", [{1: 5}, {4096: 3, 1: 1}, {2000: 7, 2096: 6, 30: 100}, {i: 4096 // i for i in range(1, 4096, 7)}])
def test_plan_places_every_rank_once(histogram):
    where, sequences = packing.plan(histogram)
    for n, g in where.groupby("length"):
        spans = sorted(zip(g.from_rank, g.to_rank, strict=True))
        assert spans[0][0] == 0 and spans[-1][1] == histogram[n] and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert sequences >= -(-sum(n * c for n, c in histogram.items()) // 4096)


def test_token_files_round_trip(spark, edge, none):
    out = f"{checkpoint_root(spark)}/{uuid.uuid4().hex}"
    token_files.write(edge, out)
    rows = token_files.read(spark, out, ids=True).orderBy("start").collect()
    encode = tokens.encoder(tokens.tokenizer_path("byte_bpe_50k.json")).tokenizer
    want = sorted([*encode.encode(r["text"] or "", add_special_tokens=False).ids, 2] for r in edge.collect())
    assert sorted(r["ids"] for r in rows) == want
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 4, 5, 6, 7, 8, 9]
    assert [r["start"] for r in rows] == list(np.cumsum([0, *[r["n_tokens"] for r in rows[:-1]]]))
    assert token_files.read_document(spark, out, 4) == [r["ids"] for r in rows if r["doc_id"] == 4]
    empty = f"{checkpoint_root(spark)}/{uuid.uuid4().hex}"
    token_files.write(none, empty)
    assert token_files.read(spark, empty).count() == 0


def test_mixing_equals_sql(spark, docs, edge, none):
    assert sorted(map(tuple, mixing.op6(spark, SF).collect())) == sorted(duck(mixing.ORACLE))
    rows = mixing.mix_documents(edge).collect()
    assert len(rows) == 11 and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mix_documents(none).count() == 0
    assert mixing.resample(edge).columns == edge.columns


def test_resample_repeats_each_row_by_its_own_copies(spark):
    rows = [(None, f"text{i} of four words", "web") for i in range(50)] + [(7, f"other{i} text", "code") for i in range(5)] + [(i, "a b c " * 99, "books") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = Counter(map(tuple, mixing.resample(docs).collect()))
    taken = Counter()
    for r in mixing.mix_documents(docs).collect():
        taken[r["source"]] += r["copies"]
    assert set(found) <= set(rows) and max(found.values()) <= mixing.MOST
    assert sum((Counter({k[2]: n}) for k, n in found.items()), Counter()) == +taken
    assert sum(k[0] is None for k in found) >= min(50, taken["web"] / mixing.MOST) > 1


def test_topk_equals_sql(spark):
    assert sorted(map(tuple, topk.op5(spark, SF).collect())) == sorted(duck(topk.ORACLE))
    kind = "vec_id long, embedding array<float>, label int"
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, None, 1), (3, [None, 1.0], 1), (4, [float("nan"), 1.0], 1), (5, [-1.0, 2.0], 1), (None, [1.0], 1), (6, [], 1)]
    v = topk.usable(spark.createDataFrame(rows, kind))
    found = [(r["rank"], r["vec_id"], r["score"]) for r in topk.search(v, v.where("vec_id = 0")).orderBy("rank").collect()]
    assert found == [(1, 1, 81920), (2, 1, 81920), (3, 5, 0), (4, 6, 0)]
    assert topk.search(v.limit(0), v).count() == 0


def test_quality_statistics(docs, edge, none, texts, spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r["doc_id"]: r for r in quality.judge(docs, labels).collect()}
    for i, t in texts.items():
        w = WORD.findall(t)
        seen = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        covered = {j for k in range(len(w) - 4) if seen[tuple(w[k:k + 5])] > 1 for j in range(k, k + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
    judged = quality.judge(edge, labels.limit(0)).collect()
    assert [r["kept"] for r in judged if r["doc_id"] in (1, 2, 3, 8, 9)] == [False] * 5
    assert [r["kept"] for r in judged if r["doc_id"] in (4, 5, 6)] == [True] * 4
    assert quality.keep_good(none, labels).count() == 0 and quality.keep_good(edge, labels).columns == edge.columns


def test_near_duplicates(docs, edge, none, texts):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(t.translate(table))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    rows = near_dup.near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == {i: (len(s), top(i)) for i, s in sets.items()}
    got = sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in near_dup.near_duplicates(edge).collect())
    assert got == sorted([(0, None, True), (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (4, 4, True), (5, 4, False), (6, 6, True), (7, 6, False), (8, 8, True), (9, 9, True)], key=lambda r: (r[0], r[1]))
    assert near_dup.near_duplicates(none).count() == 0


def test_near_copies_that_are_no_links_make_no_pairs(spark, monkeypatch):
    """Copies of one text, each with 4 of 150 words replaced: two share 0.80 to 0.848 of their shingles, which a sketch of samples can't tell from a link."""
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(f"x{k}" if i // 4 == k + 1 else w for i, w in enumerate(base)) for k in range(31)]
    texts += [" ".join(first + [f"z{i}" for i in range(149)]) for first in (["a"], ["b"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    compared = []

    def counted(nodes, near, verify):
        def seen(pairs, candidates):
            compared.append(pairs.count())
            return verify(pairs, candidates)
        return link_groups(nodes, near, seen)

    link_groups = near_dup.link_groups
    monkeypatch.setattr(near_dup, "link_groups", counted)
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs, 85).collect()}
    sets = [{tuple(t.split()[i: i + 5]) for i in range(146)} for t in texts]
    true = sum(100 * len(a & b) >= 85 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    plain = sum(1000 * len(a & b) >= 770 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    parent = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if 100 * len(a & b) >= 85 * len(a | b):
                    parent[i] = parent[j] = min(parent[i], parent[j])
    assert got == dict(enumerate(parent))
    assert 0 < true and sum(compared) <= true + len(sets) and plain > 2 * (true + len(sets))


def test_stage_links_from_four_fifths(spark):
    words = [f"w{i}" for i in range(104)]
    near = words[:93] + [f"v{i}" for i in range(11)]  # 89 of 111 shingles shared: 0.80
    assert near_dup.band_count(85) == 25 and near_dup.band_count(80) == 37
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(words[:84] + [f"u{i}" for i in range(20)]))], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_dup.keep_one(docs).collect()) == [1, 3]


def test_line_dedup(spark, edge, none):
    rows = [(1, "alpha beta gamma delta epsilon zeta\nshort line"), (2, "Alpha, beta gamma delta epsilon zeta!\nShort line.\nquite other words stand in this line\n...\n"), (3, None), (4, "")]
    out = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: (rows[0][1], 2, 0), 2: ("quite other words stand in this line\n...\n", 5, 2), 3: (None, 0, 0), 4: ("", 1, 0)}
    kept = line_dedup.drop_repeated_lines(edge)
    assert kept.columns == edge.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [1, 2, 3, 4, 4, 6, 8, 9]  # 7 is one long line, nearly that of 6; the row without id repeats 4
    assert line_dedup.dedup_lines(none).count() == 0


def test_line_groups_equal_brute_force(spark):
    """Lines with replaced words and changed letters; groups by the edit similarity of all pairs."""
    random = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in random.integers(0, 26, random.integers(3, 9))) for _ in range(400)]
    rows = []
    for n in (6, 10, 20, 50):
        for _ in range(12):
            line = [words[k] for k in random.integers(0, 400, n)]
            other, letters = list(line), list(" ".join(line))
            other[int(random.integers(n))] = words[int(random.integers(400))]
            letters[int(random.integers(len(letters)))] = "q"
            rows += [" ".join(line), " ".join(other), "".join(letters)]
    lines = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    pairs = lines.toDF("a", "ta").crossJoin(lines.toDF("b", "tb")).where(
        "a < b and levenshtein(ta, tb) <= floor(0.2 * greatest(length(ta), length(tb)) + 1e-9)").select("a", "b").collect()
    up = list(range(len(rows)))
    for _ in rows:
        for a, b in pairs:
            up[a] = up[b] = min(up[a], up[b])
    assert sum(x != i for i, x in enumerate(up)) > 80
    found = {r["place"]["doc_id"]: r["first"]["doc_id"] for r in line_dedup.line_groups(lines).collect()}
    assert found == dict(enumerate(up))


def test_line_bands_come_a_few_at_a_time(spark, monkeypatch):
    """Half of the bands at once: the groups are the same, and no table but the result's two stays."""
    import os
    from ledgerlens.session import checkpoint_root
    words = "amber birch cedar delta ember frost grove haven inlet jumbo knoll larch maple north ocean plaza".split()
    rows = [(10 * i + j, " ".join(words[i * 4:i * 4 + 4] * 2 + ["w" * j])) for i in range(4) for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keys, linked = [], line_dedup.link_groups

    def counted(nodes, *args, **more):
        keys.append(nodes.selectExpr("max(size(keys))").first()[0])
        return linked(nodes, *args, **more)

    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    monkeypatch.setattr(line_dedup, "link_groups", counted)
    monkeypatch.setattr(line_dedup, "AT_ONCE", 26)
    monkeypatch.setattr(line_dedup, "FEW", 0)
    found = {r["place"]["doc_id"]: r["first"]["doc_id"] for r in line_dedup.line_groups(docs).collect()}
    assert found == {i: i - i % 10 for i, _ in rows}
    assert keys == [26, 26]
    assert sorted(x.rpartition("-")[0] for x in set(os.listdir(root)) - before) == ["llm-line-firsts", "llm-line-places"]


def test_heads_of_linked_lines_fit(spark):
    """Edits that all stand in the head, or shift it, never fail the test that comes before the whole lines."""
    from pyspark.sql import functions as F
    random, rows = np.random.default_rng(8), []
    for n in (5, 9, 20, 60):
        for _ in range(60):
            a = "".join("abc "[k] for k in random.integers(0, 4, n))
            b, k = list(a), n // 6
            for _ in range(k):
                at = int(random.integers(len(b))) // int(random.integers(1, 4))
                b[at:at + int(random.integers(2))] = ["x"] * int(random.integers(2))
            rows += [(a, "".join(b)), ("".join(b), a), (a, "y" * k + a), (a, a[k:])]
    pairs = spark.createDataFrame(rows, "na string, nb string").withColumns({"size_a": F.length("na"), "size_b": F.length("nb")})
    pairs = pairs.withColumn("k", F.expr("cast(floor(0.2 * greatest(size_a, size_b) + 1e-9) as int)")).where("levenshtein(na, nb, k) >= 0")
    head = [F.expr(f"left({x}, greatest(cast(ceil({line_dedup.HEAD} * length({x})) as int), k))").alias(x) for x in ("na", "nb")]
    assert pairs.count() > 600
    assert pairs.select(*head, "size_a", "size_b", "k").where(~line_dedup._heads_fit("na", "nb", "size_a", "size_b", F.col("k"))).count() == 0


def test_only_places_of_possible_repeats_are_sorted(monkeypatch):
    """Strings that cannot repeat cost no suffix; those that do are found as by counting."""
    sorted_, plain = [], suffix_dedup.sort_shard
    monkeypatch.setattr(suffix_dedup, "sort_shard", lambda symbols, after: (sorted_.append(len(symbols)), plain(symbols, after))[1])
    draw = np.random.default_rng(8)
    alone = [draw.integers(97, 123, 3000).astype(np.uint8).tobytes() for _ in range(4)]
    assert not suffix_dedup.repeated_starts(alone, np.arange(4) % 2).any() and sum(sorted_) == 0
    for shard in ([0, 0, 1, 1], [1, 0, 1, 0]):
        texts = [alone[0], alone[1][:700] + alone[0][100:520] + alone[2][:9], b"ab" * 300, alone[3][:1000]]
        starts = Counter(t[i:i + 400] for t in texts for i in range(len(t) - 399))
        want = [i + 400 <= len(t) and starts[t[i:i + 400]] > 1 for t in texts for i in range(len(t) + 1)]
        sorted_.clear()
        assert suffix_dedup.repeated_starts(texts, np.array(shard)).tolist() == want and sum(want) > 42
        assert sum(sorted_) < 2000


def test_suffix_dedup(docs, edge, none, texts):
    starts = Counter()
    for t in texts.values():
        b = t.encode()
        starts.update(b[i:i + 400] for i in range(len(b) - 399))
    rows = {r["doc_id"]: r for r in suffix_dedup.dedup_bytes(docs).collect()}
    for i, t in texts.items():
        b = t.encode()
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - 399):
            if starts[b[k:k + 400]] > 1:
                gone[k:k + 400] = 1
        left = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        spans = int((np.diff(np.concatenate(([0], gone))) == 1).sum())
        r = rows[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())
    assert suffix_dedup.dedup_bytes(edge).count() == 11 and suffix_dedup.dedup_bytes(none).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_merged_transforms_find_repeats(seed):
    random = np.random.default_rng(seed)
    parts = [random.integers(97, 99 + seed, n).astype(np.uint8).tobytes() for n in (400, 420, 777, 1200)]
    made = [b"".join(parts[j] for j in random.integers(0, 4, 2)) for _ in range(7)] + [b"ab" * 500]
    flags = suffix_dedup.repeated_starts(made, np.arange(len(made)) % 2)
    every = Counter(x[i:i + 400] for x in made for i in range(len(x) - 399))
    want = [i + 400 <= len(x) and every[x[i:i + 400]] > 1 for x in made for i in range(len(x) + 1)]
    assert flags.tolist() == want


def test_language_id(docs, edge, none):
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    found = {r["doc_id"]: r for r in langid.predict(edge, langid.learn(docs), words=True).collect()}
    assert [found[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and found[1]["score"] == 0
    assert len(found[4]["word_langs"]) == 12
    assert langid.identify(none).count() == 0


def test_forward_backward_sums_all_paths():
    random = np.random.default_rng(1)
    scores, moves, first = random.standard_normal((4, 3)), random.standard_normal((3, 3)), random.standard_normal(3)
    paths = [(a, b, c, d) for a in range(3) for b in range(3) for c in range(3) for d in range(3)]
    weight = np.array([np.exp(first[p[0]] + sum(scores[i, p[i]] for i in range(4)) + sum(moves[p[i], p[i + 1]] for i in range(3))) for p in paths])
    want = np.array([[weight[[p[i] == k for p in paths]].sum() for k in range(3)] for i in range(4)]) / weight.sum()
    assert np.allclose(langid.marginals(scores, np.array([0, 4]), moves, first), want)


@pytest.fixture(scope="module")
def model(docs):
    words, total = lm_score.vocabulary(docs)
    return words, total, lm_score.train(docs, words, total)


def test_lm_score_of_edge_rows(edge, none, model):
    words, _, net = model
    rows = {r["doc_id"]: r for r in lm_score.score(edge, net, words).collect()}
    assert (rows[1]["n_tokens"], rows[1]["log_prob"], rows[1]["mean_log_prob"]) == (0, 0.0, None) and rows[6]["n_tokens"] == 12_000
    assert rows[4]["log_prob"] == rows[5]["log_prob"] and rows[6]["log_prob"] < rows[4]["log_prob"] < 0
    assert lm_score.score_documents(none).count() == 0


def test_lm_score_equals_a_plain_softmax(docs, texts, model):
    """Every token's probability from the definition: one softmax over all tokens, then the spelling of unknown words."""
    words, _, net = model
    flat = net["out"].reshape(lm_score.TOKENS, lm_score.HIDDEN).astype(float)
    number = {w.decode(): i + 1 for i, w in enumerate(words.known.to_pylist())}
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def scored(text):
        tokens_ = WORD.findall(text.translate(table))
        ids, out = [number.get(w, 0) for w in tokens_], 0.0
        for i, w in enumerate(tokens_):
            near = [ids[j] if 0 <= j < len(ids) else lm_score.PAD for j in (i - 2, i - 1, i + 1, i + 2)]
            h = np.tanh(sum(net["vectors"][n].astype(float) @ m for n, m in zip(near, net["maps"], strict=True)) + net["bias"])
            kinds = h @ net["class_out"] + net["class_prior"]
            inside = (flat @ h + net["prior"].reshape(-1)).reshape(lm_score.CLASSES, lm_score.CLASSES)
            every = (kinds - np.logaddexp.reduce(kinds))[:, None] + inside - np.logaddexp.reduce(inside, axis=1, keepdims=True)
            assert abs(np.exp(every).sum() - 1) < 1e-6          # a distribution over all tokens
            out += every.reshape(-1)[ids[i]]
            if not ids[i]:
                raw = [256, *w.encode()]
                out += sum(words.spelling[a, b] for a, b in zip(raw, [*raw[1:], 256], strict=True))
        return len(ids), out

    some = {i: t for i, t in texts.items() if 0 < len(t) < 400}
    got = {r["doc_id"]: (r["n_tokens"], r["log_prob"]) for r in lm_score.score(docs, net, words).collect()}
    assert len(some) > 10
    for i, t in list(some.items())[:25]:
        n, want = scored(t)
        assert got[i][0] == n and abs(got[i][1] - want) < 1e-3 * max(1, n)
    assert abs(np.exp(words.spelling).sum(axis=1) - 1).max() < 1e-9


def test_lm_beats_unigrams_on_texts_it_has_not_seen(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen, unseen = docs.where("doc_id % 5 <> 0"), docs.where("doc_id % 5 = 0")
    words, total = lm_score.vocabulary(seen)
    unigram, net = lm_score.start(words), lm_score.train(seen, words, total)
    before, after = (lm_score.score(unseen, n, words).selectExpr("sum(log_prob) / sum(n_tokens)").first()[0] for n in (unigram, net))
    assert after > before + 0.03


def test_lm_trains_on_every_place_once(spark):
    texts = [None, "", "one", "a b c d e", "a b c d e", " ".join(f"w{i % 700}" for i in range(2 * lm_score.PIECE + 3))]
    docs = spark.createDataFrame([(i if i != 4 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    words, total = lm_score.vocabulary(docs)
    number = {w.decode(): i + 1 for i, w in enumerate(words.known.to_pylist())}
    want, got = [], []
    for text in texts:
        ids = [number[w] for w in (text or "").split()]
        padded = [lm_score.PAD] * 2 + ids + [lm_score.PAD] * 2
        want += [tuple(padded[i: i + 5]) for i in range(len(ids))]
    for r in lm_score.examples_of(docs.repartition(3), words, 5).collect():
        assert 0 <= r["round"] < lm_score.ROUNDS and 0 <= r["shard"] < 5
        ids = np.frombuffer(r["ids"], "<i2")
        got += [tuple(ids[i - 2: i + 3].tolist()) for i in lm_score._places(np.array([len(ids)]))]
    assert total == len(want) and sorted(got) == sorted(want)


def test_lm_scores_do_not_depend_on_partitions(docs):
    def scores(frame):
        return {r["doc_id"]: r["log_prob"] for r in lm_score.score_documents(frame).collect()}
    one, many = scores(docs.coalesce(1)), scores(docs.repartition(7))
    assert max(abs(one[i] - many[i]) / max(1, abs(one[i])) for i in one) < 1e-5


def test_pipeline(spark):
    import corpus_pipeline
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "offset", "sequence_id"] or "sequence_id" in found.columns
    assert found.count() > 50
