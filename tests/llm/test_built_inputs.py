"""Inputs built to break an operator: colliding hashes, shared ids, clashing names, special strings."""

from collections import Counter

import numpy as np
import pytest

from ledgerlens.llm import line_dedup, mixing, near_dup, packing, suffix_dedup, tokens


def thue_morse(n, flip=0):
    """2 ** n letters; two such words agree in every polynomial modulo 2 ** 64 if n is 10 or more."""
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(1 << n))


def test_words_that_a_polynomial_cannot_tell_apart_stay_apart(spark):
    docs = spark.createDataFrame([(1, thue_morse(11)), (2, thue_morse(11, 1)), (3, thue_morse(11))], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_texts_that_a_polynomial_cannot_tell_apart_lose_nothing(spark):
    """Two texts of 8,192 bytes whose polynomial hashes are equal: only what truly repeats goes."""
    a, b = thue_morse(13), thue_morse(13, 1)
    starts = Counter(x[i:i + 400] for x in (a, b) for i in range(len(x) - 399))
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in suffix_dedup.dedup_bytes(docs, kept_text=True).collect()}
    gone = {1: a, 2: b}
    for i, t in gone.items():
        covered = np.zeros(len(t) + 1, int)
        for k in range(len(t) - 399):
            if starts[t[k:k + 400]] > 1:
                covered[k:k + 400] = 1
        assert rows[i]["n_removed"] == int(covered.sum())


def test_salted_anchors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PER_SALT", 1)
    draw = np.random.default_rng(2)
    part = ["".join(chr(97 + c) for c in draw.integers(0, 26, n)) for n in (450, 500, 390, 700)]
    texts = ["".join(part[k] for k in draw.integers(0, 4, 3)) for _ in range(12)] + [part[0] + "x" * 900]
    starts = Counter(t[i:i + 400] for t in texts for i in range(len(t) - 399))
    rows = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.dedup_bytes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        covered = np.zeros(len(t), int)
        for k in range(len(t) - 399):
            if starts[t[k:k + 400]] > 1:
                covered[k:k + 400] = 1
        assert rows[i] == int(covered.sum())


def test_word_hashes_follow_the_words():
    texts = ["a b  c", "", "A b\tc d", "é É", " "]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in raw]))).astype(np.int64)
    hashes, borders = near_dup.word_hashes(np.frombuffer(b"".join(raw), np.uint8), offsets)
    parts = [hashes[borders[i]:borders[i + 1]].tolist() for i in range(len(texts))]
    assert [len(p) for p in parts] == [3, 0, 4, 2, 0]
    assert parts[0] == parts[2][:3] and parts[3][0] != parts[3][1]


def test_rows_that_share_an_id_keep_their_own_lines(spark):
    x, u = "this very line stands in two rows", "an only line that must not go"
    docs = spark.createDataFrame([(1, x), (2, u), (2, x), (None, x), (None, u + " at all, not ever"), (3, "so short"), (4, "So short!")], "doc_id long, text string")
    got = Counter((r["doc_id"], r["text"], r["n_removed"]) for r in line_dedup.dedup_lines(docs).collect())
    assert got == Counter([(1, x, 0), (2, u, 0), (2, "", 1), (None, "", 1), (None, u + " at all, not ever", 0), (3, "so short", 0), (4, "", 1)])
    kept = Counter((r["doc_id"], r["text"]) for r in line_dedup.drop_repeated_lines(docs).collect())
    assert kept == Counter([(1, x), (2, u), (None, u + " at all, not ever"), (3, "so short")])


def test_lines_with_clashing_columns(spark):
    kind = "doc_id long, text string, _gone int, _doc int, gone string, row int, digest int, n_lines int, `a.b` int"
    docs = spark.createDataFrame([(1, "one line of text here", 1, 2, "g", 3, 4, 5, 6), (2, "one line of text here", 1, 2, "g", 3, 4, 5, 6)], kind)
    out = line_dedup.dedup_lines(docs)
    assert sorted((r["doc_id"], r["_gone"], r["gone"], r["row"], r["a.b"], r["n_lines"], r["n_removed"]) for r in out.collect()) == [(1, 1, "g", 3, 6, 1, 0), (2, 1, "g", 3, 6, 1, 1)]
    assert [tuple(r) for r in line_dedup.drop_repeated_lines(docs).collect()] == [(1, "one line of text here", 1, 2, "g", 3, 4, 5, 6)]


def test_mixing_keeps_columns_of_any_name(spark):
    kind = "doc_id long, text string, source string, _row int, _copy int, _copies int, row string, number int, copies int, digest int"
    docs = spark.createDataFrame([(i, f"some words of text {i}", "ab"[i % 2], i, 7, 8, "r", 9, 1, 2) for i in range(40)], kind)
    out = mixing.resample(docs)
    assert out.schema == docs.schema
    rows = out.collect()
    assert rows and {(r["_row"], r["_copy"], r["_copies"], r["row"], r["number"]) for r in rows} <= {(i, 7, 8, "r", 9) for i in range(40)}


def test_many_rows_without_id_are_mixed_one_by_one(spark):
    docs = spark.createDataFrame([(None, f"text number {i} of many", "s") for i in range(300)] + [(None, "the same text", "s")] * 100 + [(1, "z", "t")], "doc_id long, text string, source string")
    out = mixing.mix_documents(docs)
    assert out.count() == 401
    per_source = {r["source"]: (r["target"], r["taken"]) for r in out.groupBy("source").agg({"target": "max", "taken": "sum"}).toDF("source", "target", "taken").collect()}
    assert abs(per_source["s"][0] - per_source["s"][1]) <= 0.05 * per_source["s"][0]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_special_strings_are_encoded_as_the_library_does(name):
    from tokenizers import Tokenizer
    path = tokens.tokenizer_path(name)
    plain, ours = Tokenizer.from_file(path), tokens.encoder(path)
    draw = np.random.default_rng(4)
    bits = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|endof", "text|>", "a", "B", " ", "\n", ".", "|", "é", "word", "  "]
    for _ in range(60):
        texts = ["".join(draw.choice(bits, draw.integers(0, 10))) for _ in range(draw.integers(1, 8))]
        raw = [t.encode() for t in texts]
        ids, borders = ours.encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in raw]))).astype(np.int64))
        assert [ids[borders[i]:borders[i + 1]].tolist() for i in range(len(texts))] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_counts_a_special_string_as_the_library_does(spark):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokens.tokenizer_path("word_bpe_49k.json"))
    text = "before <|endoftext|> after <|ENDOFTEXT|>."
    rows = packing.pack_documents(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [r["length"] for r in rows] == [len(plain.encode(text, add_special_tokens=False).ids) + 1]
