"""Operator 9 against the library on whole texts."""

import random

import pytest

from tidewatch.llm.token_counts import content_digest, split_safe, token_counts, tokenizer_version

P = pytest.importorskip("public_tokenizers")


def library(path, texts):
    if path.endswith(".json"):
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        return [len(e.ids) for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    import sentencepiece
    return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode([t or "" for t in texts])]


def samples():
    r = random.Random(4)
    bits = ["Hello", "it's", "'S", "<|endoftext|>", "<|startoftext|>x", "é", "é", " ", "\n", "\t", " ", "\x1c",
            "日本語", "😀", "123", "don't", "≯", "ΣΑΣ", "İ", "a b", "!!", "x" * 90, "​", "\r\n", "́", "End.", "a,", "E.G.,", "...", "T̈.", "'S.", "<|ENDOFTEXT|>"]
    out = ["".join(r.choice(bits) + r.choice(["", " ", "\n"]) for _ in range(r.randint(1, 20))) for _ in range(400)]
    return out + [None, "", "  ", "word " * 9000, "<|endoftext|≯"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_equal_library(spark, name):
    path, texts = P.path(name), samples()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(df, path).collect()}
    want = library(path, texts)
    assert got == {i: (len((t or "").encode()), n, n > 2048) for i, (t, n) in enumerate(zip(texts, want))}


def test_cache_is_used_and_appended(spark, tmp_path):
    path, cache = P.path("word_bpe_49k.json"), str(tmp_path / "cache")
    df = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c")], "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in token_counts(df, path, cache).collect()} == {1: 2, 2: 2, 3: 1}
    stored = spark.read.parquet(cache)
    assert stored.count() == 2 and {r.tokenizer for r in stored.collect()} == {tokenizer_version(path)}
    # a planted count shows that a hit is not encoded again; only the miss is appended
    spark.createDataFrame([(bytearray(content_digest("d e f")), 77)], "digest binary, n_tokens long").write.mode("append").parquet(
        f"{cache}/tokenizer={tokenizer_version(path)}")
    more = df.union(spark.createDataFrame([(4, "d e f"), (None, "new one here"), (5, None)], "doc_id long, text string"))
    assert {r.doc_id: r.n_tokens for r in token_counts(more, path, cache).collect()} == {1: 2, 2: 2, 3: 1, 4: 77, None: 3, 5: 0}
    assert spark.read.parquet(cache).count() == 5


def test_empty_extra_columns(spark):
    path = P.path("word_bpe_49k.json")
    schema = "doc_id long, text string, digest string, n_tokens long"
    assert token_counts(spark.createDataFrame([], schema), path).collect() == []
    assert token_counts(spark.createDataFrame([(1, "x y", "d", 9)], schema), path).first().n_tokens == 2


def test_only_this_layout_is_cut():
    assert split_safe(P.path("word_bpe_49k.json"))
    assert not split_safe(P.path("byte_bpe_50k.json")) and not split_safe(P.path("piece_bpe_32k.model"))
