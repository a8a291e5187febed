"""Operator 10: held-out accuracy and defined edge cases."""

import random
import zlib

import pytest
import zstandard

from tidewatch.llm.toxicity import (LEVEL, WINDOWS, Model, score_documents, stretches, toxicity, train, typical_grams,
                                    windows)

SF = "/root/testdata/sf0.1"


def auc(pairs):
    ranked = sorted(pairs)
    ranks, i = {}, 0
    total = 0.0
    while i < len(ranked):
        j = i
        while j < len(ranked) and ranked[j][0] == ranked[i][0]:
            j += 1
        total += sum(y for _, y in ranked[i:j]) * ((i + 1 + j) / 2)
        i = j
    p = sum(y for _, y in pairs)
    return (total - p * (p + 1) / 2) / (p * (len(pairs) - p))


def test_held_out_ranking(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    got = toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id", "left").collect()
    assert len(got) == docs.count()
    for r in got[:300]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.7)
    # only English rows of this table carry the words that the label goes by
    english = {r.doc_id for r in docs.where("lang = 'en'").select("doc_id").collect()}
    test = [(r.score, r.toxic) for r in got if r.held_out and r.toxic is not None and r.doc_id in english]
    assert auc(test) > 0.95
    clean = [r.predicted for r in got if r.held_out and r.toxic == 0]
    assert sum(clean) / len(clean) < 0.02
    caught = [r.predicted for r in got if r.held_out and r.toxic == 1 and r.doc_id in english]
    assert sum(caught) / len(caught) > 0.75


def test_labels_of_held_out_rows_change_nothing(spark):
    r = random.Random(1)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    rows, labels = [], []
    for d in range(240):
        bad = d % 4 == 0
        w = [r.choice(vocab) for _ in range(80)]
        for _ in range(4 if bad else 0):
            w.insert(r.randrange(80), r.choice(["zzgrumpf", "qqknarz"]))
        rows.append((d, " ".join(w)))
        labels.append((d, int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    held = [d for d, _ in rows if zlib.crc32(str(d).encode()) % 3 == 1]
    flipped = [(d, 1 - y if d in held else y) for d, y in labels]
    one, two = ({x.doc_id: x.score for x in toxicity(df, spark.createDataFrame(lab, "doc_id long, toxic int")).collect()}
                for lab in (labels, flipped))
    assert one == two
    assert auc([(one[d], labels[d][1]) for d in held]) > 0.95


def planted(n=900):
    r = random.Random(3)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    rows = []
    for d in range(n):
        w = [r.choice(vocab) for _ in range(60)]
        for _ in range(3 if d % 4 == 0 else 0):
            w.insert(r.randrange(60), r.choice(["zzgrumpf", "qqknarz", "vvplonk", "wwschtr"]))
        rows.append((" ".join(w), int(d % 4 == 0)))
    return rows


def test_both_dictionaries_are_trained():
    rows = planted()
    model = train(rows)
    magic = b"\x37\xa4\x30\xec"   # of a dictionary that the library trained
    own = model.toxic[len(model.ordinary):]
    assert model.ordinary.startswith(magic) and own.startswith(magic) and model.toxic.startswith(model.ordinary)
    toxic, ordinary = ([t for t, y in rows if y == k] for k in (1, 0))
    grams = typical_grams(toxic, ordinary)
    left = [stretches(t, grams) for t in toxic]
    assert all(left) and not any(stretches(t, grams) for t in ordinary)
    assert set(b" ".join(left).split()) <= {b"zzgrumpf", b"qqknarz", b"vvplonk", b"wwschtr"}
    assert b"grump" in own and b"grump" not in model.ordinary


def test_savings_equal_direct_compression():
    rows = planted(400)
    model = train(rows)

    def length(content, data):
        d = zstandard.ZstdCompressionDict(content)
        return len(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False,
                                            write_dict_id=False).compress(data))
    for text in [rows[0][0], rows[1][0], "", "Zzgrumpf qqknarz!"]:
        for size in WINDOWS:
            want = [length(model.ordinary, w) - length(model.toxic, w) for w in windows(text, size)]
            assert model.savings(text, size).tolist() == want
    assert model.score(rows[0][0]) > 0.7 > model.score(rows[1][0])


def test_edges(spark):
    lab = "doc_id long, quality int, toxic int"
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, ""), (3, "x" * 20_000), (3, "x" * 20_000)],
                                 "doc_id long, text string")
    none = toxicity(docs, spark.createDataFrame([], lab)).collect()
    assert [r.score for r in none] == [0.0] * 5
    empty = spark.createDataFrame([], "doc_id long, text string, score double, held_out boolean")
    assert toxicity(empty, spark.createDataFrame([(1, None, None), (None, 1, 1), (9, 1, 1)], lab)).collect() == []
    scored = score_documents(docs.withColumn("score", docs.doc_id), Model(b"", b"", None, None, None, 0.25))
    assert scored.columns == ["doc_id", "text", "score"] and {r.score for r in scored.collect()} == {0.25}


def test_windows_hold_every_word():
    text = "One two  three\n" + "é" * 90 + " four " * 50
    for size in (32, 48):
        parts = windows(text, size)
        assert all(len(p) <= size + 1 for p in parts)
        assert b"".join(p.replace(b" ", b"") for p in parts) == "".join(text.lower().split()).encode()
    assert windows("", 32) == [b" "] and train([]).score("x") == pytest.approx(0.0)


