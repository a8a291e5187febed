"""Toxicity by compression distance (operator 10).

Method: zstandard dictionaries for toxic and for ordinary text; every window
of a text is compressed with either, and the bytes that the toxic dictionary
saves, over calibrated thresholds, make the score.

* **Dictionaries.**  Both are trained by the library on the labelled sample:
  the ordinary one on all windows of ordinary texts, the toxic one on the toxic
  texts, of each the stretches that ordinary text lacks (whole toxic texts
  train little else than ordinary words).  A stretch is a run of five-byte
  grams that are far more frequent in toxic texts and seen in many different
  contexts (copies of one text share their contexts and so do not count).
  Ordinary words have to be as cheap on either side, or their noise would hide
  the toxic ones, so what a window saves is its length after the ordinary
  dictionary minus its length after both, the toxic one nearest.  Too few
  samples to train on are the dictionary themselves.
* **Windows** are whole words up to ``WINDOWS`` bytes; a text is cut twice, by
  a shorter and a longer size, and read to its end.
* **Calibration.**  Per size, the largest savings and the shares of windows
  that save at least 1, 2 and 3 bytes go through a logistic curve fitted on
  the same sample.

The sample is bounded and documented: at most ``SAMPLE`` labelled texts of
each class (those with the lowest hash of their id), of each at most
``SAMPLE_BYTES`` characters taken from evenly spaced places.  What reaches the
driver is that sample; the model is a few KB.  Every text is scored, in whole.

Only the text is an input of a score.  Edge cases: null or empty text is one
empty window and gets the score of a text without toxic words; with no
labelled text of one class every score is the share of toxic labels (0 without
labels); labels without a document and null labels are ignored; repeated rows
score alike; empty table, empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOWS = (40, 64)
LEVEL = 3
SAMPLE = 3000            # labelled texts of each class
SAMPLE_BYTES = 6000      # characters of each of them
ORDINARY_BYTES = 16384   # dictionary content
TOXIC_BYTES = 2048
CONTEXTS = 8             # different neighbours that a gram of a toxic word has at least
THRESHOLD = 0.7


def windows(text: str, size: int) -> list[bytes]:
    """The text's words, lower-cased, joined by spaces into windows of at most
    ``size`` bytes (a longer word is cut into several)."""
    out, cur = [], b""
    for w in text.lower().encode().split():
        if len(w) >= size:
            if cur:
                out.append(cur + b" ")
                cur = b""
            out += [b" " + w[i:i + size - 1] + b" " for i in range(0, len(w), size - 1)]
            continue
        if cur and len(cur) + len(w) + 1 > size:
            out.append(cur + b" ")
            cur = b""
        cur += b" " + w
    if cur:
        out.append(cur + b" ")
    return out or [b" "]


def _words(text: str) -> list[bytes]:
    return [w.strip(b".,;:!?\"'()") for w in text.lower().encode().split()]


def _grams(word: bytes) -> list[bytes]:
    w = b" " + word + b" "
    return [w[i:i + 5] for i in range(len(w) - 4)]


def typical_grams(toxic: list[str], ordinary: list[str]) -> set[bytes]:
    """Grams that recur, in different contexts, in toxic texts only."""
    def document_counts(texts):
        c: Counter = Counter()
        for t in texts:
            c.update({g for w in set(_words(t)) for g in _grams(w)})
        return c
    pos, neg = document_counts(toxic), document_counts(ordinary)
    p, n = max(len(toxic), 1), max(len(ordinary), 1)
    typical = {g for g, c in pos.items() if c >= max(3, 0.008 * p) and c / p > 20 * (neg[g] + 0.5) / n}
    contexts: dict[bytes, set] = {}
    for t in toxic:
        ws = [b"", *_words(t), b""]
        for before, w, after in zip(ws, ws[1:], ws[2:]):
            for g in _grams(w):
                if g in typical:
                    contexts.setdefault(g, set()).add((before, after))
    least = min(CONTEXTS, max(2, p // 50))
    return {g for g, c in contexts.items() if len(c) >= least}


def stretches(text: str, grams: set[bytes]) -> bytes:
    """The parts of the text's words that ``grams`` cover, one after the other."""
    out = b""
    for word in _words(text):
        w, end = b" " + word + b" ", 0
        for i, g in enumerate(_grams(word)):
            if g in grams:
                out += w[max(i, end):i + 5]
                end = i + 5
    return out


def _dictionary(size: int, samples: list[bytes], k: int, d: int) -> bytes:
    """A dictionary trained by the library; with too few samples, they themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=d).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


class Model:
    """Two dictionaries and the weights of the logistic curve; picklable."""

    def __init__(self, ordinary: bytes, toxic: bytes, mean, scale, weights, prior: float):
        self.ordinary, self.toxic = ordinary, toxic
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior
        self._compress = None

    def __getstate__(self):
        return self.__dict__ | {"_compress": None}

    def savings(self, text: str, size: int) -> np.ndarray:
        """Bytes that the toxic dictionary saves in each window."""
        if self._compress is None:
            def compressor(content):
                d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_AUTO)
                d.precompute_compress(level=LEVEL)
                return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                                write_checksum=False, write_dict_id=False).compress
            self._compress = compressor(self.ordinary), compressor(self.toxic)
        plain, toxic = self._compress
        return np.array([len(plain(w)) - len(toxic(w)) for w in windows(text, size)])

    def features(self, text: str | None) -> list[float]:
        out: list[float] = []
        for size in WINDOWS:
            g = self.savings(text or "", size)
            top = np.sort(g)[::-1][:3]
            out += [max(0.0, float(top[k])) if k < len(top) else 0.0 for k in range(3)]
            out += [float((g >= k).sum()) / math.sqrt(len(g)) for k in (1, 2, 3)]
            out.append(math.log(len(g)))
        return out

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return self.prior
        z = (np.array(self.features(text)) - self.mean) / self.scale
        z = float(np.append(z, 1.0) @ self.weights)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def train(sample: list[tuple[str, int]]) -> Model:
    """A model of (text, toxic) pairs."""
    sample = list(dict.fromkeys(sample))
    toxic, ordinary = ([t for t, y in sample if y == k] for k in (1, 0))
    prior = len(toxic) / len(sample) if sample else 0.0
    if not toxic or not ordinary:
        return Model(b"", b"", None, None, None, prior)
    base = _dictionary(ORDINARY_BYTES, [w for t in ordinary for w in windows(t, 64)], 64, 8)
    grams = typical_grams(toxic, ordinary)
    # the trainer takes samples of eight bytes or more
    own = _dictionary(TOXIC_BYTES, [s.ljust(8) for s in (stretches(t, grams) for t in toxic) if s], 32, 6)
    model = Model(base, base + own + b" ", None, None, None, prior)
    x = np.array([model.features(t) for t, _ in sample])
    y = np.array([k for _, k in sample], dtype=float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.c_[(x - mean) / scale, np.ones(len(x))]
    # both classes weigh as if one text in five were toxic
    weight = np.where(y == 1, 0.2 / prior, 0.8 / (1 - prior))
    w = np.zeros(x.shape[1])
    for _ in range(30):   # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = 1e-2 * np.append(np.ones(len(w) - 1), 0)
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        w -= np.linalg.solve(hessian, x.T @ (weight * (p - y)) + ridge * w)
    model.mean, model.scale, model.weights = mean, scale, w
    return model


def held_out(doc_id: Column) -> Column:
    """True for the third of the ids that no model may learn from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> list[tuple[str, int]]:
    """(text, toxic) of at most ``size`` learnable texts of each class, those
    with the lowest hash of their id."""
    known = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
             .where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id"))).distinct())
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    here = known.join(texts.select("doc_id"), "doc_id", "left_semi").withColumn("order", F.xxhash64("doc_id"))
    picked = None
    for k in (0, 1):
        part = here.where(F.col("toxic") == k).orderBy("order", "doc_id").limit(size)
        picked = part if picked is None else picked.unionByName(part)
    # long texts give pieces from three evenly spaced places
    third, n = SAMPLE_BYTES // 3, F.length("text")
    pieces = F.when(n <= SAMPLE_BYTES, F.col("text")).otherwise(F.concat_ws(
        " ", F.substr("text", F.lit(1), F.lit(third)), F.substr("text", (n / 2).cast("int"), F.lit(third)),
        F.substr("text", n - third, F.lit(third))))
    rows = (texts.join(F.broadcast(picked), "doc_id")   # at most 2 * size rows
            .select("toxic", "order", "doc_id", pieces.alias("text")).collect())
    return [(r["text"], r["toxic"]) for r in sorted(rows, key=lambda r: (r["toxic"], r["order"], r["doc_id"], r["text"]))]


def score_documents(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` plus the score of each text (a column of that name is replaced)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            at = batch.schema.names.index(text_col)
            scores = pa.array([own.score(t) for t in batch.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, out_col])

    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != out_col])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + [f"`{out_col}` double"])
    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    model = train(labelled_sample(docs, labels))
    scored = score_documents(docs.select("doc_id", F.col("text").cast("string").alias("text")), model)
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
