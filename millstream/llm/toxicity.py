"""Toxicity by compression distance: windows of a text compressed with a zstandard dictionary of toxic and one of ordinary text.

The ordinary dictionary is trained on windows of ordinary texts. The toxic one is trained on what toxic texts have that
ordinary ones lack: their words whose first letters occur in far more toxic than ordinary texts, by Dunning's
likelihood ratio. Before it goes the ordinary dictionary's content, so that a window without toxic words compresses
alike with both, and the bytes that the toxic dictionary saves tell how toxic a window is. How many windows of a text
save how many bytes is turned into a probability by a logistic curve, calibrated on labelled texts that neither
dictionary has seen.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstream.llm.arrow import add_columns
from millstream.llm.sample import smallest
from millstream.session import stored

NOISE = re.compile(r"[\W\d_]+")
WINDOW, LEVEL, PREFIX = 32, 15, 5
ORDINARY_BYTES, TOXIC_BYTES = 16384, 4096
STEPS = (1, 2, 3, 4, 5, 6)
#: Chance that any beginning at all passes for a mark in texts that no word marks.
CHANCE = 0.01
#: Bounds of the training sample: texts of either class, and windows of an ordinary text.
SAMPLE = {1: 4000, 0: 8000}
TEXT_WINDOWS = 20


def plain(text: str | None) -> str:
    """Lower-case letters with one blank between words."""
    return NOISE.sub(" ", (text or "").lower()).strip()


def windows(text: str) -> list[bytes]:
    """A plain text in windows of about WINDOW bytes that end at a blank where there is one; a blank goes to both sides."""
    if not text:
        return []
    raw, made, i = f" {text} ".encode(), [], 0
    last = len(raw) - 1
    while i < last:
        j = i + WINDOW
        if j >= last:
            made.append(raw[i:])
            break
        k = raw.rfind(b" ", i + WINDOW // 2, j)
        j = k if k > 0 else j
        made.append(raw[i : j + 1])
        i = j
    return made


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS
    )
    if not content:
        return zstandard.ZstdCompressor(compression_params=params)
    words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    words.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=words, compression_params=params)


def _trained(samples: list[bytes], size: int) -> bytes:
    """Dictionary content; where there is too little text to train on, all of the text itself."""
    whole = b"".join(samples)
    if len(whole) <= 8 * size:
        return whole
    return zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes()


@dataclass
class ToxicityModel:
    """Contents of both dictionaries and the logistic curve over `features`."""

    ordinary: bytes
    toxic: bytes
    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def scorer(self):
        """Features of a text, with compressors made once."""
        plainly, toxically = _compressor(self.ordinary).compress, _compressor(self.toxic + self.ordinary).compress

        def features(text: str | None) -> list[float]:
            parts = windows(plain(text))
            saved = np.fromiter((len(plainly(w)) - len(toxically(w)) for w in parts), np.int32, len(parts))
            n, most = max(len(parts), 1), int(saved.max()) if parts else 0
            counts = np.bincount(np.clip(saved, 0, STEPS[-1]), minlength=STEPS[-1] + 1)[::-1].cumsum()[::-1][1:]
            return [*np.log1p(counts), *np.log1p(WINDOW * counts / n), float(most), float(np.log1p(n))]

        return features

    def probability(self, features: np.ndarray) -> np.ndarray:
        x = np.hstack([np.ones((len(features), 1)), (features - self.middle) / self.spread])
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -700, 700)))

    def calibrated(self, features: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> ToxicityModel:
        """With a curve fitted by Newton's steps; with labels of one class only, their share, smoothed, for every text."""
        self.middle, self.spread = features.mean(axis=0), features.std(axis=0) + 1e-9
        x = np.hstack([np.ones((len(features), 1)), (features - self.middle) / self.spread])
        penalty = np.full(x.shape[1], ridge)
        penalty[0] = 0
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        w = np.zeros(x.shape[1])
        w[0] = np.log(share / (1 - share))
        for _ in range(30 if 0 < labels.sum() < len(labels) else 0):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w = w - np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(penalty + 1e-9), x.T @ (p - labels) + penalty * w)
        self.weights = w
        return self



def _beginnings(sample: DataFrame) -> list[str]:
    """First letters of words that mark toxic texts: with more than 4 times the share of toxic texts, beyond chance.

    As chance finds more of them the more there are, the limit of the likelihood ratio goes by the number of beginnings
    tested (Bonferroni), and by nothing else.
    """

    def run(batches):
        for batch in batches:
            kinds, found = [], []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {w[:PREFIX] for w in plain(text).split()}
                kinds += [label] * (len(own) + 1)
                found += [*own, None]  # the row without a beginning counts the text
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int64()), pa.array(found, pa.string())], names=["label", "b"])

    each = sample.filter("half").select("label", "text").mapInArrow(run, "label long, b string")
    counts = each.groupBy("b").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("ordinary"))
    texts = F.col("b").isNull()
    total = counts.agg(F.max(F.when(texts, F.col("toxic"))).alias("n1"), F.max(F.when(texts, F.col("ordinary"))).alias("n0"), F.count_if(F.length("b") > 3).alias("tested"))
    part = F.col("toxic") + F.col("ordinary")
    e1 = part * F.col("n1") / (F.col("n1") + F.col("n0"))
    e0 = part * F.col("n0") / (F.col("n1") + F.col("n0"))

    def term(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    ratio = 2 * (term(F.col("toxic"), e1) + term(F.col("ordinary"), e0))
    share = (F.col("toxic") + 0.5) / (F.col("n1") + 1) / ((F.col("ordinary") + 0.5) / (F.col("n0") + 1))
    marked = counts.filter("b IS NOT NULL AND length(b) > 3 AND toxic > 2").crossJoin(F.broadcast(total))  # one row
    marked = marked.withColumn("g", ratio).filter(share > 4)
    tested = max(1, total.first()["tested"] or 0)
    # The ratio is a squared normal number where the word marks nothing. The sample bounds how many beginnings there are.
    found = marked.filter(F.col("g") >= NormalDist().inv_cdf(CHANCE / tested / 2) ** 2)
    return [r.b for r in found.select("b").collect()]


def training_sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Labelled texts to learn from: of either class the SAMPLE ids of the smallest hash, as a table of its own.

    labels: one row for each id, with label 0 or 1. Only ids and labels are shuffled; the chosen ids, whose number is
    bounded, are broadcast to the texts.
    """
    rows = labels.filter(F.col(label).isin(0, 1)).select(F.col(key).alias("id"), F.col(label).cast("long").alias("label"))
    hashed = rows.withColumn("h", F.xxhash64("id"))
    chosen = smallest(hashed.filter("label = 1"), "label", "h", SAMPLE[1]).unionByName(smallest(hashed.filter("label = 0"), "label", "h", SAMPLE[0]))
    ids = F.col("id").cast("string")
    half = F.crc32(F.concat(F.lit("half "), ids).cast("binary")) % 2 == 0
    found = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen.drop("h")), "id")
    return stored(found.select("label", "text", half.alias("half")), "toxicity-sample")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text") -> ToxicityModel:
    """Model from the labelled texts among `docs` (see `training_sample`). Without labels every text scores 0.5."""
    sample = training_sample(docs, labels, label, key, text)
    marks = set(_beginnings(sample))

    def pieces(batches):
        for batch in batches:
            kinds, made = [], []
            for kind, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if kind:
                    words = f" {' '.join(w for w in plain(t).split() if w[:PREFIX] in marks)} ".encode()
                    own = [words[i : i + 400] for i in range(0, len(words), 400)] if len(words) > 8 else []
                else:
                    own = windows(plain(t))
                    own = own[:: -(-len(own) // TEXT_WINDOWS)] if own else []  # spread over the whole text
                kinds += [kind] * len(own)
                made += own
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int64()), pa.array(made, pa.binary())], names=["label", "piece"])

    rows = sample.filter("half").select("label", "text").mapInArrow(pieces, "label long, piece binary").collect()
    found = {k: sorted(bytes(r.piece) for r in rows if r.label == k) for k in (0, 1)}
    for own in found.values():
        random.Random(1).shuffle(own)  # the trainer takes its share from each stretch of the samples
    size = len(STEPS) * 2 + 2
    model = ToxicityModel(_trained(found[0], ORDINARY_BYTES), _trained(found[1], TOXIC_BYTES), np.zeros(size), np.ones(size), np.zeros(size + 1))
    seen = with_features(sample.filter("NOT half"), model).select("label", "features").collect()
    if not seen:
        return model
    seen.sort()
    return model.calibrated(np.array([r.features for r in seen]), np.array([r.label for r in seen], float))


def with_features(df: DataFrame, model: ToxicityModel, text: str = "text", features: str = "features") -> DataFrame:
    """`df` with how many windows of the whole text the toxic dictionary shortens by how much (array, replaced if there)."""

    def start():
        of = model.scorer()
        return lambda columns: [pa.array([of(t) for t in columns[0].to_pylist()], pa.list_(pa.float64()))]

    return add_columns(df, [text], [T.StructField(features, T.ArrayType(T.DoubleType()))], start)


def predict(df: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score") -> DataFrame:
    """`df` with the probability that the whole text is toxic (column replaced if there).

    Null and empty texts, and those without letters, have no window and score as such. Repeated rows and other columns
    pass unchanged.
    """

    def start():
        of = model.scorer()

        def work(columns: list[pa.Array]) -> list[pa.Array]:
            rows = [of(t) for t in columns[0].to_pylist()]
            return [pa.array(model.probability(np.array(rows, float).reshape(len(rows), -1)) if rows else [], pa.float64())]

        return work

    return add_columns(df, [text], [T.StructField(score, T.DoubleType())], start)
