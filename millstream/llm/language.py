"""Language of a text by a byte convolutional network: filters of several widths, max pooling and softmax, in numpy.

A filter of width w over one-hot bytes is a table of w x 256 weights, so that a convolution is a sum of looked-up
rows. Texts are lower-cased and cut into fixed windows of bytes; the network gives each window a distribution over the
languages, and a text's is the mean of its windows' by bytes. All of a text counts, however long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstream.llm.arrow import add_columns
from millstream.llm.sample import smallest

WIDTHS = (2, 3, 4)
FILTERS = 16
WINDOW = 256
UNKNOWN = "und"
#: Bound of the training sample: documents of a language, and windows of a document.
SAMPLE_DOCS, SAMPLE_WINDOWS = 800, 6


@dataclass
class ByteConvNet:
    """tables[w][o]: 256 x FILTERS weights of offset o of the filters of width w; byte 0 pads and has no weight."""

    languages: list[str]
    tables: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def start(cls, languages: list[str], seed: int = 7) -> ByteConvNet:
        rng = np.random.default_rng(seed)
        tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        n = FILTERS * len(WIDTHS)
        return cls(languages, tables, np.zeros(n, np.float32), rng.normal(0, 0.1, (n, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter in each window, and where it is. windows: n x WINDOW bytes."""
        tops, places = [], []
        for table in self.tables:
            n = windows.shape[1] - len(table) + 1
            response = table[0].take(windows[:, :n], axis=0)
            for o in range(1, len(table)):
                response += table[o].take(windows[:, o : o + n], axis=0)
            places.append(response.argmax(axis=1))
            tops.append(np.take_along_axis(response, places[-1][:, None], axis=1)[:, 0])
        return np.concatenate(tops, axis=1), np.concatenate(places, axis=1)

    def hidden(self, windows: np.ndarray) -> np.ndarray:
        """As `pooled`, with a rectifier, without places."""
        tops = []
        for table in self.tables:
            n = windows.shape[1] - len(table) + 1
            response = table[0].take(windows[:, :n], axis=0)
            for o in range(1, len(table)):
                response += table[o].take(windows[:, o : o + n], axis=0)
            tops.append(response.max(axis=1))
        return np.maximum(np.concatenate(tops, axis=1) + self.bias, 0)

    def probabilities(self, windows: np.ndarray, step: int = 64) -> np.ndarray:
        made = [softmax(self.hidden(windows[i : i + step]) @ self.out + self.out_bias) for i in range(0, len(windows), step)]
        return np.concatenate(made) if made else np.zeros((0, len(self.languages)), np.float32)

    def fit(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 6, step: int = 64, rate: float = 0.004, seed: int = 11) -> ByteConvNet:
        """Adam on the cross-entropy; gradients reach a filter at the place of its largest response only."""
        rng = np.random.default_rng(seed)
        params = [*self.tables, self.bias, self.out, self.out_bias]
        first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), step):
                x, y = windows[order[at : at + step]], labels[order[at : at + step]]
                tops, places = self.pooled(x)
                h = np.maximum(tops + self.bias, 0)
                g = softmax(h @ self.out + self.out_bias)
                g[np.arange(len(y)), y] -= 1
                g /= len(y)
                back = (g @ self.out.T) * (h > 0)
                grads = [np.zeros_like(p) for p in params]
                for k, table in enumerate(self.tables):
                    part = slice(k * FILTERS, (k + 1) * FILTERS)
                    for o in range(len(table)):
                        seen = np.take_along_axis(x, places[:, part] + o, axis=1)
                        np.add.at(grads[k][o], (seen, np.arange(FILTERS)), back[:, part])
                    grads[k][:, 0] = 0
                grads[-3:] = [back.sum(axis=0), h.T @ g, g.sum(axis=0)]
                t += 1
                for p, d, m, v in zip(params, grads, first, second):
                    m += 0.1 * (d - m)
                    v += 0.001 * (d * d - v)
                    p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return self


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(text: bytes) -> np.ndarray:
    """The bytes of a text in rows of WINDOW, the last padded with zeros."""
    rows = np.zeros(-(-len(text) // WINDOW) * WINDOW, np.uint8)
    rows[: len(text)] = np.frombuffer(text, np.uint8)
    return rows.reshape(-1, WINDOW)


def fit(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS) -> ByteConvNet:
    """Network for the languages of the rows where `learn` holds, with a language and a letter in the text.

    Learns from `sample_docs` documents of each language (those of the smallest hash) and up to SAMPLE_WINDOWS windows
    of each, spread over its text; so what reaches the driver is bounded by the number of languages. With no such
    rows the network knows no language.
    """
    size = F.length(text)
    steps = [F.substring(F.col(text), F.floor((size - WINDOW) * i / (SAMPLE_WINDOWS - 1)).cast("int") + 1, F.lit(WINDOW)) for i in range(SAMPLE_WINDOWS)]
    parts = F.when(size > WINDOW, F.array_distinct(F.array(*steps))).otherwise(F.array(F.col(text)))
    rows = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    rows = rows.select(F.col(lang).alias("lang"), F.xxhash64(text).alias("h"), parts.alias("parts"))
    picked = smallest(rows, "lang", "h", sample_docs)
    found = sorted((r.lang, p) for r in picked.select("lang", "parts").collect() for p in r.parts)
    languages = sorted({name for name, _ in found})
    net = ByteConvNet.start(languages)
    if len(languages) > 1:
        x = np.concatenate([windows_of(p.lower().encode())[:1] for _, p in found])
        net.fit(x, np.array([languages.index(name) for name, _ in found]))
    return net


def predict(df: DataFrame, net: ByteConvNet, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """`df` with the likeliest language of the whole text and its probability (columns replaced if there).

    A null text, or one without any letter, is `und` with score 0, and so is every text where no language was
    learned. Ties go to the language first in the alphabet. Other columns and repeated rows pass unchanged.
    """

    def start():
        def one(text: str | None) -> tuple[str, float]:
            rows = windows_of(text.lower().encode())
            p = net.probabilities(rows)
            weight = np.full(len(rows), WINDOW, float)
            weight[-1] = len(text.encode()) % WINDOW or WINDOW
            p = weight @ p.astype(float) / weight.sum()
            return net.languages[int(p.argmax())], min(1.0, float(p.max()))

        def work(columns: list[pa.Array]) -> list[pa.Array]:
            letters = pc.match_substring_regex(columns[0], r"\p{L}").to_pylist()
            made = [one(t) if ok and net.languages else (UNKNOWN, 0.0) for t, ok in zip(columns[0].to_pylist(), letters)]
            return [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())]

        return work

    return add_columns(df, [text], [T.StructField(lang_pred, T.StringType()), T.StructField(score, T.DoubleType())], start)
