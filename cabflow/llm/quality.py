"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text fit a linear model on character-class and
repetition statistics of whole texts, by the non-negative unbiased risk

    prior * P[loss(+)] + max(0, U[loss(-)] - prior * P[loss(-)])

with the logistic loss. The class prior is estimated over all unlabelled texts:
a first model tells positives from unlabelled text, and the share of unlabelled
scores above a threshold, over the share of positives above it, is smallest in
the best bin, where unlabelled text is purest in positives.

The fit sees at most ``max_positives`` and ``max_unlabelled`` texts, chosen by a
hash of their id; nothing else is bounded. Features and scores are computed where
the texts are; the driver gets the fit's features and a histogram.

Defined results: null or empty text has zero features and the score they give;
ids that are null are never used to fit; repeated rows get equal scores; without
any trusted positive every score is the prior of a coin, 0.5; an empty table gives
an empty table; other columns pass through, and a new column whose name is taken
gets an underscore more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.llm.common import append, fresh_name, plus, sampled, slices, text_column, utf8
from cabflow.llm.shingles import span_hashes, words

MAX_POSITIVES = 8192
MAX_UNLABELLED = 8192
BINS = 2000
_CLASSES = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",", b"!", b"?",
    b"|", b"#$%&*@^~", bytes(range(0x80, 0x100)), bytes([*range(0, 10), *range(11, 32), 127]),
]


def _class_table() -> np.ndarray:
    table = np.full(256, len(_CLASSES), np.uint8)  # the last class: other punctuation
    for i, members in enumerate(_CLASSES):
        table[list(members)] = i
    return table


CLASS_OF = _class_table()
K = len(_CLASSES) + 1
LAGS = 8
N_FEATURES = K * K + K + 4 + LAGS + 1


def _repetition(texts: pa.Array) -> np.ndarray:
    """Share of words equal to the word 1 to ``LAGS`` places before, and share of distinct words."""
    data, starts, ends, at = words(texts, lower=False)
    h, n = span_hashes(data, starts, ends), np.diff(at)
    out = np.zeros((len(texts), LAGS + 1))
    some = np.flatnonzero(n)
    if not len(some):
        return out
    owner = np.repeat(np.arange(len(texts)), n)
    for lag in range(1, LAGS + 1):
        same = (h[lag:] == h[:-lag]) & (owner[lag:] == owner[:-lag])
        out[:, lag - 1] = np.bincount(owner[lag:][same], minlength=len(texts)) / np.maximum(1, n - lag)
    for i in some:
        out[i, LAGS] = len(np.unique(h[at[i] : at[i + 1]])) / n[i]
    return out


def features(texts: pa.Array) -> np.ndarray:
    """A row for each text: shares of classes and of pairs of neighbouring classes, four sizes, and repetition."""
    data, at = utf8(texts)
    cls = CLASS_OF[data]
    pair = cls[:-1] * np.uint8(K) + cls[1:] if len(cls) else cls
    out = np.zeros((len(texts), N_FEATURES), np.float32)
    for i in range(len(texts)):
        a, b = at[i], at[i + 1]
        if a == b:
            continue
        one = np.bincount(cls[a:b], minlength=K)
        two = np.bincount(pair[a : b - 1], minlength=K * K)
        n = b - a
        gaps, lines = one[3] + one[4] + 1, one[4] + 1
        out[i, : K * K] = np.sqrt(two / max(1, n - 1))
        out[i, K * K : K * K + K] = np.sqrt(one / n)
        out[i, K * K + K : K * K + K + 4] = np.log1p([n, n / gaps, n / lines, gaps / lines])
    out[:, K * K + K + 4 :] = _repetition(texts)
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale) @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def fit_nnpu(pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05) -> Model:
    """Minimise the non-negative risk by full-batch Adam; while the negative part is below 0, step back up its slope.

    The weights' penalty is that of a fixed prior belief on them: the fewer positives, the more it counts.
    """
    l2 = 1e-3 + 6 / len(pos)
    both = np.vstack([pos, unl]).astype(np.float64)
    mean, scale = both.mean(0), both.std(0) + 1e-3
    p, u = (pos - mean) / scale, (unl - mean) / scale
    w, b = np.zeros(p.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    grad = lambda x, g: np.r_[x.T @ g, g.sum()] / len(x)
    for t in range(1, steps + 1):
        zp, zu = p @ w + b, u @ w + b
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        negative = _softplus(zu).mean() - prior * _softplus(zp).mean()
        g_neg = grad(u, su) - prior * grad(p, sp)
        g = prior * grad(p, sp - 1) + g_neg if negative >= 0 else -g_neg
        g[:-1] += l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Model(mean, scale, w, float(b), prior)


def best_bin_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among unlabelled scores, from both histograms over [0, 1]."""
    n_p, n_u = positive.sum(), unlabelled.sum()
    if not n_p or not n_u:
        return 0.5
    q_p, q_u = positive[::-1].cumsum() / n_p, unlabelled[::-1].cumsum() / n_u
    slack = lambda n: np.sqrt(np.log(20.0) / (2 * n))  # noqa: E731  a 90 % bound on a share
    seen = q_p > 0
    upper = (q_u[seen] + slack(n_u) + slack(n_p)) / q_p[seen]
    best = int(np.argmin(upper))
    return float(np.clip(q_u[seen][best] / q_p[seen][best], 0.01, 0.99))


def _sampled(key: str, wanted: int, there: int) -> Column:
    return sampled(17, wanted / max(1, there), key)


def _featured(df: DataFrame, text: str, name: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            x = features(text_column(batch, text))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * N_FEATURES), pa.array(x.ravel()))
            kept = batch.select([c for c in batch.schema.names if c != text])
            yield append(kept, [name], [lists])

    fields = [f for f in df.schema.fields if f.name != text]
    return df.mapInArrow(run, T.StructType([*fields, T.StructField(name, T.ArrayType(T.FloatType()))]))


def score(df: DataFrame, model: Model | None, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with each whole text's score; without a model all score 0.5."""
    name = fresh_name(df.columns, out)
    if model is None:
        return df.withColumn(name, F.lit(0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            yield append(batch, [name], [pa.array(model.score(features(text_column(batch, text))), pa.float64())])

    return df.mapInArrow(run, plus(df.schema, T.StructField(name, T.DoubleType())))


def train(
    docs: DataFrame,
    positives: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    max_positives: int = MAX_POSITIVES,
    max_unlabelled: int = MAX_UNLABELLED,
) -> Model | None:
    """A model from unlabelled ``docs`` and the ids of trusted ones among them; None without any."""
    texts = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).filter(F.col("id").isNotNull())
    ids = positives.select(F.col(f"`{key}`").alias("id")).filter(F.col("id").isNotNull()).distinct()
    there, n_docs = ids.count(), texts.select("id").count()
    chosen = ids.filter(_sampled("id", max_positives, there)).withColumn("trusted", F.lit(True))
    # Bounded by max_positives (and the spread of a hash), so it may be broadcast.
    marked = texts.join(F.broadcast(chosen), "id", "left").withColumn(
        "loose", _sampled("id", max_unlabelled, n_docs)
    ).filter(F.col("trusted") | F.col("loose"))
    got = _featured(marked, "text", "x").select("trusted", "loose", "x", "id").toArrow()
    if not got.num_rows and not (there and n_docs):
        return None
    order = np.argsort(got["id"].to_numpy(), kind="stable")
    x = got["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(got.num_rows, N_FEATURES)[order]
    trusted = got["trusted"].fill_null(False).to_numpy()[order]
    loose = got["loose"].to_numpy()[order]
    if not trusted.any() and (not there or texts.join(ids, "id", "left_semi").isEmpty()):
        return None
    if not trusted.any() or not loose.any():
        raise ValueError("there are trusted positives, but the sample of texts to fit holds none, or no unlabelled text")
    first = fit_nnpu(x[trusted], x[loose], 0.5)

    bins = F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")
    scored = score(texts, first).select("id", bins)
    both = scored.join(ids.withColumn("trusted", F.lit(1)), "id", "left").groupBy("bin").agg(
        F.count(F.lit(1)).alias("u"), F.count("trusted").alias("p")
    )
    counts = np.zeros((2, BINS))
    for r in both.collect():  # at most BINS rows
        counts[:, r["bin"]] = r["p"], r["u"]
    prior = best_bin_prior(counts[0], counts[1])
    return fit_nnpu(x[trusted], x[loose], prior)
