"""Document quality by a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, table
from .learn import calibrated, fold, label_sample, platt, sampled_texts

#: Labelled documents of each class that the model is fitted on; of one with more lines, this many in runs of RUN lines
#: that are spread over the whole text.
SAMPLE, SAMPLE_LINES, RUN = 1500, 300, 50
KEEP_FROM = 0.3
ROUNDS, RATE, RIDGE = 150, 0.15, 1e-3
#: Log odds by which a line's hidden label agrees with its document's; scale of the neighbouring lines' features, small so
#: that a line is judged by itself before its neighbours.
AGREE, NEAR = 2.0, 0.2


def _told(chars: str, *spans: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[[ord(c) for c in chars]] = 1
    for a, b in spans:
        out[a:b] = 1
    return out


#: Bytes of kinds: upper case, letters, signs, calls, strokes, digits, stops.
_KINDS = [_told("", (65, 91)), _told("", (65, 91), (97, 123), (128, 256)), _told("#$%&*+/<=>@\\^_`{}~[]"), _told("!?"), _told("|"), _told("", (48, 58)), _told(".,;:")]
_LOW = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: Of a line itself; the same of the lines before and behind follow.
OWN = 12


def _text_lines(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and length of each line; an empty text is one empty line."""
    raw = np.frombuffer(text, np.uint8)
    cut = np.flatnonzero(raw == 10)
    start = np.concatenate(([0], cut + 1))
    return start, np.concatenate((cut, [len(raw)])) - start


def _said_twice(text: bytes, low: np.ndarray, first: np.ndarray, last: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Whether each word is the one before it in the same line, A-Z lower-cased."""
    out = np.zeros(len(first), bool)
    size, middle = last - first, low[(first + last) // 2]
    like = (size[1:] == size[:-1]) & (line[1:] == line[:-1]) & (low[first[1:]] == low[first[:-1]]) & (low[last[1:] - 1] == low[last[:-1] - 1]) & (middle[1:] == middle[:-1])
    for i in (np.flatnonzero(like) + 1).tolist():  # few are alike so far
        out[i] = text[first[i] : last[i]].lower() == text[first[i - 1] : last[i - 1]].lower()
    return out


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(lines x features, bytes of each line): shares of kinds of characters and of words said twice running.

    A few bytes of memory for each byte of text.
    """
    start, size = _text_lines(text)
    n = len(start)
    own = np.zeros((n, OWN), np.float32)
    own[:, 0] = np.log1p(size) / 8
    own[:, 1] = size == 0
    if len(text):
        raw = np.frombuffer(text + b"\n", np.uint8)  # so each line has an end, which is of no kind
        per = []
        for k, kind in enumerate(_KINDS):
            hit = kind[raw]
            if k == 0:
                hit[1:] += (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
            per.append(np.add.reduceat(hit, start, dtype=np.int64))
        long = np.maximum(size, 1)
        own[:, 2] = per[0] / np.maximum(per[1], 1)
        for k, scale in ((2, 4), (3, 4), (4, 8), (5, 4), (6, 8)):
            own[:, k + 1] = np.minimum(per[k] / long * scale, 1)
        gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
        step = np.diff(np.concatenate(([True], gap)).astype(np.int8))
        first, last = np.flatnonzero(step == -1), np.flatnonzero(step == 1)
        if len(first):
            line = np.searchsorted(start, first, "right") - 1
            count = np.bincount(line, minlength=n)
            some = np.maximum(count, 1)
            own[:, 8] = np.bincount(line, _said_twice(text, _LOW[raw], first, last, line), minlength=n) / some
            own[:, 9] = np.minimum(np.bincount(line, last - first, minlength=n) / some / 16, 1)
            own[:, 10] = np.minimum(np.bincount(line, (last - first) <= 3, minlength=n) / some, 1)
            own[:, 11] = np.minimum(count / 40, 1)
    out = np.zeros((n, 3 * OWN + 2), np.float32)
    out[:, :OWN] = own
    out[1:, OWN : 2 * OWN] = own[:-1]
    out[:-1, 2 * OWN : 3 * OWN] = own[1:]
    out[0, -2] = out[-1, -1] = 1
    return out, size


def spread(n: int, most: int = SAMPLE_LINES, run: int = RUN) -> np.ndarray:
    """The places of up to most of n lines: all, or runs of lines at even distances from the first to the last."""
    if n <= most:
        return np.arange(n)
    run = min(run, most)
    begin = np.linspace(0, n - run, most // run).astype(np.int64)
    return np.unique(begin[:, None] + np.arange(run))


class Chain:
    """Labels 0 (bad) and 1 (good); weights of features for label 1 and of the four transitions."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.weights, self.moves, self.mean, self.scale = weights, moves, mean, scale
        self.slope, self.shift = 1.0, 0.0

    def documents(self, push: np.ndarray, lengths: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated score of each sequence, the weighed mean of its lines' marginals; and these marginals."""
        p = self.marginals(push, lengths)
        ends = np.cumsum(lengths)
        sums = np.concatenate(([0], np.cumsum(p * weight))), np.concatenate(([0], np.cumsum(weight)))
        mean = np.clip(np.diff(sums[0][np.concatenate(([0], ends))]) / np.diff(sums[1][np.concatenate(([0], ends))]), 1e-6, 1 - 1e-6)
        return calibrated(mean, self.slope, self.shift), p

    def push(self, x: np.ndarray) -> np.ndarray:
        z = np.concatenate(((x - self.mean) / self.scale, np.ones((len(x), 1))), axis=1)
        return np.exp(np.clip(z @ self.weights, -25, 25))

    def marginals(self, push: np.ndarray, lengths: np.ndarray, pairs: bool = False):
        """P(good) of each line of sequences that lie one behind the other.

        With pairs, also the place of each line that another follows, the four transitions' probabilities there, and the
        log of each sequence's partition sum. Forward and backward messages are kept normalised; a step serves the
        sequences that are long enough, together.
        """
        m = np.exp(np.clip(self.moves, -20, 20))
        order = np.argsort(-lengths, kind="stable")
        size, base = lengths[order], (np.cumsum(lengths) - lengths)[order]
        alive = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), "right") if len(size) else []
        a, b = np.empty(len(push)), np.full(len(push), 0.5)
        total = np.zeros(len(lengths))
        for t, k in enumerate(alive):
            at = base[:k] + t
            g = push[at]
            if t:
                p = a[at - 1]
                good, bad = g * (p * m[1, 1] + (1 - p) * m[0, 1]), p * m[1, 0] + (1 - p) * m[0, 0]
            else:
                good, bad = g, np.ones(k)
            a[at] = good / (good + bad)
            if pairs:
                total[order[:k]] += np.log(good + bad)
        for t in range(len(alive) - 2, -1, -1):
            at = base[: alive[t + 1]] + t
            q, g = b[at + 1], push[at + 1]
            good, bad = m[1, 1] * g * q + m[1, 0] * (1 - q), m[0, 1] * g * q + m[0, 0] * (1 - q)
            b[at] = good / (good + bad)
        p = a * b / (a * b + (1 - a) * (1 - b))
        if not pairs:
            return p
        inner = np.ones(len(push), bool)
        inner[np.cumsum(lengths) - 1] = False
        at = np.flatnonzero(inner)
        x, q, g = a[at], b[at + 1], push[at + 1]
        xi = np.stack([(1 - x) * m[0, 0] * (1 - q), (1 - x) * m[0, 1] * g * q, x * m[1, 0] * (1 - q), x * m[1, 1] * g * q], axis=1)
        return p, at, xi / xi.sum(1, keepdims=True), total

    def likelihood(self, push: np.ndarray, lengths: np.ndarray, bias: float, labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, float]:
        """Log likelihood of documents' labels, and its gradient by the lines' log pushes, the moves and the bias.

        Lines' labels are hidden: a document of label y has the chain's weight of a labelling, times e^AGREE for each
        line whose label is y; its label's probability is y's share of the sum over all labellings and both labels.
        """
        p1, at, xi1, z1 = self.marginals(push * np.exp(AGREE), lengths, pairs=True)
        p0, _, xi0, z0 = self.marginals(push * np.exp(-AGREE), lengths, pairs=True)
        odds = np.clip(z1 - z0 - AGREE * lengths + bias, -500, 500)
        rest = labels - 1 / (1 + np.exp(-odds))
        each = np.repeat(rest, lengths)
        value = float(np.sum(labels * odds - np.logaddexp(0, odds)))
        return value, each * (p1 - p0), (each[at, None] * (xi1 - xi0)).sum(0), float(rest.sum())


def fit(sequences: list[np.ndarray], sizes: list[np.ndarray], labels: list[int], rounds: int = ROUNDS) -> Chain | float:
    """The chain of most conditional likelihood of the documents' labels, those of their lines hidden; scores calibrated.

    The share of label 1 if there are no two classes (0.5 without rows).
    """
    if len(set(labels)) < 2:
        return float(np.mean(labels)) if labels else 0.5
    x = np.concatenate(sequences).astype(np.float64)
    lengths, y = np.array([len(s) for s in sequences]), np.array(labels, np.float64)
    mean, scale = x.mean(0), x.std(0) + 0.05
    scale[OWN : 3 * OWN] /= NEAR
    chain = Chain(np.zeros(x.shape[1] + 1), np.zeros((2, 2)), mean, scale)
    z = np.concatenate(((x - mean) / scale, np.ones((len(x), 1))), axis=1)
    theta = np.zeros(z.shape[1] + 5)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):  # Adam
        chain.weights, chain.moves = theta[:-5], theta[-5:-1].reshape(2, 2)
        _, line, moves, bias = chain.likelihood(np.exp(np.clip(z @ chain.weights, -25, 25)), lengths, theta[-1], y)
        grad = np.concatenate((z.T @ line, moves, [bias])) / len(lengths) - RIDGE * theta
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
        theta = theta + RATE * (m1 / (1 - 0.9**k)) / (np.sqrt(m2 / (1 - 0.999**k)) + 1e-8)
    chain.weights, chain.moves = theta[:-5], theta[-5:-1].reshape(2, 2)
    rough = chain.documents(np.exp(np.clip(z @ chain.weights, -25, 25)), lengths, np.concatenate(sizes) + 1.0)[0]
    chain.slope, chain.shift = platt(rough, y)
    return chain


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_lines: int = SAMPLE_LINES) -> Chain | float:
    """Fits on labels.quality of up to sample documents a class outside fold 0, of each sample_lines lines by spread().

    Null and unlike labels, and labels without a document, play no part; a null text is an empty one. Without labelled
    rows of both classes the model is a constant. The driver holds the sample's features only; rows that repeat a
    sampled doc_id count once each.
    """
    small_batches(docs.sparkSession)
    chosen, _ = label_sample(labels, "quality", sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for i, y, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                x, size = line_features(t)
                at = spread(len(x), sample_lines)
                found.append((i, y, x[at], size[at]))
            cols = [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32()), pa.array([f[2].tobytes() for f in found], pa.binary()), pa.array([f[3].astype(np.int64).tobytes() for f in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "y", "x", "size"])

    rows = sampled_texts(docs, chosen).select(F.col("doc_id").cast("long").alias("doc_id"), "y", "text").mapInArrow(run, "doc_id long, y int, x binary, size binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    return fit([np.frombuffer(r["x"], np.float32).reshape(-1, 3 * OWN + 2) for r in rows], [np.frombuffer(r["size"], np.int64) for r in rows], [r["y"] for r in rows])


def score(docs: DataFrame, model: Chain | float) -> DataFrame:
    """All columns of docs with score (0 to 1, higher: better) and line_scores (P(good) of each line).

    The score is the mean of the lines' marginals, weighed by bytes plus one, with log odds calibrated on the sample. Only the text is looked at; a null text
    is an empty one, which is one empty line. Rows are scored one by one: repeated rows get the same score, an empty
    table gives no rows. Columns of docs named as the result's are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    out = docs.drop("score", "line_scores")
    names = out.columns
    told = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = told.value
        for b in batches:
            pushes, sizes = [], []
            for t in b.column(names.index("text")).to_pylist():  # one text's features at a time
                x, size = line_features((t or "").encode())
                pushes.append(np.zeros(len(x)) if isinstance(m, float) else m.push(x))
                sizes.append(size)
            lengths = np.array([len(s) for s in sizes], np.int64)
            weight = np.concatenate(sizes) + 1.0 if sizes else np.empty(0)
            if not sizes or isinstance(m, float):
                total, p = np.full(len(sizes), m if sizes else 0.0), np.full(len(weight), m if sizes else 0.0)
            else:
                total, p = m.documents(np.concatenate(pushes), lengths, weight)
            ends = np.concatenate(([0], np.cumsum(lengths)))
            lines = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(p, pa.float32()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(total, pa.float64()), lines], [*names, "score", "line_scores"])

    schema = T.StructType([*out.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("line_scores", T.ArrayType(T.FloatType()))])
    return out.mapInArrow(run, schema)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of score() over documents, fitted on labels; rows, nulls and ties as there."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))
