"""Document quality by a linear-chain conditional random field over lines.

Each line gets shape features of its own and of both neighbouring lines; the chain
labels lines good or bad.  A labelled document's label holds for all its lines.  The
score of a document is the mean of its lines' forward-backward marginals of "good",
weighted by line length.  The model is fitted on a bounded sample of labelled
documents; every line of every text is scored.

Defined results: null and empty texts count as one empty line; labels that are null, or
whose document is missing, are not learned from; repeated rows are scored one by one;
with no label at all every score is 0.5; an empty table gives an empty result; lang, source,
doc_id and other columns are never read by the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, slices, text_of
from .hashing import Hasher, buffer_of, word_hashes, word_places

#: The sample for fitting: so many labelled documents at most, of so many lines at most each.
FIT_DOCUMENTS = 4000
FIT_LINES = 500
ROUNDS = 150
RATE = 0.1
PENALTY = 1e-3
THRESHOLD = 0.7

#: Bytes by kind; each byte is of the first kind that lists it.
KINDS = {
    "lower": bytes(range(97, 123)), "upper": bytes(range(65, 91)), "digit": b"0123456789",
    "space": b" \t\r\x0b\x0c", "pipe": b"|", "symbol": b"#*$%&<>", "bang": b"!",
    "stop": b".,;:?'\"()-", "wide": bytes(range(128, 256)),
}
NEIGHBOURS = ("upper", "pipe", "symbol", "bang", "again", "echo", "log_words")


def line_places(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of lines, and the bounds of each text in lines; an empty text is one line."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([bounds[:-1], breaks + 1])
    doc = np.concatenate([np.arange(len(bounds) - 1), np.searchsorted(bounds, breaks, "right") - 1])
    order = np.lexsort((starts, doc))
    starts, doc = starts[order], doc[order]
    first = np.searchsorted(doc, np.arange(len(bounds)))
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    ends[first[1:] - 1] = bounds[1:]
    return starts, ends, first


class Lines(NamedTuple):
    features: np.ndarray
    weights: np.ndarray
    first: np.ndarray


def shift(column: np.ndarray, first: np.ndarray, by: int) -> np.ndarray:
    """The neighbouring line's value, 0 beyond a text's ends."""
    out = np.zeros_like(column)
    if by > 0:
        out[1:] = column[:-1]
        out[first[:-1]] = 0
    else:
        out[:-1] = column[1:]
        out[first[1:] - 1] = 0
    return out


def lines_of(texts: pa.Array, hasher: Hasher) -> Lines:
    data, bounds = buffer_of(texts)
    starts, ends, first = line_places(data, bounds)
    size = ends - starts
    whole = np.maximum(size, 1)
    columns: dict[str, np.ndarray] = {}
    for name, chars in KINDS.items():
        table = np.zeros(256, bool)
        table[list(chars)] = True
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(table[data], out=sums[1:])
        columns[name] = (sums[ends] - sums[starts]) / whole
    word_starts, word_ends, word_first = word_places(data, bounds)
    at, to = np.searchsorted(word_starts, starts), np.searchsorted(word_starts, ends)
    n_words = to - at
    short = np.concatenate([[0], np.cumsum(word_ends - word_starts <= 3)])
    spoken = word_hashes(hasher, data, word_starts, word_ends)
    echo = np.zeros(len(spoken), bool)
    # Words are compared within one text only.
    since = np.arange(len(spoken)) - np.repeat(word_first[:-1], np.diff(word_first))
    for back in (1, 2, 3):
        echo[back:] |= (spoken[back:] == spoken[:-back]) & (since[back:] >= back)
    echoes = np.concatenate([[0], np.cumsum(echo)])
    columns["echo"] = (echoes[to] - echoes[at]) / np.maximum(n_words, 1)
    columns["log_words"] = np.log1p(n_words)
    columns["short"] = (short[to] - short[at]) / np.maximum(n_words, 1)
    columns["word_size"] = np.log1p(size / np.maximum(n_words, 1))
    columns["blank"] = (n_words == 0).astype(float)
    sums = hasher.sums(hasher.values[data])
    hashes = hasher.stretch(sums, starts, ends)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, doc))
    again = np.zeros(len(starts))
    same = (doc[order][1:] == doc[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    again[order[1:][same]] = 1
    columns["again"] = again * (n_words > 0)
    for name in NEIGHBOURS:
        columns[f"{name}<"] = shift(columns[name], first, 1)
        columns[f"{name}>"] = shift(columns[name], first, -1)
    place = np.arange(len(starts)) - first[doc]
    columns["first"] = (place == 0).astype(float)
    columns["only"] = (np.diff(first)[doc] == 1).astype(float)
    columns["log_lines"] = np.log1p(np.diff(first)[doc])
    columns["one"] = np.ones(len(starts))
    return Lines(np.stack(list(columns.values()), 1), size + 1.0, first)


class Model(NamedTuple):
    """Weights of "good" over "bad", and gains of keeping or changing the label."""

    weights: np.ndarray
    stay_bad: float
    stay_good: float


def lanes(first: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Texts by falling number of lines, and how many have more than t lines, for each t."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    falling = -sizes[order]
    return order, np.searchsorted(falling, -np.arange(1, int(sizes.max(initial=0)) + 1), "right").tolist()


def passed_on(odds: np.ndarray, model: Model) -> np.ndarray:
    """Log odds of a line's label given those of the line before (the chain is symmetric)."""
    return np.logaddexp(model.stay_good + odds, 0) - np.logaddexp(odds, model.stay_bad)


def forward_backward(own: np.ndarray, first: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of "good" from lines up to and from lines after each line; their sum is the
    marginal's.  All texts move in step, longest first."""
    order, active = lanes(first)
    begin, end = first[:-1][order], first[1:][order]
    ahead, behind = own.copy(), np.zeros_like(own)
    for t in range(1, len(active)):
        at = begin[:active[t]] + t
        ahead[at] += passed_on(ahead[at - 1], model)
        back = end[:active[t]] - 1 - t
        behind[back] = passed_on(own[back + 1] + behind[back + 1], model)
    return ahead, behind


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(features: np.ndarray, first: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS,
        rate: float = RATE, penalty: float = PENALTY) -> Model:
    """Penalised maximum likelihood of the chains by Adam; every line has its text's label."""
    mean, spread = features.mean(0), features.std(0)
    fixed = spread < 1e-9
    mean, spread = np.where(fixed, 0, mean), np.where(fixed, 1, spread)
    x = (features - mean) / spread
    sizes = np.diff(first)
    y = np.repeat(labels.astype(float), sizes)
    keep = np.ones(len(x), bool)
    keep[first[:-1]] = False
    pairs = np.flatnonzero(keep)
    # Texts count alike, however many lines they have.
    weight = np.repeat(1 / np.maximum(sizes, 1), sizes) / len(sizes)
    w = np.zeros(x.shape[1] + 2)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, rounds + 1):
        model = Model(w[:-2], w[-2], w[-1])
        own = x @ model.weights
        ahead, behind = forward_backward(own, first, model)
        gradient = x.T @ (weight * (y - sigmoid(ahead + behind)))
        left, right = ahead[pairs - 1], own[pairs] + behind[pairs]
        both = np.stack([np.full(len(pairs), model.stay_bad), left, right, left + right + model.stay_good])
        both = np.exp(both - both.max(0))
        both /= both.sum(0)
        yp = y[pairs]
        stay = np.array([(weight[pairs] * ((1 - yp) - both[0])).sum(), (weight[pairs] * (yp - both[3])).sum()])
        gradient = np.concatenate([gradient, stay]) - penalty * w
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        w = w + rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
    weights = w[:-2] / spread
    weights[-1] -= (weights * mean).sum()
    return Model(weights, float(w[-2]), float(w[-1]))


def scores(lines: Lines, model: Model) -> np.ndarray:
    # Summed row by row, so that a score does not depend on the texts beside it.
    ahead, behind = forward_backward((lines.features * model.weights).sum(1), lines.first, model)
    good = sigmoid(ahead + behind) * lines.weights
    at = lines.first[:-1]
    return np.add.reduceat(good, at) / np.add.reduceat(lines.weights, at)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2




def sample_lines(limit: int):
    out = arrow_schema("label int, width int, features binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, 1 << 20):
            lines = lines_of(batch.column(1), hasher)
            rows = [(label, lines.features.shape[1], lines.features[a:b].tobytes()) for label, a, b in
                    zip(batch.column(0).to_pylist(), lines.first[:-1], lines.first[1:]) if b - a <= limit]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)

    return run


def train(documents: DataFrame, labels: DataFrame, documents_most: int = FIT_DOCUMENTS,
          lines_most: int = FIT_LINES) -> Model | None:
    """A model from at most ``documents_most`` labelled documents outside the held-out fold,
    drawn by a hash of doc_id; their lines come to the driver."""
    chosen = (labels.where(F.col("quality").isin(0, 1) & ~held_out())
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents_most))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    # At most ``documents_most`` rows of two numbers.
    rows = (docs.join(F.broadcast(chosen), "doc_id").select("label", "text")
            .mapInArrow(sample_lines(lines_most), "label int, width int, features binary").toArrow())
    found = list(zip(rows["label"].to_pylist(), rows["width"].to_pylist(), rows["features"].to_pylist()))
    if not found:
        return None
    found.sort(key=lambda r: (r[0], r[2]))
    parts = [np.frombuffer(f).reshape(-1, width) for _, width, f in found]
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return fit(np.concatenate(parts), first, np.array([r[0] for r in found]))


def quality_scores(documents: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.  One narrow pass."""
    out = arrow_schema("doc_id long, held_out boolean, score double, predicted int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, 512 << 10):
            if model is None:
                made = np.full(batch.num_rows, 0.5)
            else:
                made = scores(lines_of(batch.column(2), hasher), model)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(made),
                pa.array((made >= threshold).astype(np.int32))], schema=out)

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.coalesce(held_out(), F.lit(False)).alias("held_out"), text_of().alias("text"))
    return docs.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return quality_scores(documents, train(documents, labels))
