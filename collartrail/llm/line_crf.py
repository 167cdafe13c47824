"""Quality of documents by a linear-chain conditional random field over their lines.

Each line is good or bad. Its potential comes from binned shares of characters and words of the line
and of the lines before and after; neighbouring labels have transition weights. Forward-backward gives
each line's marginal probability of being good, and a document's quality is their mean weighted by
length. Chains of a batch run side by side, one array operation per line position.

Training takes lines of a document to be as good as its label says, fits, lets lines of bad documents
that look good be good, and fits again.
"""

from __future__ import annotations

import operator
import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collartrail.llm.arrow import by_bytes
from collartrail.llm.samples import labelled_sample
from collartrail.llm.text import id_and_text

#: Bounds of the training sample: documents labelled bad and good.
PER_CLASS = (2000, 2000)
STEPS = 80
PENALTY = 1e-4

_LOWER, _UPPER, _DIGIT, _BLANK, _SENTENCE, _SYMBOL, _BEYOND = range(7)
_CLASSES = np.array(
    [
        _LOWER if 97 <= b <= 122
        else _UPPER if 65 <= b <= 90
        else _DIGIT if 48 <= b <= 57
        else _BLANK if b <= 32
        else _BEYOND if b >= 128
        else _SENTENCE if chr(b) in ".,;:?'\"()-"
        else _SYMBOL
        for b in range(256)
    ],
    np.uint8,
)
#: Upper ends of bins of the measures, in the order of ``measures``.
BINS = (
    (0.05, 0.15, 0.4, 0.8),  # upper case among letters of ASCII
    (0.005, 0.03, 0.06, 0.15),  # symbols
    (0.005, 0.05, 0.2),  # digits
    (0.02, 0.08, 0.2),  # sentence marks
    (0.05, 0.2, 0.5),  # bytes beyond ASCII
    (0.02, 0.1, 0.5),  # words equal to the one before
    (0.3, 0.5, 0.7, 0.9),  # distinct words
    (3.0, 5.0, 8.0, 12.0),  # bytes in a word
    (1.0, 20.0, 40.0, 200.0, 1000.0),  # bytes
)
N_OWN = sum(len(b) + 1 for b in BINS)
N_FEATURES = 3 * N_OWN + 3


def measures(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Measures of all lines of the texts, in order, and the number of lines of each text."""
    bodies = [t.encode() for t in texts]
    n_lines = np.array([b.count(b"\n") + 1 for b in bodies], np.int64)
    lines = b"\n".join(bodies).split(b"\n")
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    kind = _CLASSES[np.frombuffer(b"".join(lines), np.uint8)]
    line = np.repeat(np.arange(len(lines), dtype=np.int64), sizes)
    counts = np.bincount(line * 7 + kind, minlength=7 * len(lines)).reshape(-1, 7).astype(float)
    n_words, distinct, again = (np.zeros(len(lines)) for _ in range(3))
    for k, words in enumerate(map(bytes.split, lines)):
        n_words[k] = len(words)
        distinct[k] = len(set(words))
        again[k] = sum(map(operator.eq, words, words[1:]))
    size, some = np.maximum(sizes, 1), np.maximum(n_words, 1)
    letters = np.maximum(counts[:, _LOWER] + counts[:, _UPPER], 1)
    return np.stack(
        [
            counts[:, _UPPER] / letters,
            counts[:, _SYMBOL] / size,
            counts[:, _DIGIT] / size,
            counts[:, _SENTENCE] / size,
            counts[:, _BEYOND] / size,
            again / some,
            distinct / some,
            (sizes - counts[:, _BLANK]) / some,
            sizes.astype(float),
        ],
        axis=1,
    ), n_lines


def features(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of each line's features that are set, lines of each text, and bytes of each line."""
    values, n_lines = measures(texts)
    own = np.zeros((len(values), len(BINS)), np.int16)
    start = 0
    for k, ends in enumerate(BINS):
        own[:, k] = start + np.searchsorted(ends, values[:, k], side="right")
        start += len(ends) + 1
    first = np.zeros(len(values), bool)
    last = np.zeros(len(values), bool)
    ends = np.cumsum(n_lines)
    first[ends - n_lines], last[ends - 1] = True, True
    before = np.where(first[:, None], 3 * N_OWN, np.roll(own, 1, axis=0) + N_OWN)
    after = np.where(last[:, None], 3 * N_OWN + 1, np.roll(own, -1, axis=0) + 2 * N_OWN)
    return np.hstack([own, before, after]).astype(np.int16), n_lines, values[:, -1]


class Chains:
    """Lines of many documents in step: at step t the t-th line of each that has one."""

    def __init__(self, n_lines: np.ndarray):
        by_length = np.argsort(-n_lines, kind="stable")
        starts = (np.cumsum(n_lines) - n_lines)[by_length]
        lengths = n_lines[by_length]
        self.steps = [
            starts[: int(np.searchsorted(-lengths, -t, side="left"))] + t
            for t in range(int(lengths[0]) if len(lengths) else 0)
        ]

    def marginals(self, score: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of good for each line, and expected numbers of moves between labels.

        ``score`` speaks for good against bad; ``moves[a, b]`` for label b behind label a.
        """
        n = len(score)
        forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
        for t, at in enumerate(self.steps):
            if t:
                came = forward[self.steps[t - 1][: len(at)]]
                for b in (0, 1):
                    forward[at, b] = np.logaddexp(came[:, 0] + moves[0, b], came[:, 1] + moves[1, b])
            forward[at, 1] += score[at]
            forward[at] -= forward[at].max(axis=1, keepdims=True)
        expected = np.zeros((2, 2))
        for t in range(len(self.steps) - 2, -1, -1):
            after = self.steps[t + 1]
            at = self.steps[t][: len(after)]
            ahead = backward[after].copy()
            ahead[:, 1] += score[after]
            joint = forward[at][:, :, None] + moves[None] + ahead[:, None, :]
            joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
            expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            for a in (0, 1):
                backward[at, a] = np.logaddexp(ahead[:, 0] + moves[a, 0], ahead[:, 1] + moves[a, 1])
            backward[at] -= backward[at].max(axis=1, keepdims=True)
        both = forward + backward
        return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500))), expected

    def observed(self, labels: np.ndarray) -> np.ndarray:
        """Numbers of moves between the given labels."""
        moves = np.zeros((2, 2))
        for before, after in zip(self.steps[:-1], self.steps[1:], strict=True):
            np.add.at(moves, (labels[before[: len(after)]], labels[after]), 1)
        return moves


def quality(weights: np.ndarray, moves: np.ndarray, texts: Sequence[str]) -> np.ndarray:
    """Share of each text, by length, that is good; an empty line weighs one byte."""
    at, n_lines, size = features(texts)
    good, _ = Chains(n_lines).marginals(weights[at].sum(axis=1) + weights[-1], moves)
    size = np.maximum(size, 1)
    ends = np.cumsum(n_lines)
    total = np.add.reduceat(size, ends - n_lines)
    return np.clip(np.add.reduceat(size * good, ends - n_lines) / total, 0, 1)


def fit_chain(
    at: np.ndarray, n_lines: np.ndarray, labels: np.ndarray, steps: int = STEPS
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and moves of most likelihood for labelled lines, by steps of Adam."""
    chains = Chains(n_lines)
    seen = chains.observed(labels)
    weights, moves = np.zeros(N_FEATURES), np.zeros((2, 2))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, moves)]
    for step in range(1, steps + 1):
        good, expected = chains.marginals(weights[at].sum(axis=1) + weights[-1], moves)
        off = (good - labels) / len(labels)
        by_weight = np.bincount(
            at.ravel(), np.repeat(off, at.shape[1]), minlength=N_FEATURES
        ) + PENALTY * weights
        by_weight[-1] += off.sum()
        by_move = (expected - seen) / len(labels) + PENALTY * moves
        for p, g, (mean, square) in zip((weights, moves), (by_weight, by_move), state, strict=True):
            mean += 0.1 * (g - mean)
            square += 0.01 * (g * g - square)
            p -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-12)
    return weights, moves


def fit(texts: Sequence[str], labels: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Weights and moves from labelled documents; without labels every line is as good as bad."""
    if not len(texts):
        return np.zeros(N_FEATURES), np.zeros((2, 2))
    at, n_lines, size = features(texts)
    of_document = np.repeat(np.array(labels, np.int64), n_lines)
    weights, moves = fit_chain(at, n_lines, of_document)
    good, _ = Chains(n_lines).marginals(weights[at].sum(axis=1) + weights[-1], np.zeros((2, 2)))
    looks_good = (of_document == 0) & (good >= 0.5)
    # most of a bad document stays bad
    starts = np.cumsum(n_lines) - n_lines
    share = np.add.reduceat(np.maximum(size, 1) * looks_good, starts) / np.add.reduceat(
        np.maximum(size, 1), starts
    )
    lines = np.where(looks_good & np.repeat(share < 0.5, n_lines), 1, of_document)
    return fit_chain(at, n_lines, lines)


def fit_on(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """``fit`` in one task on a bounded sample ``doc_id, text, label``."""

    def run(batches):
        texts, labels = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            labels += batch.column("label").to_pylist()
        weights, moves = fit(texts, labels)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([weights, moves.ravel()]))], names=["value"]
        )

    one = sample.repartition(1).sortWithinPartitions("doc_id", F.xxhash64("text"))
    found = np.array([r.value for r in one.mapInArrow(run, "value double").collect()])
    if not len(found):
        return np.zeros(N_FEATURES), np.zeros((2, 2))
    return found[:N_FEATURES], found[N_FEATURES:].reshape(2, 2)


def score_quality(
    docs: DataFrame,
    weights: np.ndarray,
    moves: np.ndarray,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, score``, one row per input row: the share of the text that is good, from 0 to 1.

    A NULL text is empty, which is one empty line. Ids may be NULL or repeat; other columns are
    ignored. An empty table gives no rows. Without training labels every score is a half.
    """
    model = docs.sparkSession.sparkContext.broadcast((weights, moves))

    def run(batches):
        for batch in by_bytes(batches):
            found = quality(*model.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found)], names=["doc_id", "score"]
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def document_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    per_class: tuple[int, int] = PER_CLASS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``score_quality`` by a model fitted on a bounded sample of ``docs`` with ``labels``."""
    sample = labelled_sample(docs, labels, label, per_class, id_col, text_col)
    return score_quality(docs, *fit_on(sample), id_col, text_col)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
