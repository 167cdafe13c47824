"""Severity of toxicity by cumulative-link ordinal regression over sparse word features.

``P(grade >= k) = 1 / (1 + exp(threshold_k - score))``: one set of weights for all grades and ordered
thresholds. A score sums the weights of a document's distinct words; a word's features are itself and
its beginnings, hashed. Only features that toxic documents have far more often than chance allows
get a weight (likelihood ratio test over documents, copies counted once), so that the many clean words of a
long text do not add up.

Where labels only say toxic or not, a toxic document's grade in training is the quantile of its number
of words with such features.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collartrail.llm.arrow import by_bytes, tidy
from collartrail.llm.samples import labelled_sample
from collartrail.llm.shingles import mix
from collartrail.llm.text import id_and_text

#: Bounds of the training sample: documents without and with the label.
PER_CLASS = (16_000, 4_000)
FEATURE_BITS = 22
BEGINNINGS = (4, 5, 6)
MIN_RATIO_TEST = 20.0
MOST_FEATURES = 2000
STEPS = 400
PENALTY = 1e-5
GRADES = 4
CACHE_WORDS = 300_000
_WORD = re.compile(r"\w+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(word: str) -> list[int]:
    """Hashed features of a word: the whole word, and its beginnings if it is longer."""
    parts = ["w" + word] + [f"{n}{word[:n]}" for n in BEGINNINGS if len(word) >= n]
    return [xxhash.xxh3_64_intdigest(p.encode()) & ((1 << FEATURE_BITS) - 1) for p in parts]


def ratio_test(with_a: np.ndarray, n_a: int, with_b: np.ndarray, n_b: int) -> np.ndarray:
    """Likelihood ratio statistic of features against class a or b; 0 where b has them more often."""
    total = with_a + with_b
    expected_a, expected_b = total * n_a / (n_a + n_b), total * n_b / (n_a + n_b)

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-12)), 0)

    return np.where(with_a > expected_a, 2 * (part(with_a, expected_a) + part(with_b, expected_b)), 0)


def fit_ordinal(
    cells: tuple[np.ndarray, np.ndarray, np.ndarray],
    width: int,
    grade: np.ndarray,
    times: np.ndarray,
    grades: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds of most likelihood, each row counted ``times``.

    ``cells`` are rows, columns and values of a sparse matrix of ``width`` columns. Steps of Adam over
    all rows. Each threshold is the one before plus an exponential, so order holds.
    """
    w, first, gaps = np.zeros(width), np.array([1.0]), np.zeros(grades - 2)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, first, gaps)]
    for step in range(1, STEPS + 1):
        _, *gradients = loss_and_gradients(cells, grade, times, w, first, gaps)
        for p, g, (mean, square) in zip((w, first, gaps), gradients, state, strict=True):
            mean += 0.1 * (g - mean)
            square += 0.001 * (g * g - square)
            p -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-12)
    return w, thresholds_of(first, gaps)


def thresholds_of(first: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    return first[0] + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


def loss_and_gradients(cells, grade, times, w, first, gaps):
    """Mean negative log likelihood of the grades with the penalty, and its gradients."""
    row, column, value = cells
    n, grades = len(grade), len(gaps) + 2
    score = np.bincount(row, w[column] * value, n)
    above = 1 / (1 + np.exp(np.clip(thresholds_of(first, gaps)[None, :] - score[:, None], -30, 30)))
    bounds = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
    low, high = bounds[np.arange(n), grade], bounds[np.arange(n), grade + 1]
    p, total = np.maximum(low - high, 1e-9), times.sum()
    loss = -(times * np.log(p)).sum() / total + PENALTY / 2 * (w * w).sum()
    by_score = times * (low + high - 1) / total
    by_threshold = np.bincount(grade, times * low * (1 - low) / p / total, grades + 1)
    by_threshold += np.bincount(grade + 1, -times * high * (1 - high) / p / total, grades + 1)
    inner = by_threshold[1:-1]
    later = np.cumsum(inner[::-1])[::-1]
    by_weight = np.bincount(column, by_score[row] * value, len(w)) + PENALTY * w
    return loss, by_weight, later[:1], later[1:] * np.exp(gaps)


def one_of_copies(documents: list[np.ndarray]) -> list[int]:
    """Positions of documents without those much like an earlier one, by three least hashes alike."""
    seen: set[tuple] = set()
    kept = []
    for k, ids in enumerate(documents):
        least = [int(mix(ids.astype(np.uint64) + np.uint64(j << 40)).min()) for j in range(12)] if len(ids) else []
        keys = {(j, *least[j : j + 3]) for j in range(0, len(least), 3)} or {k}
        if not keys & seen:
            kept.append(k)
        seen |= keys
    return kept


def fit(
    documents: list[np.ndarray], toxic: list[int], grades: int = GRADES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features with a weight, their weights, and thresholds, from the features of each document's words."""
    toxic = np.array(toxic)
    n = np.bincount(toxic, minlength=2)
    if not n.all():
        return np.zeros(0, np.int64), np.zeros(0), np.arange(2.0, grades + 1.0)
    of_toxic = [documents[k] for k in np.flatnonzero(toxic)]
    of_toxic = [of_toxic[k] for k in one_of_copies(of_toxic)]
    # only features of toxic documents can tell them from others
    known, with_toxic = np.unique(np.concatenate([np.unique(ids) for ids in of_toxic]), return_counts=True)
    with_clean = np.zeros(len(known), np.int64)
    for k in np.flatnonzero(toxic == 0):
        with_clean[places_in(known, np.unique(documents[k]))] += 1
    found = ratio_test(with_toxic.astype(float), len(of_toxic), with_clean.astype(float), n[0])
    most = min(MOST_FEATURES, int((found >= MIN_RATIO_TEST).sum()))
    use = known[np.sort(np.argsort(-found, kind="stable")[:most])]
    rows = _counted(documents, use)
    hits = np.array([x.sum() for _, x in rows])
    cuts = np.quantile(hits[toxic == 1], np.arange(1, grades - 1) / (grades - 1))
    grade = np.where(toxic == 1, 1 + (hits[:, None] > cuts[None, :]).sum(axis=1), 0)
    # rows without features are alike but for the grade
    told = np.flatnonzero(hits)
    cells = (
        np.repeat(np.arange(len(told)), [len(rows[d][0]) for d in told]),
        np.concatenate([rows[d][0] for d in told] or [np.zeros(0, np.int64)]),
        np.concatenate([rows[d][1] for d in told] or [np.zeros(0, np.int64)]).astype(float),
    )
    rest = np.bincount(grade[hits == 0], minlength=grades)
    times = np.concatenate([np.ones(len(told)), rest])
    told_and_rest = np.concatenate([grade[told], np.arange(grades)])
    weights, thresholds = fit_ordinal(cells, len(use), told_and_rest, times, grades)
    return use.astype(np.int64), weights, thresholds


def places_in(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places in the ascending ``known`` of those ``values`` that are in it."""
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return at[known[at] == values] if len(known) else at[:0]


def _counted(documents: list[np.ndarray], use: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places in ``use`` of each document's features, and how many of its words have them."""
    return [np.unique(places_in(use, ids), return_counts=True) for ids in documents]


def fit_on(sample: DataFrame) -> tuple[dict[int, float], list[float]]:
    """Fit in one task on a bounded sample ``doc_id, text, label``; returns weights and thresholds."""

    def hashed(batches):
        known: dict[str, list[int]] = {}
        for batch in by_bytes(batches):
            ids = []
            for text in batch.column("text").to_pylist():
                if len(known) > CACHE_WORDS:
                    known.clear()
                own: list[int] = []
                for w in words_of(text):
                    own += known.get(w) or known.setdefault(w, features_of(w))
                ids.append(sorted(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(ids, pa.list_(pa.int32()))],
                names=["doc_id", "label", "ids"],
            )

    def run(batches):
        documents, toxic = [], []
        for batch in batches:
            ids = batch.column("ids")
            flat, ends = ids.values.to_numpy(), ids.offsets.to_numpy()
            documents += [flat[a:z].copy() for a, z in zip(ends[:-1], ends[1:], strict=True)]
            toxic += batch.column("label").to_pylist()
        use, weights, thresholds = fit(documents, toxic)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([use, -1 - np.arange(len(thresholds))])),
                pa.array(np.concatenate([weights, thresholds])),
            ],
            names=["at", "value"],
        )

    rows = sample.mapInArrow(tidy(hashed), "doc_id long, label int, ids array<int>")
    one = rows.repartition(1).sortWithinPartitions("doc_id", F.xxhash64("ids"))
    found = one.mapInArrow(tidy(run), "at long, value double").collect()  # at most 2 ** FEATURE_BITS
    thresholds = [r.value for r in sorted(found, key=lambda r: -r.at) if r.at < 0]
    return {r.at: r.value for r in found if r.at >= 0}, thresholds or [2.0]


def score_toxicity(
    docs: DataFrame,
    weights: dict[int, float],
    thresholds: list[float],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc`` (the input row) and ``found: struct<severity, p_toxic, toxic>`` for each input row.

    ``severity`` is the expected grade, ``p_toxic`` the probability of any grade above none, ``toxic``
    whether that is at least a half. A NULL text is empty. Ids may be NULL or repeat; each row is
    scored by its own text. An empty table gives no rows.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast((weights, thresholds))
    text = F.coalesce(F.col(f"doc.`{text_col}`"), F.lit(""))
    rows = docs.select(F.struct("*").alias("doc")).select("doc", text.alias("text"))

    def run(batches):
        weights, thresholds = model.value
        known: dict[str, float] = {}
        bounds = np.array(thresholds)

        def weight(word: str) -> float:
            if len(known) >= CACHE_WORDS:
                known.clear()
            known[word] = found = sum(weights.get(i, 0.0) for i in features_of(word))
            return found

        for batch in by_bytes(batches):
            scores = []
            for text in batch.column("text").to_pylist():
                own = [known[w] if w in known else weight(w) for w in words_of(text)]
                scores.append(sum(own))
            above = 1 / (1 + np.exp(np.clip(bounds[None, :] - np.array(scores)[:, None], -500, 500)))
            found = pa.StructArray.from_arrays(
                [
                    pa.array(above.sum(axis=1)),
                    pa.array(above[:, 0].copy()),
                    pa.array((above[:, 0] >= 0.5).astype(np.int32)),
                ],
                names=["severity", "p_toxic", "toxic"],
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc"), found], names=["doc", "found"])

    found = T.StructType.fromDDL("found struct<severity: double, p_toxic: double, toxic: int>")
    return rows.mapInArrow(tidy(run), T.StructType([rows.schema["doc"], *found.fields]))


def toxicity(
    docs: DataFrame,
    training_docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    per_class: tuple[int, int] = PER_CLASS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``score_toxicity`` by a model fitted on a bounded sample of ``training_docs`` and ``labels``.

    With no labels, or only one class, every severity is near nothing and no document is toxic.
    """
    sample = labelled_sample(training_docs, labels, label, per_class, id_col, text_col)
    return score_toxicity(docs, *fit_on(sample), id_col, text_col)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
