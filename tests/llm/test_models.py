"""Classifiers by held-out accuracy, the language model by brute force and by its sums."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import AWKWARD, docs_of

from collartrail.llm import line_crf, pitman_yor, queries, samples, toxicity

SF = "/root/testdata/sf0.01"


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def held_out(doc_id, divisor, remainder):
    return zlib.crc32(str(doc_id).encode()) % divisor == remainder


def test_quality_of_unseen_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op1_line_crf(spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == held_out(r.doc_id, 4, 2) and r.predicted == (r.score >= 0.7) for r in rows)
    unseen = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in unseen]) > 0.95


def test_toxicity_of_unseen_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op7_toxicity(spark, sf).collect()
    assert len(rows) == 10_000 and all(0 <= r.severity <= 3 for r in rows)
    unseen = [(r.toxic, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic = [a for a, b in unseen if b]
    clean = [a for a, b in unseen if not b]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.02
    # more severe grades are likelier where the score is higher, and severity follows
    by_p = sorted(rows, key=lambda r: r.p_toxic)
    assert by_p[0].severity <= by_p[-1].severity


def test_models_on_awkward_rows(spark):
    docs = docs_of(spark, AWKWARD)
    for labels in (
        labels_of(spark, []),
        labels_of(spark, [(4, 1, 0), (4, 1, 0), (None, 1, 1), (5, None, None)]),
        labels_of(spark, [(4, 1, 0), (5, 0, 1), (99, 1, 1)]),
    ):
        scored = line_crf.document_quality(docs, labels).collect()
        assert Counter(r.doc_id for r in scored) == Counter(i for i, _ in AWKWARD)
        assert all(0 <= r.score <= 1 for r in scored)
        found = toxicity.toxicity(docs, docs, labels)
        assert found.columns == ["doc", "found"]
        assert Counter(r.doc.doc_id for r in found.collect()) == Counter(i for i, _ in AWKWARD)
        assert {r.found.toxic for r in found.filter("doc.text is null or doc.text = ''").collect()} == {0}
    none = docs_of(spark, [])
    assert line_crf.document_quality(none, labels).count() == 0
    assert toxicity.toxicity(none, docs, labels).count() == 0
    assert pitman_yor.language_model_scores(none).count() == 0


def test_sample_is_bounded_and_even(spark):
    docs = docs_of(spark, [(k, f"text {k}") for k in range(100)])
    labels = labels_of(spark, [(k, k % 2, 0) for k in range(100)] * 2)
    sample = samples.labelled_sample(docs, labels, "quality", (7, 9)).collect()
    assert Counter(r.label for r in sample) == {0: 7, 1: 9}
    again = samples.labelled_sample(docs, labels, "quality", (7, 9)).collect()
    assert {r.doc_id for r in sample} == {r.doc_id for r in again}


def test_chain_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    n_lines = np.array([3, 1, 5])
    score, moves = rng.normal(size=9), rng.normal(size=(2, 2))
    got, expected = line_crf.Chains(n_lines).marginals(score, moves)
    start, want, want_moves = 0, [], np.zeros((2, 2))
    for n in n_lines:
        weights = {}
        for code in range(2**n):
            y = [(code >> k) & 1 for k in range(n)]
            s = sum(score[start + k] for k in range(n) if y[k]) + sum(moves[a, b] for a, b in zip(y, y[1:]))
            weights[tuple(y)] = math.exp(s)
        total = sum(weights.values())
        want += [sum(w for y, w in weights.items() if y[k]) / total for k in range(n)]
        for y, w in weights.items():
            for a, b in zip(y, y[1:]):
                want_moves[a, b] += w / total
        start += n
    assert np.allclose(got, want) and np.allclose(expected, want_moves)


def test_ordinal_thresholds_are_ordered_and_severity_grows():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 5, (400, 1)).astype(float)
    grade = np.clip(x[:, 0].astype(int) - 1, 0, 3)
    weights, thresholds = toxicity.fit_ordinal(cells_of(x), x.shape[1], grade, np.ones(400), 4)
    assert weights[0] > 0 and (np.diff(thresholds) > 0).all()


def chances_of_tables(c, weight, discount):
    """Of 1 to c tables, in proportion to S(c, t) weight^t, by the recurrence in logarithms."""
    log_s = {1: 0.0}
    for n in range(1, c):
        log_s = {
            t: np.logaddexp(
                log_s.get(t, -np.inf) + (math.log(n - t * discount) if t <= n else -np.inf), log_s.get(t - 1, -np.inf)
            )
            for t in range(1, n + 2)
        }
    w = np.array([log_s[t] + t * math.log(weight) for t in range(1, c + 1)])
    w = np.exp(w - w.max())
    return w / w.sum()


@pytest.mark.parametrize("discount", [0.6, 0.8])
@pytest.mark.parametrize("c, weight", [(1, 2), (2, 0.3), (12, 1), (200, 7), (201, 0.01), (300, 0.5), (300, 20), (400, 1000)])
def test_tables_of_a_dish_are_drawn_from_their_distribution(c, weight, discount):
    chances = chances_of_tables(c, weight, discount)
    t = np.arange(1, c + 1)
    mean = chances @ t
    n = 6000 if weight < 100 else 1000
    dishes = pitman_yor.Dishes(np.full(n, c), discount)
    dishes.draw(np.full(n, float(weight)), np.random.default_rng(c))
    error = 5 * math.sqrt(chances @ (t - mean) ** 2 / n)
    assert dishes.tables.mean() == pytest.approx(mean, rel=0.01, abs=error)
    assert dishes.expected.mean() == pytest.approx(mean, rel=0.01, abs=error if c > pitman_yor.WHOLE else 1e-9)


def test_log_gamma():
    for z in (1e-3, 0.4, 1.0, 7.5, 1e3, 1e7):
        assert pitman_yor.log_gamma(np.array([z]))[0] == pytest.approx(math.lgamma(z), abs=1e-7, rel=1e-10)


def seatings(n):
    """All ways to part n customers into tables, as tuples of sizes, one for each way."""
    ways = [()]
    for _ in range(n):
        ways = [
            (*w[:k], w[k] + 1, *w[k + 1 :]) if k < len(w) else (*w, 1) for w in ways for k in range(len(w) + 1)
        ]
    return ways


def test_gibbs_sweeps_reach_the_seating_of_a_context():
    """Mean tables over all seatings of a small context, listed one by one, against many sweeps."""
    d, strength, p = pitman_yor.DISCOUNT, pitman_yor.STRENGTH, [0.05, 0.3, 0.6]
    customers = [5, 3, 2]

    def weight(sizes):
        return math.prod(math.prod(k - d for k in range(1, n)) for n in sizes)

    total, sums = 0.0, np.zeros(3)
    for ways in itertools.product(*(seatings(c) for c in customers)):
        tables = np.array([len(w) for w in ways])
        chance = math.prod(weight(w) for w in ways) * math.prod(q**t for q, t in zip(p, tables))
        chance *= math.prod(strength + d * k for k in range(tables.sum()))
        total, sums = total + chance, sums + chance * tables
    n, random = 20_000, np.random.default_rng(3)
    dishes = pitman_yor.Dishes(np.tile(customers, n), d)
    for _ in range(30):
        x = random.gamma(strength / d + dishes.tables.reshape(n, 3).sum(axis=1))
        dishes.draw(d * np.repeat(x, 3) * np.tile(p, n), random)
    assert dishes.tables.reshape(n, 3).mean(axis=0) == pytest.approx(sums / total, rel=0.02)


def test_scores_do_not_depend_on_the_number_of_buckets(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    size = docs.selectExpr("sum(octet_length(text))").first()[0]
    found = {}
    for buckets in (4, 40):
        monkeypatch.setattr(pitman_yor, "BUCKET_BYTES", size // buckets)
        rows = pitman_yor.language_model_scores(docs).collect()
        found[buckets] = sum(r.score for r in rows) / sum(r.n_tokens for r in rows)
    assert found[4] == pytest.approx(found[40], abs=5e-4)


def test_base_scores_equal_brute_force(spark):
    rows = AWKWARD + [(k, f"w{k % 3} w{k % 5} rare{k}") for k in range(30, 60)]
    split = {i: (t or "").encode().lower().split() for i, t in rows if i != 7 and i is not None}
    tokens = [(i, (t or "").encode().lower().split() + [b"/end"]) for i, t in rows]
    taught = [(i, w) for i, w in tokens if i is None or not held_out(i, 5, 1)]
    counts = Counter(x for _, w in taught for x in w)
    n, v = sum(counts.values()), len(counts)
    want = Counter(
        (i, i is not None and held_out(i, 5, 1), len(w), sum(counts[x] > 0 for x in w), n,
         round(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6))
        for i, w in tokens
    )
    found = pitman_yor.language_model_scores(docs_of(spark, rows).repartition(3)).collect()
    got = Counter((*(r[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")), round(r.base_score, 6)) for r in found)
    assert got == want and split
    assert all(r.score < 0 for r in found)


def test_model_beats_single_words_on_unseen_texts(spark):
    rows = [r for r in queries.op5_pitman_yor(spark, SF).collect() if r.held_out]
    n = sum(r.n_tokens for r in rows)
    assert sum(r.score for r in rows) / n > sum(r.base_score for r in rows) / n + 0.2


def test_probabilities_of_a_context_add_up(spark):
    """Texts of one word each ask for P(word | start) and P(end | word)."""
    train = [(k, t) for k, t in enumerate(["a b", "a c", "a b", "b a", "c", "a a a"]) if not held_out(k, 5, 1)]
    words = sorted({w for _, t in train for w in t.split()})
    asks = [k for k in range(100, 400) if held_out(k, 5, 1)]
    pairs = [f"{u} {w}" for u in words for w in words]
    rows = train + list(zip(asks, words + pairs))
    found = {r.doc_id: r.score for r in pitman_yor.language_model_scores(docs_of(spark, rows)).collect()}
    text = dict(rows)
    single = {text[i]: 10 ** found[i] for i in asks[: len(words)]}
    double = {text[i]: 10 ** found[i] for i in asks[len(words) : len(words) + len(pairs)]}
    # P(u) P(end | u) + sum over w of P(u) P(w | u) P(end | w) cannot exceed P(u)
    for u in words:
        assert single[u] + sum(double[f"{u} {w}"] for w in words) < 1
    assert sum(single.values()) + sum(double.values()) < 1


def test_hot_contexts_change_no_counts(spark, monkeypatch):
    rows = [(k, "the a the b the c " * (k % 4 + 1)) for k in range(40)]
    plain = {r.doc_id: r for r in pitman_yor.language_model_scores(docs_of(spark, rows)).collect()}
    monkeypatch.setattr(pitman_yor, "HOT_SHARE", 1e9)
    cold = {r.doc_id: r for r in pitman_yor.language_model_scores(docs_of(spark, rows)).collect()}
    for k, r in plain.items():
        assert r.base_score == pytest.approx(cold[k].base_score)
        assert r.score == pytest.approx(cold[k].score, rel=0.05)


@pytest.mark.parametrize("buckets", [4, 32, 500])
def test_probabilities_of_a_hot_context_add_up(spark, monkeypatch, buckets):
    """The start is hot. ``z`` and ``u`` are unknown, so behind them words have the parent's chances."""
    words = [f"w{k}" for k in range(12)]
    rows = [(None, w) for k, w in enumerate(words) for _ in range(3 + 5 * k)]
    free = (k for k in range(10**6) if held_out(k, 5, 1))
    asks = {t: next(free) for w in words for t in (w, f"z {w}", f"z {w} u")} | {t: next(free) for t in ("", "z", "z u")}
    rows += [(i, t) for t, i in asks.items()]
    monkeypatch.setattr(pitman_yor, "BUCKET_BYTES", sum(len(t) for _, t in rows) // buckets)
    got = {r.doc_id: 10**r.score for r in pitman_yor.language_model_scores(docs_of(spark, rows)).collect()}
    at = {t: got[i] for t, i in asks.items()}
    # words are only followed by the end, so P(end | w) = 1 - back_off(w) (1 - p(end))
    unknown = at["z u"] / at["z"]
    ends = {w: at[f"z {w}"] / at["z"] for w in words}  # p(w) P(end | w) / p(end)
    backs = {w: at[f"z {w} u"] / at["z u"] for w in words}  # p(w) back_off(w)
    p_end = (1 - unknown - sum(backs.values())) / (1 + sum(ends.values()) - sum(backs.values()))
    p = {w: ends[w] * p_end + backs[w] * (1 - p_end) for w in words}
    behind_start = [at[w] * p[w] / (ends[w] * p_end) for w in words] + [at[""], at["z"] / p_end]
    assert sum(behind_start) == pytest.approx(1, abs=1e-3)


def test_hot_contexts_are_counted_over_all_rows(spark):
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(100_000))) for k in range(6)] + [(9, "late " * 600_000)]
    found = pitman_yor._hot_contexts(docs_of(spark, rows).coalesce(1).select("doc_id", "text"), 8)
    assert pitman_yor.WordHashes().of([b"late"])[0] & pitman_yor.HASH_BITS in found
    assert len(found) == 1
    assert not len(pitman_yor._hot_contexts(docs_of(spark, []), 8))


def cells_of(x):
    row, column = np.nonzero(x)
    return row, column, x[row, column].astype(float)


def test_ordinal_gradients_and_probabilities_are_those_of_the_model():
    rng = np.random.default_rng(8)
    x = rng.integers(0, 3, (60, 7)) * (rng.random((60, 7)) < 0.4)
    grade, times = rng.integers(0, 4, 60), rng.integers(1, 5, 60).astype(float)
    w, first, gaps = rng.normal(size=7), rng.normal(size=1), rng.normal(size=2)

    def brute():
        cuts = [first[0], first[0] + np.exp(gaps[0]), first[0] + np.exp(gaps[0]) + np.exp(gaps[1])]
        total = 0.0
        for row, g, n in zip(x, grade, times):
            at_least = [1.0, *[1 / (1 + np.exp(c - row @ w)) for c in cuts], 0.0]
            total -= n * np.log(at_least[g] - at_least[g + 1])
        return total / times.sum() + toxicity.PENALTY / 2 * (w @ w)

    loss, *found = toxicity.loss_and_gradients(cells_of(x), grade, times, w, first, gaps)
    assert abs(loss - brute()) < 1e-9
    for value, gradient in zip((w, first, gaps), found):
        for k in range(len(value)):
            value[k] += 1e-6
            high = brute()
            value[k] -= 2e-6
            assert abs((high - brute()) / 2e-6 - gradient[k]) < 1e-6
            value[k] += 1e-6


def test_severity_is_the_expected_grade(spark):
    from helpers import docs_of

    texts = ["grim words here", "nice day", "", None, "grim grim foul"]
    weights = {f: 1.5 for f in toxicity.features_of("grim")} | {f: -0.5 for f in toxicity.features_of("nice")}
    cuts = [0.5, 1.0, 3.0]
    found = toxicity.score_toxicity(docs_of(spark, list(enumerate(texts))), weights, cuts)
    for r in found.select("doc.doc_id", "doc.text", "found.*").collect():
        score = sum(weights.get(f, 0.0) for w in set((r.text or "").split()) for f in toxicity.features_of(w))
        at_least = [1 / (1 + np.exp(c - score)) for c in cuts]
        steps = [1.0, *at_least, 0.0]
        assert abs(r.severity - sum(g * (steps[g] - steps[g + 1]) for g in range(4))) < 1e-9
        assert abs(r.p_toxic - at_least[0]) < 1e-9 and r.toxic == (at_least[0] >= 0.5)


def test_draws_without_a_mean_give_the_same_tables():
    customers = np.array([0, 1, 2, 5, 40, 150, 900] * 30)
    weight = np.random.default_rng(0).gamma(1.0, 3.0, len(customers)) + 1e-3
    weight[::7] = 1e60
    one, other = (pitman_yor.Dishes(customers, 0.8) for _ in range(2))
    at_start = other.expected.copy()
    a, b = np.random.default_rng(1), np.random.default_rng(1)
    for _ in range(3):
        one.draw(weight, a)
        other.draw(weight, b, mean=False)
        assert (one.tables == other.tables).all()
    few = customers <= pitman_yor.WHOLE
    assert (other.expected[few] == at_start[few]).all() and (one.expected[few] != at_start[few]).any()
    other.draw(weight, b)
    one.draw(weight, a)
    assert (one.expected == other.expected).all()


def test_words_counted_in_parts_are_the_same_hot_contexts(monkeypatch):
    class Rows:
        def mapInArrow(self, run, schema):
            texts = [" ".join(f"w{k % m}" for k in range(300)) for m in (1, 3, 50, 299)] * 3
            batches = [pa.RecordBatch.from_pydict({"text": texts[i : i + 2]}) for i in range(0, len(texts), 2)]
            (found,) = run(iter(batches))
            counts.append(dict(zip(*found.to_pydict().values(), strict=True)))
            raise StopIteration

    counts: list[dict] = []
    for most in (10**6, 10):
        monkeypatch.setattr(pitman_yor, "CACHE_WORDS", most)
        with pytest.raises(StopIteration):
            pitman_yor._hot_contexts(Rows(), 4)
    assert counts[0] == counts[1] and counts[0][None] == 3 * (4 * 300 + 4)


def test_tokens_of_a_batch_are_those_of_each_text():
    words = [b"A", b"a", b"a\0", b"\0", b"a\0\0", "ß".encode(), "Ä".encode(), "\u00a0\u2003x".encode(), b"\x1c"]
    words += [b"xY" * 40 + bytes([97 + k]) for k in range(3)] + [b"x" * n for n in (*range(1, 42), 5000)]
    blanks = [b" ", b"\t", b"\n \n", b"\x0b", b"\x0c", b"\r"]
    texts = [blanks[k % 6].join(words[k::7] + words[k : k + 3]).decode() for k in range(30)]
    texts += ["", "end", "start", " \n", " both sides ", "", "x", "x y", "y", ""]
    table = pa.RecordBatch.from_pydict({"text": texts})
    for batch in (table, table.slice(3, 9), table.slice(32, 6), table.slice(30, 1), table.slice(30, 0)):
        found = pitman_yor.Tokens(batch.column("text"))
        plain = [t.encode().lower().split() for t in batch.column("text").to_pylist()]
        assert found.counts.tolist() == [len(p) for p in plain]
        hashes = pitman_yor.WordHashes().of([w for p in plain for w in p]) & pitman_yor.HASH_BITS
        assert (found.hashes[found.words] == hashes).all()
        assert len(found.hashes) == len(np.unique(hashes))


def proposed_one_table_at_a_time(dishes, weight, random):
    """What ``_propose`` gives, weighed at each table."""
    n_proposals, d = pitman_yor.PROPOSALS, dishes.discount
    c, weight = (np.tile(x, n_proposals) for x in (dishes.customers[dishes.many], weight))
    below, above = np.full(len(c), np.log(1e-9)), np.log(weight + c + 1.0)
    for _ in range(30):
        x = np.exp((below + above) / 2)
        less = x * ((x + c - (1 + d) / 2) / (x + (1 - d) / 2)) ** d < weight
        below, above = np.where(less, (below + above) / 2, below), np.where(less, above, (below + above) / 2)
    shift = np.exp(below) - (1 + d) / 2
    seated, tables, log_w = (np.ones(len(c)) for _ in range(3))
    low = 1
    while low < c.max():
        high = max(low + 1, int(low * 1.42))
        opens = weight * (((low + high) / 2 + shift) / (c + shift)) ** d
        at = np.flatnonzero(c > low)
        while len(at):
            a, n, t, stop = opens[at], seated[at], tables[at], np.minimum(high, c)[at]
            reached = n + np.minimum(random.geometric(np.clip(random.beta(a, n - d * t), 1e-15, 1)), stop)
            new, reached = reached <= stop, np.minimum(reached, stop)
            gain = [math.lgamma(r) - math.lgamma(s) for r, s in zip(reached - d * t + a, n - d * t + a, strict=True)]
            log_w[at] += gain + np.where(new, np.log(weight[at] / a), 0)
            seated[at], tables[at] = reached, t + new
            at = at[reached < stop]
        low = high
    return tables.reshape(n_proposals, -1), log_w.reshape(n_proposals, -1)


def test_proposals_are_weighed_many_at_once(monkeypatch):
    """The same tables and weights as step by step, in two calls for each range of seats, not for each table."""
    dishes = pitman_yor.Dishes(np.array([201, 3, 700, 100_000, 260, 5000]), 0.8)
    weight = np.array([0.01, 4.0, 3e4, 0.5, 20.0])
    calls, plain = [], pitman_yor.log_gamma
    monkeypatch.setattr(pitman_yor, "log_gamma", lambda z: calls.append(len(z)) or plain(z))
    tables, log_w = dishes._propose(weight, np.random.default_rng(5))
    want, want_log_w = proposed_one_table_at_a_time(dishes, weight, np.random.default_rng(5))
    assert (tables == want).all() and (tables > 100).any()
    assert log_w == pytest.approx(want_log_w, abs=1e-5, rel=1e-9)
    assert len(calls) <= 2 * math.log(100_000, 1.3)
