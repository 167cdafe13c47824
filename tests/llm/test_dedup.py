"""Exact dedup, line dedup and near-duplicates on awkward rows and against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import AWKWARD, docs_of, near_groups
from pyspark.sql import functions as F

from collartrail.llm import components, exact_dedup, hyperminhash, line_dedup


def expected_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = Counter()
    for i, t in rows:
        body = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        keep = min((x for x in groups[body] if x is not None), default=None)
        out[i, keep, len(groups[body]), i == keep, hashlib.sha256(body.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize(
    "digest", [exact_dedup.sha256, lambda t: F.substring(exact_dedup.sha256(t), 1, 0)]
)
def test_exact_groups_whatever_the_digest(spark, digest):
    rows = AWKWARD + [(20, "a  b"), (21, "a\tb"), (22, "a\nb"), (23, " a b")]
    found = exact_dedup.exact_groups(docs_of(spark, rows).repartition(5), digest=digest, salts=2)
    got = Counter(
        (r.doc_id, r.keep_id, r.group_size, r.kept) for r in found.select("doc_id", "keep_id", "group_size", "kept").collect()
    )
    want = Counter()
    for k, n in expected_groups(rows).items():
        want[k[:4]] += n
    assert got == want


def test_exact_digest_is_of_the_normalised_text(spark):
    found = exact_dedup.exact_groups(docs_of(spark, [(1, "a  b")])).first()
    assert bytes(found.digest) == hashlib.sha256(b"a b").digest()


def expected_lines(rows):
    def key(line):
        return re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    owners = defaultdict(set)
    rank = lambda i: float("-inf") if i is None else i
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                owners[key(line)].add(i)
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = [
            k
            for k, line in enumerate(lines)
            if len(key(line)) >= 20
            and len(owners[key(line)]) >= 3
            and rank(i) < max(map(rank, owners[key(line)]))
        ]
        out[i, len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone)] += 1
    return out


def test_lines(spark):
    found = line_dedup.drop_shared_lines(docs_of(spark, AWKWARD)).select("doc.doc_id", "found.*")
    got = Counter(tuple(r) for r in found.collect())
    assert got == expected_lines(AWKWARD)
    assert sum(n for (_, _, gone, _), n in got.items() if gone) == 3


def edited(rng, words, share):
    return [f"e{rng.random()}" if rng.random() < share else w for w in words]


def near_rows(seed=3):
    rng = random.Random(seed)
    rows, i = list(AWKWARD), 100
    for size in (1, 2, 5, 6, 7, 8, 30, 200):
        base = [f"w{rng.randrange(500)}" for _ in range(size + 2)]
        rows.append((i, " ".join(base)))
        for share in (0, 0.01, 0.02, 0.03, 0.05, 0.08):
            i += 1
            rows.append((i, " ".join(edited(rng, base, share))))
        rows.append((i + 1, " ".join(base[:-1])))
        i += 10
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
@pytest.mark.parametrize("block", [1500, 3])
def test_near_duplicates_equal_all_pairs(spark, words, percent, block):
    rows = near_rows()
    found = hyperminhash.near_duplicates(docs_of(spark, rows), words, percent, block_nodes=block)
    want = near_groups(rows, words, percent)
    got = [(r.doc_id, r.component_id, r.kept) for r in found.collect()]
    assert len(got) == len(rows)
    assert all(want[i] == c and k == (i == c) for i, c, k in got)
    assert len(set(want.values())) < len(want)


def test_no_rows(spark):
    none = docs_of(spark, [])
    assert exact_dedup.exact_groups(none).count() == 0
    assert line_dedup.drop_shared_lines(none).count() == 0
    assert hyperminhash.near_duplicates(none).count() == 0


def test_registers_tell_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    registers = hyperminhash.Registers(1000)
    common = rng.integers(0, 2**63, 8000).astype(np.uint64)
    a = np.concatenate([common, rng.integers(0, 2**63, 1000).astype(np.uint64)])
    b = np.concatenate([common, rng.integers(0, 2**63, 1000).astype(np.uint64)])
    x, y = registers.of([a * np.uint64(2), b * np.uint64(2)])
    assert abs(hyperminhash.corrected(np.array([(x == y).mean()]))[0] - 0.8) < 0.05


def test_intersections_are_exact():
    import numpy as np

    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 80))).astype(np.uint64) for _ in range(60)]
    for dense_from in (2, 24, 100):
        found = hyperminhash.intersections(sets, dense_from)
        assert all(
            found[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(60) for j in range(60)
        )


def test_components_of_a_long_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 150)] + [(7, 7)]
    found = components.components(spark.createDataFrame(links, "a long, b long"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 150)}


def test_slices_of_asking_documents_are_bounded_by_shingles(spark):
    asking = spark.createDataFrame([(1, k, 20_000) for k in range(100)] + [(2, 1, 5)], "centre long, node long, n_all long")
    got = {r.centre: r.n_slices for r in hyperminhash._slices(asking, 1_500, 1_000_000).collect()}
    assert got == {1: 2, 2: 1}
