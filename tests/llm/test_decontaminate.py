"""Decontamination and the corpus pipeline against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from helpers import AWKWARD, contaminated, docs_of, near_groups
from test_dedup import expected_lines
from test_tokens import library_encoder

from collartrail.llm import decontaminate
from collartrail.session import stage

ITEMS = [
    (1, " ".join(f"w{k}" for k in range(20))),
    (2, "Short item, of SIX words only"),
    (3, "two words"),
    (4, "lone"),
    (5, None),
    (6, "?!"),
    (None, "an item that has no name but more than thirteen words so that windows slide over it"),
    (7, " ".join(f"w{k}" for k in range(3, 18))),
    (7, "seven again has a second text"),
    (10, "étude à la carte — ünïcode 数学"),
]


def random_rows(seed):
    rng = random.Random(seed)
    pool = [t for _, t in ITEMS if t]
    rows = list(AWKWARD)
    for k in range(60):
        words = [rng.choice(["w1", "w2", "x", "Two", "words", "lone?"]) for _ in range(rng.randrange(30))]
        for _ in range(rng.randrange(3)):
            item = rng.choice(pool).split()
            a = rng.randrange(len(item))
            at = rng.randrange(len(words) + 1)
            words[at:at] = item[a if rng.random() < 0.5 else 0 :]
        rows.append((200 + k % 50, rng.choice([" ", ", ", "\n"]).join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_contamination_equals_brute_force(spark, seed):
    rows = random_rows(seed)
    items = spark.createDataFrame([(i, t, 1.0) for i, t in ITEMS], "item_id long, text string, n_hit double")
    found = decontaminate.contamination(docs_of(spark, rows), items).collect()
    want = Counter()
    for (i, words, hit, names), n in contaminated(rows, ITEMS).items():
        want[i, words, hit, hashlib.sha256(names.encode()).hexdigest(), hit > 0 and 20 * hit >= words] += n
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.items_sha256, r.contaminated) for r in found)
    assert got == want
    assert sum(n for k, n in got.items() if k[2]) > 20


def test_no_documents_or_no_items(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination(docs_of(spark, []), items).count() == 0
    found = decontaminate.contamination(docs_of(spark, AWKWARD), items.filter("item_id = 5")).collect()
    assert len(found) == len(AWKWARD) and not any(r.n_hit for r in found)


def test_pipeline_stages_equal_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    before = [tuple(r) for r in docs.collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    texts = []
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, sf), name)
        texts.append([(r.doc_id, r.text) for r in docs.collect()] if name != "byte_bpe" else None)
        if name != "byte_bpe":
            assert docs.columns == columns
    assert set(texts[0]) <= {(r[0], r[1]) for r in before}
    want = {i: t for (i, _, gone, t) in expected_lines(texts[0]) if not gone or t.strip(" \t\n\x0b\f\r")}
    assert dict(texts[1]) == want
    groups = near_groups(texts[1], 5, 80)
    assert sorted(i for i, _ in texts[2]) == sorted(i for i, first in groups.items() if i == first)
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {i for (i, words, hit, _) in contaminated(texts[2], items) if hit and 20 * hit >= words}
    assert sorted(i for i, _ in texts[3]) == sorted(i for i, _ in texts[2] if i not in bad)
    encoder = library_encoder()
    assert {r.doc_id: r.n_tokens for r in docs.collect()} == {
        i: len(encoder.encode_ordinary(t)) for i, t in texts[3]
    }
    whole = corpus_pipeline.run(spark, sf)
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, docs.collect()))


def test_pipeline_on_awkward_rows(spark):
    sf = "/root/testdata/sf0.001"
    copies = [(300 + k, "copy of a longer text with many words in it so that it has shingles") for k in range(4)]
    for rows in (AWKWARD + copies, []):
        docs = docs_of(spark, rows)
        for name, step in corpus_pipeline.STAGES:
            docs = stage(step(spark, docs, sf), name)
        kept = Counter(r.doc_id for r in docs.collect())
        assert set(kept) <= {i for i, _ in rows}
        if rows:
            left = defaultdict(int, kept)
            assert sum(left[300 + k] for k in range(4)) == 1 and left[9] and left[10] and left[None]
