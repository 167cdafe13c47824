"""Ranked search, nearest neighbours and the manifest against brute force."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import duckdb
import numpy as np
import pytest
from helpers import AWKWARD, docs_of
from pyspark.sql import functions as F

from collartrail.llm import lexical_index, merkle, neighbours, queries

SF = "/root/testdata/sf0.001"


# --- ranked search ------------------------------------------------------------------------

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms_of(text):
    return _TERM.findall((text or "").encode().lower())


def brute_rank(rows, items, top):
    bags = [(i, Counter(terms_of(t))) for i, t in rows]
    bags = [(i, bag, bag.total()) for i, bag in bags if bag]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(term for _, bag, _ in bags for term in bag)
    out = []
    for item, text in set(items):
        scores = []
        for doc, bag, n in bags:
            m = 25 + 75 * n * n_docs // n_terms
            score = 0
            for term, times in Counter(terms_of(text)).items():
                tf = bag[term]
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += times * w * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scores)[:top], 1):
            out.append((item, rank, doc, -score))
    return Counter(out)


ITEMS = [
    (1, "the same line stands in many documents"),
    (1, "the same line stands in many documents"),
    (2, "word WORD words étude 数学 nobody else"),
    (2, "own line"),
    (3, None),
    (4, "— … !"),
    (None, "short word text and special"),
    (5, "x" * 3000 + " word"),
]


@pytest.mark.parametrize("shard_bytes,block,queries_at_once", [(10**9, 128, 1000), (300, 2, 1000), (2000, 3, 2)])
def test_ranks_are_those_of_scoring_everything(spark, monkeypatch, shard_bytes, block, queries_at_once):
    monkeypatch.setattr(lexical_index, "QUERIES", queries_at_once)
    rng = random.Random(3)
    rows = AWKWARD + [(100 + i, " ".join(rng.choices(["a", "b", "line", "word", "many", f"w{i % 7}"], k=rng.randrange(40)))) for i in range(150)]
    docs = docs_of(spark, rows).repartition(3)
    items = spark.createDataFrame([(i, t, 1.0) for i, t in ITEMS], "item_id long, text string, score double")
    size = lexical_index.corpus_size(docs)
    index = lexical_index.build_index(docs, *size, shard_bytes=shard_bytes, block=block)
    found = lexical_index.search(index, items, *size, top=10)
    got = Counter(tuple(r) for r in found.select("query_id", "rank", "doc_id", "score").collect())
    assert got == brute_rank(rows, ITEMS, 10)


def test_no_documents_or_no_queries(spark):
    docs, items = docs_of(spark, AWKWARD), spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert lexical_index.ranked_search(docs.limit(0), items).count() == 0
    assert lexical_index.ranked_search(docs, items.limit(0)).count() == 0
    assert lexical_index.ranked_search(docs_of(spark, [(1, None), (2, "")]), items).count() == 0


def test_packed_numbers_come_back():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**28, 2**31 - 1, 5])
    body, ends = lexical_index.pack(values)
    assert lexical_index.unpack(body).tolist() == values.tolist()
    assert lexical_index.unpack(body[ends[2] : ends[5]]).tolist() == values[3:6].tolist()


@pytest.mark.parametrize("text", [b"", b"A b", b"x" * 3_000_000, b"ab1 " * 700_000, b"y" * 1_500_000 + b" z " * 10])
def test_long_texts_fall_into_the_same_terms(text):
    assert [w for part in lexical_index.words_of(text) for w in part] == terms_of(text.decode())


def test_blocks_that_cannot_win_stay_packed():
    """A frequent term's list is met only where a candidate of the rare term could be."""
    sizes = np.full(10_000, 50)
    norm = lexical_index.length_norm(sizes, 10_000, 500_000)
    builder = lexical_index.ShardBuilder(10_000, 500_000, 128)
    for i in range(10_000):
        words = ["common"] + ["rare"] * (i % 100 == 0) * (3 if i < 1000 else 1) + ["filler"] * 46
        builder.add(i, " ".join(words).encode())
    rows = {r["term"]: r for batch in builder.rows(0) for r in batch.to_pylist() if r["term"]}
    lists = {t: lexical_index.Postings(rows[t], norm) for t in (b"common", b"rare")}
    heap = lexical_index.Heap(10)
    lexical_index.search_shard([(3, lists[b"common"]), (5000, lists[b"rare"])], np.arange(10_000), heap, window=256)
    assert heap.ids.tolist() == [100 * k for k in range(10)]
    assert lists[b"common"].unpacked <= 8 and len(lists[b"common"].lasts) == 79


# --- nearest neighbours -------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, part string, score double")


def brute_nearest(rows, every, top):
    x = {i: np.array(v, float) for i, v in rows}
    out = {}
    for q in x:
        if q % every:
            continue
        scored = []
        for i, v in x.items():
            if i != q:
                s = (x[q] * v).sum() / (math.sqrt((x[q] ** 2).sum()) * math.sqrt((v**2).sum()))
                scored.append((-s, i))
        out[q] = [i for _, i in sorted(scored)[:top]]
    return out


def test_all_copies_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=8).round(2).tolist()) for i in range(60)]
    good += [(100 + i, good[0][1]) for i in range(40)]  # copies, queries among them
    good += [(200, (2 * np.array(good[1][1])).tolist())]
    bad = [(300, None), (302, [0.0] * 8), (304, [1.0] * 7 + [None]), (306, [float("nan")] + [1.0] * 7)]
    bad += [(308, [float("inf")] + [1.0] * 7), (310, [1.0, 2.0]), (None, [1.0] * 8), (312, [])]
    rows = [(i, v, 0, "p", 1.0) for i, v in good + bad]
    rows += [(0, good[0][1], 1, "again", 2.0)]
    found = neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 2 == 0).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.vec_id)
        assert r["rank"] == len(got[r.query_id])
    exact = brute_nearest([(i, np.float32(v).astype(float)) for i, v in good], 2, 5)
    assert got == exact


def test_few_and_no_vectors(spark):
    def all_of(rows):
        found = neighbours.nearest(vectors(spark, [(i, v, 0, "", 0.0) for i, v in rows]), F.col("vec_id") >= 0)
        return sorted((r.query_id, r["rank"], r.vec_id) for r in found.collect())

    assert all_of([]) == []
    assert all_of([(1, [1.0, 0.0])]) == []
    assert all_of([(1, [1.0, 0.0]), (2, [1.0, 1.0])]) == [(1, 1, 2), (2, 1, 1)]
    assert all_of([(1, None), (2, [0.0])]) == []


def test_learned_partitions_find_nine_of_ten(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    x = (centres[rng.integers(0, 30, 4000)] + 0.5 * rng.normal(size=(4000, 16))).astype(np.float32)
    rows = [(i, v.tolist(), 0, "", 0.0) for i, v in enumerate(x)]
    found = neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, sample=2048, per_part=64)
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
        assert abs(r.score - neighbours.cosines(x[[r.query_id]].astype(float), x[[r.vec_id]].astype(float))[0]) < 1e-12
    exact = brute_nearest([(i, v.astype(float)) for i, v in enumerate(x)], 20, 5)
    assert sum(len(got[q] & set(w)) for q, w in exact.items()) >= 0.9 * 5 * len(exact)


def test_parts_are_balanced_and_cut_fewer_edges_than_chance():
    rng = np.random.default_rng(3)
    x = neighbours.unit(rng.normal(size=(12, 16))[rng.integers(0, 12, 1024)] + 0.3 * rng.normal(size=(1024, 16)))
    graph = neighbours.neighbour_graph(x, 10)
    part = neighbours.balanced_parts(x, graph, 8)
    assert np.bincount(part).tolist() == [128] * 8
    assert (part[graph] != part[:, None]).mean() < 0.35  # by chance 0.875


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(4)
    x, want = rng.normal(size=(20, 6)), rng.dirichlet(np.ones(4), 20)
    model = {"w1": rng.normal(size=(6, 5)), "b1": rng.normal(size=5), "w2": rng.normal(size=(5, 4)), "b2": rng.normal(size=4)}

    def loss():
        return -(want * np.log(neighbours.network(x, model)[0])).sum(axis=1).mean()

    for name, found in neighbours.gradients(x, want, model).items():
        for at in np.ndindex(model[name].shape):
            model[name][at] += 1e-6
            high = loss()
            model[name][at] -= 2e-6
            assert abs((high - loss()) / 2e-6 - found[at]) < 1e-6
            model[name][at] += 1e-6


# --- manifest -----------------------------------------------------------------------------


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def climb(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][k : k + 3]) for k in range(0, len(levels[-1]), 3)])
    return levels


def way(levels, at):
    out = []
    for nodes in levels[:-1]:
        low = at // 3 * 3
        out.append((nodes[low:at], nodes[at + 1 : low + 3]))
        at //= 3
    return out


def brute_manifest(rows):
    def leaf(row, text):
        return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])

    names = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {
        s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        for s in names
    }
    trees = {s: climb([leaf(r, r[4]) for r in ordered[s]]) for s in names}
    top = climb([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for at, r in enumerate(ordered[s]):
            path, text = way(trees[s], at) + way(top, k), r[4]
            if text is not None and r[0] is not None and crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf(r, text)
            for left, right in path:
                folded = digest(*left, folded, *right)
            proof = digest(*[d for left, right in path for d in left + right])
            root = top[-1][0]
            out.append((r[0], leaf(r, r[4]), trees[s][-1][0], root, proof, folded, folded == root))
    return out


MANIFEST = "doc_id long, source string, lang string, n_chars long, text string, pos long, grp string, digest string"


def manifest_of(spark, rows, levels):
    docs = spark.createDataFrame([(*r, 7, "g", "d") for r in rows], MANIFEST)
    altered = F.when(queries.even_crc32("doc_id"), F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle.manifest(docs.repartition(3), altered, levels=levels)


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_is_that_of_one_tree_built_at_once(spark, levels):
    rng = random.Random(6)
    sources = [None, "", "a", "Z", "é", "one"]
    rows = [
        (i, "one" if i == 0 else rng.choice(sources[:5]), rng.choice([None, "en", ""]), rng.choice([None, i]), rng.choice([None, "", "a\nb", "ü\n\n", "plain"]))
        for i in range(80)
    ]
    rows += [(i, "hot", "en", 1, f"line\n{i}") for i in range(1000, 1200)]
    rows += [(None, "a", "en", 1, "x"), (None, "a", None, 1, "y\n"), (5, "a", "en", 2, "again"), (5, "a", "en", 2, "again")]
    found = manifest_of(spark, rows, levels)
    got = [tuple(r) for r in found.collect()]
    assert Counter(got) == Counter(brute_manifest(rows))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_lone_leaves_and_full_runs(spark, n):
    rows = [(i, "s", "en", 1, "t\n") for i in range(n)]
    assert Counter(tuple(r) for r in manifest_of(spark, rows, 2).collect()) == Counter(brute_manifest(rows))


def test_manifest_of_nothing(spark):
    assert manifest_of(spark, [], 2).count() == 0


def test_folding_hashes_nothing_to_the_left():
    children = [digest(c).encode() for c in "abc"]
    made, slots = merkle.parent(children)
    assert made.decode() == digest(*[c.decode() for c in children])
    for k, slot in enumerate(slots):
        slot.left = None  # folding must not need it
        changed = [*children[:k], digest("new").encode(), *children[k + 1 :]]
        assert slot.fold(changed[k]).decode() == digest(*[c.decode() for c in changed])
        assert slot.fold(children[k]) == made  # the kept state is not used up


@pytest.mark.parametrize("name", ["op11_block_max_maxscore", "op13_merkle_manifest"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    result = con.execute(queries.SQL[name])
    names = [d[0] for d in result.description]
    want = sorted((tuple(r[names.index(c)] for c in cols) for r in result.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == want
