"""Nearest neighbours by cosine, with partitions learned from a neighbour graph.

1. On a bounded sample the graph of nearest neighbours is cut into parts of equal size with few edges
   between them (recursive bisection), and a small network learns from a vector how its neighbours are
   spread over the parts.
2. Every vector is filed under its most probable part. A query goes to its most probable parts, as many
   as a held-out part of the sample needed to find its neighbours there.
3. Within a part, blocks of vectors meet blocks of queries, and exact cosines rank what was found.

Copies of a vector are filed once, with the least ids they stand for, and searched for once.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collartrail.llm.text import salted_join
from collartrail.session import stage

#: Vectors the partitions are learned from; all if there are fewer.
SAMPLE = 16_384
#: Sample vectors for each part; the number of parts is a power of two.
PER_PART = 256
#: Share of the held-out sample's neighbours that must lie in the parts looked into.
COVERAGE = 0.95
#: Rows and queries that meet in one group of a task.
BLOCK_ROWS, BLOCK_QUERIES = 8_192, 4_096

_GRAPH, _HIDDEN, _EPOCHS, _BATCH, _RATE = 10, 128, 20, 256, 0.003
#: Cosines by matrix product differ from exact ones by less than this.
_SLACK = 1e-9

_MODEL = "w1 binary, b1 binary, w2 binary, b2 binary, mass double"


# --- learning -----------------------------------------------------------------------------


def neighbour_graph(x: np.ndarray, k: int, block: int = 1_024) -> np.ndarray:
    """The ``k`` nearest others of each row of unit vectors."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for low in range(0, len(x), block):
        near = x[low : low + block] @ x.T
        near[np.arange(len(near)), np.arange(low, low + len(near))] = -np.inf
        out[low : low + block] = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else 0
    return out


def halves(a: np.ndarray, b: np.ndarray, n: int, start: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Which half each of ``n`` nodes is in: equal in size, with few of the edges ``a - b`` cut.

    The second eigenvector of the walk on the graph puts nodes in line; the middle cuts. Then pairs
    across the cut change places while that saves edges.
    """
    degree = np.maximum(np.bincount(a, minlength=n) + np.bincount(b, minlength=n), 1).astype(float)
    line = start - np.average(start, weights=degree)
    for _ in range(rounds):
        pulled = np.bincount(a, line[b], n) + np.bincount(b, line[a], n)
        line = 0.5 * line + 0.5 * pulled / degree
        line -= np.average(line, weights=degree)
        line /= np.abs(line).max() or 1.0
    side = np.zeros(n, bool)
    side[np.argsort(line, kind="stable")[n // 2 :]] = True
    for _ in range(10):
        cut = (side[a] != side[b]).astype(float)
        gain = np.bincount(a, 2 * cut - 1, n) + np.bincount(b, 2 * cut - 1, n)
        low, high = np.flatnonzero(~side), np.flatnonzero(side)
        low, high = low[np.argsort(-gain[low])], high[np.argsort(-gain[high])]
        m = min(len(low), len(high))
        # a few at a time: neighbours that move together spoil each other's gain
        many = min(int((gain[low[:m]] + gain[high[:m]] > 0).sum()), max(1, n // 20))
        if not many:
            break
        swapped = side.copy()
        swapped[low[:many]], swapped[high[:many]] = True, False
        if (swapped[a] != swapped[b]).sum() >= cut.sum():
            break
        side = swapped
    return side


def balanced_parts(x: np.ndarray, graph: np.ndarray, n_parts: int) -> np.ndarray:
    """A part for each node, sizes equal but for one, by cutting the graph in halves again and again."""
    part = np.zeros(len(x), np.int64)
    a, b = np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()
    made = 1
    while made < n_parts:
        deeper = np.zeros(len(x), np.int64)
        for p in range(made):
            mine = np.flatnonzero(part == p)
            place = np.full(len(x), -1)
            place[mine] = np.arange(len(mine))
            inside = (place[a] >= 0) & (place[b] >= 0)
            body = x[mine] - x[mine].mean(axis=0)
            axis = np.linalg.eigh(body.T @ body)[1][:, -1]
            side = halves(place[a[inside]], place[b[inside]], len(mine), body @ axis)
            deeper[mine] = 2 * p + side
        part, made = deeper, 2 * made
    return part


def network(x: np.ndarray, model: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the parts, and the hidden layer."""
    hidden = np.maximum(x @ model["w1"] + model["b1"], 0)
    logits = hidden @ model["w2"] + model["b2"]
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True), hidden


def gradients(x: np.ndarray, want: np.ndarray, model: dict) -> dict[str, np.ndarray]:
    """Of the mean cross entropy between ``want`` and the network's probabilities."""
    p, hidden = network(x, model)
    out = (p - want) / len(x)
    back = (out @ model["w2"].T) * (hidden > 0)
    return {"w1": x.T @ back, "b1": back.sum(0), "w2": hidden.T @ out, "b2": out.sum(0)}


def train(x: np.ndarray, want: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    d, parts = x.shape[1], want.shape[1]
    model = {
        "w1": rng.normal(0, np.sqrt(2 / d), (d, _HIDDEN)) * np.sqrt(d) / 2,
        "b1": np.zeros(_HIDDEN),
        "w2": rng.normal(0, np.sqrt(1 / _HIDDEN), (_HIDDEN, parts)),
        "b2": np.zeros(parts),
    }
    mean = {k: np.zeros_like(v) for k, v in model.items()}
    square = {k: np.zeros_like(v) for k, v in model.items()}
    step = 0
    for _ in range(_EPOCHS):
        order = rng.permutation(len(x))
        for low in range(0, len(x), _BATCH):
            some = order[low : low + _BATCH]
            step += 1
            for k, g in gradients(x[some], want[some], model).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                fair = np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8
                model[k] = model[k] - _RATE * mean[k] / (1 - 0.9**step) / fair
    return model


def mass_before(p: np.ndarray) -> np.ndarray:
    """For each part, the probability of the parts before it in its row's order."""
    order = np.argsort(-p, axis=1, kind="stable")
    ranked = np.take_along_axis(p, order, axis=1)
    out = np.empty_like(p)
    np.put_along_axis(out, order, np.cumsum(ranked, axis=1) - ranked, axis=1)
    return out


def fit(x: np.ndarray, per_part: int, coverage: float, near: int = 5) -> dict:
    """Network over parts and the probability mass that queries look into."""
    n_parts = 1 << max(0, int(np.log2(max(len(x) // per_part, 1))))
    graph = neighbour_graph(x, _GRAPH)
    part = balanced_parts(x, graph, n_parts)
    want = np.zeros((len(x), n_parts))
    np.add.at(want, (np.arange(len(x)), part), 1.0)
    for column in graph.T:
        np.add.at(want, (np.arange(len(x)), part[column]), 1.0)
    want /= want.sum(axis=1, keepdims=True)
    held = np.arange(len(x)) % 10 == 0
    model = train(x[~held] if n_parts > 1 else x, want[~held] if n_parts > 1 else want)
    p, _ = network(x, model)
    filed, before = p.argmax(axis=1), mass_before(p)
    mass = 1.0
    if n_parts > 1:
        asked = np.flatnonzero(held)
        nearest = neighbour_graph(x, near)[asked]
        needed = np.sort(np.take_along_axis(before[asked], filed[nearest], axis=1), axis=None)
        mass = float(needed[min(int(np.ceil(coverage * len(needed))), len(needed) - 1)]) + 1e-12
    return {**model, "mass": mass}


# --- vectors ------------------------------------------------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows; sums do not depend on where a row stands."""
    lengths = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
    return (a * b).sum(axis=1) / lengths


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` of the rows that take part; one for each id, the least of several.

    Left out are rows without id, and vectors that are NULL, zero, hold NULL or non-finite
    components, have squares beyond a double's range, or differ in length from most others.
    """
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    ).filter("vec_id is not null and vector is not null")
    norm = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v)
    rows = rows.filter(
        ~F.exists("vector", lambda v: v.isNull()) & (norm > 0) & (norm < float("inf")) & ~F.isnan(norm)
    )
    common = (
        rows.groupBy(F.size("vector").alias("d"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "d")
        .first()
    )
    rows = rows.filter(F.size("vector") == (common["d"] if common else 0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


# --- filing and searching -----------------------------------------------------------------


def learned(points: DataFrame, sample: int, per_part: int, coverage: float) -> dict:
    """The model from a sample by least hash, fitted in one task; some 100 KB come back."""

    def run(batches):
        parts = [_matrix(batch.column("vector")) for batch in batches if batch.num_rows]
        if not parts:
            return
        model = fit(unit(np.concatenate(parts)), per_part, coverage)
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.array([model[k].astype(float).tobytes()], pa.binary()) for k in ("w1", "b1", "w2", "b2")],
                pa.array([model["mass"]]),
            ],
            names=["w1", "b1", "w2", "b2", "mass"],
        )

    chosen = points.select("vector", F.xxhash64("vector").alias("h")).orderBy("h", "vector").limit(sample)
    row = stage(
        chosen.repartition(1).sortWithinPartitions("h", "vector").select("vector").mapInArrow(run, _MODEL),
        "neighbour-model",
    ).first()
    if row is None:
        return {}
    flat = {k: np.frombuffer(row[k]) for k in ("w1", "b1", "w2", "b2")}
    flat["w1"] = flat["w1"].reshape(-1, _HIDDEN)
    flat["w2"] = flat["w2"].reshape(_HIDDEN, -1)
    return {**flat, "mass": row["mass"]}


def _filed(model: dict) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``part``, the most probable one, and ``looks``, those a query looks into."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            p, _ = network(unit(_matrix(batch.column("vector"))), model)
            looks = mass_before(p) < model["mass"]
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(looks.sum(axis=1))]).astype(np.int32)),
                pa.array(np.nonzero(looks)[1].astype(np.int32)),
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p.argmax(axis=1).astype(np.int32)), lists],
                names=[*batch.schema.names, "part", "looks"],
            )

    return run


def _ranker(keep: int):
    """The ``keep`` nearest ids of each query among a block's points."""
    schema = pa.schema([("query", pa.int64()), ("score", pa.float64()), ("vec_id", pa.int64())])

    def rank(points: pa.Table, queries: pa.Table) -> pa.Table:
        if not points.num_rows or not queries.num_rows:
            return schema.empty_table()
        x, q = _matrix(points.column("vector")), _matrix(queries.column("vector"))
        ids = points.column("ids").to_pylist()
        names = queries.column("point").to_pylist()
        x1, q1 = unit(x), unit(q)
        out: list[list] = [[], [], []]
        for low in range(0, len(q), 512):
            near = q1[low : low + 512] @ x1.T
            k = min(keep, len(x)) - 1
            least = -np.partition(-near, k, axis=1)[:, k] - _SLACK
            row, col = np.nonzero(near >= least[:, None])
            exact = cosines(q[low + row], x[col])
            found: dict[int, list] = {}
            for r, c, s in zip(row.tolist(), col.tolist(), exact.tolist()):
                found.setdefault(r, []).extend((-s, i) for i in ids[c])
            for r, pairs in found.items():
                for s, i in sorted(pairs)[:keep]:
                    out[0].append(names[low + r])
                    out[1].append(-s)
                    out[2].append(i)
        return pa.table(out, schema=schema)

    return rank


def _blocks(points: DataFrame, queries: DataFrame, keep: int) -> DataFrame:
    """``query, score, vec_id``: points and queries of a part meet in groups of bounded size."""
    asked = queries.select("point", "vector", F.explode("looks").alias("part"))
    rows = points.groupBy("part").agg(F.count("*").alias("n_rows"))
    askers = asked.groupBy("part").agg(F.count("*").alias("n_asked"))
    sizes = rows.join(askers, "part").select(
        "part",
        F.ceil(F.col("n_rows") / BLOCK_ROWS).cast("int").alias("blocks"),
        F.ceil(F.col("n_asked") / BLOCK_QUERIES).cast("int").alias("chunks"),
    )
    sizes = stage(sizes, "neighbour-sizes")  # one row for each part

    def own(n: str) -> Column:
        return F.pmod(F.xxhash64("point"), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = points.join(sizes, "part").select(
        "part", own("blocks").alias("block"), every("chunks").alias("chunk"), "vector", "ids"
    )
    right = asked.join(sizes, "part").select(
        "part", every("blocks").alias("block"), own("chunks").alias("chunk"), "vector", "point"
    )
    keys = ["part", "block", "chunk"]
    return (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(_ranker(keep), "query long, score double, vec_id long")
    )


def nearest(
    vectors: DataFrame,
    is_query: Column,
    top: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    sample: int = SAMPLE,
    per_part: int = PER_PART,
    coverage: float = COVERAGE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row ``is_query`` says of ``vec_id``, its ``top`` nearest.

    Nearness is the cosine in doubles; equal ones go by ascending id. A row is not its own neighbour.
    Which rows take part says ``usable``; queries among the others have no rows in the result, nor has
    a query that is alone. Search is approximate where ``sample // per_part`` gives more than one part.
    Other columns are ignored. Empty tables give no rows.
    """
    rows = stage(
        usable(vectors, id_col, vector_col).withColumn("asks", is_query), "neighbour-rows"
    )
    # of equal vectors only the least ids can be among the nearest
    keep = top + 1
    placed = rows.withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id")))
    points = (
        placed.filter(F.col("place") <= keep)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("point", F.monotonically_increasing_id())
    )
    points = stage(points, "neighbour-points")
    model = learned(points, sample, per_part, coverage)
    schema = "vector array<double>, ids array<bigint>, point long, part int, looks array<int>"
    filed = stage(points.select("vector", "ids", "point").mapInArrow(_filed(model), schema), "neighbour-filed")
    asking = rows.filter("asks").select("vector").distinct()
    queries = filed.join(asking, "vector", "left_semi").select("point", "vector", "looks")
    queries = stage(queries, "neighbour-queries")
    found = stage(_blocks(filed.drop("looks"), queries, keep), "neighbour-found")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= keep)
    answers = found.groupBy("query").agg(
        F.collect_list(F.struct("score", F.col("vec_id").alias("found_id"))).alias("found")
    )
    answers = answers.join(points.select(F.col("point").alias("query"), "vector"), "query").drop("query")
    # rows of one vector are many queries with one answer
    asked = salted_join(rows.filter("asks").drop("asks"), answers, ["vector"], "vec_id")
    each = asked.select(F.col("vec_id").alias("query_id"), F.explode("found").alias("f")).select(
        "query_id", F.col("f.found_id").alias("vec_id"), F.col("f.score").alias("score")
    )
    of_query = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        each.filter(F.col("query_id") != F.col("vec_id"))
        .withColumn("rank", F.row_number().over(of_query))
        .filter(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
