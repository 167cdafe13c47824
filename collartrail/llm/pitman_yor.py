"""Bigram language model: a hierarchical Pitman-Yor process, seated by Gibbs sampling.

Each word is a context with a restaurant of the words behind it; the restaurants share one parent, a
restaurant of words over a uniform base. A table of a context is a customer of the parent.

Given the parent's probabilities ``p``, the tables ``t`` of a restaurant's dishes with ``c`` customers
have the chance ``(strength | discount)_T * prod S(c, t) p^t``, S generalised Stirling numbers, T all
tables. The rising factor is a Gamma integral; with its variable x drawn, dishes are independent and
weigh ``S(c, t) (discount x p)^t``. A sweep draws x for each restaurant from Gamma(strength / discount + T),
then the tables of each dish: from the whole distribution if it has few customers, else
by seating them one by one a few times and taking one way by its weight (expected tables of
proposals differ from exact means by at most 1 % in tests). That is a blocked Gibbs sampler of
the seating, and a restaurant may be split over tasks, since these need to share x and T only.

Tokens are dealt to buckets by context, packed, once; contexts that hold a large part of a bucket are
dealt by word as well. Words are dealt to shares. The levels are sampled in turn:

1. Each bucket starts with a table for each dish and sends tables by word to the words' shares. These
   seat them in the parent and answer with its customers and tables, and with counts of words.
2. Each bucket seats its contexts under these probabilities and sends its tables again; the shares
   seat the parent again, for as many samples as are kept. This is done twice.
3. Each bucket seats its contexts under each of the parent's samples, averages predictive
   probabilities, given x and p, over sweeps and samples, and adds up log probabilities of each document's tokens in it. A last
   shuffle adds these up for each chunk of documents that were packed together.

Totals over all shares (tokens, vocabulary, the parent's customers and tables) are one row, taken from the
shuffled answers. Buckets of a split context send their part of its tables to the share of its own
hash, which answers with the sum. A parallel sampler: within a pass, contexts see the parent as it was
before the pass, and a split context keeps its x.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collartrail.llm.arrow import by_bytes
from collartrail.llm.shingles import CACHE_WORDS, WordHashes, mix
from collartrail.llm.text import id_and_text, remainder_of_id

DISCOUNT, STRENGTH = 0.8, 1.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.6, 1.0
#: Sweeps before any is kept, samples of the parent, sweeps kept under each of them.
BURN_IN, SAMPLES, KEPT = 3, 2, 3
#: Parts of a table that are told apart in sums of expected tables.
PARTS = 256
#: Dishes with more customers are drawn as one of a few proposals, by weight.
WHOLE = 200
PROPOSALS = 4
BUCKET_BYTES = 16_000_000
FLUSH_BYTES = 16_000_000
HOT_SHARE = 0.125
#: Bits of a word's hash that are kept; seven bytes of it travel.
HASH_BITS = np.uint64((1 << 56) - 1)
START = np.uint64(xxhash.xxh3_64_intdigest(b" start")) & HASH_BITS
END = np.uint64(xxhash.xxh3_64_intdigest(b" end")) & HASH_BITS
#: Bytes beyond which a word is hashed by itself, and masks of the first 0 to 8 bytes.
LONG_WORD = 32
_LOWER_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

PACKED = "bucket int, chunk long, body binary"
ASKED = "share int, bucket int, body binary"
#: Whole numbers in front of an answer that add up to totals.
N_SUMS = 5
SUMMED = "chunk long, body binary"
SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
    " base_score double, score double"
)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes; sizes and kinds travel along."""
    press = zstandard.ZstdCompressor(1).compress
    parts = []
    for a in arrays:
        body = press(np.ascontiguousarray(a).tobytes())
        parts.append(np.array([len(body)], "<u4").tobytes() + a.dtype.str.encode().ljust(4) + body)
    return b"".join(parts)


def unpack(body: bytes) -> list[np.ndarray]:
    arrays, at = [], 0
    plain = zstandard.ZstdDecompressor().decompress
    while at < len(body):
        size = int(np.frombuffer(body, "<u4", 1, at)[0])
        kind = body[at + 4 : at + 8].decode().strip()
        arrays.append(np.frombuffer(plain(body[at + 8 : at + 8 + size]), kind))
        at += 8 + size
    return arrays


def smallest(a: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in the narrowest kind that holds them."""
    return a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))


def seven_bytes(hashes: np.ndarray) -> np.ndarray:
    """The lower seven bytes of each hash, byte by byte, which compresses sorted ones."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].T).ravel()


def from_seven_bytes(planes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(planes) // 7, 8), np.uint8)
    out[:, :7] = planes.reshape(7, -1).T
    return out.view("<u8").ravel().astype(np.uint64)


class Tokens:
    """What stands between blanks in each text of a batch, A-Z in lower case.

    Words get numbers by hashes of eight bytes at a time, of all tokens at once; only distinct words are cut out.
    """

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string())
        _, offsets, body = texts.buffers()
        edges = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
        body = body.slice(edges[0], edges[-1] - edges[0]).to_pybytes().lower() if edges[-1] > edges[0] else b""
        edges = edges - edges[0]
        of_bytes = np.frombuffer(body, np.uint8)
        blank = (of_bytes == 32) | (of_bytes - np.uint8(9) < 5)
        # a text ends what the one before it left open
        first = np.zeros(len(body) + 1, bool)
        first[edges] = True
        starts = np.flatnonzero(~blank & (first[:-1] | np.append(True, blank[:-1])))
        ends = np.flatnonzero(~blank & (first[1:] | np.append(blank[1:], True))) + 1
        #: Tokens of each text.
        self.counts = np.diff(np.searchsorted(starts, edges))
        #: The word of each token, as a place among the hashes of distinct words.
        self.words, found = pd.factorize(_keys(body, starts, ends - starts))
        at = np.empty(len(found), np.int64)
        at[self.words[::-1]] = np.arange(len(starts))[::-1]
        # each with the byte behind it, which a blank replaces
        sizes = ends[at] - starts[at] + 1
        stops = np.cumsum(sizes)
        cut = np.append(of_bytes, np.uint8(32))[np.arange(sizes.sum()) + np.repeat(starts[at] + sizes - stops, sizes)]
        cut[stops - 1] = 32
        words = cut.tobytes().split()
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) & HASH_BITS


def _keys(body: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit numbers of tokens that tell words of one body apart."""
    eight = np.ndarray(len(body) + 1, "<u8", body + bytes(8), strides=(1,))
    keys, at = mix(lengths.astype(np.uint64)), np.arange(len(starts))
    for done in range(0, LONG_WORD, 8):
        rest = lengths[at] - done
        keys[at] = mix(keys[at] ^ (eight[starts[at] + done] & _LOWER_BYTES[np.minimum(rest, 8)]))
        at = at[rest > 8]
    if len(at):
        edges = zip(starts[at].tolist(), (starts + lengths)[at].tolist(), strict=True)
        keys[at] = WordHashes().of([body[a:b] for a, b in edges])
    return keys


def bits(n: int) -> np.uint64:
    """Bits that hold whole numbers below ``n``."""
    return np.uint64(max(n - 1, 0).bit_length())


def in_order(pairs: np.ndarray, n_pairs: int, other: np.ndarray, n_other: int) -> tuple[np.ndarray, np.ndarray]:
    """Both, sorted by the first and then the second; values are below ``n_pairs`` and ``n_other``."""
    pairs, other, low = pairs.astype(np.uint64), other.astype(np.uint64), bits(n_other)
    if bits(n_pairs) + low <= 64:
        both = np.sort(pairs << low | other)
        return both >> low, (both & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    order = np.lexsort((other, pairs))
    return pairs[order], other[order].astype(np.int64)


def ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and the place of each value among them; only the distinct are sorted."""
    at, found = pd.factorize(values)
    order = np.argsort(found)
    rank = np.empty(len(found), np.int64)
    rank[order] = np.arange(len(found))
    return found[order], rank[at]


def distinct(values: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct whole numbers from 0, ascending, and the place of each value among them."""
    if below > 4 * len(values):
        return np.unique(values, return_inverse=True)
    seen = np.zeros(below, bool)
    seen[values] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[values]


def places(context: np.ndarray, word: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each token: by context, for hot contexts by word as well."""
    key = np.where(np.isin(context, hot), context ^ mix(word), context)
    return (mix(key) % np.uint64(buckets)).astype(np.int32)


def _packed(rows: DataFrame, hot: np.ndarray, buckets: int) -> DataFrame:
    """Tokens of whole texts, packed by bucket: contexts, the words behind each, and the documents
    of each such pair."""

    def run(batches):
        docs: list[tuple[int | None, bool]] = []
        found: list[Tokens] = []
        size, flush = 0, 0

        def packed() -> Iterator[pa.RecordBatch]:
            # behind the words come start and end, which stand for no word of a text
            hashes = [t.hashes for t in found]
            vocabulary, rank = ranked(np.concatenate([*hashes, [START, END]]))
            ranks = np.split(rank, np.cumsum([len(h) for h in hashes]))
            n_words = np.concatenate([t.counts for t in found])
            ends = np.cumsum(n_words + 1)
            token = np.concatenate([r[t.words] for t, r in zip(found, ranks, strict=False)])
            all_ids = np.array([i or 0 for i, _ in docs], np.int64)
            all_marks = np.array([(i is None) * 2 + out for i, out in docs], np.uint8)
            # in front of a document's first word is the start, behind its last one the end
            context = np.full(ends[-1], rank[-2], np.uint64)
            word = np.full(ends[-1], rank[-1], np.uint64)
            doc = np.repeat(np.arange(len(docs)), n_words + 1)
            at = np.arange(len(token)) + np.repeat(np.arange(len(docs)), n_words)
            word[at] = context[at + 1] = token
            wide = bits(len(vocabulary))
            pair, doc = in_order(context << wide | word, 1 << int(2 * wide), doc, len(docs))
            starts = np.flatnonzero(np.diff(pair, prepend=~pair[:1]))
            times = np.diff(starts, append=len(pair))
            pair = pair[starts]
            context, word = vocabulary[pair >> wide], vocabulary[pair & ((np.uint64(1) << wide) - np.uint64(1))]
            place = smallest(places(context, word, hot, buckets))
            order = np.argsort(place, kind="stable")
            ends = np.searchsorted(place[order], np.arange(buckets + 1))
            chunk = (TaskContext.get().partitionId() << 16) + flush
            for b in np.flatnonzero(np.diff(ends)).tolist():
                at = order[ends[b] : ends[b + 1]]
                n = times[at]
                own = doc[np.repeat(starts[at] - np.cumsum(n) + n, n) + np.arange(n.sum())]
                changes = np.flatnonzero(np.diff(context[at], prepend=~context[at[:1]]))
                own_docs, at_doc = distinct(own, len(docs))
                body = pack(
                    seven_bytes(context[at][changes]),
                    smallest(np.diff(changes, append=len(at))),
                    seven_bytes(word[at]),
                    smallest(n),
                    smallest(at_doc),
                    np.diff(all_ids[own_docs], prepend=0),
                    all_marks[own_docs],
                    own_docs.astype(np.int32),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([chunk], pa.int64()), pa.array([body], pa.binary())],
                    names=["bucket", "chunk", "body"],
                )

        for batch in by_bytes(batches):
            docs += zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out")), strict=True)
            found.append(Tokens(batch.column("text")))
            size += pc.sum(pc.utf8_length(batch.column("text"))).as_py() or 0
            if size >= FLUSH_BYTES:
                yield from packed()
                docs, found, size, flush = [], [], 0, flush + 1
        if docs:
            yield from packed()

    return rows.mapInArrow(run, PACKED)


def _hot_contexts(rows: DataFrame, buckets: int) -> np.ndarray:
    """Contexts that hold ``HOT_SHARE`` of a bucket's tokens or more, counted over all rows.

    Each task leaves out contexts with less than an eighth of that share of its own tokens, which
    together are less than an eighth of what is asked for; so all with the full share are found, and
    some with seven eighths of it. They only decide where tokens go.
    """

    def run(batches):
        # contexts with their numbers, and those that are not yet added to them
        contexts, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]

        def added() -> None:
            found, at = ranked(np.concatenate(contexts))
            n = np.bincount(at, np.concatenate(counts), minlength=len(found)).astype(np.int64)
            contexts[:], counts[:] = [found], [n]

        for batch in by_bytes(batches):
            tokens = Tokens(batch.column("text"))
            contexts += [tokens.hashes, np.array([START])]
            counts += [np.bincount(tokens.words, minlength=len(tokens.hashes)), np.array([batch.num_rows])]
            if sum(map(len, contexts[1:])) > max(CACHE_WORDS, len(contexts[0])):
                added()
        added()
        contexts, counts = contexts[0], counts[0]
        hot = counts * buckets * 8 >= HOT_SHARE * counts.sum()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None, *contexts[hot].view(np.int64).tolist()], pa.int64()),
                pa.array([counts.sum(), *counts[hot]], pa.int64()),
            ],
            names=["context", "n"],
        )

    share = HOT_SHARE * 7 / 8 / buckets
    # all tokens, whose context is NULL, come first
    found = rows.mapInArrow(run, "context long, n long").groupBy("context").agg(F.sum("n").alias("n"))
    top = found.orderBy(F.col("context").isNotNull(), F.col("n").desc()).limit(int(1 / share) + 2).collect()
    hot = [r.context for r in top[1:] if r.n >= share * top[0].n]
    return np.array(sorted(hot), np.int64).view(np.uint64)


def log_gamma(z: np.ndarray) -> np.ndarray:
    """Logarithm of the Gamma function of positive numbers."""
    shift = np.ones_like(z)
    for k in range(8):
        shift = shift * (z + k)
    z = z + 8
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def log_stirling(most: int, discount: float) -> np.ndarray:
    """Logarithms of generalised Stirling numbers: ways, weighted, to seat c customers at t tables."""
    log_s = np.full((most + 1, most + 1), -np.inf)
    log_s[1, 1] = 0
    for c in range(1, most):
        t = np.arange(1, c + 1)
        joined = np.append(np.log(c - t * discount), -np.inf)
        log_s[c + 1, 1 : c + 2] = np.logaddexp(joined + log_s[c, 1 : c + 2], log_s[c, : c + 1])
    return log_s


class Dishes:
    """Tables of dishes, drawn given the weight of each table: the chance of t tables is in proportion
    to ``S(customers, t) * weight ** t``. ``expected``: the mean of what was drawn from last."""

    def __init__(self, customers: np.ndarray, discount: float):
        self.customers, self.discount = customers, discount
        self.tables = np.minimum(customers, 1)
        self.expected = self.tables.astype(float)
        self.log_s = log_stirling(int(np.clip(customers.max(initial=1), 1, WHOLE)), discount)
        some = np.flatnonzero((customers > 1) & (customers <= WHOLE))
        some = some[np.argsort(smallest(customers[some]), kind="stable")]
        sizes, starts = np.unique(customers[some], return_index=True)
        self.few = list(zip(sizes.tolist(), np.split(some, starts[1:]), strict=True)) if len(some) else []
        self.many = np.flatnonzero(customers > WHOLE)

    def draw(self, weight: np.ndarray, random, mean: bool = True) -> None:
        """Take new tables for all dishes; without ``mean``, what is ``expected`` is not kept up."""
        for c, at in self.few:
            u, w = random.random(len(at)), weight[at]
            # powers of these weights stay far from overflow; for more customers they gain nothing
            small = (w < np.exp(500 / (c - 1))) & (c <= 12)
            for way, mine in ((self._by_powers, small), (self._by_logarithms, ~small)):
                if mine.any():
                    own = at if mine.all() else at[mine]
                    self.tables[own], expected = way(c, w[mine], u[mine], mean)
                    if mean:
                        self.expected[own] = expected
        if len(self.many):
            self._steps(weight[self.many], random)

    def _by_powers(self, c: int, weight: np.ndarray, u: np.ndarray, want_mean: bool) -> tuple[np.ndarray, np.ndarray]:
        """Tables at the quantiles ``u`` of dishes with ``c`` customers, and their mean if wanted."""
        ways = np.exp(self.log_s[c, 1 : c + 1] - self.log_s[c, 1])
        tables, mean = np.ones(len(u), np.int8), np.ones(len(u))
        for a in range(0, len(u), 8192):  # such blocks stay in the cache
            w, m = weight[a : a + 8192], mean[a : a + 8192]
            upto, power = np.ones((c, len(w))), np.ones(len(w))
            for t in range(1, c):
                power *= w
                now = power * ways[t]
                np.add(upto[t - 1], now, out=upto[t])
                if want_mean:
                    now *= t + 1
                    m += now
            m /= upto[-1]
            aim, mine = u[a : a + 8192] * upto[-1], tables[a : a + 8192]
            for below in upto[:-1]:
                mine += (below <= aim).view(np.int8)
        return tables, mean

    def _by_logarithms(self, c: int, weight: np.ndarray, u: np.ndarray, want_mean: bool) -> tuple[np.ndarray, np.ndarray]:
        """The same for weights of any size."""
        log_w = self.log_s[c, 1 : c + 1] + np.log(weight)[:, None] * np.arange(1, c + 1)
        w = np.exp(log_w - log_w.max(axis=1, keepdims=True))
        mean = w @ np.arange(1, c + 1) / w.sum(axis=1) if want_mean else None
        w = np.cumsum(w, axis=1)
        return 1 + (w[:, :-1] <= (u * w[:, -1])[:, None]).sum(axis=1), mean

    def _propose(self, weight: np.ndarray, random) -> tuple[np.ndarray, np.ndarray]:
        """Tables of the dishes with many customers, seated one by one a few times, and the logarithm of
        how much more likely each way of seating is than it was proposed.

        Tables opened early cost all later customers, so weights to open one grow while a dish fills:
        as they do on average in a Chinese restaurant that ends at ``weight``, constant for half an
        octave. The wait for the next new table is geometric with a Beta chance.
        """
        d, c = self.discount, np.tile(self.customers[self.many], PROPOSALS)
        weight = np.tile(weight, PROPOSALS)
        # the strength of that restaurant, by bisection
        below, above = np.full(len(c), np.log(1e-9)), np.log(weight + c + 1.0)
        for _ in range(30):
            half = (below + above) / 2
            x = np.exp(half)
            less = x * ((x + c - (1 + d) / 2) / (x + (1 - d) / 2)) ** d < weight
            below, above = np.where(less, half, below), np.where(less, above, half)
        shift = np.exp(below) - (1 + d) / 2
        seated, tables, log_w = (np.ones(len(c)) for _ in range(3))
        low = 1
        while low < c.max():
            high = max(low + 1, int(low * 1.42))
            end = np.minimum(high, c)
            opens = weight * (((low + high) / 2 + shift) / (c + shift)) ** d
            at = np.flatnonzero(c > low)
            a, n, t, stop, steps = opens[at], seated[at], tables[at], end[at], []
            seated[at] = stop
            while len(at):
                chance = np.maximum(random.beta(a, n - d * t), 1e-15)
                reached = n + np.minimum(random.geometric(chance), stop)
                new = reached <= stop
                reached = np.minimum(reached, stop)
                steps.append((at, a, n, t, reached, new))
                n, t, left = reached, t + new, reached < stop
                if not left.all():
                    at, a, n, t, stop = at[left], a[left], n[left], t[left], stop[left]
            # what a step weighs is worked out for many at once, and added up in their order
            at, a, n, t, reached, new = (np.concatenate(x) for x in zip(*steps, strict=True))
            tables += np.bincount(at, new, minlength=len(c))
            gains = np.empty((len(at), 2))
            gains[:, 0] = log_gamma(reached - d * t + a) - log_gamma(n - d * t + a)
            gains[:, 1] = np.where(new, np.log(weight / opens)[at], 0)
            log_w += np.bincount(np.repeat(at, 2), gains.ravel(), minlength=len(c))
            low = high
        return tables.astype(np.int64).reshape(PROPOSALS, -1), log_w.reshape(PROPOSALS, -1)

    def _steps(self, weight: np.ndarray, random) -> None:
        """One of a few proposals, by its weight."""
        tables, log_w = self._propose(weight, random)
        pick = np.argmax(log_w + random.gumbel(size=log_w.shape), axis=0)
        self.tables[self.many] = tables[pick, np.arange(len(pick))]
        w = np.exp(log_w - log_w.max(axis=0))
        self.expected[self.many] = (w * tables).sum(axis=0) / w.sum(axis=0)


class Bucket:
    """All pairs of a bucket's contexts and words; dishes are those with customers."""

    def __init__(self, bodies: list[bytes], chunks: list[int], hot: np.ndarray):
        contexts, runs, words, taught = [], [], [], []
        #: Of each body, where its pairs start and what it has for each occurrence and document.
        self.chunks: list[tuple[int, int, list[np.ndarray]]] = []
        n_pairs = 0
        for body, chunk in zip(bodies, chunks, strict=True):
            context, run, word, n, at_doc, id_steps, mark, own_docs = unpack(body)
            contexts.append(from_seven_bytes(context))
            runs.append(run)
            words.append(from_seven_bytes(word))
            starts = np.cumsum(n, dtype=np.int64) - n
            taught.append(np.add.reduceat(((mark & 1) == 0)[at_doc], starts, dtype=np.int32))
            self.chunks.append((chunk, n_pairs, [n, at_doc, id_steps, mark, own_docs]))
            n_pairs += len(n)
        words, contexts, runs, taught = (np.concatenate(x) for x in (words, contexts, runs, taught))
        self.words, word = ranked(words)
        self.contexts, context = ranked(contexts)
        n_keys = len(self.contexts) * len(self.words)
        pairs, order = in_order(np.repeat(context, runs) * len(self.words) + word, n_keys, np.arange(n_pairs), n_pairs)
        new = np.diff(pairs, prepend=~pairs[:1]) != 0
        at = np.empty(n_pairs, np.int32)
        at[order] = np.cumsum(new) - 1
        pairs, self.pair = pairs[new].astype(np.int64), at
        self.of_context, self.of_word = np.divmod(pairs, len(self.words))
        self.customers = np.bincount(at, taught, minlength=len(pairs)).astype(np.int64)
        self.in_context = np.bincount(self.of_context, self.customers, minlength=len(self.contexts))
        self.split = np.isin(self.contexts, hot)
        #: Tables of split contexts in all buckets, when known.
        self.all_tables = np.zeros(len(self.contexts))
        self.dishes = Dishes(self.customers, DISCOUNT)

    def over_contexts(self, of_dish: np.ndarray) -> np.ndarray:
        return np.bincount(self.of_context, of_dish, minlength=len(self.contexts))

    def tables_of_contexts(self) -> np.ndarray:
        return self.over_contexts(self.dishes.tables)

    def tables_of_words(self) -> np.ndarray:
        return np.bincount(self.of_word, self.dishes.tables, minlength=len(self.words)).astype(np.int64)

    def sweeps(self, n: int, parent: np.ndarray, random, settled: bool = True) -> None:
        """Seat all contexts ``n`` times, given the parent's probabilities of ``words``.

        A split context has the same x in all its buckets. As long as its tables are not ``settled``,
        they are taken to have grown elsewhere as they did here.
        """
        at = np.flatnonzero(self.split)
        if settled:
            shared = [
                np.random.default_rng(int(c)).gamma(STRENGTH / DISCOUNT + t)
                for c, t in zip(self.contexts[at], self.all_tables[at], strict=True)
            ]
        start = np.maximum(self.over_contexts(self.customers > 0)[at], 1)
        # dishes of one customer or none have as many tables, whatever is drawn
        drawn = np.flatnonzero(self.customers > 1)
        of_context, p = self.of_context[drawn], parent[self.of_word[drawn]]
        others, weight = self.over_contexts(self.customers == 1), np.ones(len(self.customers))
        for k in range(n):
            tables = others + np.bincount(of_context, self.dishes.tables[drawn], minlength=len(self.contexts))
            x = random.gamma(STRENGTH / DISCOUNT + tables)
            grown = np.maximum(tables[at], 1) / start
            x[at] = shared if settled else STRENGTH / DISCOUNT + self.all_tables[at] * grown
            weight[drawn] = np.maximum(DISCOUNT * x[of_context] * p, 1e-300)
            self.dishes.draw(weight, random, mean=k == n - 1)


def dealt(place: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each place that occurs, and where."""
    order = np.argsort(place, kind="stable")
    found, starts = np.unique(place[order], return_index=True)
    if len(found):
        yield from zip(found.tolist(), np.split(order, starts[1:]), strict=True)


def parent_probabilities(customers: np.ndarray, tables: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Of words; ``sums``: the parent's customers and tables, distinct words known."""
    all_customers, all_tables, known = (float(x) for x in sums)
    rest = (PARENT_STRENGTH + PARENT_DISCOUNT * all_tables) / (known + 1)
    return (customers - PARENT_DISCOUNT * tables + rest) / (PARENT_STRENGTH + all_customers)


def language_model_scores(
    docs: DataFrame, divisor: int = 5, held_out: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each input row.

    Tokens are what stands between blanks, A-Z in lower case, and an end. Rows whose crc32 of the id,
    modulo ``divisor``, is ``held_out`` teach nothing. ``base_score`` is the log10 probability under
    single words with half a count added; ``score`` that of the model. A NULL text is empty and has
    the end only. Rows without id teach; ids may repeat. Other columns are ignored. An empty table
    gives no rows; without any row to learn from, words are as likely as under the uniform base.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn(
        "held_out", F.col("doc_id").isNotNull() & (remainder_of_id(divisor) == held_out)
    )
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4, -(-volume // BUCKET_BYTES))
    shares = max(4, buckets // 4)
    hot = _hot_contexts(rows, buckets)
    packed = _packed(rows, hot, buckets)

    def bucket_of(own: pd.DataFrame) -> Bucket:
        own = own.sort_values("chunk")
        return Bucket(own["body"].tolist(), own["chunk"].tolist(), hot)

    def share_of(hashes: np.ndarray) -> np.ndarray:
        return (mix(hashes) % np.uint64(shares)).astype(np.int64)

    def to_shares(number: int, bucket: Bucket, by_word: list[np.ndarray], by_split: list[np.ndarray], sums):
        """Rows for the shares that hold words or split contexts of the bucket."""
        at = np.flatnonzero(bucket.split)
        splits = dict(dealt(share_of(bucket.contexts[at])))
        words = dict(dealt(share_of(bucket.words)))
        none = np.zeros(0, np.int64)
        for s in sorted(words.keys() | splits.keys()):
            w, c = words.get(s, none), splits.get(s, none)
            body = pack(
                np.array([len(by_word), len(by_split)]), sums, bucket.words[w], *(smallest(x[w]) for x in by_word),
                bucket.contexts[at[c]], *(smallest(x[at[c]]) for x in by_split),
            )
            yield s, number, body

    def from_shares(bucket: Bucket, answers: pd.DataFrame, n_word: int, n_split: int):
        """What shares answered, in the order of the bucket's words and contexts."""
        at = np.flatnonzero(bucket.split)
        splits, words = dict(dealt(share_of(bucket.contexts[at]))), dict(dealt(share_of(bucket.words)))
        by_word = np.zeros((n_word, len(bucket.words)), np.int64)
        by_split = np.zeros((n_split, len(bucket.contexts)), np.int64)
        for s, body in zip(answers["share"], answers["body"], strict=True):
            if s < shares:
                got = unpack(body[8 * N_SUMS :])
                if s in words:
                    by_word[:, words[s]] = got[:n_word]
                if s in splits:
                    by_split[:, at[splits[s]]] = got[n_word:]
        return by_word, by_split

    def summed(own: pd.DataFrame) -> tuple[list, list, list, list, np.ndarray]:
        """A share's words, where each bucket's are in them, and sums by word; the same of contexts."""
        asked = [unpack(b) for b in own["body"]]
        n_word, n_split = asked[0][0].tolist()

        def over(first: int, n: int):
            keys = [x[first] for x in asked]
            found, at = ranked(np.concatenate(keys))
            total = [
                np.bincount(at, np.concatenate([x[first + 1 + k] for x in asked]), minlength=len(found))
                for k in range(n)
            ]
            return np.split(at, np.cumsum([len(k) for k in keys])[:-1]), [x.astype(np.int64) for x in total]

        return *over(2, n_word), *over(3 + n_word, n_split), asked[0][1]

    def answered(own: pd.DataFrame, sums: list, at_word, by_word, at_split, by_split) -> pd.DataFrame:
        """A row for each bucket; the first one carries the share's sums."""
        share, out = int(own["share"].iloc[0]), []
        heads = [np.array(sums + [0] * (N_SUMS - len(sums)), np.int64)]
        heads += [np.zeros(N_SUMS, np.int64)] * (len(own) - 1)
        for head, number, w, c in zip(heads, own["bucket"], at_word, at_split, strict=True):
            body = pack(*(smallest(x[w]) for x in by_word), *(smallest(x[c]) for x in by_split))
            out.append((share, number, head.tobytes() + body))
        return pd.DataFrame(out, columns=["share", "bucket", "body"])

    def asking(own: pd.DataFrame) -> pd.DataFrame:
        number, bucket = int(own["bucket"].iloc[0]), bucket_of(own)
        taught = np.bincount(bucket.of_word, bucket.customers, minlength=len(bucket.words)).astype(np.int64)
        by_split = [bucket.tables_of_contexts().astype(np.int64), bucket.in_context.astype(np.int64)]
        by_word = [bucket.tables_of_words(), taught]
        out = list(to_shares(number, bucket, by_word, by_split, np.zeros(0)))
        return pd.DataFrame(out, columns=["share", "bucket", "body"])

    def parent_start(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("bucket")
        at_word, (customers, taught), at_split, by_split, _ = summed(own)
        dishes, random = Dishes(customers, PARENT_DISCOUNT), np.random.default_rng(int(own["share"].iloc[0]))
        # of one table for each word, x is about the number of words, which cancels against the base
        for _ in range(BURN_IN):
            dishes.draw(np.full(len(customers), PARENT_DISCOUNT), random, mean=False)
        sums = [taught.sum(), (taught > 0).sum(), customers.sum(), dishes.tables.sum()]
        return answered(own, sums, at_word, [customers, dishes.tables, taught], at_split, by_split)

    def seating(own: pd.DataFrame, answers: pd.DataFrame, first: bool) -> pd.DataFrame:
        number, bucket = int(own["bucket"].iloc[0]), bucket_of(own)
        sums = np.asarray(answers["sums"].iloc[0], np.int64)
        if first:
            all_sums, sums = sums[:2], sums[2:]
            (customers, tables, taught), (bucket.all_tables, _) = from_shares(bucket, answers, 3, 2)
        else:
            taught, _, all_sums = from_itself(answers)
            (customers, tables, *_), (_, bucket.all_tables, _) = from_shares(bucket, answers, 1 + SAMPLES, 3)
        known = all_sums[1]
        p, random = parent_probabilities(customers, tables, [*sums[:2], known]), random_of(number, int(first))
        bucket.sweeps(BURN_IN, p, random, not first)
        parts = np.zeros(len(bucket.customers))
        for _ in range(KEPT):
            bucket.sweeps(1, p, random, not first)
            parts += bucket.dishes.expected * PARTS / KEPT
        parts = np.rint(parts).astype(np.int64)
        of_contexts = [bucket.in_context, bucket.tables_of_contexts(), bucket.over_contexts(parts)]
        by_split = [x.astype(np.int64) for x in of_contexts]
        told = np.array([known, sums[1]])
        out = list(to_shares(number, bucket, [bucket.tables_of_words()], by_split, told))
        kept = smallest(parts[away_of(bucket)][: 0 if first else None])
        out.append((shares + number, number, pack(smallest(taught), kept, all_sums)))
        return pd.DataFrame(out, columns=["share", "bucket", "body"])

    def first_seating(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        return seating(own, answers, True)

    def second_seating(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        return seating(own, answers, False)

    def away_of(bucket: Bucket) -> np.ndarray:
        """Dishes of split contexts whose tables are not given by their customers."""
        return bucket.split[bucket.of_context] & (bucket.customers > 1)

    def from_itself(answers: pd.DataFrame) -> list[np.ndarray]:
        return unpack(answers["body"][answers["share"] >= shares].iloc[0][8 * N_SUMS :])

    def parent_again(own: pd.DataFrame) -> pd.DataFrame:
        """The parent under its true totals; what a bucket sent to itself passes."""
        share, own = int(own["share"].iloc[0]), own.sort_values("bucket")
        if share >= shares:
            return own.assign(body=[bytes(8 * N_SUMS) + b for b in own["body"]])
        at_word, (customers,), at_split, by_split, (known, tables_before) = summed(own)
        dishes, random = Dishes(customers, PARENT_DISCOUNT), random_of(share, 1)
        # all shares draw the same x
        x = np.random.default_rng(0).gamma(PARENT_STRENGTH / PARENT_DISCOUNT + tables_before)
        weight = np.full(len(customers), PARENT_DISCOUNT * x / (known + 1))
        tables = []
        for s in range(SAMPLES):
            for _ in range(KEPT if s else BURN_IN):
                dishes.draw(weight, random, mean=False)
            tables.append(dishes.tables.copy())
        found = [customers.sum(), *(t.sum() for t in tables)]
        return answered(own, found, at_word, [customers, *tables], at_split, by_split)

    def random_of(number: int, step: int):
        return np.random.default_rng([number, step])

    def scoring(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        number, bucket = int(own["bucket"].iloc[0]), bucket_of(own)
        taught, kept, all_sums = from_itself(answers)
        train_tokens, known = all_sums.tolist()
        sums = np.asarray(answers["sums"].iloc[0], np.int64)
        by_word, (of_split, bucket.all_tables, parts) = from_shares(bucket, answers, 1 + SAMPLES, 3)
        away = away_of(bucket)
        customers = STRENGTH + np.where(bucket.split, of_split, bucket.in_context)
        chance, random = np.zeros(len(bucket.customers)), random_of(number, 2)
        for s in range(SAMPLES):
            p = parent_probabilities(by_word[0], by_word[1 + s], [sums[0], sums[1 + s], known])
            for _ in range(KEPT):
                bucket.sweeps(1 if s or chance.any() else BURN_IN, p, random)
                tables = bucket.dishes.expected.copy()
                tables[away] = kept / PARTS
                by_context = np.where(bucket.split, parts / PARTS, bucket.over_contexts(tables))
                back_off = (STRENGTH + DISCOUNT * by_context) / customers
                direct = (bucket.customers - DISCOUNT * tables) / customers[bucket.of_context]
                chance += (direct + back_off[bucket.of_context] * p[bucket.of_word]) / (SAMPLES * KEPT)
        chance = np.log10(chance)
        base = np.log10((taught + 0.5) / (train_tokens + 0.5 * (known + 1)))
        out = []
        for chunk, start, (times, at_doc, id_steps, mark, own_docs) in bucket.chunks:
            pair, n = bucket.pair[start : start + len(times)], len(own_docs)
            word = bucket.of_word[pair]
            known_tokens, base_sum, score = (
                np.bincount(at_doc, np.repeat(x, times), minlength=n)
                for x in (taught[word] > 0, base[word], chance[pair])
            )
            body = pack(
                own_docs, id_steps, mark, smallest(np.bincount(at_doc, minlength=n)),
                smallest(known_tokens.astype(np.int64)), base_sum, score.astype(np.float32),
                np.array([train_tokens], np.int64),
            )
            out.append((chunk, body))
        return pd.DataFrame(out, columns=["chunk", "body"])

    def summing(own: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(b) for b in own["body"]]
        docs = np.concatenate([x[0] for x in parts])
        n = int(docs.max()) + 1
        total = [np.bincount(docs, np.concatenate([x[k] for x in parts]), minlength=n) for k in (3, 4, 5, 6)]
        ids, marks = np.zeros(n, np.int64), np.zeros(n, np.uint8)
        ids[docs] = np.concatenate([np.cumsum(x[1]) for x in parts])
        marks[docs] = np.concatenate([x[2] for x in parts])
        return pd.DataFrame(
            {
                "doc_id": pd.Series(ids, dtype="Int64").mask(marks >= 2),
                "held_out": (marks & 1).astype(bool),
                "n_tokens": total[0].astype(np.int64),
                "n_known": total[1].astype(np.int64),
                "train_tokens": np.full(n, parts[0][7][0]),
                "base_score": total[2],
                "score": total[3],
            }
        )

    def totals(batches):
        """The sums in front of answers."""
        for batch in batches:
            heads = [np.frombuffer(b, np.int64, N_SUMS) for b in batch.column("body").to_pylist()]
            sums = np.sum(heads, axis=0, dtype=np.int64) if heads else np.zeros(N_SUMS, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(x)], pa.int64()) for x in sums], names=[f"s{k}" for k in range(N_SUMS)]
            )

    def with_sums(answers: DataFrame) -> DataFrame:
        """Answers at their buckets, with the one row of totals over all of them."""
        answers = answers.repartition("bucket")
        parts = answers.mapInArrow(totals, ", ".join(f"s{k} long" for k in range(N_SUMS)))
        one = parts.agg(F.array(*(F.sum(f"s{k}") for k in range(N_SUMS))).alias("sums"))
        return answers.withColumn("sums", one.scalar())

    def with_packed(answers: DataFrame, run, schema: str) -> DataFrame:
        return packed.groupBy("bucket").cogroup(with_sums(answers).groupBy("bucket")).applyInPandas(run, schema)

    asked = packed.groupBy("bucket").applyInPandas(asking, ASKED)
    started = asked.groupBy("share").applyInPandas(parent_start, ASKED)
    answers = started
    for seat in (first_seating, second_seating):
        answers = with_packed(answers, seat, ASKED).groupBy("share").applyInPandas(parent_again, ASKED)
    parts = with_packed(answers, scoring, SUMMED)
    return parts.groupBy("chunk").applyInPandas(summing, SCORED)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
