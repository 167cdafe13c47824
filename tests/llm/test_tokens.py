"""Token counts, token files and byte-level BPE against the libraries, text by text."""

import base64
import hashlib
import io
import random
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import zstandard
from helpers import AWKWARD, docs_of

from collartrail.llm import byte_bpe, queries, seekable, token_counts, token_files

COUNT_FILE = public_tokenizers.path("byte_bpe_50k.json")
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.001"


def whole(path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def strange_texts(n=300, seed=5):
    rng = random.Random(seed)
    parts = [
        " ", "  ", "\n", "\t", "a", "B", "the", "é", "É", "ß", "×", "÷", "'", "'s", "'T", "''", "1", "42", "!", "—", "…",
        "́", "̸", "=", "<|", "|>", "<|endoftext|>", "K", "İ", "ª", "数", "🙂", "\x1c", "\x00", "\xa0", "#", "don't", "½",
    ]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(n)]


TEXTS = [t for _, t in AWKWARD if t is not None] + strange_texts()


def test_units_count_as_the_whole_text():
    from tokenizers import Tokenizer

    ids, lengths = whole(COUNT_FILE), token_counts.UnitLengths(Tokenizer.from_file(COUNT_FILE), most=50)
    assert ["".join(token_counts.units(t)) for t in TEXTS] == TEXTS
    assert lengths.of(TEXTS) == [len(ids(t)) for t in TEXTS]


def test_units_encode_as_the_whole_text():
    from tokenizers import Tokenizer

    ids, units = whole(WORD_FILE), token_files.UnitIds(Tokenizer.from_file(WORD_FILE), most=50)
    for start in range(0, len(TEXTS), 40):
        part = TEXTS[start : start + 40]
        assert [x.tolist() for x in units.of(part)] == [ids(t) for t in part]


def test_count_tokens(spark):
    ids = whole(COUNT_FILE)
    found = token_counts.count_tokens(docs_of(spark, AWKWARD), COUNT_FILE, batch_bytes=100)
    want = Counter((i, len((t or "").encode()), len(ids(t))) for i, t in AWKWARD)
    assert Counter(tuple(r) for r in found.collect()) == want
    assert token_counts.count_tokens(docs_of(spark, []), COUNT_FILE).count() == 0


def test_token_files_hold_all_documents_in_order(spark, tmp_path):
    ids = whole(WORD_FILE)
    manifest = token_files.write_token_files(
        docs_of(spark, AWKWARD).repartition(3), str(tmp_path / "f"), WORD_FILE, 2
    )
    rows = token_files.read_token_files(manifest, with_ids=True).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter((i, (*ids(t), 2)) for i, t in AWKWARD)
    rows.sort(key=lambda r: r.start)
    known = [r.doc_id for r in rows]
    assert known == sorted(known, key=lambda i: (i is not None, i or 0))
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
    assert all(r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.n_tokens}I", *r.ids)) for r in rows)
    some = token_files.read_token_files(token_files.read_manifest(spark, str(tmp_path / "f")), [7, 9, 77])
    want = {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows if r.doc_id in (7, 9)}
    assert {tuple(r) for r in some.collect()} == want
    empty = token_files.write_token_files(docs_of(spark, []), str(tmp_path / "none"), WORD_FILE, 2)
    assert token_files.read_token_files(empty).count() == 0


def test_seekable_frames():
    stream = io.BytesIO()
    writer = seekable.Writer(stream, frame_ids=10)
    documents = [(5, np.arange(35, dtype=np.uint32)), (None, np.zeros(0, np.uint32)), (9, np.full(3, 2**32 - 1, np.uint32))]
    for doc_id, ids in documents:
        writer.add(doc_id, ids)
    writer.close()
    body = stream.getvalue()
    reader = seekable.Reader(io.BytesIO(body))
    assert [(reader.doc_id(k), reader.ids(k).tolist()) for k in range(3)] == [(i, x.tolist()) for i, x in documents]
    assert list(reader.find(9)) == [2] and list(reader.find(None)) == [1]
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(body), read_across_frames=True).read()
    assert plain == b"".join(x.tobytes() for _, x in documents)
    # a changed byte in one document does not hinder the others
    broken = bytearray(body)
    broken[int(reader.starts[5]) + 6] ^= 255
    reader = seekable.Reader(io.BytesIO(bytes(broken)))
    assert reader.ids(0).tolist() == documents[0][1].tolist()
    with pytest.raises((ValueError, zstandard.ZstdError)):
        reader.ids(2)
    with pytest.raises(ValueError):
        seekable.Reader(io.BytesIO(body[:-1]))


def library_encoder():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_long_texts_are_cut_where_nothing_matches_across(monkeypatch):
    encoder = library_encoder()
    monkeypatch.setattr(byte_bpe, "LONG", 3)
    for text in TEXTS:
        assert "".join(byte_bpe.pieces(text, 3)) == text
        ids = [i for p in byte_bpe.pieces(text, 3) for i in encoder.encode_ordinary(p)]
        assert ids == encoder.encode_ordinary(text)


BLANKS = [" ", "\n", "\t", "\xa0", "\u3000", "\r\n", " \n"]


@pytest.mark.parametrize("blank", BLANKS)
@pytest.mark.parametrize("before,after", [("", ""), ("word", ""), ("", "word"), ("a", "b c"), ("a", "1"), ("a", "\x1c!"), ("a", "'s")])
def test_runs_of_blanks_are_matched_as_by_the_pattern(monkeypatch, blank, before, after):
    encoder = library_encoder()
    monkeypatch.setattr(byte_bpe, "LONG_BLANKS", 3)
    for n in (1, 2, 3, 4, 5, 40):
        text = before + blank * n + after + blank * n + before
        assert byte_bpe.encode(encoder, text) == encoder.encode_ordinary(text)
    for text in TEXTS:
        assert byte_bpe.encode(encoder, text) == encoder.encode_ordinary(text)


def test_three_million_blanks(spark):
    texts = [a + blank * 3_000_000 + b for blank in (" ", "\n", "\t", "\xa0") for a, b in (("", ""), ("before", "behind"))]
    found = byte_bpe.round_trip(docs_of(spark, list(enumerate(texts))), RANKS, public_tokenizers.PATTERN)
    got = {r.doc_id: r.decoded_sha256 for r in found.collect()}
    assert got == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in enumerate(texts)}


def test_byte_bpe(spark):
    encoder = library_encoder()
    docs = docs_of(spark, AWKWARD)
    want = Counter()
    for i, t in AWKWARD:
        ids = encoder.encode_ordinary(t or "")
        text = ",".join(map(str, ids)).encode()
        want[i, len(ids), hashlib.sha256(text).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    found = byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)
    assert Counter(tuple(r) for r in found.collect()) == want
    encoded = byte_bpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode_ids(encoded, RANKS)
    assert Counter((r.doc_id, bytes(r.body).decode()) for r in decoded.collect()) == Counter(
        (i, t or "") for i, t in AWKWARD
    )
    assert byte_bpe.round_trip(docs_of(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_queries_over_a_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    count, words, encoder = whole(COUNT_FILE), whole(WORD_FILE), library_encoder()
    got = {r.doc_id: (r.n_tokens, r.over_limit) for r in queries.op4_token_counts(spark, SF).collect()}
    assert got == {d.doc_id: (n := len(count(d.text)), n > 512) for d in docs}
    start, want = 0, {}
    for d in sorted(docs, key=lambda d: d.doc_id):
        ids = [*words(d.text), 2]
        want[d.doc_id] = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    assert {r.doc_id: tuple(r[1:]) for r in queries.op2_token_files(spark, SF).collect()} == want
    got = {r.doc_id: r.n_tokens for r in queries.op10_byte_bpe(spark, SF).collect()}
    assert got == {d.doc_id: len(encoder.encode_ordinary(d.text)) for d in docs}
