"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are cut where the pattern cannot match across, so that the library never sees a long
one; ids decode to raw bytes, which need not be text. A long run of blanks is one match by the
pattern, on which the library's matcher would run out of stack: its bytes go to the merges directly.
"""

from __future__ import annotations

import base64
import re
import sys
from collections.abc import Iterable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from collartrail.llm.arrow import by_bytes, per_worker, tidy
from collartrail.llm.text import id_and_text

LONG = 100_000
LONG_BLANKS = 10_000
_CUT = re.compile(r"(?<=\S)(?= \S)")
#: White space as the pattern's library defines it.
_BLANK = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encoding(rank_file: str, pattern: str):
    """The library's encoder over a rank file, without special tokens; one for a worker."""

    def make():
        import tiktoken

        return tiktoken.Encoding(
            "local", pat_str=pattern, mergeable_ranks=read_ranks(rank_file), special_tokens={}
        )

    return per_worker(("byte_bpe", rank_file, pattern), make)


def vocabulary_of(rank_file: str) -> dict[int, bytes]:
    """The bytes of each id; one table for a worker."""
    return per_worker(
        ("byte_bpe_vocabulary", rank_file), lambda: {i: token for token, i in read_ranks(rank_file).items()}
    )


def pieces(text: str, long: int = LONG) -> list[str]:
    """A text of over ``long`` characters in pieces of about that length, cut where no match spans.

    A single space between two characters that are no white space begins a match. A stretch without
    such a place stays whole.
    """
    if len(text) <= long:
        return [text]
    cut, start = [], 0
    while len(text) - start > long:
        at = _CUT.search(text, start + long - 1)
        if not at:
            break
        cut.append(text[start : at.start()])
        start = at.start()
    return [*cut, text[start:]]


def blank_matches(text: str, long: int = LONG_BLANKS) -> list[tuple[int, int]]:
    """Where runs of more than ``long`` blanks are matched: the whole run at the end of the text,
    elsewhere all but its last blank, which goes to what follows."""
    runs = re.finditer(f"{_BLANK}{{{long + 1},}}", text)
    return [(m.start(), m.end() - (m.end() < len(text))) for m in runs]


def encode(encoder, text: str) -> list[int]:
    if len(text) <= LONG_BLANKS:
        return encoder.encode_ordinary(text)
    ids, start = [], 0
    for low, high in [*blank_matches(text, LONG_BLANKS), (len(text), len(text))]:
        for piece in pieces(text[start:low], LONG):
            ids += encoder.encode_ordinary(piece)
        if high > low:
            ids += encoder._encode_single_piece(text[low:high].encode())
        start = high
    return ids


def decode(vocabulary: dict[int, bytes], ids: Iterable[int]) -> bytes:
    return b"".join(map(vocabulary.__getitem__, ids))


def encode_texts(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids: array<int>``, one row per input row; a NULL or empty text has no ids."""

    def run(batches):
        encoder = encoding(rank_file, pattern)
        for batch in by_bytes(batches):
            ids = [encode(encoder, t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(tidy(run), "doc_id long, ids array<int>")


def decode_ids(
    encoded: DataFrame, rank_file: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """``doc_id, body: binary`` from lists of ids; NULL decodes to no bytes."""

    def run(batches):
        vocabulary = vocabulary_of(rank_file)
        for batch in batches:
            bodies = [decode(vocabulary, ids or ()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(bodies, pa.binary())], names=["doc_id", "body"]
            )

    picked = encoded.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{ids_col}` ids")
    return picked.mapInArrow(tidy(run), "doc_id long, body binary")


def round_trip(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: texts encoded, and their ids decoded.

    Hashes are lower-case hex: of the decimal ids joined by commas, and of the decoded bytes. Ids are
    hashed in the task that made them, so no list of ids leaves it. A NULL text is empty; ids of rows
    may be NULL or repeat; other columns are ignored; an empty table gives no rows.
    """

    def run(batches):
        from hashlib import sha256

        encoder = encoding(rank_file, pattern)
        vocabulary = vocabulary_of(rank_file)
        for batch in by_bytes(batches):
            n, of_ids, of_bytes = [], [], []
            for text in batch.column("text").to_pylist():
                ids = encode(encoder, text)
                n.append(len(ids))
                of_ids.append(sha256(",".join(map(str, ids)).encode()).hexdigest())
                of_bytes.append(sha256(decode(vocabulary, ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_bytes)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        tidy(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
