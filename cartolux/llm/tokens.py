"""Encoding of a corpus with a public byte-level BPE vocabulary.

Documents are encoded in Arrow batches; the vocabulary is loaded once per worker from a rank file
whose path is a parameter. A text longer than ``LONG`` characters is first cut where the splitting
pattern cannot span: before a single blank between two characters that are not white space. Such a
blank always opens a new piece, so the ids are those of the whole text. A stretch without such a
place stays whole. Decoding works on raw bytes, as a token may hold part of a character.

Cases. Null and empty texts give an empty list. Blank texts have ids. Strings of special tokens are
ordinary text. Repeated texts are encoded each. Nothing is shuffled or cut short.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the splitting pattern that belongs to the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG = 1 << 16
_SEAM = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=4)
def encoding(ranks: str = RANKS):
    import base64

    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def pieces(text: str, long: int = LONG) -> Iterator[str]:
    """``text`` in order, cut at safe places no closer than ``long`` characters."""
    start = 0
    while len(text) - start > long:
        seam = _SEAM.search(text, start + long)
        if seam is None:
            break
        yield text[start : seam.start()]
        start = seam.start()
    yield text[start:]


def encode(text: str | None, ranks: str = RANKS) -> list[int]:
    if not text:
        return []
    e = encoding(ranks)
    if len(text) <= LONG:
        return e.encode_ordinary(text)
    return [i for piece in pieces(text) for i in e.encode_ordinary(piece)]


def decode(ids: list[int], ranks: str = RANKS) -> bytes:
    e = encoding(ranks)
    return b"".join(map(e.decode_single_token_bytes, ids))


def encoded(documents: DataFrame, ranks: str = RANKS) -> DataFrame:
    """(doc_id, ids) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [encode(t, ranks) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def round_trip(documents: DataFrame, ranks: str = RANKS) -> DataFrame:
    """(doc_id, n_tokens, n_bytes, exact): whether the raw bytes of the ids are those of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(1).to_pylist():
                ids, raw = encode(t, ranks), (t or "").encode()
                rows.append((len(ids), len(raw), decode(ids, ranks) == raw))
            n, size, exact = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32()), pa.array(size, pa.int64()), pa.array(exact, pa.bool_())], names=["doc_id", "n_tokens", "n_bytes", "exact"])

    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens int, n_bytes long, exact boolean")
