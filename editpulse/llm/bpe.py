"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches (operator 7).

The rank file is read by each Python worker from ``path`` (a parameter; the vocabulary is public and
is installed on every machine). Each byte stands for one printable character in the library's
alphabet. A text is cut into the pattern's matches; every distinct piece of a batch is encoded once
and its ids are kept in a bounded dictionary, since words repeat. Every split of a token into two
known tokens is a merge at that token's rank, which gives the ids of plain rank merging.

Decoding maps ids to bytes by the reversed table; bytes of a character split over several tokens
meet again in the joined bytes. ``round_trip`` takes both steps in one Python worker, so that a core
needs one of them and ids do not go back to the JVM in between.

Defined cases: null and empty texts have no tokens; special-token strings are ordinary text; rows
repeat as they come; an empty table gives no rows; unknown ids raise.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.columns import id_and_text, table

# Pieces whose ids a worker keeps at once; beyond it the dictionary starts anew.
KEPT_PIECES = 200_000


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def byte_characters() -> list[str]:
    """The printable character of each byte: itself where printable, else the next from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(byte) if byte in printable else chr(next(rest)) for byte in range(256)]


@lru_cache(maxsize=2)
def tokenizer_of(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, models

    ranks, shown = ranks_of(path), byte_characters()
    spell = lambda token: "".join(map(shown.__getitem__, token))
    merges = [
        (spell(token[:i]), spell(token[i:]))
        for token, _ in sorted(ranks.items(), key=lambda item: item[1])
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    return Tokenizer(models.BPE(vocab={spell(t): r for t, r in ranks.items()}, merges=merges, ignore_merges=True))


class PieceEncoder:
    """Ids of texts as little-endian 32-bit bytes."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.tokenizer, self.find = tokenizer_of(path), regex.compile(pattern).findall
        self.shown, self.known = byte_characters(), {}

    def _learn(self, pieces: list[str]) -> None:
        spelled = ["".join(map(self.shown.__getitem__, piece.encode())) for piece in pieces]
        for piece, found in zip(pieces, self.tokenizer.encode_batch_fast(spelled, add_special_tokens=False), strict=True):
            self.known[piece] = np.array(found.ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        pieces = self.find(text)
        try:
            return b"".join(map(self.known.__getitem__, pieces))
        except KeyError:
            found = set(pieces)
            if len(self.known) > KEPT_PIECES:  # only here, so that none of this text's pieces goes
                self.known.clear()
            self._learn([piece for piece in found if piece not in self.known])
            return b"".join(map(self.known.__getitem__, pieces))


def _encoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    encoder = PieceEncoder(path, pattern)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids = [encoder.encode(text.as_py() or "") for text in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: ids of each whole text as little-endian unsigned 32-bit integers."""
    source = id_and_text(docs, id_col, text_col)
    run = lambda batches: _encoded(batches, path, pattern)
    return source.mapInArrow(run, f"doc_id {source.schema[0].dataType.simpleString()}, ids binary")


def token_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Joined bytes of all tokens in id order, and their bounds."""
    ranks = ranks_of(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    bounds = np.zeros(len(tokens) + 1, dtype=np.int64)
    np.cumsum([len(token) for token in tokens], out=bounds[1:])
    return np.frombuffer(b"".join(tokens), dtype=np.uint8), bounds


def decoded(ids: np.ndarray, joined: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Bytes of ``ids``, gathered from the token table."""
    sizes = bounds[ids + 1] - bounds[ids]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return joined[np.repeat(bounds[ids] - (ends - sizes), sizes) + np.arange(total)]


def token_offsets(ids: np.ndarray, joined: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(start, end) in characters of each token of one text; tokens inside one character share it."""
    raw = decoded(ids, joined, bounds)
    ends = np.cumsum(bounds[ids + 1] - bounds[ids])
    opened = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)]
    inner = (raw[np.minimum(starts, len(raw) - 1)] & 0xC0) == 0x80 if len(raw) else np.zeros(0, bool)
    return np.stack([opened[starts] - inner, opened[ends]], axis=1) if len(ids) else np.zeros((0, 2), np.int64)


def _decoded(batches: Iterator[pa.RecordBatch], path: str, offsets: bool) -> Iterator[pa.RecordBatch]:
    joined, bounds = token_table(path)
    names = ["doc_id", "ids", "decoded", *["offsets"] * offsets]
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids = [np.frombuffer(x.as_py() or b"", "<u4").astype(np.int64) for x in part.column(1)]
            columns = [*part.columns, pa.array([decoded(x, joined, bounds).tobytes() for x in ids], pa.binary())]
            if offsets:
                spans = [token_offsets(x, joined, bounds).ravel().tolist() for x in ids]
                columns.append(pa.array(spans, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names)


def _decoded_schema(kind: str, offsets: bool) -> str:
    return f"doc_id {kind}, ids binary, decoded binary" + ", offsets array<bigint>" * offsets


def decode(encoded: DataFrame, path: str, offsets: bool = False) -> DataFrame:
    """``encoded`` with ``decoded`` bytes and, if asked for, ``offsets`` (start and end per token)."""
    schema = _decoded_schema(encoded.schema["doc_id"].dataType.simpleString(), offsets)
    return encoded.select("doc_id", "ids").mapInArrow(lambda batches: _decoded(batches, path, offsets), schema)


def round_trip(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False
) -> DataFrame:
    """``decode(encode(docs))``, both in one worker."""
    source = id_and_text(docs, id_col, text_col)
    run = lambda batches: _decoded(_encoded(batches, path, pattern), path, offsets)
    return source.mapInArrow(run, _decoded_schema(source.schema[0].dataType.simpleString(), offsets))


def digests(docs: DataFrame) -> DataFrame:
    """Digest columns of the round trip with the public multi-language ranks."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip(docs, path, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
