"""SentencePiece by prefix table: equal to the library on whole tables, odd and random texts."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from editpulse.llm import piece_prefix as P

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "  a  b   ", " " * 15, " " * 16, " " * 17, " " * 33 + "x", " " * 40,
    "a▁b", "▁", "<s></s><unk><0x41>", "tab\tnew\nline\r\n", "é中文字😀👩‍👩‍👧 ﬁ ǅ", "\x00\x01 \x7f", "…" * 50,
    "é" * 20, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "的" * 100, "1234567890" * 30, "\U0001f600" * 9, "==" * 70, "   　x",
    "﻿bom", "   ",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def expected(library, text):
    ids = library.encode(text or "", add_eos=True)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))


def test_query_equals_the_library(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = P.op13_sentencepiece(spark, SF).collect()
    assert len(rows) == len(docs)
    for row in rows:
        assert tuple(row)[1:] == expected(library, docs[row.doc_id]), row.doc_id


def test_random_texts(library):
    encoder, rng = P.PrefixEncoder(PATH), random.Random(7)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    letters = "aeinrst hlo  -.,_()'\n1eé中"
    for n in range(4000):
        if n % 2:
            text = "".join(rng.choices(pieces, k=rng.randint(1, 12)))
        else:
            text = "".join(rng.choices(letters, k=rng.randint(1, 60)))
        assert [int(x) for x in memoryview(encoder.encode([text])[0]).cast("i")] == library.encode(text), text


def test_every_prefix_ends_in_its_last_token(library):
    model, text = P.model_of(PATH), "▁internationalisation-of-straightforwardness"
    prefixes = [text[:end] for end in range(2, len(text) + 1)]
    for order in (prefixes, prefixes[::-1]):
        for prefix, ids in model.ids_of(order):
            assert ids == library.encode(prefix[1:]), prefix


def test_odd_rows_and_round_trip(spark, library):
    rows = [(i, text, "x", [1]) for i, text in enumerate(ODD)] + [(None, "twice", "x", None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids array<int>")
    found = P.decode(P.encode(docs, PATH), PATH).collect()
    assert len(found) == len(rows)
    for row in found:
        text = "twice" if row.doc_id is None else ODD[row.doc_id]
        assert row.ids == library.encode(text or "", add_eos=True), text
        assert row.decoded == library.decode(row.ids), text
    digests = {r.doc_id: tuple(r)[1:] for r in P.digests(P.encode(docs, PATH), PATH).collect()}
    assert all(digests[i] == expected(library, t) for i, t in enumerate(ODD))
    bare = P.encode(docs.where("doc_id = 5"), PATH, end_id=False).first()
    assert bare.ids == library.encode(ODD[5])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert P.digests(P.encode(docs, PATH), PATH).count() == 0


def test_very_long_texts(library, monkeypatch):
    encoder, words = P.PrefixEncoder(PATH), "a straightforward 中文😀 walk  through "
    for text in (words * 20_000, "straightforward" * 20_000, "😀" * 50_000, " " * 200_000 + "x"):
        ids = memoryview(encoder.encode([text])[0]).cast("i").tolist()
        assert ids == library.encode(text)
        import numpy as np

        assert "".join(P.decoded_slices(encoder.model, np.array(ids, dtype=np.int32))) == library.decode(ids)


def test_bounded_dictionary(library, monkeypatch):
    monkeypatch.setattr(P, "KEPT_CUTS", 3)
    monkeypatch.setattr(P, "SLICE", 8)
    encoder = P.PrefixEncoder(PATH)
    for text in ("one two three four five six seven", "eight one nine ten"):
        assert memoryview(encoder.encode([text])[0]).cast("i").tolist() == library.encode(text)
