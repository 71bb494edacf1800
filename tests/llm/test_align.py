"""Cross-tokenizer alignment against a plain loop over token borders."""

from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from editpulse.llm import align as A
from editpulse.llm.bpe import byte_characters

SF = "/root/testdata/sf0.001"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BYTE_OF = {c: b for b, c in enumerate(byte_characters())}
ODD = [
    None, "", " ", "  two  spaces ", "a▁b", "<|endoftext|> </s> <unk>", "é中文字😀👩‍👩‍👧 ﬁ", "\x00 nul", "tab\t new\n line",
    "x" * 3000, "0123456789abcdef" * 300, "same words here", "same words here", "don't, won't: it's", "   　x",
]


class Plain:
    """Token bytes and groups of one text, in plain Python."""

    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])

    def groups(self, text):
        if not text:
            return None
        a = [(i, bytes(BYTE_OF[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if any(b"".join(t for _, t in side) != whole for side in (a, b)):
            return None
        out, pos, i, j = [], [0, 0], 0, 0
        group = ([], [])
        while i < len(a) or j < len(b):
            if pos[0] <= pos[1] and i < len(a):
                group[0].append(a[i][0])
                pos[0] += len(a[i][1])
                i += 1
            else:
                group[1].append(b[j][0])
                pos[1] += len(b[j][1])
                j += 1
            if pos[0] == pos[1]:
                out.append((group, pos[0]))
                group = ([], [])
        return out


def expected(texts):
    plain = Plain()
    found = [plain.groups(t) for t in texts]
    pairs = [
        None if groups is None else Counter((a, b) for (aa, bb), _ in groups for a in aa for b in bb) for groups in found
    ]
    docs = Counter(pair for p in pairs if p for pair in p)
    best = {}
    for (a, _), n in docs.items():
        best[a] = max(best.get(a, 0), n)
    rows = []
    for groups, links in zip(found, pairs, strict=True):
        if groups is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for (a, b), _ in groups)
        rows.append(
            (
                sum(len(a) for (a, _), _ in groups), sum(len(b) for (_, b), _ in groups), len(groups), sum(links.values()),
                sum(n for (a, b), n in links.items() if docs[a, b] == best[a]),
                sum(n * docs[pair] for pair, n in links.items()), hashlib.sha256(text.encode()).hexdigest(),
            )
        )
    return rows


def check(spark, monkeypatch, docs, ids, texts):
    monkeypatch.setattr(A, "table", lambda *_: docs)
    found = sorted((tuple(r) for r in A.op11_alignment(spark, "").collect()), key=repr)
    assert found == sorted(((i, *row) for i, row in zip(ids, expected(texts), strict=True)), key=repr)


def test_query_equals_the_plain_loop(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    check(spark, monkeypatch, docs, [r.doc_id for r in rows], [r.text for r in rows])


@pytest.mark.parametrize("hot", [1, 1 << 17])
def test_odd_rows(spark, monkeypatch, hot):
    ids = [*range(len(ODD)), None, None]
    texts = [*ODD, "same words", "same words here"]
    docs = spark.createDataFrame(
        [(i, t, 1, "x") for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, pairs int, row string"
    )
    monkeypatch.setattr(A.link_sums, "__defaults__", (hot,))
    check(spark, monkeypatch, docs, ids, texts)


@pytest.mark.parametrize(("slice_", "batch", "kept"), [(50, 120, 200_000), (1 << 17, 1 << 18, 200_000), (40, 60, 2)])
def test_long_texts_are_cut_without_a_trace(monkeypatch, slice_, batch, kept):
    for name, value in (("SLICE", slice_), ("BATCH", batch), ("KEPT_CUTS", kept)):
        monkeypatch.setattr(A, name, value)
    texts = ["word,  two\n three 中文 é 12 don't " * 30, "a▁b " * 40, "x y " * 100 + "z" * 300, "tail   ", "\x1c a b\x85 c"]
    cuts = A.Cuts(A.ByteTokens(PATHS[0]), A.PieceTokens(PATHS[1]))
    found = [d.values() for d in A.aligned(texts, cuts)]
    plain = Plain()
    for text, values in zip(texts, found, strict=True):
        groups = plain.groups(text)
        assert values[0] == (groups is not None)
        if groups:
            assert values[5] == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for (x, y), _ in groups)
            assert list(values[6]) == [end for _, end in groups]
            links = Counter((x << 32) | y for (xs, ys), _ in groups for x in xs for y in ys)
            assert dict(zip(values[7].tolist(), values[8].tolist(), strict=True)) == links


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert A.align(docs, *PATHS).count() == 0
