"""Merkle manifest: SQL, a plain recomputation, and the odd cases."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from compare import compare, duck

from editpulse.llm import merkle

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, grp int, digest string, tie string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lowered=False):
    doc_id, text, lang, source, n_chars = row[:5]
    if lowered and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    fields = [doc_id, source, lang, n_chars, text]
    return digest("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(nodes):
    """(root, per leaf the list of (left, right) strings) of a list of digests."""
    paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        upper, covered = [], []
        for at in range(0, len(nodes), 16):
            run = nodes[at : at + 16]
            for i in range(len(run)):
                for j in below[at + i]:
                    paths[j].append(("".join(run[:i]), "".join(run[i + 1 :])))
            upper.append(digest("".join(run)))
            covered.append([j for one in below[at : at + 16] for j in one])
        nodes, below = upper, covered
    return nodes[0], paths


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        members = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((members, *tree([leaf(r) for r in members])))
    root, above = tree([t[1] for t in trees])
    out = []
    for (members, subroot, paths), upper in zip(trees, above, strict=True):
        for row, path in zip(members, paths, strict=True):
            whole = [*path, *upper]
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = leaf(row, tampered)
            for left, right in whole:
                node = digest(left + node + right)
            proof = digest("".join(a + b for a, b in whole))
            out.append((row[0], leaf(row), subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


def result(spark, rows, monkeypatch):
    frame = spark.createDataFrame(rows, DOCS)
    monkeypatch.setattr(merkle, "table", lambda *_: frame)
    found = merkle.op12_merkle_manifest(spark, "")
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_query_matches_sql(spark):
    assert compare(spark, duck(SF), merkle.op12_merkle_manifest, merkle.OP12_SQL, SF) is None


def test_odd_rows_against_plain_trees(spark, monkeypatch):
    rows = [(i, f"Text {i} É", "en", "hot", i, 1, "d", "t") for i in range(-300, 300)]
    rows += [(i, "One", None, None, None, 1, None, None) for i in range(17)]
    rows += [(5, "Same", "en", "é", 4, 1, "x", "y")] * 3 + [(5, "Other", "en", "é", 4, 1, "x", "y")]
    rows += [(None, None, None, "", None, None, None, None), (10, "", "en", "", 0, 1, "", "")]
    rows += [(7, "X" * 300_000, "de", "lone", 300_000, 1, "", "")]
    rows += [(i, "T", "fr", f"s{i}", 1, 1, "", "") for i in range(20)]
    found = result(spark, rows, monkeypatch)
    assert found == brute(rows)
    assert any(not r[-1] for r in found) and any(r[-1] for r in found)


@pytest.mark.parametrize("n", [0, 1, 16, 17, 257])
def test_sizes_around_a_run(spark, monkeypatch, n):
    rows = [(i * 3, "Abc", "en", "s", 3, 1, "", "") for i in range(n)]
    assert result(spark, rows, monkeypatch) == (brute(rows) if rows else [])
