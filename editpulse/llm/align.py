"""Alignment of two tokenizers' tokens by interval coalescing (operator 11).

Tokenizer A is a byte-level BPE (its input gets a space in front), B a SentencePiece model (which
adds that space itself), so the tokens of both tile the same bytes. Within a Spark task the tokens of
many texts are laid out on one line of byte offsets, sorted by start, and their ends are accumulated
to a running maximum; a group ends where a start reaches it. In a group every A token is linked with
every B token. A document's distinct id pairs and their numbers of links are written once.

Corpus-wide, Spark counts the documents of each pair (partial counts travel, so a frequent pair is
no hot key) and takes each A id's highest count. Counts come back to the documents in two joins that
together see every row: pairs that are in many documents, at most ``HOT_PAIRS`` by construction, are broadcast;
all others are in so few documents that the join on the pair has no hot key.

Where a single space stands between other characters both tokenizers always start a token, so texts are
cut there and the groups of a text are those of its cuts, one after the other. The groups of a cut are worked out
once as long as a worker keeps it, and texts of more than ``SLICE`` characters pass slice by slice.

Defined cases: null and empty texts, and texts whose tokens do not spell the space and the text (a
literal U+2581, say), have no tokens and zeros; special-token strings are ordinary text; rows count as
documents of their own even if ids repeat or are null; an empty table gives no rows; extra columns do
not matter.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.bpe import byte_characters
from editpulse.llm.columns import id_and_text, table
from editpulse.sources.working import working_table

# Most pairs that are broadcast with their counts, about 3 MB.
HOT_PAIRS = 1 << 17
# Characters of a text, and of a batch of texts or cuts, handled at a time.
SLICE, BATCH = 1 << 17, 1 << 18
# Cuts whose groups a worker keeps at once.
KEPT_CUTS = 200_000
# The pre-tokenizer and its pattern, by which ids and ranks agree on ASCII texts.
PRE_TOKENIZER = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# ASCII texts that border on a space with other characters on both sides when joined by one.
_JOINED = re.compile(r"[!-~](?:[ -~\n\t\r]*[!-~])?")
# Where both tokenizers start a token: at a single space between other characters.
_BORDER = re.compile(r"(?<=\S) (?=\S)")

SCHEMA = (
    "valid boolean, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, ends array<int>, "
    "pairs array<bigint>, links array<bigint>"
)


def _spelled(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Joined bytes of all tokens in id order, and their bounds."""
    bounds = np.zeros(len(tokens) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in tokens], out=bounds[1:])
    return np.frombuffer(b"".join(tokens), dtype=np.uint8), bounds


def _flat(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array(list(chain.from_iterable(found)), dtype=np.int64), np.array([len(x) for x in found], dtype=np.int64)


class ByteTokens:
    """Tokenizer A: ids of texts, and each id's bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        vocab = self.library.get_vocab(with_added_tokens=False)
        tokens = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            tokens[i] = bytes(byte_of[c] for c in token)
        self.joined, self.bounds = _spelled(tokens)
        self.ranked = self._by_rank(path, tokens)

    def _by_rank(self, path: str, tokens: list[bytes]):
        """The same tokenizer as ranks, if ids are in the order of merges; quicker on many short texts."""
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        made = [self.library.token_to_id(left + right) for left, right in merges]
        plain = model["normalizer"] is None and model["pre_tokenizer"] == PRE_TOKENIZER
        if not plain or made != sorted(made) or sorted(made + list(range(256))) != list(range(len(tokens))):
            return None
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, a space in front of each, and how many each has.

        ASCII texts without a space at their ends are joined: the space between them always starts a token.
        """
        if not self.ranked or not all(_JOINED.fullmatch(t) for t in texts):
            found = self.library.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)
            return _flat([f.ids for f in found])
        ids = np.array(self.ranked.encode_ordinary(" " + " ".join(texts)), dtype=np.int64)
        ends = np.cumsum(self.bounds[ids + 1] - self.bounds[ids])
        places = np.cumsum([len(t) + 1 for t in texts])
        return ids, np.bincount(np.searchsorted(places, ends), minlength=len(texts))


class PieceTokens:
    """Tokenizer B: ids of texts, and each id's bytes."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.joined, self.bounds = _spelled(
            [
                bytes([int(lib.id_to_piece(i)[3:5], 16)]) if lib.is_byte(i) else lib.id_to_piece(i).replace("▁", " ").encode()
                for i in range(lib.get_piece_size())
            ]
        )

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat(self.library.encode(texts, num_threads=1))


def slices_of(text: str) -> list[str]:
    """Pieces of a text that lose the space between them; equal tokens come out of them."""
    out, at = [], 0
    while len(text) - at > SLICE:
        border = _BORDER.search(text, at + SLICE)
        if not border:
            break
        out.append(text[at : border.start()])
        at = border.end()
    return [*out, text[at:]]


def _laid_out(ids: np.ndarray, counts: np.ndarray, tokens, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of all tokens on the line of bytes, and each text's first token.

    ``sizes`` are the texts' numbers of bytes; a text's tokens begin at its own place whatever
    the tokens before it spell.
    """
    first = np.concatenate([[0], np.cumsum(counts)])
    length = tokens.bounds[ids + 1] - tokens.bounds[ids]
    ends = np.cumsum(length)
    places = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    before = np.concatenate([[0], ends])[first[:-1]]
    ends = ends + np.repeat(places - before, counts)
    return ends - length, ends, first


def _spells(ids: np.ndarray, first: np.ndarray, tokens, sizes: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Which texts' tokens spell exactly the text's bytes."""
    length = tokens.bounds[ids + 1] - tokens.bounds[ids]
    total = np.concatenate([[0], np.cumsum(length)])[first]
    right = np.diff(total) == sizes
    places = np.concatenate([[0], np.cumsum(sizes)])
    for row in range(len(sizes)) if not right.all() else ():
        if right[row]:
            own = slice(first[row], first[row + 1])
            right[row] = tokens_bytes(ids[own], tokens).tobytes() == raw[places[row] : places[row + 1]].tobytes()
    if right.all():
        same = tokens_bytes(ids, tokens) == raw
        if not same.all():
            wrong = np.flatnonzero(~same)
            right[np.searchsorted(places, wrong, side="right") - 1] = False
    return right


def tokens_bytes(ids: np.ndarray, tokens) -> np.ndarray:
    """The bytes that ``ids`` spell."""
    length = tokens.bounds[ids + 1] - tokens.bounds[ids]
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return tokens.joined[np.repeat(tokens.bounds[ids] - (ends - length), length) + np.arange(total)]


class Groups:
    """Groups of a batch of short texts: which are valid, and their tokens ordered by group."""

    def __init__(self, texts: list[str], a: ByteTokens, b: PieceTokens):
        coded = [f" {t}".encode() for t in texts]
        self.sizes = sizes = np.array([len(c) for c in coded], dtype=np.int64)
        raw = np.frombuffer(b"".join(coded), dtype=np.uint8)
        laid = []
        valid = np.ones(len(texts), dtype=bool)
        for tokens in (a, b):
            ids, counts = tokens.encode(texts)
            starts, ends, first = _laid_out(ids, counts, tokens, sizes)
            valid &= _spells(ids, first, tokens, sizes, raw)
            laid.append((ids, starts, ends, np.repeat(np.arange(len(texts)), np.diff(first))))
        self.valid = valid
        kept = [tuple(x[valid[row]] for x in (ids, starts, ends, row)) for ids, starts, ends, row in laid]
        ids, starts, ends, row = (np.concatenate([side[k] for side in kept]) for k in range(4))
        side = np.repeat([0, 1], [len(kept[0][0]), len(kept[1][0])])
        order = np.lexsort((side, starts))
        reach = np.maximum.accumulate(ends[order]) if len(order) else ends
        opens = np.ones(len(order), dtype=bool)
        opens[1:] = starts[order][1:] >= reach[:-1]
        group = np.empty(len(order), dtype=np.int64)
        group[order] = np.cumsum(opens) - 1
        # by group, A before B, in order of start
        order = np.lexsort((starts, side, group))
        self.ids, self.side, self.group, self.row = ids[order], side[order], group[order], row[order]
        n = int(group.max()) + 1 if len(group) else 0
        self.counts = [np.bincount(group[side == s], minlength=n) for s in (0, 1)]
        self.group_row = np.zeros(n, dtype=np.int64)
        self.group_row[self.group] = self.row
        self.group_end = np.zeros(n, dtype=np.int64)
        np.maximum.at(self.group_end, group, ends)
        self.group_end -= np.concatenate([[0], np.cumsum(sizes)])[self.group_row]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, A id << 32 | B id) and the links of each."""
        per = [self._distinct(s) for s in (0, 1)]
        (ga, ia, na), (gb, ib, nb) = per
        first_b, many_b = np.searchsorted(gb, ga), np.searchsorted(gb, ga, side="right")
        width = many_b - first_b
        left = np.repeat(np.arange(len(ga)), width)
        right = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(first_b, width)
        row, pair, links = self.group_row[ga[left]], (ia[left] << 32) | ib[right], na[left] * nb[right]
        return summed(row, pair, links)

    def _distinct(self, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group, id and occurrences of each distinct id of a group's side."""
        own = self.side == side
        return summed(self.group[own], self.ids[own], np.ones(int(own.sum()), dtype=np.int64))

    def written(self, names: list[list[str]]) -> list[str]:
        """Per text its groups as ``a1,a2|b1;a3|b2``."""
        mark = np.zeros(len(self.ids), dtype=np.int64)  # what stands before a token: , | or ;
        if len(mark):
            mark[1:] = np.where(self.group[1:] != self.group[:-1], 2, np.where(self.side[1:] != self.side[:-1], 1, 0))
            mark[0] = 2
        n = len(names[0])
        flat = [name for group in names for name in group]
        words = list(map(flat.__getitem__, (mark * n + self.ids).tolist()))
        bounds = np.searchsorted(self.row, np.arange(len(self.sizes) + 1))
        return ["".join(words[bounds[k] : bounds[k + 1]])[1:] for k in range(len(self.sizes))]


def summed(major: np.ndarray, minor: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (major, minor) in order, and the sum of the values of each."""
    if not len(major):
        return major, minor, values
    order = np.lexsort((minor, major))
    major, minor, values = major[order], minor[order], values[order]
    new = np.ones(len(major), dtype=bool)
    new[1:] = (major[1:] != major[:-1]) | (minor[1:] != minor[:-1])
    at = np.flatnonzero(new)
    return major[at], minor[at], np.add.reduceat(values, at)


def ranges(first: np.ndarray, width: np.ndarray) -> np.ndarray:
    """The numbers ``first, first + 1, ...`` of each range, one after the other."""
    return np.repeat(first - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))


class Cuts:
    """The alignment of every cut a worker keeps, as columns by number of the cut."""

    def __init__(self, a: ByteTokens, b: PieceTokens):
        self.a, self.b = a, b
        n = max(len(a.bounds), len(b.bounds))
        self.names = [[f"{mark}{i}" for i in range(n)] for mark in ",|;"]
        self.hits = np.zeros(0, dtype=np.int64)
        self.number: dict[str, int] = {}
        self.texts: list[str] = []
        # bytes, invalid, tokens of A and of B, groups, links; then bounds and values of ends and pairs
        self.counts = np.zeros((0, 6), dtype=np.int64)
        self.group_at, self.pair_at = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        self.ends, self.pairs, self.links = (np.zeros(0, dtype=kind) for kind in (np.int32, np.int64, np.int64))

    def numbers(self, parts: list[list[str]]) -> np.ndarray:
        """Numbers of all cuts, of which new ones are aligned first."""
        new = set().union(*parts).difference(self.number)
        if self.number and len(self.number) + len(new) > KEPT_CUTS:  # before any of these gets a number
            self._keep_frequent()
            new = set().union(*parts).difference(self.number)
        plain = list(filter(_JOINED.fullmatch, new))
        for kind in (plain, list(new.difference(plain))):
            waiting, size = [], 0
            for cut in kind:
                waiting.append(cut)
                size += len(cut) + 1
                if size >= BATCH:
                    self._learn(waiting)
                    waiting, size = [], 0
            if waiting:
                self._learn(waiting)
        found = np.array(list(map(self.number.__getitem__, chain.from_iterable(parts))), dtype=np.int64)
        self.hits = np.bincount(found, minlength=len(self.texts)) + np.pad(self.hits, (0, len(self.texts) - len(self.hits)))
        return found

    def _keep_frequent(self) -> None:
        """Drop cuts met once, and the rarest beyond half of what may be kept."""
        kept = np.argsort(-self.hits, kind="stable")[: KEPT_CUTS // 2]
        kept = np.sort(kept[self.hits[kept] > 1])
        cuts, texts = list(self.number), self.texts
        self.number = {cuts[old]: new for new, old in enumerate(kept.tolist())}
        self.texts = [texts[old] for old in kept.tolist()]
        self.counts, self.hits = self.counts[kept], self.hits[kept] // 2
        for at, names in (("group_at", ("ends",)), ("pair_at", ("pairs", "links"))):
            first = getattr(self, at)[kept]
            width = getattr(self, at)[kept + 1] - first
            for name in names:
                setattr(self, name, getattr(self, name)[ranges(first, width)])
            setattr(self, at, np.concatenate([[0], np.cumsum(width)]))

    def _learn(self, cuts: list[str]) -> None:
        groups, n = Groups(cuts, self.a, self.b), len(cuts)
        self.number.update(zip(cuts, range(len(self.texts), len(self.texts) + n), strict=True))
        self.texts += groups.written(self.names)
        at = np.searchsorted(groups.group_row, np.arange(n + 1))
        per_group = (*groups.counts, np.ones(len(groups.group_row), dtype=np.int64), groups.counts[0] * groups.counts[1])
        columns = [np.diff(np.concatenate([[0], np.cumsum(c)])[at]) for c in per_group]
        own = np.stack([groups.sizes, ~groups.valid, *columns], axis=1)
        self.counts = np.concatenate([self.counts, own])
        rows, pairs, links = groups.pairs()
        pair_at = np.searchsorted(rows, np.arange(n + 1))
        self.group_at = np.concatenate([self.group_at, at[1:] + self.group_at[-1]])
        self.pair_at = np.concatenate([self.pair_at, pair_at[1:] + self.pair_at[-1]])
        for name, values in (("ends", groups.group_end), ("pairs", pairs), ("links", links)):
            kept = getattr(self, name)
            setattr(self, name, np.concatenate([kept, values.astype(kept.dtype)]))


class _Document:
    """What the slices of one text add up to."""

    def __init__(self, empty: bool):
        self.valid, self.counts, self.bytes = not empty, np.zeros(4, dtype=np.int64), 0
        self.texts, self.ends, self.pairs, self.links = [], [], [], []

    def values(self) -> tuple:
        if not self.valid:
            return False, 0, 0, 0, 0, "", [], [], []
        pairs, links = np.concatenate(self.pairs), np.concatenate(self.links)
        if len(self.pairs) > 1:
            _, pairs, links = summed(np.zeros(len(pairs), dtype=np.int64), pairs, links)
        return True, *self.counts.tolist(), ";".join(self.texts), np.concatenate(self.ends), pairs, links


def _add(slices: list[str], documents: list[_Document], cuts: Cuts) -> None:
    """Add the groups of a batch of slices to their documents, in order."""
    parts = [_BORDER.split(text) for text in slices]
    numbers = cuts.numbers(parts)
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    row = np.repeat(np.arange(len(parts)), np.diff(bounds))
    totals = np.concatenate([np.zeros((1, 6), dtype=np.int64), np.cumsum(cuts.counts[numbers], axis=0, dtype=np.int64)])
    sums = np.diff(totals[bounds], axis=0)

    first = cuts.group_at[numbers]
    width = cuts.group_at[numbers + 1] - first
    ends = cuts.ends[ranges(first, width)] + np.repeat(totals[:-1, 0] - np.repeat(totals[bounds[:-1], 0], np.diff(bounds)), width)
    end_at = np.concatenate([[0], np.cumsum(width)])[bounds]

    keys, times = np.unique(row * len(cuts.texts) + numbers, return_counts=True)
    row, number = np.divmod(keys, len(cuts.texts))
    first = cuts.pair_at[number]
    width = cuts.pair_at[number + 1] - first
    at = ranges(first, width)
    row, pairs, links = summed(np.repeat(row, width), cuts.pairs[at], cuts.links[at] * np.repeat(times, width))
    pair_at = np.searchsorted(row, np.arange(len(parts) + 1))

    numbers = numbers.tolist()
    for i, document in enumerate(documents):
        document.valid &= bool(sums[i, 1] == 0)
        if document.valid:
            document.counts += sums[i, 2:]
            document.texts.append(";".join(map(cuts.texts.__getitem__, numbers[bounds[i] : bounds[i + 1]])))
            document.ends.append((ends[end_at[i] : end_at[i + 1]] + document.bytes).astype(np.int32))
            document.pairs.append(pairs[pair_at[i] : pair_at[i + 1]])
            document.links.append(links[pair_at[i] : pair_at[i + 1]])
        else:
            document.texts, document.ends, document.pairs, document.links = [], [], [], []
        document.bytes += int(sums[i, 0])


def aligned(texts: list[str | None], cuts: Cuts) -> list[_Document]:
    """Alignment of each text, worked out in batches of slices."""
    documents = [_Document(not text) for text in texts]
    waiting, owners, size = [], [], 0
    for text, document in zip(texts, documents, strict=True):
        for piece in slices_of(text) if text else ():
            waiting.append(piece)
            owners.append(document)
            size += len(piece)
            if size >= BATCH:
                _add(waiting, owners, cuts)
                waiting, owners, size = [], [], 0
    if waiting:
        _add(waiting, owners, cuts)
    return documents


@lru_cache(maxsize=2)
def cuts_of(a_path: str, b_path: str) -> Cuts:
    """One store of cuts a worker, which outlives a task."""
    return Cuts(ByteTokens(a_path), PieceTokens(b_path))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its groups, their last bytes' offsets (after the added space), its id pairs and links.

    ``groups`` lists each group's A and B ids as ``a1,a2|b1;a3|b2``; ``pairs`` holds A id times 2**32 plus B id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = cuts_of(a_path, b_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                values = [d.values() for d in aligned(part.column(1).to_pylist(), cuts)]
                columns = [pa.array([v[k] for v in values], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", *fields])

    kinds = [pa.bool_(), *[pa.int64()] * 4, pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    fields = [f.split()[0] for f in SCHEMA.split(", ")]
    source = id_and_text(docs, id_col, text_col)
    return source.mapInArrow(run, f"doc_id {source.schema[0].dataType.simpleString()}, {SCHEMA}")


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair, docs, best`` of rows ``row, pair``: documents that hold it, and whether its A id has no pair with more."""
    counts = working_table(links.groupBy("pair").agg(F.count("*").alias("docs")), "pairs")
    a = F.shiftright("pair", 32)
    # one row per A id: as many as A's vocabulary has entries
    tops = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))
    return counts.join(F.broadcast(tops), a == F.col("a")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def link_sums(links: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``row, n_best, count_sum`` of rows ``row, pair, links`` (one per document and pair)."""
    counts = working_table(pair_counts(links), "counts")
    total = counts.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
    # at most total / many <= hot_pairs pairs can be in this many documents
    many = total // hot_pairs + 1
    hot = F.broadcast(counts.where(F.col("docs") >= many))
    frequent = links.join(hot, "pair")
    rare = links.join(hot.select("pair"), "pair", "left_anti").join(counts.where(F.col("docs") < many).hint("merge"), "pair")
    sums = (
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
        F.sum(F.col("links") * F.col("docs")).alias("count_sum"),
    )
    both = [side.groupBy("row").agg(*sums) for side in (frequent, rare)]
    return both[0].unionByName(both[1]).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found = align(table(spark, sf_dir, "documents"), *paths)
    written = working_table(
        found.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", "n_groups", "n_links",
            F.when(F.col("valid"), F.sha2("groups", 256)).otherwise("").alias("groups_sha256"), "pairs", "links",
        ),
        "aligned",
    )
    zipped = F.explode(F.arrays_zip("pairs", "links"))
    links = written.select("row", zipped.alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.links").alias("links"))
    return written.drop("pairs", "links").join(link_sums(links), "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
    )
