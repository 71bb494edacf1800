"""SentencePiece BPE encoding by a table of each prefix's last token, and decoding (operator 13).

The encoding of a text ends in the same token whatever follows that prefix is cut off, so a prefix
has one last token. An automaton over all pieces reports the pieces that end at a character; the one
that fits the last token of the prefix before it is the new prefix's last token. Two adjacent
tokens fit if no merge across their border would have come before the merges that made them.
The ids are read off the table from the end. Work is linear in the text, however long its words.

Merges are ranked by score, and every pair whose joined string is a piece may merge. Pieces that tie
for the lowest score must be runs of the space mark; they are joined last, from the left. No piece may
hold a space mark after another character, so a text is cut before each run of space marks, and the
ids of the distinct cuts of a worker are kept in a bounded dictionary. Models that break these
rules are refused. Characters without a piece become the bytes' pieces. The library normalizes texts and
decodes ids; very long texts are decoded in slices that split no run of byte pieces.

Defined cases: null and empty texts give the end id alone and decode to the empty text; strings like
``</s>`` in a text are ordinary text; a literal space mark is a space; rows repeat as they come; an
empty table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from editpulse.llm.columns import id_and_text, table

MARK = "▁"
# Cuts whose ids a worker keeps at once, and characters, cuts or ids handled at a time.
KEPT_CUTS = 400_000
# Pairs of adjacent tokens whose fit a worker keeps at once.
KEPT_PAIRS = 500_000
SLICE = 1 << 16
_BORDER = re.compile(f"[^{MARK}](?={MARK})")
_NONE = -1


class Automaton:
    """All pieces that end at a character, longest first, while a string is read.

    Steps that follow shorter suffixes are kept once taken, so reading is one lookup a character.
    """

    def __init__(self, tokens: dict[str, int]):
        self.steps: list[dict[str, int]] = [{}]
        ending: dict[int, tuple[int, int]] = {}
        for piece, token in tokens.items():
            state = 0
            for char in piece:
                if char not in self.steps[state]:
                    self.steps[state][char] = len(self.steps)
                    self.steps.append({})
                state = self.steps[state][char]
            ending[state] = token, len(piece)
        self.shorter = [0] * len(self.steps)
        self.matches: list[tuple[tuple[int, int], ...]] = [()] * len(self.steps)
        reached = deque(self.steps[0].values())
        for state in self.steps[0].values():
            self.matches[state] = (ending[state],) if state in ending else ()
        edges = [list(step.items()) for step in self.steps]
        while reached:
            state = reached.popleft()
            for char, child in edges[state]:
                self.shorter[child] = short = self.step(self.shorter[state], char)
                self.matches[child] = ((ending[child],) if child in ending else ()) + self.matches[short]
                reached.append(child)

    def step(self, state: int, char: str) -> int:
        found = self.steps[state].get(char)
        if found is None:
            at = state
            while at and char not in self.steps[at]:
                at = self.shorter[at]
            found = self.steps[state][char] = self.steps[at].get(char, 0)
        return found


class PieceModel:
    """Pieces, their ranks and merges of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        known = [i for i in range(lib.get_piece_size()) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
        text, score = {i: lib.id_to_piece(i) for i in known}, {i: lib.get_score(i) for i in known}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        runs = {i for i in known if len(text[i]) > 1 and not text[i].strip(MARK)}
        self.mark, self.runs = lib.piece_to_id(MARK), {len(text[i]): i for i in runs}
        self._check(text, score, runs)

        # a token is its rank: single characters first, then merges in the order they are made
        order = sorted((i for i in known if i not in runs), key=lambda i: (len(text[i]) > 1, -score[i]))
        self.ids, self.sizes = order, [len(text[i]) for i in order]
        rank = {text[i]: r for r, i in enumerate(order)}
        self.parts: list[tuple[int, int] | None] = []
        self.merges: dict[tuple[int, int], int] = {}
        self.fitting: dict[int, bool] = {}
        for token, piece_id in enumerate(order):
            piece, parts = text[piece_id], None
            for cut in range(1, len(piece)):
                left, right = rank.get(piece[:cut], token), rank.get(piece[cut:], token)
                if left < token and right < token and self._fits(left, right):
                    parts = (left, right)
                    break
            self.parts.append(parts)
            if parts:
                self.merges[parts] = token
        # others are never reached by merging
        self.automaton = Automaton({p: t for p, t in rank.items() if self.parts[t] or len(p) == 1})
        self.cuts = re.compile(self._cut_pattern(set(rank)))
        self.plain = next(i for i in order if len(text[i]) == 1 and text[i] != MARK)

    def _check(self, text: dict[int, str], score: dict[int, float], runs: set[int]) -> None:
        pieces = set(text.values())
        others = [score[i] for i in text if i not in runs and len(text[i]) > 1]
        if len(set(others)) < len(others) or any(score[i] >= min(others) for i in runs):
            raise ValueError("pieces other than runs of the space mark tie in score")
        if len({score[i] for i in runs}) > 1:
            raise ValueError("runs of the space mark differ in score")
        if any(MARK in p.lstrip(MARK) or MARK * 2 in p for p in pieces if p.strip(MARK)):
            raise ValueError("a piece holds a space mark within")
        if not {c for p in pieces for c in p} <= pieces or any(not self.library.is_byte(i) for i in self.bytes):
            raise ValueError("characters of pieces and all bytes must be pieces")

    def _cut_pattern(self, pieces: set[str]) -> str:
        """Where texts are cut: before space marks, and between letters and other signs if no piece holds both.

        Characters without a piece join nothing, so it does not matter which kind they count as.
        """
        letters = {p for p in pieces if len(p) == 1 and p.isalpha()}
        if any(len({c in letters for c in p.lstrip(MARK)}) > 1 for p in pieces):
            return f"{MARK}*[^{MARK}]+|{MARK}+"
        listed = "".join(map(re.escape, sorted(letters)))
        return f"{MARK}*[{listed}]+|{MARK}*[^{listed}{MARK}]+|{MARK}+"

    def _fits(self, left: int, right: int) -> bool:
        """No merge across the border of two tokens comes before the merges that made them.

        Going back in time: while both tokens stand, a merge of the two of lower rank than the
        merges that end them would have been made instead. At equal ranks the left one is first.
        """
        left_ends = right_ends = len(self.ids)
        merges, parts = self.merges, self.parts
        while True:
            across = merges.get((left, right))
            if across is not None and across < left_ends and across <= right_ends:
                return False
            # undo the later of the two merges; a character was never merged
            made_left, made_right = parts[left], parts[right]
            if made_left and (left > right or not made_right):
                left, left_ends = made_left[1], left
            elif made_right:
                right, right_ends = made_right[0], right
            else:
                return True

    def fits(self, left: int, right: int) -> bool:
        """`_fits`, remembered for as many pairs as are kept."""
        if len(self.fitting) > KEPT_PAIRS:
            self.fitting.clear()
        known = self.fitting[left * len(self.ids) + right] = self._fits(left, right)
        return known

    def ids_of(self, cuts: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Each cut with its ids. Cuts in sorted order share the table of the prefix they have in common."""
        last, states = array("i", [_NONE]), array("i", [0])
        steps, matches, fitting, n = self.automaton.steps, self.automaton.matches, self.fitting, len(self.ids)
        before_cut = ""
        for cut in cuts:
            shared = 0
            for one, other in zip(before_cut, cut):
                if one != other:
                    break
                shared += 1
            before_cut = cut
            del last[shared + 1 :], states[shared + 1 :]
            state = states[shared]
            for end in range(shared + 1, len(cut) + 1):
                char = cut[end - 1]
                step = steps[state].get(char)
                state = self.automaton.step(state, char) if step is None else step
                states.append(state)
                for token, size in matches[state]:
                    before = last[end - size]
                    if before != _NONE:
                        known = fitting.get(before * n + token)
                        if not (self.fits(before, token) if known is None else known):
                            continue
                    last.append(token)
                    break
                else:
                    last.append(_NONE)
            yield cut, self._read_back(cut, last)

    def _read_back(self, cut: str, last: array) -> list[int]:
        """Ids of ``cut`` by the last token of each of its prefixes, -1 where it is a character without a piece."""
        at, backwards = len(cut), []
        while at > 0:
            token = last[at]
            if token == _NONE:
                backwards.extend(self.bytes[b] for b in reversed(cut[at - 1].encode()))
                at -= 1
            else:
                backwards.append(self.ids[token])
                at -= self.sizes[token]
        backwards.reverse()
        return self._joined_marks(backwards) if cut.startswith(MARK * 2) else backwards

    def _joined_marks(self, ids: list[int]) -> list[int]:
        """``ids`` with the single space marks at the start of a cut joined.

        Of the pairs that may join, the leftmost goes first: a joined run is tried again with the
        run before it, then with the mark after it.
        """
        n = next((i for i, x in enumerate(ids) if x != self.mark), len(ids))
        done: list[int] = []  # lengths of runs, none of which joins its neighbour
        for _ in range(n):
            done.append(1)
            while len(done) > 1 and done[-2] + done[-1] in self.runs:
                done[-2:] = [done[-2] + done[-1]]
        return [self.mark if size == 1 else self.runs[size] for size in done] + ids[n:]


@lru_cache(maxsize=2)
def model_of(path: str) -> PieceModel:
    return PieceModel(path)


class PrefixEncoder:
    """Ids of texts as 32-bit integers' bytes; equal cuts are encoded once."""

    def __init__(self, path: str):
        self.model, self.known = model_of(path), {}

    def _cuts(self, normal: str) -> Iterator[list[str]]:
        at = 0
        while at < len(normal):
            border = _BORDER.search(normal, at + SLICE)
            end = border.end() if border else len(normal)
            yield self.model.cuts.findall(normal, at, end)
            at = end

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        waiting, size = [], 0
        for text, ids in zip(texts, out, strict=True):
            for cuts in self._cuts(self.model.library.normalize(text)):
                waiting.append((ids, cuts))
                size += len(cuts)
                if size >= SLICE:
                    self._flush(waiting)
                    waiting, size = [], 0
        self._flush(waiting)
        return [b"".join(ids) for ids in out]

    def _flush(self, waiting: list[tuple[list[bytes], list[str]]]) -> None:
        new = set().union(*(cuts for _, cuts in waiting)).difference(self.known)
        if self.known and len(self.known) + len(new) > KEPT_CUTS:  # before any of these is encoded
            self.known.clear()
            new = set().union(*(cuts for _, cuts in waiting))
        for cut, ids in self.model.ids_of(sorted(new)):
            self.known[cut] = array("i", ids).tobytes()
        for out, cuts in waiting:
            out.append(b"".join(map(self.known.__getitem__, cuts)))


@lru_cache(maxsize=2)
def encoder_of(path: str) -> PrefixEncoder:
    """One encoder a worker, whose dictionary outlives a task."""
    return PrefixEncoder(path)


def decoded_slices(model: PieceModel, ids: np.ndarray) -> Iterator[str]:
    """The library's decoding of ``ids``, slice by slice.

    A slice ends before an id that is no byte piece. Later slices get a plain character in front,
    which is taken off again, as the library drops a space mark at the start.
    """
    at, is_byte = 0, np.zeros(model.library.get_piece_size(), dtype=bool)
    is_byte[model.bytes] = True
    while at < len(ids):
        end = at + SLICE
        while end < len(ids) and is_byte[ids[end]]:
            end += 1
        part = ids[at:end].tolist()
        yield model.library.decode([model.plain, *part])[1:] if at else model.library.decode(part)
        at = end


def encode(docs: DataFrame, path: str, end_id: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: ids of each whole text, with the model's end id last if ``end_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        tail = np.array([encoder.model.library.eos_id()][: int(end_id)], dtype="<i4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [ids + tail for ids in encoder.encode([text or "" for text in part.column(1).to_pylist()])]
                bounds = np.zeros(len(found) + 1, dtype=np.int32)
                np.cumsum([len(ids) // 4 for ids in found], out=bounds[1:])
                values = pa.array(np.frombuffer(b"".join(found), dtype="<i4"))
                ids = pa.ListArray.from_arrays(pa.array(bounds), values)
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    source = id_and_text(docs, id_col, text_col)
    return source.mapInArrow(run, f"doc_id {source.schema[0].dataType.simpleString()}, ids array<int>")


def _rows_of_ids(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for at in range(0, batch.num_rows, 256):
        part = batch.slice(at, 256)
        yield part, [np.asarray(x.values) if x.is_valid else np.zeros(0, np.int32) for x in part.column(1)]


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded``: the texts that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            for part, rows in _rows_of_ids(batch):
                texts = pa.array(["".join(decoded_slices(model, ids)) for ids in rows], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], ["doc_id", "ids", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """Number and digests of the ids and of the decoded texts, hashed slice by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        spelled = [str(i) for i in range(model.library.get_piece_size())]
        for batch in batches:
            for part, rows in _rows_of_ids(batch):
                hashes = []
                for ids in rows:
                    listed, text = hashlib.sha256(), hashlib.sha256()
                    for at in range(0, len(ids), SLICE):
                        listed.update((" " * (at > 0) + " ".join(map(spelled.__getitem__, ids[at : at + SLICE].tolist()))).encode())
                    for piece in decoded_slices(model, ids):
                        text.update(piece.encode())
                    hashes.append((len(ids), listed.hexdigest(), text.hexdigest()))
                columns = [pa.array([h[k] for h in hashes], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    kind = encoded.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return digests(encode(table(spark, sf_dir, "documents"), path), path)
