"""Toxicity by a counterfactual-regularised linear classifier (operator 6).

A text's features are the distinct lower-cased words it holds and the prefixes of ``PREFIX`` letters of
longer words, hashed to buckets; inflected and compound forms of a rare word share a prefix. Words
that begin like an identity term give no prefix, so groups are named by the terms alone. Document
counts of each bucket by label, over all labelled training rows, choose the buckets with the largest
chi-square; their number is bounded, so only they reach the driver. A logistic regression is fitted
on a bounded sample of labelled rows; its ridge is chosen by cross-validation inside them, each fold
with buckets chosen without its rows. For each sampled row the identity terms it holds are swapped
for others (a row without any gets one term, then another), and the squared change of the score is
part of the loss: neutral mentions of a group cannot move a score.

Defined cases: null and empty texts have no words and get the score of the intercept; rows repeat as
they come; null labels are left out; with no labelled rows, or one class only, every score is the
smoothed share of toxic labels (0.5 without labels); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.batches import BASE, CHUNK_BYTES, cut, mixed, streamed_word_hashes, text_chunks, word_hashes
from editpulse.llm.columns import below_threshold, hash_place, id_and_text, table
from editpulse.operators.sizing import broadcast_if_small
from editpulse.sources.working import working_table

BUCKETS = 1 << 20
SELECTED = 800
LEAST_ROWS = 2  # labelled rows that hold a selected bucket
PREFIX = 4
RIDGES = (1e-3, 1e-4, 1e-5)  # strongest first
FOLDS, FOLD_ROWS = 3, 4_000  # rows of the sample that choose the ridge
MAX_LABELLED = 20_000  # rows the regression is fitted on; counts cover all labelled rows
SWAP_WEIGHT = 10.0
FIT_ROWS = 1_000  # rows that one step of the fit turns to floats at a time

# Neutral mentions of groups.
IDENTITY_TERMS = (
    "women men girls boys mothers fathers muslims christians jews hindus buddhists atheists black white "
    "asian african european american immigrants refugees gay straight lesbian transgender old young "
    "disabled blind deaf mujeres hombres femmes hommes frauen männer"
).split()

OUTSIDE = np.ones(256, dtype=bool)  # words are letters and all bytes beyond ASCII
OUTSIDE[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _cut_words(offsets: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """The chunk with all but the first ``PREFIX`` letters of each word blanked."""
    inside = ~OUTSIDE[raw]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    bounds = offsets[:-1][offsets[:-1] < len(raw)]
    opens[bounds] = inside[bounds]
    letters = np.cumsum((raw & 0xC0) != 0x80)
    word = np.cumsum(opens) - 1  # -1 before the first word, where nothing is inside
    beyond = np.zeros(len(raw), dtype=bool)
    if opens.any():
        beyond = inside & (letters - letters[opens][word] >= PREFIX)
    return np.where(beyond, np.uint8(0x20), raw)


def _hashes(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words, of their first letters, and each row's first word."""
    words, first = word_hashes(offsets, raw, OUTSIDE)
    return words, word_hashes(offsets, _cut_words(offsets, raw), OUTSIDE)[0], first


def _of_terms() -> tuple[np.ndarray, np.ndarray]:
    ((_, offsets, raw),) = text_chunks(pa.array(IDENTITY_TERMS))
    words, prefixes, _ = _hashes(offsets, raw)
    return np.unique(words), np.unique(prefixes)


TERM_WORDS, TERM_PREFIXES = _of_terms()


def _long_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_hashes`` of one long text, taken in pieces. The bytes before a piece tell how many letters
    of its first word are gone."""

    def blanked() -> Iterator[np.ndarray]:
        for at in range(0, len(raw), CHUNK_BYTES):
            low = max(0, at - 8 * PREFIX)
            part = raw[low : at + CHUNK_BYTES]
            yield _cut_words(np.array([0, len(part)]), part)[at - low :]

    return tuple(np.concatenate(list(streamed_word_hashes(x, OUTSIDE))) for x in (cut(raw), blanked()))


def _own_buckets(words: np.ndarray, prefixes: np.ndarray) -> np.ndarray:
    """Two buckets for each word, its own and its prefix's (its own again if it has none)."""
    has = (words != prefixes) & ~np.isin(prefixes, TERM_PREFIXES)
    both = np.stack([words, np.where(has, mixed(prefixes ^ BASE), words)], axis=1).ravel()
    return (both % np.uint64(BUCKETS)).astype(np.int64)


def _buckets(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all words, and each row's first bucket; of a long row, distinct ones."""
    if len(offsets) == 2 and len(raw) > CHUNK_BYTES:
        words, prefixes = _long_hashes(raw)
        held = np.zeros(BUCKETS, dtype=bool)
        for at in range(0, len(words), CHUNK_BYTES):
            held[_own_buckets(words[at : at + CHUNK_BYTES], prefixes[at : at + CHUNK_BYTES])] = True
        found = np.flatnonzero(held)
        return found, np.array([0, len(found)])
    words, prefixes, first = _hashes(offsets, raw)
    return _own_buckets(words, prefixes), 2 * first


def identity_buckets() -> np.ndarray:
    return np.unique((TERM_WORDS % np.uint64(BUCKETS)).astype(np.int64))


def word_buckets(rows: DataFrame) -> DataFrame:
    """``doc_id, toxic`` with the distinct word buckets of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, raw in text_chunks(batch.column(2)):
                found, first = _buckets(offsets, raw)
                own = [np.unique(found[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
                part = batch.slice(row, len(own))
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
                words = pa.ListArray.from_arrays(bounds, np.concatenate(own).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), words], ["doc_id", "toxic", "words"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", F.col("toxic").cast("int"), "text").mapInArrow(run, f"doc_id {kind}, toxic int, words array<int>")


def _fit(
    x: np.ndarray, swapped: np.ndarray, y: np.ndarray, swap_weight: float, ridge: float = 1e-3, start: np.ndarray | None = None
) -> np.ndarray:
    """Weights and intercept by Newton steps from ``start``; the swap term is quadratic in the weights."""
    n, k = x.shape

    def blocks() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows with a constant, their changes and labels, few at a time: the driver holds bytes, not floats."""
        for at in range(0, n, FIT_ROWS):
            part = x[at : at + FIT_ROWS].astype(float)
            change = swapped[at : at + FIT_ROWS] - part
            pad = np.ones((len(part), 1))
            yield np.hstack([part, pad]), np.hstack([change, 0 * pad]), y[at : at + FIT_ROWS]

    fixed = swap_weight * sum(change.T @ change for _, change, _ in blocks()) / n + ridge * np.eye(k + 1)
    w = np.zeros(k + 1) if start is None else start.copy()
    for _ in range(25):
        slope, curve = fixed @ w, fixed.copy()
        for one, _, own in blocks():
            p = 1 / (1 + np.exp(-np.clip(one @ w, -30, 30)))
            slope += one.T @ (p - own) / n
            curve += (one * (p * (1 - p))[:, None]).T @ one / n
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _swap(x: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with an identity term, and the same rows with their terms exchanged for the next ones.

    Rows that have none get a term inserted, in turn, so that the penalty sees each term.
    """
    x = x.copy()
    bare = np.flatnonzero(~x[:, terms].any(axis=1))
    x[bare, terms[bare % len(terms)]] = 1
    swapped = x.copy()
    swapped[:, terms] = np.roll(x[:, terms], 1, axis=1)
    return x, swapped


def _with_swaps(x: np.ndarray, y: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planted, swapped = _swap(x, own)
    return np.vstack([x, planted]), np.vstack([x, swapped]), np.concatenate([y, y])


def _chosen_ridge(folds: list[tuple[np.ndarray, np.ndarray, np.ndarray]], y: np.ndarray, swap_weight: float) -> float:
    """The ridge with the least loss on left-out rows. ``folds`` has, for each fold, the features of
    all rows, the places of the identity terms in them and the fold's rows."""
    loss = np.zeros(len(RIDGES))
    for x, own, out in folds:
        if not 0 < y[~out].sum() < (~out).sum():
            return RIDGES[0]
        rows, w = _with_swaps(x[~out], y[~out], own), None
        for i, ridge in enumerate(RIDGES):
            w = _fit(*rows, swap_weight, ridge, w)
            loss[i] += np.logaddexp(0, (1 - 2 * y[out]) * (x[out] @ w[:-1] + w[-1])).sum()
    return RIDGES[int(np.argmin(loss))]


def _rows_of(words: DataFrame, keep: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features as bytes, label, fold) of the first ``limit`` rows by hash of id; rows travel as bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(BUCKETS, -1, dtype=np.int32)
        place[keep] = np.arange(len(keep))
        for batch in batches:
            for at in range(0, batch.num_rows, FIT_ROWS):
                part = batch.slice(at, FIT_ROWS)
                lists = part.column(3)
                row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                own = place[lists.flatten().to_numpy()]
                x = np.zeros((len(lists), len(keep)), dtype=np.uint8)
                x[row[own >= 0], own[own >= 0]] = 1
                bits = pa.array([r.tobytes() for r in np.packbits(x, axis=1)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:3], bits], ["doc_id", "toxic", "fold", "bits"])

    kind = words.schema["doc_id"].dataType.simpleString()
    near = below_threshold(words.select("doc_id", "toxic", "fold", "words"), limit)
    packed = near.mapInArrow(run, f"doc_id {kind}, toxic int, fold int, bits binary")
    rows = packed.orderBy(hash_place(), "doc_id").limit(limit).select("toxic", "fold", "bits").collect()
    bits = np.frombuffer(b"".join(r.bits for r in rows), dtype=np.uint8).reshape(len(rows), -1)
    x = np.unpackbits(bits, axis=1, count=len(keep))
    return x, np.array([r.toxic for r in rows], dtype=float), np.array([r.fold for r in rows], dtype=int)


def train(
    docs: DataFrame,
    labels: DataFrame,
    selected: int = SELECTED,
    max_labelled: int = MAX_LABELLED,
    swap_weight: float = SWAP_WEIGHT,
) -> tuple[np.ndarray, np.ndarray, float]:
    """(bucket, weight) arrays and the intercept. ``labels`` has ``doc_id, toxic``."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.join(broadcast_if_small(marked), "doc_id")
    fold = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(FOLDS)).cast("int")
    words = working_table(word_buckets(rows).withColumn("fold", fold), "toxicity-words")
    total = words.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("pos")).first()
    base = (total.pos + 1) / (total.n + 2)
    prior = float(np.log(base / (1 - base)))
    terms = identity_buckets()
    if not 0 < total.pos < total.n:
        return np.zeros(0, np.int64), np.zeros(0), prior
    split = words.select("toxic", "fold", F.explode("words").alias("word")).groupBy("word").agg(*[
        f(F.when(F.col("fold") == k, c)).alias(f"{a}{k}")
        for k in range(FOLDS) for a, f, c in (("n", F.count, F.lit(1)), ("pos", F.sum, F.col("toxic")))
    ])
    split = working_table(split, "toxicity-counts")
    shares = words.groupBy("fold").agg(F.count("*").alias("n"), F.sum("toxic").alias("pos")).collect()

    def best(without: int | None) -> np.ndarray:
        """Buckets with the largest chi-square over all rows but those of one fold, and the terms."""
        used = [k for k in range(FOLDS) if k != without]
        n = sum(r.n for r in shares if r.fold in used)
        share = sum(r.pos for r in shares if r.fold in used) / max(1, n)
        if not 0 < share < 1:
            return terms
        held = sum((F.col(f"n{k}") for k in used), F.lit(0))
        expected = held * F.lit(share)
        pos = sum((F.coalesce(f"pos{k}", F.lit(0)) for k in used), F.lit(0))
        chi = (pos - expected) ** 2 / (expected * F.lit(1 - share))
        top = split.where(held >= LEAST_ROWS).orderBy(chi.desc(), "word").limit(selected).select("word").collect()
        return np.unique(np.concatenate([[r.word for r in top], terms]).astype(np.int64))

    keep = best(None)
    own = np.searchsorted(keep, terms)
    folds = []
    for k in range(FOLDS):
        left = best(k)
        x, y, fold = _rows_of(words, left, min(FOLD_ROWS, max_labelled))
        folds.append((x, np.searchsorted(left, terms), fold == k))
    ridge = _chosen_ridge(folds, y, swap_weight)
    x, y, _ = _rows_of(words, keep, max_labelled)
    if not 0 < y.sum() < len(y):
        return np.zeros(0, np.int64), np.zeros(0), prior
    w = _fit(*_with_swaps(x, y, own), swap_weight, ridge)
    return keep, w[:-1], float(w[-1])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """``doc_id, score`` of each row; one pass, no shuffle."""
    buckets, weights, intercept = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(BUCKETS, -1, dtype=np.int32)
        place[buckets] = np.arange(len(buckets))
        for batch in batches:
            for row, offsets, raw in text_chunks(batch.column(1)):
                found, first = _buckets(offsets, raw)
                own = place[found]
                hit = np.flatnonzero(own >= 0)
                doc = np.searchsorted(first, hit, side="right") - 1
                pairs = np.unique(doc * np.int64(max(1, len(weights))) + own[hit])
                n = len(offsets) - 1
                logit = intercept + np.bincount(pairs // max(1, len(weights)), weights[pairs % max(1, len(weights))], minlength=n)
                part = batch.slice(row, n)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(1 / (1 + np.exp(-logit)))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, score double")


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = id_and_text(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out("doc_id"))
    scored = score(docs, train(docs, labels))
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
