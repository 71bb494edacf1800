"""Quality by a document classifier and hierarchical empirical Bayes over sites (operator 8).

The classifier is a logistic regression on shares of character-class trigrams (letters by case,
digits, spaces, line ends and single punctuation marks) and the share of words that repeat the word
before them, fitted on a bounded sample of labelled rows. Its probabilities over *all* documents are summed per path (host and path) and per host. A
site's mean is shrunk toward its parent's, path to host and host to the corpus, by the number of
pseudo-documents that the method of moments gives for that level, so sparse sites stay at the prior.
The ratio of the site's odds to the corpus odds multiplies the document's odds.

Defined cases: null and empty texts have no evidence and get the prior of their site; null host or
path is a site of its own; rows repeat as they come; without labels of both classes all documents
are kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.batches import CHUNK_BYTES, cut, streamed_word_hashes, text_chunks, word_hashes
from editpulse.llm.columns import lowest_by_hash, table
from editpulse.operators.sizing import broadcast_if_small
from editpulse.sources.working import working_table

MAX_LABELLED = 4_000  # labelled rows the classifier is fitted on
REJECT_BELOW = 0.5
SITE_WEIGHT = 0.5  # share of the site's log odds that counts

# The character classes, in order; all other ASCII marks share class 0.
SINGLE = "\n\t .,;:!?|#$%&*@/<>{}()'\"-=_"
CLASSES = np.zeros(256, dtype=np.int64)
for _i, _mark in enumerate(SINGLE, start=1):
    CLASSES[ord(_mark)] = _i
CLASSES[65:91], CLASSES[97:123], CLASSES[48:58], CLASSES[128:] = (len(SINGLE) + i for i in range(1, 5))
N = len(SINGLE) + 5
FEATURES = N**3 + 1  # the last is the share of repeated words


def _trigrams(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram numbers at each position of a chunk, and the row of each; none crosses rows."""
    kinds = CLASSES[raw]
    rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    same = rows[2:] == rows[:-2]
    return (kinds[:-2] * (N * N) + kinds[1:-1] * N + kinds[2:])[same], rows[2:][same]


def _repeats(offsets: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """How many trigrams each row's words that equal the one before count as: in proportion to the
    bytes they take."""
    if len(offsets) == 2:
        again, words, last = 0, 0, None
        for hashes in streamed_word_hashes(cut(raw)):
            if len(hashes):
                again += int((hashes[1:] == hashes[:-1]).sum()) + int(last == hashes[0])
                words, last = words + len(hashes), hashes[-1]
        share = np.array([again / max(words, 1)])
    else:
        hashes, first = word_hashes(offsets, raw)
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        again = np.bincount(row[1:][(hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])], minlength=len(first) - 1)
        share = again / np.maximum(np.diff(first), 1)
    return np.rint(share * np.diff(offsets)).astype(np.int64)


def _pieces(offsets: np.ndarray, raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``_trigrams`` of a chunk; a single row, which may be long, in pieces that share two bytes."""
    if len(offsets) > 2:
        yield _trigrams(offsets, raw)
    else:
        for at in range(0, len(raw), CHUNK_BYTES):
            part = raw[at : at + CHUNK_BYTES + 2]
            yield _trigrams(np.array([0, len(part)]), part)


def _shares(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, number, share) of each feature that a row of a chunk has, by row and number."""
    n = len(offsets) - 1
    extra = _repeats(offsets, raw)
    if n == 1:
        counts = np.zeros(FEATURES, dtype=np.int64)
        for grams, _ in _pieces(offsets, raw):
            counts += np.bincount(grams, minlength=FEATURES)
        counts[N**3] = extra[0]
        numbers = np.flatnonzero(counts)
        return np.zeros(len(numbers), np.int64), numbers, counts[numbers] / max(counts.sum(), 1)
    grams, owner = _trigrams(offsets, raw)
    repeated = np.flatnonzero(extra)
    keys, counts = np.unique(owner * np.int64(FEATURES) + grams, return_counts=True)
    keys, counts = np.append(keys, repeated * FEATURES + N**3), np.append(counts, extra[repeated])
    order = np.argsort(keys)
    rows, numbers = np.divmod(keys[order], FEATURES)
    sizes = np.bincount(rows, counts[order], minlength=n)
    return rows, numbers, counts[order] / sizes[rows]


def _histograms(rows: DataFrame) -> DataFrame:
    """Non-zero trigram shares of labelled texts as (number, share) bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, raw in text_chunks(batch.column(1)):
                n = len(offsets) - 1
                rows_of, numbers, shares = _shares(offsets, raw)
                numbers, shares = numbers.astype("<i4"), shares.astype("<f4")
                cuts = np.searchsorted(rows_of, np.arange(n + 1))
                packed = [numbers[a:b].tobytes() + shares[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, n), pa.array(packed, pa.binary())], ["label", "packed"])

    return rows.mapInArrow(run, "label int, packed binary")


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, steps: int = 400) -> np.ndarray | None:
    """Weights per trigram and the intercept. ``labels`` has ``doc_id, quality``."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    chosen = lowest_by_hash(known, max_labelled)
    rows = docs.select("doc_id", "text").join(broadcast_if_small(chosen), "doc_id").select("label", "text")
    sample = _histograms(rows).collect()
    y = np.array([r.label for r in sample], dtype=np.float32)
    if not len(y) or y.min() == y.max():
        return None
    numbers = [np.frombuffer(r.packed[: len(r.packed) // 2], "<i4") for r in sample]
    used = np.unique(np.concatenate(numbers)) if numbers else np.zeros(0, int)
    x = np.zeros((len(y), len(used) + 1), dtype=np.float32)
    for i, (r, own) in enumerate(zip(sample, numbers, strict=True)):
        x[i, np.searchsorted(used, own)] = np.frombuffer(r.packed[len(r.packed) // 2 :], "<f4") * 10
    x[:, -1] = 1
    w, pace, mean = np.zeros(x.shape[1], np.float32), np.zeros(x.shape[1], np.float32), np.float32(0.9)
    bound = np.float32(np.linalg.norm(x, axis=1).max() ** 2 / 4)
    for _ in range(steps):  # accelerated gradient steps with a small ridge
        p = 1 / (1 + np.exp(-x @ (w + mean * pace)))
        slope = x.T @ (p - y) / len(y) + 1e-5 * w
        pace = mean * pace - slope / bound
        w = w + pace
    weights = np.zeros(FEATURES + 1)
    weights[used], weights[-1] = w[:-1] * 10, w[-1]
    return weights


def classify(docs: DataFrame, weights: np.ndarray, text_col: str = "text", out: str = "_ll_logit") -> DataFrame:
    """``docs`` with the classifier's log odds of good quality; null where a text has no trigram."""

    def logits(column: pa.Array) -> np.ndarray:
        found = []
        for _, offsets, raw in text_chunks(column):
            n = len(offsets) - 1
            sizes = _repeats(offsets, raw)
            sums = sizes * weights[N**3]
            for grams, owner in _pieces(offsets, raw):
                sizes = sizes + np.bincount(owner, minlength=n)
                sums += np.bincount(owner, weights[grams], minlength=n)
            found.append(np.where(sizes > 0, sums / np.maximum(sizes, 1) + weights[-1], np.nan))
        return np.concatenate(found) if found else np.zeros(0)

    @F.arrow_udf("double")
    def logit(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            values = logits(column)
            yield pa.array(values, mask=np.isnan(values))

    return docs.withColumn(out, logit(F.col(text_col)))


def _level(stats: DataFrame, parent: Column, within: float) -> Column:
    """Shrunk mean of each group of ``n`` documents with mean ``m``; ``parent`` is its prior mean."""
    between = stats.agg(
        (F.sum(F.col("n") * (F.col("m") - parent) ** 2) / F.sum("n")).alias("spread"),
        (F.count("*") / F.sum("n")).alias("noise"),
    ).first()
    signal = max((between.spread or 0.0) - within * (between.noise or 0.0), 1e-6)
    pseudo = within / signal
    return (F.col("n") * F.col("m") + pseudo * parent) / (F.col("n") + pseudo)


def site_posteriors(scored: DataFrame, host: str, path: str) -> tuple[DataFrame, float]:
    """``host, path, site`` (posterior mean of each path) and the corpus mean.

    Sums are combined on the map side; hosts are summed from paths. Three scalars per level reach
    the driver.
    """
    p = 1 / (1 + F.exp(-F.col("_ll_logit")))
    paths = scored.where(F.col("_ll_logit").isNotNull()).groupBy(F.col(host).alias("_ll_host"), F.col(path).alias("_ll_path")).agg(
        F.count("*").alias("n"), F.sum(p).alias("s"), F.sum(p * p).alias("ss")
    )
    paths = working_table(paths, "quality-sites")
    total = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).first()
    mean = total.s / total.n if total.n else 0.5
    within = max(total.ss / total.n - mean * mean, 1e-6) if total.n else 1.0
    hosts = paths.groupBy("_ll_host").agg(F.sum("n").alias("n"), (F.sum("s") / F.sum("n")).alias("m"))
    hosts = hosts.select(F.col("_ll_host").alias("host"), _level(hosts, F.lit(mean), within).alias("prior"))
    both = paths.join(hosts, F.col("_ll_host").eqNullSafe(F.col("host")))
    both = both.select("_ll_host", "_ll_path", "n", (F.col("s") / F.col("n")).alias("m"), "prior")
    return both.select("_ll_host", "_ll_path", _level(both, F.col("prior"), within).alias("_ll_site")), mean


def _log_odds(p: Column) -> Column:
    safe = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(safe / (1 - safe))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    host: str = "source",
    path: str = "lang",
    max_labelled: int = MAX_LABELLED,
    reject_below: float = REJECT_BELOW,
    columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` of ``docs`` (default: all) with ``_ll_quality`` (posterior) and ``_ll_keep``.

    Each text is classified once; the rows are written with their log odds and read again for the
    site sums and the result.
    """
    columns = columns or docs.columns
    weights = train(docs, labels, max_labelled)
    if weights is None:
        return docs.select(*columns).withColumns({"_ll_quality": F.lit(0.5), "_ll_keep": F.lit(True)})
    written = list(dict.fromkeys([*columns, host, path]))
    scored = working_table(classify(docs, weights).select(*written, "_ll_logit"), "quality-scores")
    sites, mean = site_posteriors(scored, host, path)
    sites = broadcast_if_small(sites)
    joined = scored.join(
        sites, scored[host].eqNullSafe(sites["_ll_host"]) & scored[path].eqNullSafe(sites["_ll_path"]), "left"
    )
    base = float(np.log(max(mean, 1e-6) / max(1 - mean, 1e-6)))
    shift = SITE_WEIGHT * (_log_odds(F.coalesce("_ll_site", F.lit(mean))) - F.lit(base))
    odds = F.coalesce("_ll_logit", F.lit(base)) + shift
    quality = 1 / (1 + F.exp(-odds))
    return joined.select(*[scored[c] for c in columns], quality.alias("_ll_quality")).withColumn(
        "_ll_keep", F.col("_ll_quality") >= reject_below
    )


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier does not reject."""
    scored = score_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return scored.where("_ll_keep").select(*docs.columns)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = score_quality(docs, labels, columns=["doc_id"])
    return scored.select("doc_id", F.col("_ll_quality").alias("quality"), F.col("_ll_keep").alias("kept"))
