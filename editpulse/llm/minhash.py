"""Near-duplicate classes by circulant MinHash, banding and exact Jaccard (operator 2).

A document's set holds its distinct shingles of five lower-cased words, as 64-bit hashes. Two
permutations make all signature coordinates: the first spreads shingles over a universe of 2**20
places, the second gives each place its rank, circularly shifted by k for coordinate k; a shingle's
ranks under all shifts are one contiguous slice, so a signature is a running minimum of slices.

Documents with equal sets fold into one class first, so exact copies never meet in pairs. Class
representatives that share a band are linked if 100 * intersection >= 75 * union on the full sets.
Linking goes in rounds that stay linear in the size of a bucket: each member is compared with the
bucket's most central member (the one with the most entries in its buckets, as an original among its
edited copies), then with its smallest id. Members of buckets that still hold several components are
ordered rarest shingle first and joined on prefixes so long that each pair alike enough meets in its
first common shingle; the smaller set's prefix is the shorter one, so a passage that many texts share
brings none together that are not nearly alike. Links inside a component cannot change it, so pairs
within one are left out and none is lost that matters for the result.

Long texts are taken in pieces; only their sets are held whole.

``BANDS`` and ``ROWS`` miss a pair at exactly 0.75 with probability 8e-5 and at 0.8 with 5e-7.

Defined cases: null or empty texts and texts without words have an empty set, are linked with
nothing and kept; a null id has no component and is kept; rows with equal id are one node; an empty
table gives no rows; names of other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from editpulse.llm.batches import CHUNK_BYTES, cut, mixed, streamed_word_hashes, text_chunks, word_hashes
from editpulse.llm.columns import id_and_text, table
from editpulse.llm.components import connected_components
from editpulse.sources.working import working_table

SHINGLE = 5
BANDS, ROWS = 48, 6
UNIVERSE = 1 << 20
SEED = 20_240_229
_WEIGHTS = mixed(np.arange(101, 101 + SHINGLE, dtype=np.uint64)) | np.uint64(1)


def _runs(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of five words."""
    n = max(len(words) - SHINGLE + 1, 0)
    runs = np.zeros(n, dtype=np.uint64)
    for k in range(SHINGLE if n else 0):
        runs += mixed(words[k : k + n] + _WEIGHTS[k]) * _WEIGHTS[k]
    return runs


def _whole(words: np.ndarray) -> np.ndarray:
    """The set of a text of fewer words; their number keeps it apart from five-word runs."""
    n = len(words)
    return mixed(np.sum(mixed(words + _WEIGHTS[:n]) * _WEIGHTS[:n], keepdims=True) + np.uint64(n)) if n else words


def _long_set(raw: np.ndarray) -> np.ndarray:
    """The set of one long text, whose words are hashed in pieces."""
    held, tail = [], np.zeros(0, dtype=np.uint64)
    for words in streamed_word_hashes(cut(raw)):
        words = np.concatenate([tail, words])
        held.append(np.unique(_runs(words)))
        tail = words[len(words) - SHINGLE + 1 :] if len(words) >= SHINGLE else words
    found = np.unique(np.concatenate(held)) if held else tail
    return found if len(found) else _whole(tail)


def shingle_sets(offsets: np.ndarray, raw: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row of a chunk."""
    if len(offsets) == 2 and len(raw) > CHUNK_BYTES:
        return [_long_set(raw)]
    words, first = word_hashes(offsets, raw)
    runs = _runs(words)
    return [
        np.unique(runs[a : b - SHINGLE + 1]) if b - a >= SHINGLE else _whole(words[a:b])
        for a, b in zip(first[:-1], first[1:], strict=True)
    ]


class Signatures:
    """Band hashes of shingle sets under the circulant permutation."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = SEED):
        self.bands, self.rows = bands, rows
        ranks = np.random.default_rng(seed).permutation(UNIVERSE).astype(np.int32)
        n = bands * rows
        # slice at place p: ranks at p - n + 1 .. p around the circle, that is shifts n - 1 .. 0
        self.slices = np.lib.stride_tricks.sliding_window_view(np.concatenate([ranks[-(n - 1) :], ranks]), n)

    def coordinates(self, shingles: np.ndarray) -> np.ndarray:
        places = (mixed(shingles + np.uint64(SEED)) % np.uint64(UNIVERSE)).astype(np.int64)
        low = None
        for at in range(0, len(places), 512):
            part = self.slices[places[at : at + 512]].min(axis=0)
            low = part if low is None else np.minimum(low, part)
        return low

    def band_hashes(self, shingles: np.ndarray) -> np.ndarray:
        rows = self.coordinates(shingles).astype(np.uint64).reshape(self.bands, self.rows)
        total = np.arange(1, self.bands + 1, dtype=np.uint64)
        for k in range(self.rows):
            total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
        return total.view(np.int64)


def _keys(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set: two independent sums over its elements."""
    a = mixed(np.sum(mixed(shingles), keepdims=True) + np.uint64(len(shingles)))
    b = np.sum(mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return int(a.view(np.int64)[0]), int(b.view(np.int64))


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, k1, k2, bands``: set size, set key and band hashes of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures = Signatures(bands, rows)
        for batch in batches:
            for row, offsets, raw in text_chunks(batch.column(1)):
                sets = shingle_sets(offsets, raw)
                keys = [_keys(s) for s in sets]
                hashes = [signatures.band_hashes(s) if len(s) else np.zeros(0, np.int64) for s in sets]
                bounds = np.concatenate([[0], np.cumsum([len(h) for h in hashes])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([k[0] for k in keys], pa.int64()),
                        pa.array([k[1] for k in keys], pa.int64()),
                        pa.ListArray.from_arrays(bounds, np.concatenate(hashes)),
                    ],
                    ["doc_id", "n_shingles", "k1", "k2", "bands"],
                )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, shingles``: the whole sorted set as 64-bit little-endian bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, raw in text_chunks(batch.column(1)):
                sets = [s.tobytes() for s in shingle_sets(offsets, raw)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(sets)), pa.array(sets, pa.binary())], ["doc_id", "shingles"])

    return docs.mapInArrow(run, "doc_id long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                one, other = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                both = len(np.intersect1d(one, other, assume_unique=True))
                ok.append(100 * both >= percent * (len(one) + len(other) - both))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    other = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    joined = pairs.join(one, "a").join(other, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(run, "a long, b long")


def _fits(n: str, m: str, percent: int) -> Column:
    """Sizes that can reach the similarity at all."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _prefix_entries(sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """``shingle, id, component, n, at, short`` of the shingles in each member's prefix.

    A member's shingles are ordered by how many members hold them, rarest first; ``at`` is the place.
    The prefix is so long that it has the first common shingle with any set alike enough, ``short`` marks
    the part that suffices for sets that are not smaller. Shingles that no other member holds are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own = np.frombuffer(batch.column(2)[row].as_buffer(), dtype=np.int64)
                for at in range(0, len(own), 100_000):
                    part = own[at : at + 100_000]
                    same = [pa.repeat(batch.column(i)[row], len(part)) for i in range(2)]
                    yield pa.RecordBatch.from_arrays([*same, pa.repeat(pa.scalar(len(own), pa.int64()), len(part)), pa.array(part)], ["id", "component", "n", "shingle"])

    held = sets.join(members.select(F.col("id").alias("doc_id"), "component"), "doc_id").select("doc_id", "component", "shingles")
    listed = working_table(held.mapInArrow(run, "id long, component long, n long, shingle long"), "shingles")
    common = listed.groupBy("shingle").agg(F.count("*").alias("holders")).where("holders > 1")
    from_last = Window.partitionBy("id").orderBy(F.desc("holders"), F.desc("shingle"))
    placed = listed.join(common, "shingle").withColumn("at", F.col("n") - F.row_number().over(from_last))
    least = F.ceil(F.lit(percent) * F.col("n") / 100)  # of the intersection with any set, and with one not smaller
    least_short = F.ceil(2 * F.lit(percent) * F.col("n") / (100 + percent))
    return placed.where(F.col("at") <= F.col("n") - least).select(
        "shingle", "id", "component", "n", "at", (F.col("at") <= F.col("n") - least_short).alias("short")
    )


def prefix_pairs(sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of ``members`` (``id, component``) of different components; all that are
    alike enough are among them. Of each shingle's holders, those outside its largest component are
    compared with all."""
    entries = working_table(_prefix_entries(sets, members, percent), "prefixes")
    shares = entries.groupBy("shingle", "component").agg(F.count("*").alias("n"))
    largest = shares.groupBy("shingle").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("parts"))
    entries = entries.join(largest.where("parts > 1").drop("parts"), "shingle")
    names = ["id", "component", "n", "at"]
    few = F.col("component") != F.col("largest")
    x = lambda rows: rows.where("short").select("shingle", *[F.col(c).alias(f"{c}_x") for c in names])
    y = lambda rows: rows.select("shingle", *[F.col(c).alias(f"{c}_y") for c in names])
    left = F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y"))  # no intersection is larger
    alike = (
        (F.col("component_x") != F.col("component_y"))
        & (F.struct("n_x", "id_x") < F.struct("n_y", "id_y"))
        & ((100 + percent) * left >= percent * (F.col("n_x") + F.col("n_y")))
    )
    both = x(entries.where(few)).join(y(entries), "shingle").where(alike).select("id_x", "id_y")
    both = both.unionByName(x(entries.where(~few)).join(y(entries.where(few)), "shingle").where(alike).select("id_x", "id_y"))
    return _pairs(both.select(F.col("id_x").alias("a"), F.col("id_y").alias("b")))


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where(F.col("a") < F.col("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 75,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row; ``percent`` is 100 times the least
    similarity. Ids are whole numbers."""
    source = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    marked = working_table(sketches(source, bands, rows), "sketches")
    full = marked.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = working_table(
        full.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n")), "classes"
    )
    # band entries of the representatives, in buckets of two or more
    held = (
        full.join(classes, ["k1", "k2"]).where(F.col("doc_id") == F.col("rep"))
        .select(F.col("rep").alias("id"), "n", F.explode("bands").alias("bucket"))
    )
    sizes = held.groupBy("bucket").agg(F.countDistinct("id").alias("members"), F.min("id").alias("low")).where("members > 1")
    entries = working_table(held.distinct().join(sizes, "bucket"), "buckets")
    central = entries.groupBy("id").agg(F.sum("members").alias("degree"))
    hubs = entries.join(central, "id").groupBy("bucket").agg(F.max_by("id", F.struct("degree", "id")).alias("hub"))
    reps = entries.select(F.col("id").alias("doc_id")).distinct()
    sets = working_table(full_sets(source.join(reps, "doc_id", "left_semi").dropDuplicates(["doc_id"])), "sets")
    size = entries.select("id", "n").distinct()

    def sized(pairs: DataFrame) -> DataFrame:
        a = size.select(F.col("id").alias("a"), F.col("n").alias("na"))
        b = size.select(F.col("id").alias("b"), F.col("n").alias("nb"))
        return pairs.join(a, "a").join(b, "b").where(_fits("na", "nb", percent)).select("a", "b")

    tried = working_table(sized(_pairs(entries.join(hubs, "bucket").select(F.col("id").alias("a"), F.col("hub").alias("b")))), "tried")
    links = working_table(confirmed(tried, sets, percent), "links")
    found = working_table(connected_components(links), "components")
    with_component = lambda: entries.join(found, F.col("id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "id"))
    apart = with_component()
    # second round: against the smallest id, if still in another component
    second = apart.join(
        found.select(F.col("node").alias("_node"), F.col("component").alias("_component")), F.col("low") == F.col("_node"), "left"
    ).where(F.col("component") != F.coalesce("_component", "low"))
    more = working_table(sized(_pairs(second.select(F.col("id").alias("a"), F.col("low").alias("b")))).join(tried, ["a", "b"], "left_anti"), "tried")
    links = working_table(links.unionByName(confirmed(more, sets, percent)), "links")
    tried = tried.unionByName(more)
    found = working_table(connected_components(links), "components")
    # last round: members of buckets that hold several components, on their rarest shingles
    apart = working_table(with_component().select("bucket", "id", "component"), "apart")
    parts = apart.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
    members = apart.join(parts, "bucket").select("id", "component").distinct()
    rest = working_table(prefix_pairs(sets, members, percent).join(tried, ["a", "b"], "left_anti"), "tried")
    links = working_table(links.unionByName(confirmed(rest, sets, percent)), "links")
    found = working_table(connected_components(links), "components")
    of_class = classes.join(found, F.col("rep") == F.col("node"), "left").select(
        F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.coalesce("component", "rep").alias("component_id")
    )
    own = (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return marked.drop("bands").join(of_class, own, "left").select(
        "doc_id", "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        (F.coalesce("component_id", "doc_id").eqNullSafe(F.col("doc_id"))).alias("kept"),
    )


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the document with the smallest id of each class."""
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_ll_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_ll_gone"), "left_anti").select(*docs.columns)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def near_duplicates_sql(source: str = "documents") -> str:
    """CTEs ending in ``near`` (doc_id, n_shingles, component_id) over ``source``; links are found by
    shared shingles, components by a recursive walk."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS w FROM {source}),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[s : s + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM w WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
class AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY k, n) AS rep
  FROM (SELECT doc_id, count(*) AS n, string_agg(g, chr(10) ORDER BY g) AS k FROM sh GROUP BY doc_id)),
rs AS (SELECT sh.* FROM sh JOIN class USING (doc_id) WHERE class.doc_id = rep),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM rs a JOIN rs b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * common >= 75 * (x.n + y.n - common)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
walk AS (
  SELECT DISTINCT a AS node, a AS seen FROM edge
  UNION SELECT walk.node, edge.b FROM walk JOIN edge ON walk.seen = edge.a),
root AS (SELECT node, min(seen) AS low FROM walk GROUP BY node),
near AS (
  SELECT {source}.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(low, rep, {source}.doc_id) AS component_id
  FROM {source} LEFT JOIN class ON class.doc_id = {source}.doc_id LEFT JOIN root ON root.node = class.rep)"""


OP2_SQL = f"""
WITH RECURSIVE {near_duplicates_sql()}
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM near
"""
