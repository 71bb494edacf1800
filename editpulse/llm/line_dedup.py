"""Line dedup by overlapping three-line windows (operator 1); DataFrame functions only.

Lines are what stands between line feeds. Windows run over the lines of a document that are not
blank (only white space); two windows are equal if their three lines are, compared by two 64-bit
hashes. The first occurrence of a window is the one with the smallest (doc_id, position); every
line covered by a later occurrence is removed, in whichever document it is. Windows are judged on
the input, so a line may be removed because of one window although it belongs to the first
occurrence of another.

Defined cases: null stays null; blank lines, and texts with fewer than three other lines, are never
touched; a fully covered text becomes what is left of its blank lines or empty, its row stays; rows
with equal id and text are one document and are treated alike, rows with equal id and other texts are
ordered by text hash; null ids come first; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.columns import table

WINDOW = 3
ROW = ("_ll_id", "_ll_hash")


def _windows(rows: DataFrame) -> DataFrame:
    """One row per window: document, its three line positions and two hashes."""
    line = F.transform(
        "_ll_lines",
        lambda text, at: F.when(
            F.trim(text, F.lit(" \t\r\f\u000b")) != "",
            F.struct(at.alias("at"), F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(1)).alias("b")),
        ),
    )
    rest = lambda n: F.slice("_ll_solid", n + 1, F.greatest(F.size("_ll_solid") - n, F.lit(0)))
    return (
        rows.where(F.size("_ll_lines") >= WINDOW)
        .select(*ROW, F.array_compact(line).alias("_ll_solid"))
        .where(F.size("_ll_solid") >= WINDOW)
        .select(*ROW, F.inline(F.arrays_zip(F.col("_ll_solid").alias("x"), rest(1).alias("y"), rest(2).alias("z"))))
        .where(F.col("z").isNotNull())
        .select(
            *ROW,
            F.array("x.at", "y.at", "z.at").alias("lines"),
            F.xxhash64("x.a", "y.a", "z.a").alias("h1"),
            F.xxhash64("x.b", "y.b", "z.b").alias("h2"),
        )
    )


def covered_lines(rows: DataFrame) -> DataFrame:
    """Positions to remove per document: the merged lines of all later window occurrences.

    First occurrences are a map-side-combined minimum per window. Occurrences of a window that a
    third of all rows hold are one key of a plain join, which AQE splits.
    """
    windows = _windows(rows)
    place = F.struct(*ROW, "lines")
    repeated = (
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
    )
    later = windows.join(repeated, ["h1", "h2"]).where(place > F.col("first"))
    return later.groupBy(*ROW).agg(F.array_distinct(F.flatten(F.collect_set("lines"))).alias("_ll_gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with deduplicated text and ``_ll_lines_in``, ``_ll_lines_out``."""
    rows = docs.withColumns({
        "_ll_id": F.col(id_col),
        "_ll_hash": F.xxhash64(text_col),
        "_ll_lines": F.split(text_col, "\n"),
    }).drop(text_col)
    gone = covered_lines(rows.select(*ROW, "_ll_lines")).select(
        F.col("_ll_id").alias("_ll_gid"), F.col("_ll_hash").alias("_ll_ghash"), "_ll_gone"
    )
    joined = rows.join(
        gone, F.col("_ll_id").eqNullSafe(F.col("_ll_gid")) & (F.col("_ll_hash") == F.col("_ll_ghash")), "left"
    )
    size = F.size("_ll_lines")
    kept = F.array_sort(F.array_except(F.sequence(F.lit(0), size - 1), F.coalesce("_ll_gone", F.array().cast("array<int>"))))
    left = F.when(F.col("_ll_gone").isNull(), F.array_join("_ll_lines", "\n")).otherwise(
        F.array_join(F.transform(kept, lambda at: F.col("_ll_lines")[at]), "\n")
    )
    result = joined.withColumns({
        "_ll_text": left,
        "_ll_lines_in": F.coalesce(size, F.lit(0)).cast("long"),
        "_ll_lines_out": F.coalesce(size - F.coalesce(F.size("_ll_gone"), F.lit(0)), F.lit(0)).cast("long"),
    })
    keep: list[Column] = [F.col("_ll_text").alias(c) if c == text_col else F.col(c) for c in docs.columns]
    return result.select(*keep, "_ll_lines_in", "_ll_lines_out")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, with repeated passages of lines taken out and lengths renewed."""
    left = dedup_lines(docs)
    columns = [F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return left.select(*columns)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select(
        "doc_id", "text",
        F.col("_ll_lines_in").alias("n_lines"),
        (F.col("_ll_lines_in") - F.col("_ll_lines_out")).alias("n_removed"),
    )


def line_dedup_sql(source: str = "documents") -> str:
    """CTEs ``gone`` (doc_id, pos) and ``lines`` (doc_id, pos, line) over ``source``."""
    return f"""
lines AS (
  SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM {source} WHERE text IS NOT NULL)),
windows AS (
  SELECT doc_id, pos, lead(pos, 1) OVER w AS pos2, lead(pos, 2) OVER w AS pos3,
    line AS l1, lead(line, 1) OVER w AS l2, lead(line, 2) OVER w AS l3
  FROM lines WHERE trim(line, chr(32) || chr(9) || chr(13) || chr(12) || chr(11)) <> ''
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
later AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id, pos) AS k
    FROM windows WHERE pos3 IS NOT NULL) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest([pos, pos2, pos3]) AS pos FROM later)"""


OP1_SQL = f"""
WITH {line_dedup_sql()},
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n
  FROM lines ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines,
  (coalesce(len(string_split(d.text, chr(10))), 0) - coalesce(k.n, 0))::BIGINT AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
