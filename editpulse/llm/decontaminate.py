"""Benchmark decontamination by a positional inverted index (operator 9); DataFrame functions only.

The index holds the postings (term, document, position) of every training word that is also a
benchmark word, written once to the shared folder. For each benchmark window the postings of its
terms, rarest in the corpus first, are intersected after subtracting the term's offset: the two
rarest lists meet in a join on (window, document, start); what is left must hold a posting at each
further offset, which is tested on the document's own words.

Proximity matches come from the same postings: a window of n words lies near ``start`` if at least
n - 1 of its words (all, if n is under five) stand at most ``SLACK`` positions from their places
``start + offset``, so that a word inserted, dropped or changed does not hide a passage. At most one
word may be missing, so all but one of the three rarest terms meet at a start within the slack; what
is left is tested on the document's own words. Exact matches are proximity matches too. The contract
columns and the pipeline stage go by exact matches.

Words are runs of digits, letters and all bytes beyond ASCII, A-Z lower-cased. A window is ten
consecutive item words; an item of fewer is one window.

Defined cases: null or empty texts have no words and no hits; items without words match nothing;
equal windows of several items are matched once and credited to each; rows with equal id and text are
one document, equal id with other text another; an empty table of either kind gives no matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.columns import ascii_lower, table
from editpulse.operators.sizing import broadcast_if_small
from editpulse.sources.working import working_table

WINDOW = 10
SLACK = 2
# Everything in ASCII that is neither a digit nor a letter ends a word.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words in order; no words for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAKS), "")


def benchmark_windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """Distinct windows: ``window`` (its words) with ``item_ids``."""
    split = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
    split = split.where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - width + 1, F.lit(1)))
    windows = split.withColumn("start", F.explode(starts)).select("item_id", F.slice("words", F.col("start"), F.lit(width)).alias("window"))
    return windows.groupBy("window").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))


def positional_index(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Postings ``term, doc, key, at`` of the vocabulary's terms, written to the shared folder.

    The vocabulary (``term, name``) is broadcast only if measured small; otherwise both sides are
    exchanged on the term and AQE splits frequent ones.
    """
    posted = docs.select("_ll_id", "_ll_hash", F.posexplode(words_of(F.col("_ll_text"))).alias("at", "name"))
    return working_table(
        posted.join(broadcast_if_small(vocabulary), "name").select("term", "_ll_id", "_ll_hash", "at"), "postings"
    )


def _terms(windows: DataFrame) -> DataFrame:
    return windows.select("window_id", F.posexplode("window").alias("offset", "name"))


def _by_rarity(index: DataFrame, windows: DataFrame, vocabulary: DataFrame) -> DataFrame:
    counts = index.groupBy("term").agg(F.count("*").alias("n"))
    lists = _terms(windows).join(vocabulary, "name").join(counts, "term", "left")
    order = F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("offset"), F.col("term"))
    return lists.groupBy("window_id").agg(F.array_sort(F.collect_list(order)).alias("by_rarity"))


def candidates(index: DataFrame, windows: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(window_id, document, start) at which the two rarest terms of a window stand at their offsets."""
    rarest = _by_rarity(index, windows, vocabulary)
    # the rarest term, and the next (or itself, in windows of one word)
    pick = rarest.select(
        "window_id",
        F.col("by_rarity")[0].alias("one"),
        F.element_at("by_rarity", F.least(F.lit(2), F.size("by_rarity"))).alias("two"),
    ).where(F.col("one.n") > 0)
    pick = working_table(pick, "rarest-terms")

    def starts(which: str) -> DataFrame:
        side = pick.select("window_id", F.col(f"{which}.term").alias("term"), F.col(f"{which}.offset").alias("offset"))
        return (
            index.join(broadcast_if_small(side), "term")
            .select("window_id", "_ll_id", "_ll_hash", (F.col("at") - F.col("offset")).alias("start"))
            .where(F.col("start") >= 0)
        )

    return starts("one"), starts("two")


def exact_matches(docs: DataFrame, windows: DataFrame, vocabulary: DataFrame, index: DataFrame) -> DataFrame:
    """Per document with any: ``_ll_hits`` (distinct hit positions) and ``_ll_windows`` (window ids).

    ``docs`` has ``_ll_id, _ll_hash, _ll_text``.
    """
    one, two = candidates(index, windows, vocabulary)
    on = (
        one["window_id"].eqNullSafe(two["window_id"]) & one["_ll_id"].eqNullSafe(two["_ll_id"])
        & one["_ll_hash"].eqNullSafe(two["_ll_hash"]) & one["start"].eqNullSafe(two["start"])
    )
    phrases = windows.select("window_id", F.array_join("window", " ").alias("phrase"), F.size("window").alias("n"))
    both = one.join(two, on, "left_semi").distinct().join(broadcast_if_small(phrases), "window_id")
    found = both.groupBy(F.col("_ll_id").alias("_ll_cid"), F.col("_ll_hash").alias("_ll_chash")).agg(
        F.collect_list(F.struct("window_id", "start", "phrase", "n")).alias("_ll_found")
    )
    found = broadcast_if_small(working_table(found, "candidates"))
    same = F.col("_ll_id").eqNullSafe(F.col("_ll_cid")) & (F.col("_ll_hash") == F.col("_ll_chash"))
    # the one-element array binds the words, so that they are split once per document
    tested = F.transform(
        F.array(words_of(F.col("_ll_text"))),
        lambda words: F.filter(
            "_ll_found", lambda c: F.array_join(F.slice(words, c["start"] + 1, c["n"]), " ") == c["phrase"]
        ),
    )[0]
    held = docs.join(found, same).select("_ll_id", "_ll_hash", tested.alias("_ll_found")).dropDuplicates(["_ll_id", "_ll_hash"])
    spans = F.transform("_ll_found", lambda c: F.sequence(c["start"], c["start"] + c["n"] - 1))
    return held.where(F.size("_ll_found") > 0).select(
        F.col("_ll_id").alias("_ll_mid"),
        F.col("_ll_hash").alias("_ll_mhash"),
        F.array_distinct(F.flatten(spans)).alias("_ll_hits"),
        F.array_distinct(F.transform("_ll_found", lambda c: c["window_id"])).alias("_ll_windows"),
    )


def near_matches(docs: DataFrame, windows: DataFrame, vocabulary: DataFrame, index: DataFrame, slack: int) -> DataFrame:
    """Like ``exact_matches`` for windows whose words stand within ``slack`` of their places."""
    missing = lambda n: F.when(n >= 5, 1).otherwise(0)
    rarest = _by_rarity(index, windows, vocabulary).withColumn("n", F.size("by_rarity"))
    least = F.least(F.col("n"), F.lit(3)) - missing(F.col("n"))
    picked = rarest.select("window_id", least.alias("least"), F.posexplode(F.slice("by_rarity", 1, 3)).alias("which", "t"))
    picked = working_table(picked.select("window_id", "least", "which", "t.term", "t.offset"), "near-terms")
    shifts = F.array(*[F.lit(d) for d in range(-slack, slack + 1)])
    starts = (
        index.join(broadcast_if_small(picked), "term")
        .select("window_id", "least", "which", "_ll_id", "_ll_hash", (F.col("at") - F.col("offset")).alias("at"), F.explode(shifts).alias("d"))
        .withColumn("start", F.col("at") + F.col("d"))
    )
    met = starts.groupBy("window_id", "_ll_id", "_ll_hash", "start").agg(
        F.bit_or(F.expr("shiftleft(1, which)")).alias("terms"), F.first("least").alias("least")
    )
    met = met.where(F.bit_count("terms") >= F.col("least")).select("window_id", "_ll_id", "_ll_hash", "start")
    both = met.join(broadcast_if_small(windows.select("window_id", "window")), "window_id")
    found = both.groupBy(F.col("_ll_id").alias("_ll_cid"), F.col("_ll_hash").alias("_ll_chash")).agg(
        F.collect_list(F.struct("window_id", "start", "window")).alias("_ll_found")
    )
    found = broadcast_if_small(working_table(found, "near-candidates"))
    same = F.col("_ll_id").eqNullSafe(F.col("_ll_cid")) & (F.col("_ll_hash") == F.col("_ll_chash"))

    def places(words: Column, c: Column) -> Column:
        """For each word of the window the places within the slack at which it stands."""
        return F.transform(
            c["window"],
            lambda w, o: F.filter(
                F.transform(shifts, lambda d: c["start"] + o + d), lambda at: F.coalesce(F.get(words, at) == w, F.lit(False))
            ),
        )

    tested = F.transform(
        F.array(words_of(F.col("_ll_text"))),
        lambda words: F.transform("_ll_found", lambda c: F.struct(c["window_id"].alias("window_id"), places(words, c).alias("places"))),
    )[0]
    whole = lambda c: F.size(F.filter(c["places"], lambda x: F.size(x) > 0)) >= F.size(c["places"]) - missing(F.size(c["places"]))
    held = docs.join(found, same).select("_ll_id", "_ll_hash", tested.alias("_ll_found")).dropDuplicates(["_ll_id", "_ll_hash"])
    held = held.withColumn("_ll_found", F.filter("_ll_found", whole))
    return held.where(F.size("_ll_found") > 0).select(
        F.col("_ll_id").alias("_ll_mid"),
        F.col("_ll_hash").alias("_ll_mhash"),
        F.array_distinct(F.flatten(F.flatten(F.transform("_ll_found", lambda c: c["places"])))).alias("_ll_hits"),
        F.array_distinct(F.transform("_ll_found", lambda c: c["window_id"])).alias("_ll_windows"),
    )


def prepared(items: DataFrame, width: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(windows with ids, vocabulary with term numbers), both written; they follow the benchmark's size."""
    windows = benchmark_windows(items, width)
    windows = windows.withColumn("window_id", F.xxhash64(F.array_join("window", " ")))
    windows = working_table(windows, "windows")
    names = windows.select(F.explode("window").alias("name")).distinct()
    return windows, working_table(names.withColumn("term", F.xxhash64("name")), "vocabulary")


def _with_credit(rows: DataFrame, matches: DataFrame, windows: DataFrame, n: str, items: str) -> DataFrame:
    """``rows`` with the number of hit words ``n`` and the sorted item ids ``items`` of ``matches``."""
    matches = working_table(matches, "matches")
    credited = (
        matches.select("_ll_mid", "_ll_mhash", F.explode("_ll_windows").alias("window_id"))
        .join(broadcast_if_small(windows.select("window_id", F.explode("item_ids").alias("item_id"))), "window_id")
        .groupBy(F.col("_ll_mid").alias("_ll_iid"), F.col("_ll_mhash").alias("_ll_ihash"))
        .agg(F.array_sort(F.collect_set("item_id")).alias(items))
    )
    hits = matches.select("_ll_mid", "_ll_mhash", F.size("_ll_hits").cast("long").alias(n)).join(
        credited, F.col("_ll_mid").eqNullSafe(F.col("_ll_iid")) & (F.col("_ll_mhash") == F.col("_ll_ihash"))
    )
    hits = broadcast_if_small(working_table(hits.select("_ll_mid", "_ll_mhash", n, items), "hits"))
    joined = rows.join(hits, F.col("_ll_id").eqNullSafe(F.col("_ll_mid")) & F.col("_ll_hash").eqNullSafe(F.col("_ll_mhash")), "left")
    return joined.select(
        *rows.columns,
        F.coalesce(n, F.lit(0).cast("long")).alias(n),
        F.coalesce(items, F.array().cast("array<string>")).alias(items),
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW, slack: int | None = SLACK
) -> DataFrame:
    """``docs`` with ``_ll_n_hit`` (hit words), ``_ll_items`` (sorted ids of occurring items) and, unless
    ``slack`` is None, ``_ll_n_near`` and ``_ll_near_items``, the same for proximity matches."""
    windows, vocabulary = prepared(items, width)
    rows = docs.withColumns({"_ll_id": F.col(id_col), "_ll_hash": F.xxhash64(text_col)})
    slim = rows.select("_ll_id", "_ll_hash", F.col(text_col).alias("_ll_text"))
    index = positional_index(slim, vocabulary)
    out = _with_credit(rows, exact_matches(slim, windows, vocabulary, index), windows, "_ll_n_hit", "_ll_items")
    if slack is not None:
        out = _with_credit(out, near_matches(slim, windows, vocabulary, index, slack), windows, "_ll_n_near", "_ll_near_items")
    return out.drop("_ll_id", "_ll_hash")


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without any benchmark window."""
    marked = decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), slack=None)
    return marked.where(F.col("_ll_n_hit") == 0).select(*docs.columns)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), slack=None)
    return marked.select(
        "doc_id",
        F.size(words_of(F.col("text"))).cast("long").alias("n_words"),
        F.col("_ll_n_hit").alias("n_hit"),
        F.size("_ll_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_ll_items", ","), 256).alias("items_sha256"),
        (F.col("_ll_n_hit") > 0).alias("contaminated"),
    )


def op9_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return marked.select(
        "doc_id",
        F.col("_ll_n_hit").alias("n_hit"),
        F.size("_ll_items").cast("long").alias("n_items"),
        F.col("_ll_n_near").alias("n_near"),
        F.size("_ll_near_items").cast("long").alias("n_near_items"),
        F.sha2(F.array_join("_ll_near_items", ","), 256).alias("near_items_sha256"),
    )


_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SQL_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def decontamination_sql(source: str = "documents") -> str:
    """CTEs ``hit`` (doc_id, n_hit) and ``leaks`` (doc_id, items) over ``source``."""
    return rf"""
dw AS (SELECT doc_id, {_SQL_WORDS} AS w FROM {source}),
iw AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
win AS (
  SELECT item_id, least({WINDOW}, len(w)) AS size,
    array_to_string(w[s : s + {WINDOW} - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS s FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
dwin AS (
  SELECT doc_id, size, s, array_to_string(w[s : s + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM dw, sizes WHERE len(w) >= size)),
occ AS (
  SELECT doc_id, item_id, s, dwin.size FROM dwin JOIN win ON dwin.size = win.size AND dwin.phrase = win.phrase),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM occ) GROUP BY doc_id),
leaks AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM occ) GROUP BY doc_id)"""


OP9_SQL = f"""
WITH {decontamination_sql()}
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN leaks USING (doc_id)
"""
