"""Document fingerprints from closed syncmers (operator 4); DataFrame functions only.

A text is its sequence of units: words cut after each a, e, i, o, digit, sign and character beyond ASCII
(and after eight other letters), so that texts without white space have many units as well; ``K - 1``
end marks follow. Of all runs of ``K`` units those are chosen whose smallest inner run of ``S`` units,
by hash, is the first or the last one. Whether a run is chosen depends on nothing outside it, so a
passage has the same anchors in every document; any ``2 * K - S - 1`` units in a row hold one. The end
marks give a run to each unit of a text of any length, so one definition holds for all; a text with
units has an anchor, since its last run is always chosen. All steps are array functions over one row.
A print lists 24 bits of each anchor's hash, so it is shorter than its text; anchors of different runs
agree by chance once in 16.8 million pairs.

The edited text of the registered query needs the next document in descending id order. The distinct
(id, text hash) pairs alone are sorted by range and get dense positions; each text is brought to its
position by an equi-join and then to its cell of ``CELL`` positions, whatever the ids' spread. The first
text of a cell also goes to the cell before it, so a window inside each cell finds every neighbour.
Prints are made after that exchange and never travel.

Defined cases: null is empty; texts without units have an empty fingerprint, which is like another
empty one (1.0) and like nothing else (0.0); rows with equal id are ordered by text hash, null ids
come after all others in descending order; rows with equal id and text follow each other, so all but
one of them have themselves as the next text, and are worked out once however many they are; a single
document is its own next one; an empty table gives no rows. Ids may be of any sortable type.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from editpulse.llm.columns import id_and_text, table
from editpulse.operators.positions import with_positions
from editpulse.sources.working import working_table

K, S = 5, 2
PRINT_BITS = 24
CELL = 256
COPIES = 4096  # equal rows listed at a time
_LETTERS = "BCDFGHJKLMNPQRSTUVWXYZbcdfghjklmnpqrstuvwxyz"  # letters that do not end a unit
# Each character is looked at once: letters are never given back, and any character but white space may follow
# them, an eighth letter or the end of the unit. Classes without ranges are table lookups.
_SOLID = r"[^\x09\x0A\x0B\x0C\x0D\x20]"
UNITS = rf"[{_LETTERS}]{{1,7}}+{_SOLID}?+|{_SOLID}"
_KEY = ["_ll_none", "_ll_id", "hash"]
_P = "_ll_"


def _runs(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with ``out``: for each unit the 31-bit hash of the run that starts there, null if it is
    not chosen."""
    units, hashes, inner = _P + "units", _P + "hashes", _P + "inner"
    found = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(UNITS), F.lit(0))
    df = df.withColumn(units, F.transform(found, lambda unit: F.xxhash64(unit)))
    marks = F.array_repeat(F.xxhash64(F.lit("")), K - 1)
    df = df.withColumn(hashes, F.when(F.size(units) > 0, F.concat(units, marks)).otherwise(F.col(units)))
    df = df.withColumn(
        inner, F.transform(hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + j) for j in range(1, S)]))
    )

    def chosen(first: Column, i: Column) -> Column:
        last, *between = [F.get(inner, i + j) for j in (K - S, *range(1, K - S))]
        lower = lambda edge: reduce(Column.__and__, [edge <= one for one in between])
        run = F.xxhash64(*[F.get(hashes, i + j) for j in range(K)])
        return F.when(lower(first) | lower(last), run.bitwiseAND(F.lit((1 << 31) - 1)).cast("int"))

    return df.withColumn(out, F.transform(F.slice(inner, F.lit(1), F.size(units)), chosen)).drop(units, hashes, inner)


def with_anchors(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with ``out``: the anchors of ``text_col`` in text order, as (unit position, 31-bit hash)."""
    anchor = lambda h, at: F.when(h.isNotNull(), F.struct(at.alias("at"), h.alias("hash")))
    runs = _runs(df, text_col, _P + "runs")
    return runs.withColumn(out, F.array_compact(F.transform(_P + "runs", anchor))).drop(_P + "runs")


def with_print(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with ``out``: the hashes of the anchors of ``text_col`` in text order, ``PRINT_BITS`` of each."""
    short = lambda h: h.bitwiseAND(F.lit((1 << PRINT_BITS) - 1))
    return _runs(df, text_col, _P + "runs").withColumn(out, F.transform(F.array_compact(_P + "runs"), short)).drop(_P + "runs")


def likeness(one: str, other: str) -> Column:
    """Jaccard similarity of two hash lists."""
    union = F.size(F.array_union(one, other))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(one, other)) / union)


def shown(hashes: str) -> Column:
    """Hash list as text: the three bytes of each in text order, as Base64 (four characters each)."""
    return F.base64(F.unhex(F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h), PRINT_BITS // 4, "0")), "")))


def in_cells(docs: DataFrame, size: int = CELL) -> DataFrame:
    """Distinct rows of ``docs`` (doc_id, hash, text) with their number ``_ll_n``, in cells of ``size``
    places of the descending (doc_id, hash) order. The first of a cell is also, as a ghost, the last of
    the cell before it; the first of all is that of the last cell. One count reaches the driver."""
    kind = docs.schema["doc_id"].dataType
    keyed = docs.select(
        F.col("doc_id").isNull().alias(_KEY[0]), F.coalesce("doc_id", F.lit("0").cast(kind)).alias(_KEY[1]), "hash", "text"
    )
    order = [F.asc(_KEY[0]), F.desc(_KEY[1]), F.desc("hash")]
    places = working_table(with_positions(keyed.select(*_KEY).distinct(), order, name="_ll_place"), "places")
    last = max(places.count() - 1, 0) // size
    rows = keyed.groupBy(*_KEY).agg(F.first("text").alias("text"), F.count("*").alias("_ll_n"))
    cell = F.floor(F.col("_ll_place") / size).cast("long")
    own = F.struct(cell.alias("cell"), F.lit(0).alias("ghost"))
    before = F.when(cell == 0, F.lit(last).cast("long")).otherwise(cell - 1)
    sent = F.struct(before.alias("cell"), F.lit(1).alias("ghost"))
    to = F.when(F.col("_ll_place") % size == 0, F.array(own, sent)).otherwise(F.array(own))
    return rows.join(places, _KEY).withColumn("_ll_to", F.explode(to)).select(
        F.when(~F.col(_KEY[0]), F.col(_KEY[1])).alias("doc_id"), "hash", "text", "_ll_n", "_ll_place",
        F.col("_ll_to.cell").alias("_ll_cell"), F.col("_ll_to.ghost").alias("_ll_ghost"),
    )


def following(column: str) -> Column:
    """The column's value in the next row of ``in_cells``; null in ghosts."""
    return F.lead(column).over(W.partitionBy("_ll_cell").orderBy("_ll_ghost", "_ll_place"))


def own_rows(df: DataFrame, payload: list[str]) -> DataFrame:
    """Without ghosts, with ``copies``: one row that has the next one's payload and, of equal rows, one
    that stands for all others, whose next is equal to them."""
    once = F.struct(F.lit(1).cast("long").alias("copies"), *[F.col(f"next_{c}").alias(f"next_{c}") for c in payload])
    others = F.struct((F.col("_ll_n") - 1).alias("copies"), *[F.col(c).alias(f"next_{c}") for c in payload])
    both = F.when(F.col("_ll_n") > 1, F.array(once, others)).otherwise(F.array(once))
    rows = df.where("_ll_ghost = 0").withColumn("_ll_with", F.explode(both))
    internal = ["_ll_n", "_ll_place", "_ll_cell", "_ll_ghost", "_ll_with"]
    return rows.withColumns({c: F.col(f"_ll_with.{c}") for c in ["copies", *[f"next_{c}" for c in payload]]}).drop(*internal)


def repeated(df: DataFrame) -> DataFrame:
    """Each row ``copies`` times."""
    blocks = df.withColumn("_ll_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    each = F.array_repeat(F.lit(0), F.least(F.lit(COPIES), F.col("copies") - F.col("_ll_from")).cast("int"))
    return blocks.withColumn("_ll_each", F.explode(each)).drop("copies", "_ll_from", "_ll_each")


def with_next(docs: DataFrame, size: int = CELL) -> DataFrame:
    """``docs`` (doc_id, hash, text) with ``next_text``: the text of the next row in descending
    (doc_id, hash) order; the last row's next is the first."""
    return repeated(own_rows(in_cells(docs, size).withColumn("next_text", following("text")), ["text"]))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = id_and_text(table(spark, sf_dir, "documents")).select("doc_id", text.alias("text"), F.xxhash64(text).alias("hash"))
    placed = in_cells(docs).withColumn("next_text", following("text"))
    printed = with_print(placed, "text", "print").withColumn("next_print", following("print"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = own_rows(printed, ["text", "print"]).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    )
    both = with_print(edited, "edited", "edited_print")
    return repeated(
        both.select(
            "doc_id",
            n.cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            shown("print").alias("fingerprint"),
            shown("edited_print").alias("edited_fingerprint"),
            likeness("print", "edited_print").alias("near_edited"),
            likeness("print", "next_print").alias("near_next"),
            "copies",
        )
    )
