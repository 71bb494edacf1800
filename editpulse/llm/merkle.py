"""Merkle manifest of a dataset by nested-interval labels (operator 12).

Every row is a leaf, the hash of its fields. Leaves of a group (a source) are ranked by key; a node
covers an interval of leaf ranks, ``[lo, hi)``, and holds the hash of its run of at most ``FANOUT``
children. Group roots, ranked by group, are the leaves of one more tree of the same kind.

Levels are built upwards, each a written table of one row per node with the labels of its children.
Going down, a node is joined with its ancestor at the next level through the bucket its interval lies
in (``lo`` divided by the level's width) and the test that the ancestor's interval contains its own.
The ancestor's run without the node's own interval gives the siblings: what ends before ``lo`` is to
the left, what begins at ``hi`` or later to the right. A node passes its whole path to its children,
so what is shuffled is one path per run of leaves, and no level holds more than a sixteenth of the
rows of the one below it. Ranks come from a range sort with per-partition offsets, so a group that
holds a third of all rows is spread over many tasks.

Defined cases: a null field is ``-``, an empty text ``0:``; the null group comes first and null keys
come before all others; rows with equal keys go by their leaf, and fully equal rows have a place
each; a null key is never tampered with; a lone leaf is its group's root and a lone group's root the
dataset's; an empty table gives no rows; columns that are no fields do not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse.llm.columns import ascii_lower, table
from editpulse.operators.positions import with_positions
from editpulse.sources.working import working_table

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "struct<left:string,right:string>"


def leaf_digest(fields: list[Column]) -> Column:
    """Hash of the fields, each as UTF-8 byte count, colon and value, or ``-`` if null."""
    spelled = []
    for field in fields:
        value = field.cast("string")
        size = F.octet_length(value).cast("string")
        spelled.append(F.coalesce(F.concat(size, F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*spelled), 256)


def _joined(run: Column) -> Column:
    return F.array_join(F.transform(run, lambda c: c["digest"]), "")


def tree_levels(items: DataFrame, largest: int, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels 1 and up of every group's tree; ``items`` has ``grp, n, lo, hi, digest, carried``.

    A level has ``grp, n, lo, hi, digest`` and ``run``, the children in order of ``lo``. ``largest``
    is the size of the largest group; groups that are down to one node leave.
    """
    levels, width, below = [], 1, items
    while width < largest:
        wide = width * fanout
        bucket = F.floor(F.col("lo") / F.lit(wide)).cast("long")
        child = F.struct(*[c for c in ("lo", "hi", "digest", "carried") if c in below.columns])
        runs = (
            below.where(F.col("n") > width)
            .groupBy("grp", "n", bucket.alias("bucket"))
            .agg(F.array_sort(F.collect_list(child)).alias("run"))
        )
        lo = F.col("bucket") * wide
        nodes = runs.select(
            "grp", "n", lo.alias("lo"), F.least(F.col("n"), lo + wide).alias("hi"),
            F.sha2(_joined(F.col("run")), 256).alias("digest"), "run",
        )
        levels.append(working_table(nodes, "level"))
        below, width = levels[-1].drop("run"), wide
    return levels


def tree_roots(items: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``grp, digest`` of the one node of each group that covers all its leaves."""
    tops = [nodes.where(F.col("hi") - F.col("lo") == F.col("n")) for nodes in (items, *levels)]
    return reduce(DataFrame.unionByName, [t.select("grp", "digest") for t in tops])


def leaf_paths(items: DataFrame, levels: list[DataFrame], above: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``grp, lo, digest, carried, path, top`` per leaf; ``above`` has ``grp, path, top`` of group roots.

    ``path`` lists, from the leaf upwards, the concatenated siblings to the left and right.
    """
    def of_group(nodes: DataFrame) -> DataFrame:
        return nodes.join(above, "grp")

    down = None
    for at in range(len(levels), 0, -1):
        nodes, width = levels[at - 1], fanout**at
        whole = F.col("hi") - F.col("lo") == F.col("n")
        reached = of_group(nodes.where(whole)).select("grp", "n", "run", "path", "top")
        if down is not None:
            inner = nodes.where(~whole).withColumn("bucket", F.floor(F.col("lo") / width).cast("long"))
            parts = down.select(
                F.col("grp").alias("_grp"), F.floor(F.col("lo") / width).cast("long").alias("_bucket"),
                F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "path", "top",
            )
            contained = (F.col("lo") <= F.col("_lo")) & (F.col("_hi") <= F.col("hi"))
            joined = inner.join(parts, (F.col("grp") == F.col("_grp")) & (F.col("bucket") == F.col("_bucket")) & contained)
            reached = reached.unionByName(joined.select("grp", "n", "run", "path", "top"))
        down = reached.withColumn("c", F.explode("run"))
        own = F.col("c")
        step = F.struct(
            _joined(F.filter("run", lambda c: c["hi"] <= own["lo"])).alias("left"),
            _joined(F.filter("run", lambda c: c["lo"] >= own["hi"])).alias("right"),
        )
        down = down.select(
            "grp", "n", F.col("c.lo").alias("lo"), F.col("c.hi").alias("hi"), F.col("c.digest").alias("digest"),
            *([F.col("c.carried").alias("carried")] if at == 1 else []),
            F.concat(F.array(step), F.col("path")).alias("path"), "top",
        )
    columns = ["grp", "lo", "digest", "carried", "path", "top"]
    lone = of_group(items.where(F.col("n") == 1)).select(*columns)
    return lone if down is None else down.select(*columns).unionByName(lone)


def folded(path: Column, start: Column) -> Column:
    """The root that ``start`` leads to along ``path``."""
    return F.aggregate(path, start, lambda node, p: F.sha2(F.concat(p["left"], node, p["right"]), 256))


def manifest(rows: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``grp, lo, digest, carried, path, top, root`` per row of ``rows``: its place, path and roots.

    ``rows`` has ``grp`` (any type), ``key``, ``digest``, ``carried`` (a struct that goes along) and
    ``tie``, unique per row; it should be a written table, as it is read more than once.
    """
    order = [F.col("key").asc_nulls_first(), F.col("digest"), F.col("tie")]
    ranked = with_positions(rows, order, ("grp",), "lo").withColumnRenamed("grp", "name")
    sizes = rows.groupBy(F.col("grp").alias("_name")).agg(F.count("*").alias("n"))
    groups = working_table(with_positions(sizes, [F.col("_name").asc_nulls_first()], name="grp"), "groups")
    total, largest = groups.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()

    named = ranked.join(groups, F.col("name").eqNullSafe(F.col("_name")))
    items = working_table(named.select("grp", "n", "lo", (F.col("lo") + 1).alias("hi"), "digest", "carried"), "leaves")
    levels = tree_levels(items, largest, fanout)

    roots = working_table(tree_roots(items, levels), "roots")
    upper = roots.select(
        F.lit(0).cast("long").alias("grp"), F.lit(total).cast("long").alias("n"), F.col("grp").alias("lo"),
        (F.col("grp") + 1).alias("hi"), "digest", F.struct("grp").alias("carried"),
    )
    upper_levels = tree_levels(upper, total, fanout)
    last = tree_roots(upper, upper_levels).first()
    root = last["digest"] if last else None
    start = rows.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("grp"), F.expr(f"CAST(array() AS array<{_STEP}>)").alias("path"), F.lit(root).alias("top")
    )
    above = leaf_paths(upper, upper_levels, start, fanout).select(
        F.col("carried.grp").alias("grp"), "path", F.col("digest").alias("top")
    )
    return leaf_paths(items, levels, working_table(above, "above"), fanout).withColumn("root", F.lit(root))


def with_leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Leaves of documents, and of their tampered texts where one in five is lower-cased."""
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lowered = [ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in fields]
    kept = docs.select(
        F.col("source").alias("grp"), F.col("doc_id").alias("key"),
        leaf_digest([F.col(c) for c in fields]).alias("digest"),
        F.struct(F.col("doc_id"), F.when(changed, leaf_digest(lowered)).alias("tampered")).alias("carried"),
        F.monotonically_increasing_id().alias("tie"),
    )
    return working_table(kept, "hashed")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = manifest(with_leaves(table(spark, sf_dir, "documents")))
    siblings = F.flatten(F.transform("path", lambda p: F.array(p["left"], p["right"])))
    checked = rows.select(
        F.col("carried.doc_id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        F.col("top").alias("subroot"),
        "root",
        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        folded(F.col("path"), F.coalesce(F.col("carried.tampered"), F.col("digest"))).alias("folded_root"),
    )
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


def _field_sql(name: str, value: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value} END"


def _tree_sql(name: str, items: str, depth: int) -> str:
    """Common table expressions of a tree over ``items(g, i, m, d)``: nodes and runs of each level."""
    parts = [f"{name}_nodes0 AS ({items})"]
    for k in range(1, depth + 1):
        below = f"{name}_nodes{k - 1}"
        parts.append(
            f"{name}_runs{k} AS (SELECT g, i // {FANOUT} AS i, any_value(m) AS m, list(d ORDER BY i) AS run "
            f"FROM {below} WHERE m > 1 GROUP BY g, i // {FANOUT})"
        )
        parts.append(
            f"{name}_nodes{k} AS (SELECT g, i, (m + {FANOUT - 1}) // {FANOUT} AS m, sha256(array_to_string(run, '')) AS d "
            f"FROM {name}_runs{k} UNION ALL SELECT * FROM {below} WHERE m = 1)"
        )
    return ",\n".join(parts)


def _climb_sql(name: str, tree: str, source: str, group: str, place: str, depth: int) -> str:
    """Common table expressions that extend ``proof`` and ``fold`` of ``source`` level by level."""
    parts, last = [], source
    for k in range(1, depth + 1):
        at = f"({place} // {FANOUT ** (k - 1)}) % {FANOUT}"
        left = f"array_to_string(run[1:{at}], '')"
        right = f"array_to_string(run[{at} + 2:len(run)], '')"
        parts.append(
            f"{name}{k} AS (SELECT s.* EXCLUDE (proof, fold), "
            f"CASE WHEN run IS NULL THEN proof ELSE proof || {left} || {right} END AS proof, "
            f"CASE WHEN run IS NULL THEN fold ELSE sha256({left} || fold || {right}) END AS fold "
            f"FROM {last} s LEFT JOIN {tree}_runs{k} r ON r.g = {group} AND r.i = {place} // {FANOUT**k})"
        )
        last = f"{name}{k}"
    return ",\n".join(parts)


_DEPTH, _UPPER = 6, 4
_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP12_SQL = f"""
WITH crc AS (
  SELECT list(list_reduce([i] || range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END)
    ORDER BY i) AS t FROM range(256) r(i)),
hashed AS (
  SELECT doc_id, source, sha256({" || ".join(_field_sql(f, f) for f in FIELDS)}) AS leaf,
    sha256({" || ".join(_field_sql(f, _LOW if f == "text" else f) for f in FIELDS)}) AS low,
    xor(4294967295, list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
      lambda a, c: xor(a >> 8, t[(xor(a, c) & 255) + 1]))) AS crc
  FROM documents, crc),
leaves AS (
  SELECT doc_id, leaf, CASE WHEN crc % 5 = 0 THEN low ELSE leaf END AS fold, '' AS proof,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS lo,
    count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp FROM hashed),
{_tree_sql("low", "SELECT grp AS g, lo AS i, n AS m, leaf AS d FROM leaves", _DEPTH)},
{_tree_sql("top", f"SELECT 0 AS g, g AS i, count(*) OVER () AS m, d FROM low_nodes{_DEPTH}", _UPPER)},
{_climb_sql("a", "low", "leaves", "s.grp", "s.lo", _DEPTH)},
{_climb_sql("b", "top", f"a{_DEPTH}", "0", "s.grp", _UPPER)}
SELECT doc_id, leaf, low_nodes{_DEPTH}.d AS subroot, top_nodes{_UPPER}.d AS root, sha256(proof) AS proof_sha256,
  fold AS folded_root, fold = top_nodes{_UPPER}.d AS verified
FROM b{_UPPER} JOIN low_nodes{_DEPTH} ON low_nodes{_DEPTH}.g = grp, top_nodes{_UPPER}
"""
