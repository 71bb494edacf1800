"""Adapters that give the order/line-item/event tables the shape of map-editing data.

Coordinates are whole multiples of 1/128 degree, so midpoints, sums and means are
exact in binary floating point whatever the order of summation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editpulse import schemas
from editpulse.functions.grid import cell_of_point
from editpulse.functions.metrics import int_struct
from editpulse.functions.wkb import point_wkb, polygon_wkb

UNIT = 128.0
LATEST_DS, OLDER_DS = "2001-08-05", "2001-07-29"

_MIN_X = "(o_custkey * 7919) % 46000 - 23000 + o_orderkey % 3"
# One latitude in a hundred and one lies beyond the pole: its distance must come out NULL.
_MIN_Y = "CASE WHEN o_orderkey % 101 = 7 THEN 11600 ELSE (o_custkey * 104729) % 20000 - 10000 END"


# Columns read from the given tables; a declared schema saves a footer pass per read.
_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_returnflag string, l_linestatus string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
}


def given_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def changesets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changesets: home of the customer plus a small key-dependent box."""
    return given_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id",
        """CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN map() ELSE map_filter(map(
             'comment', o_orderpriority,
             'created_by', CASE WHEN o_orderkey % 3 > 0 THEN concat('editor/', o_orderkey % 3) END,
             'hashtags', CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '#one' WHEN 2 THEN '#one;#two'
                         WHEN 3 THEN '#one;' ELSE concat('#p', o_custkey % 10, ';;#q') END,
             'host', CASE WHEN o_orderkey % 7 = 0 THEN 'host-a' END,
             'imagery_used', CASE WHEN o_orderkey % 4 = 0 THEN 'aerial' END,
             'source', CASE WHEN o_orderkey % 6 = 0 THEN 'survey' END,
             'locale', CASE WHEN o_orderkey % 2 = 0 THEN concat('l', o_custkey % 3) END,
             'review', CASE WHEN o_orderkey % 8 = 0 THEN 'yes' END),
             (k, v) -> v IS NOT NULL) END AS tags""",
        "o_orderdate AS created_at",
        "false AS open",
        "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 AS int), 0, 0) AS closed_at",
        "o_orderkey % 4 AS comments_count",
        *[
            f"cast(CASE WHEN o_orderkey % 13 > 0 THEN ({expr}) / 128D END AS {kind}) AS {name}"
            for name, kind, expr in (
                ("min_lat", "decimal(9,7)", _MIN_Y),
                ("max_lat", "decimal(9,7)", f"{_MIN_Y} + 2 * (o_orderkey % 4)"),
                ("min_lon", "decimal(10,7)", _MIN_X),
                ("max_lon", "decimal(10,7)", f"{_MIN_X} + 2 * (o_orderkey % 5)"),
            )
        ],
        "o_orderkey % 97 AS num_changes",
        "o_custkey AS uid",
        "concat('mapper-', o_custkey) AS user",
    )


_ELEMENT_TAGS = """CASE l_partkey % 6
    WHEN 0 THEN CASE WHEN l_partkey % 12 = 0 THEN map('building', 'yes', 'highway', 'path')
                     ELSE map('building', 'yes') END
    WHEN 1 THEN map('highway', 'track') WHEN 2 THEN map('amenity', 'school')
    WHEN 3 THEN map('name', 'n') WHEN 4 THEN map() END"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as element versions; tags cycle through themed, other, empty and NULL."""
    return given_table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS changeset",
        "CASE l_returnflag WHEN 'N' THEN 'node' WHEN 'A' THEN 'way' ELSE 'relation' END AS type",
        f"{_ELEMENT_TAGS} AS tags",
        "cast(l_linenumber AS bigint) AS version",
        "l_linestatus = 'O' AS visible",
    )


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as whole elements: nodes have a place, ways have nodes, relations have a member."""
    kind = "CASE l_returnflag WHEN 'N' THEN 'node' WHEN 'A' THEN 'way' ELSE 'relation' END"
    items = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string, l_linestatus string"
    given = spark.read.schema(f"{items}, l_shipdate timestamp_ntz").parquet(f"{sf_dir}/lineitem.parquet")
    return given.selectExpr(
        "l_orderkey * 8 + l_linenumber AS id",
        f"{kind} AS type",
        f"{_ELEMENT_TAGS} AS tags",
        "cast(CASE WHEN l_returnflag = 'N' THEN (l_partkey % 10000 - 5000) / 128D END AS decimal(9,7)) AS lat",
        "cast(CASE WHEN l_returnflag = 'N' THEN (l_suppkey % 20000 - 10000) / 128D END AS decimal(10,7)) AS lon",
        "CASE WHEN l_returnflag = 'A' THEN transform(sequence(1, l_linenumber), n -> named_struct('ref', l_partkey + n - 1)) END AS nds",
        "CASE WHEN l_returnflag = 'R' THEN array(named_struct('type', 'way', 'ref', l_suppkey, 'role', 'outer')) END AS members",
        "l_orderkey AS changeset",
        "l_shipdate AS timestamp",
        "l_suppkey AS uid",
        "concat('mapper-', l_suppkey) AS user",
        "cast(l_linenumber AS bigint) AS version",
        "l_linestatus = 'O' AS visible",
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as members in two snapshots; the older one lists everybody.

    The newest snapshot leaves out one market segment and lists some members under
    a second chapter.
    """
    people = given_table(spark, sf_dir, "customer")
    nations = given_table(spark, sf_dir, "nation")
    newest = F.array(F.lit(LATEST_DS), F.lit(OLDER_DS))
    second = (F.col("c_nationkey") + 1) % 25
    listed = people.withColumn(
        "ds", F.explode(F.when(F.col("c_mktsegment") != "BUILDING", newest).otherwise(F.slice(newest, 2, 1)))
    ).withColumn(
        "team_id",
        F.explode(
            F.when(F.col("c_custkey") % 50 == 0, F.array("c_nationkey", second)).otherwise(F.array("c_nationkey"))
        ),
    )
    placed = listed.join(nations, listed["team_id"] == nations["n_nationkey"]).select(
        F.col("c_custkey").alias("uid"),
        F.concat(F.lit("mapper-"), "c_custkey").alias("username"),
        F.col("team_id").cast("long"),
        F.col("n_name").alias("chapter"),
        F.concat(F.lit("University of "), "n_name").alias("university"),
        F.when(F.col("team_id") % 7 != 3, F.concat(F.lit("City "), "team_id")).alias("city"),
        F.concat(F.lit("Country "), F.col("team_id") % 5).alias("country"),
        F.when(
            F.col("team_id") % 6 != 5,
            point_wkb(F.col("team_id") * 5 - 60.5, F.col("team_id") * -2 + 20.25),
        ).alias("geometry"),
        "ds",
    )
    return placed.withColumn("chapter_id", F.col("team_id"))


def boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as country outlines on a 5 x 5 lattice, one of five shapes each.

    Rectangle, rectangle with a hole, L shape, two parts, and a diamond that
    overlaps its neighbours.
    """
    nations = given_table(spark, sf_dir, "nation")
    regions = given_table(spark, sf_dir, "region")
    x, y = "(-180 + 72 * (n_nationkey % 5))", "(-80 + 32 * (n_nationkey div 5))"

    def ring(*points: tuple[int, int]) -> str:
        closed = (*points, points[0])
        pairs = [f"array(cast({x} + {dx} AS double), cast({y} + {dy} AS double))" for dx, dy in closed]
        return f"array({', '.join(pairs)})"

    def box(x1: int, y1: int, x2: int, y2: int) -> str:
        return ring((x1, y1), (x2, y1), (x2, y2), (x1, y2))

    outline = f"""CASE (n_nationkey + n_nationkey div 5) % 5
        WHEN 0 THEN array(array({box(2, 1, 70, 31)}))
        WHEN 1 THEN array(array({box(2, 1, 70, 31)}, {box(20, 8, 50, 24)}))
        WHEN 2 THEN array(array({ring((2, 1), (70, 1), (70, 16), (36, 16), (36, 31), (2, 31))}))
        WHEN 3 THEN array(array({box(2, 1, 30, 31)}), array({box(40, 1, 70, 31)}))
        ELSE array(array({ring((36, 1), (86, 16), (36, 31), (-14, 16))})) END"""
    code = F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))

    def labels(fields: tuple[str, ...], known: dict[str, str]) -> F.Column:
        return F.struct(
            *[(F.col(known[f]) if f in known else F.lit(None).cast("string")).alias(f) for f in fields]
        )

    return nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"]).select(
        code.alias("a3"),
        F.col("n_name").alias("country"),
        labels(schemas.BOUNDARY_NAME, {"primary": "n_name"}).alias("name"),
        labels(schemas.BOUNDARY_ENTITY, {"geounit": "n_name"}).alias("entity"),
        labels(schemas.BOUNDARY_REGION, {"continent": "r_name"}).alias("region"),
        polygon_wkb(F.expr(outline)).alias("geometry"),
    )


def event_changesets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as already enriched changesets: few users, many per day and place."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    events = given_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", k.alias("k"))

    def themed(name: str, new: int, edited: int) -> F.Column:
        return F.when(kind == name, int_struct(new=F.col("k") % new, edited=F.col("k") % edited))

    def three(name: str) -> F.Column:
        return F.when(
            kind == name, int_struct(new=F.col("k") % 3, edited=F.col("k") % 4, deleted=F.col("k") % 2)
        )

    low_x = F.expr("((user_id * 7919) % 46000 - 23000 + k % 3) / 128D")
    low_y = F.expr("((user_id * 104729) % 20000 - 10000) / 128D")
    high_x = F.expr("((user_id * 7919) % 46000 - 23000 + k % 3 + k % 2) / 128D")
    placed = F.col("k") % 10 != 9
    shaped = events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("uid"),
        F.col("ts").alias("created_at"),
        themed("click", 5, 3).alias("buildings"),
        themed("view", 4, 6).alias("highways"),
        themed("purchase", 3, 2).alias("amenities"),
        three("click").alias("nodes"),
        three("view").alias("ways"),
        three("error").alias("relations"),
        int_struct(
            new=F.col("k") % 7, edited=F.col("k") % 5, deleted=F.col("k") % 2, num_changes=F.col("k")
        ).alias("elements"),
        int_struct(
            new=F.col("k") % 6, edited=F.col("k") % 5, new_vertices=F.col("k") % 9,
            edited_vertices=F.col("k") % 8,
        ).alias("features"),
        F.struct(
            low_x.cast("decimal(10,7)").alias("xmin"),
            low_y.cast("decimal(9,7)").alias("ymin"),
            high_x.cast("decimal(10,7)").alias("xmax"),
            low_y.cast("decimal(9,7)").alias("ymax"),
            F.lit(0.0).alias("diameter"),
        ).alias("bbox"),
        F.when(placed, (low_x + high_x) / 2).alias("lon"),
        F.when(placed, low_y).alias("lat"),
        F.concat(F.lit("N"), F.lpad((F.col("event_id") % 28).cast("string"), 2, "0")).alias("a3"),
        F.lit(LATEST_DS).alias("members_ds"),
        F.lit("2024-01-30").alias("ds"),
    )
    return shaped.withColumn("h3", cell_of_point(F.col("lon"), F.col("lat"), 8))
