"""Table schemas. Column names and types are fixed values set by the input files."""

from __future__ import annotations

from pyspark.sql import types as T

_LAT = T.DecimalType(9, 7)
_LON = T.DecimalType(10, 7)
_TAGS = T.MapType(T.StringType(), T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CHANGESETS = _struct(
    id=T.LongType(),
    tags=_TAGS,
    created_at=T.TimestampType(),
    open=T.BooleanType(),
    closed_at=T.TimestampType(),
    comments_count=T.LongType(),
    min_lat=_LAT,
    max_lat=_LAT,
    min_lon=_LON,
    max_lon=_LON,
    num_changes=T.LongType(),
    uid=T.LongType(),
    user=T.StringType(),
)

# Element history and the current-elements table share one layout.
ELEMENTS = _struct(
    id=T.LongType(),
    type=T.StringType(),
    tags=_TAGS,
    lat=_LAT,
    lon=_LON,
    nds=T.ArrayType(_struct(ref=T.LongType())),
    members=T.ArrayType(_struct(type=T.StringType(), ref=T.LongType(), role=T.StringType())),
    changeset=T.LongType(),
    timestamp=T.TimestampType(),
    uid=T.LongType(),
    user=T.StringType(),
    version=T.LongType(),
    visible=T.BooleanType(),
)

BOUNDARY_NAME = ("primary", "long", "abbrev", "formal")
BOUNDARY_ENTITY = (
    "sovereignty", "sovereignty_a3", "type", "geounit", "geounit_a3", "subunit", "subunit_a3",
)
BOUNDARY_REGION = ("wb", "subregion", "continent")

BOUNDARIES = _struct(
    a3=T.StringType(),
    country=T.StringType(),
    name=_struct(**{f: T.StringType() for f in BOUNDARY_NAME}),
    entity=_struct(**{f: T.StringType() for f in BOUNDARY_ENTITY}),
    region=_struct(**{f: T.StringType() for f in BOUNDARY_REGION}),
    geometry=T.BinaryType(),
)

MEMBERS = _struct(
    uid=T.LongType(),
    username=T.StringType(),
    gender=T.StringType(),
    team_id=T.LongType(),
    alumni=T.DateType(),
    ymsc=T.DateType(),
    regional_ambassador=T.DateType(),
    mentor_faculty_advisor=T.DateType(),
    chapter=T.StringType(),
    university=T.StringType(),
    city=T.StringType(),
    country=T.StringType(),
    account_created=T.DateType(),
    description=T.StringType(),
    img=T.StringType(),
    changesets=T.DoubleType(),
    company=T.StringType(),
    geometry=T.BinaryType(),
    ds=T.StringType(),
)

# Counter groups of one changeset: name -> fields.
THEMES = ("buildings", "highways", "amenities")
ELEMENT_KINDS = ("nodes", "ways", "relations")
METRICS = {
    "buildings": ("new", "edited"),
    "highways": ("new", "edited"),
    "amenities": ("new", "edited"),
    "elements": ("new", "edited", "deleted", "num_changes"),
    "features": ("new", "edited", "new_vertices", "edited_vertices"),
    "nodes": ("new", "edited", "deleted"),
    "ways": ("new", "edited", "deleted"),
    "relations": ("new", "edited", "deleted"),
}

_BBOX = _struct(xmin=_LON, ymin=_LAT, xmax=_LON, ymax=_LAT, diameter=T.DoubleType())

# One row per kept changeset, as written by the enrichment plan.
ENRICHED = T.StructType(
    [
        *_struct(
            id=T.LongType(),
            uid=T.LongType(),
            username=T.StringType(),
            created_at=T.TimestampNTZType(),
            closed_at=T.TimestampNTZType(),
            comment=T.StringType(),
            created_by=T.StringType(),
            imagery_used=T.StringType(),
            host=T.StringType(),
            source=T.StringType(),
            hashtags=T.ArrayType(T.StringType()),
            tags=_TAGS,
        ).fields,
        *[
            T.StructField(group, _struct(**{f: T.IntegerType() for f in METRICS[group]}))
            for group in (*THEMES, *ELEMENT_KINDS, "elements", "features")
        ],
        *_struct(
            bbox=_BBOX,
            lon=T.DoubleType(),
            lat=T.DoubleType(),
            geometry=T.BinaryType(),
            a3=T.StringType(),
            members_ds=T.StringType(),
            ds=T.StringType(),
        ).fields,
    ]
)
