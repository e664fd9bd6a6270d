"""Attribute and tag expressions: columns in, columns out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Source attribute -> display attribute.
STREET_ATTRS = {
    "FEATURENAME": "Straßenname",
    "EDGECATEGORY_NAME": "Kategorie",
    "FRC_NAME": "Funktionale Straßenklasse",
    "FOW_NAME": "Wegetyp",
    "DEDICATEDWIDTH": "Straßenbreite_m",
    "LEVELINTERMEDIATE": "Ebene",
    "BEZIRK": "Bezirk",
    "BEZIRK_RECHTS": "Bezirk rechts",
    "BEZIRK_LINKS": "Bezirk links",
}
# Attributes that must agree for lines to be dissolved.
MERGE_KEYS = ["Straßenname", "Bezirk", "RgE", "Funktionale Straßenklasse", "Wegetyp", "Kategorie"]
# Attributes dropped from one-way lines.
DROPPED_ATTRS = ["OBJECTID", "SE_ANNO_CAD_DATA"]
# Buffer width per kind of cycling facility, and for the two other mask layers.
MASK_WIDTHS = {
    "Radfahren in Wohnstraße": 20,
    "Radfahren in Fußgängerzone": 20,
    "Baulicher Radweg": 20,
    "Getrennter Geh- und Radweg": 20,
    "Gemischter Geh- und Radweg": 20,
    "Radfahren gegen die Einbahn": 5,
}
HOME_STREET_WIDTH = 5
CONTRAFLOW_WIDTH = 5
# Tags that mark a seat.
SEAT_TAGS = [
    ("amenity", "bench"), ("bench", "yes"), ("amenity", "chair"), ("amenity", "lounger"), ("amenity", "seat"),
    ("leisure", "picnic_table"), ("picnic_table", "yes"), ("tourism", "picnic_site"), ("leisure", "parklet"),
    ("outdoor_seating", "parklet"),
]
# Road classes open to pedestrians, matched anywhere in the highway value.
WIDE_ROADS = ["primary", "secondary", "tertiary", "residential", "pedestrian", "living_street", "service",
              "unclassified"]
# Tags that rule a road out, by value and by mere presence.
EXCLUDED_VALUES = [("foot", "no"), ("indoor", "yes"), ("access", "no"), ("access", "private"), ("tunnel", "yes"),
                   ("ramp:wheelchair", "yes"), ("area", "yes")]
EXCLUDED_KEYS = ["private", "permissive", "steps"]
# Metres a road of this type reaches out from its centre line.
FREE_OFFSETS = {
    2.0: ["footway", "path", "cycleway", "track"],
    3.0: ["service", "living_street", "residential", "unclassified"],
    4.0: ["pedestrian", "tertiary"],
    5.0: ["secondary"],
    6.0: ["primary"],
}
DEFAULT_FREE_OFFSET = 2.5
# First zoom level a road type is drawn at.
MIN_ZOOMS = {
    13: ["track"],
    14: ["footway", "path", "cycleway"],
    0: ["unclassified", "service", "living_street", "pedestrian", "residential", "tertiary", "secondary", "primary"],
}
DEFAULT_MIN_ZOOM = 30
PARKING_MIN_ZOOM = 14
# Distance limit -> drawing rank; beyond the last limit colour 0 and rank 10.
DISTANCE_RANKS = {25: 40, 50: 30, 75: 20}


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def mask_layer(feature_id: Column | str) -> Column:
    """Layer of a mixed response, told by the feature id; null for an unknown or missing id."""
    fid = _c(feature_id)
    chain = F.when(fid.contains("RADWEGE"), "RADWEGE").when(fid.contains("WOHNSTRASSE"), "WOHNSTRASSE")
    return chain.when(fid.contains("RADGEGENEINBAHN"), "RADGEGENEINBAHN")


def rename_attrs(df: DataFrame, names: dict[str, str] = STREET_ATTRS) -> DataFrame:
    return df.withColumnsRenamed(names)


def drop_attrs(df: DataFrame, names: list[str] = DROPPED_ATTRS) -> DataFrame:
    return df.drop(*names)


def district_code(value: Column | str) -> Column:
    """District number of an ``AT9nn00`` code, as text.  Any other text passes unchanged.

    A code that ends before its number has the number 0; null if there is something else in its place.
    """
    v = _c(value).cast("string")
    number = F.substring(v, 4, 2)
    return F.when(v.startswith("AT"), F.when(F.trim(number) == "", "0").otherwise(number.try_cast("int").cast("string"))).otherwise(v)


def crop_leading_number(value: Column | str) -> Column:
    return F.regexp_replace(_c(value), r"^\s*\d+\s*[-–—]\s*", "")


def known_width(value: Column | str) -> Column:
    return F.nullif(_c(value), F.lit(-1))


def shown_level(value: Column | str) -> Column:
    return F.nullif(_c(value), F.lit(0))


def fill_from(own: Column | str, other: Column | str) -> Column:
    return F.coalesce(_c(own), _c(other))


def street_class(frc: Column | str, fow: Column | str, category: Column | str) -> Column:
    """Streets worth matching: minor classes, no motorways, roundabout-like or pedestrian-only edges."""
    return (_c(frc) > 2) & ~_c(fow).isin(1, 2, 4) & (_c(category) != "B")


def tag(key: str, tags: Column | str = "tags", props: Column | str | None = None) -> Column:
    """Value of a tag; the flat properties count only where there is no tag map at all."""
    t = _c(tags)
    flat = _c(props)[key] if props is not None else F.lit(None).cast("string")
    return F.when(t.isNotNull(), t[key]).otherwise(flat)


def is_seat(tags: Column | str = "tags", props: Column | str | None = None) -> Column:
    hit = F.lit(False)
    for key, value in SEAT_TAGS:
        hit = hit | tag(key, tags, props).eqNullSafe(value)
    return hit


def _no_match(value: Column, pattern: str) -> Column:
    """A missing tag passes a negative match."""
    return F.coalesce(~value.rlike(pattern), F.lit(True))


def seat_filter(tags: Column | str = "tags") -> Column:
    access, level = tag("access", tags), tag("level", tags)
    hit = F.lit(False)
    for key, value in SEAT_TAGS:
        rule = tag(key, tags).eqNullSafe(value)
        if (key, value) == ("bench", "yes"):
            rule = rule & _no_match(level, "^-?[1-9]")
        elif (key, value) == ("leisure", "parklet"):
            rule = rule & _no_match(access, "^customers?$")
        elif (key, value) == ("outdoor_seating", "parklet"):
            rule = rule & F.coalesce(access.rlike("^(yes|public|permissive)$"), F.lit(False))
        hit = hit | rule
    return hit & _no_match(access, "^private")


def walkable_filter(tags: Column | str = "tags", osm_type: Column | str = "osm_type") -> Column:
    highway = tag("highway", tags)
    narrow = highway.isin("footway", "path", "track") | ((highway == "cycleway") & tag("foot", tags).eqNullSafe("yes"))
    wide = (_c(osm_type) == "way") & highway.rlike("|".join(WIDE_ROADS))
    return F.coalesce(narrow | wide, F.lit(False))


def tag_exclusion(tags: Column | str = "tags") -> Column:
    keep = F.lit(True)
    for key, value in EXCLUDED_VALUES:
        keep = keep & ~tag(key, tags).eqNullSafe(value)
    for key in EXCLUDED_KEYS:
        keep = keep & tag(key, tags).isNull()
    return keep


def road_type(tags: Column | str = "tags") -> Column:
    return F.coalesce(tag("highway", tags), F.lit(""))


def _lookup(value: Column, table: dict, default) -> Column:
    chain = None
    for result, names in table.items():
        test = value.isin(*names)
        chain = F.when(test, F.lit(result)) if chain is None else chain.when(test, F.lit(result))
    return chain.otherwise(F.lit(default))


def free_offset(road: Column | str) -> Column:
    return _lookup(_c(road), FREE_OFFSETS, DEFAULT_FREE_OFFSET)


def minzoom(road: Column | str) -> Column:
    return _lookup(_c(road), MIN_ZOOMS, DEFAULT_MIN_ZOOM)


def distance_bucket(d: Column | str) -> Column:
    chain = F
    for limit in DISTANCE_RANKS:
        chain = chain.when(_c(d) < limit, F.lit(limit))
    return chain.otherwise(F.lit(0))


def bucket_rank(d: Column | str) -> Column:
    chain = F
    for limit, rank in DISTANCE_RANKS.items():
        chain = chain.when(_c(d) < limit, F.lit(rank))
    return chain.otherwise(F.lit(10))


def street_output(name: Column | str, frc: Column | str) -> Column:
    """Published street properties as JSON; missing values are left out."""
    return F.to_json(F.struct(_c(name).alias("name"), _c(frc).alias("FRC")))


def parking_output(count: Column | str) -> Column:
    return F.to_json(F.struct(_c(count).alias("ANZAHL")))


def mask_widths(spark) -> DataFrame:
    """Buffer width per facility kind, a fixed table of six rows."""
    return spark.createDataFrame([(k, float(v)) for k, v in MASK_WIDTHS.items()], "submerkmal string, r double")


def lookup_width(masks: DataFrame) -> DataFrame:
    """Masks with their buffer width ``r``; facilities of an unlisted kind are dropped."""
    table = F.broadcast(mask_widths(masks.sparkSession))
    layer = mask_layer("feature_id")
    known = masks.withColumn("layer", layer).filter(F.col("layer").isNotNull())
    joined = known.join(table, "submerkmal", "left")
    width = F.when(F.col("layer") == "RADWEGE", F.col("r"))
    width = width.when(F.col("layer") == "WOHNSTRASSE", F.lit(float(HOME_STREET_WIDTH)))
    return joined.withColumn("r", width.otherwise(F.lit(float(CONTRAFLOW_WIDTH)))).filter(F.col("r").isNotNull())
