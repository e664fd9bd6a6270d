"""GeoJSON and OSM JSON files: reading, checking, writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

POINT = "array<double>"
LINE = f"array<{POINT}>"
AREA = f"array<{LINE}>"
MULTI_AREA = f"array<{AREA}>"
GEOMETRY = "struct<type:string,coordinates:string,geometries:array<struct<type:string,coordinates:string>>>"
FEATURE = f"struct<type:string,id:string,properties:map<string,string>,geometry:{GEOMETRY}>"
COLLECTION = f"type string, features array<{FEATURE}>, _bad string"
ELEMENTS = ("elements array<struct<type:string,id:bigint,tags:map<string,string>,lat:double,lon:double,"
            "geometry:array<struct<lat:double,lon:double>>>>")
ELEMENT = ("type string, id bigint, tags map<string,string>, lat double, lon double, geometry array<struct<lat:double,lon:double>>, _bad string")
LINE_DOC = f"type string, id string, properties map<string,string>, geometry {GEOMETRY}, features array<{FEATURE}>, _bad string"
FILE_NAME = "_metadata.file_name"
REJECTS = "(?i)example|rendertest"  # fixed value: names of files that are not data


def _as_points(line: str) -> str:
    return f"transform({line}, c -> struct(c[0] AS x, c[1] AS y))"


def geometry_parts(kind: str, coordinates: str) -> str:
    """Coordinate text of one geometry as array of parts, each an array of points."""
    parse = lambda schema: f"from_json({coordinates}, '{schema}')"
    lines = f"transform({parse(AREA)}, l -> {_as_points('l')})"
    return (
        f"CASE {kind} WHEN 'Point' THEN array({_as_points('array(' + parse(POINT) + ')')})"
        f" WHEN 'MultiPoint' THEN transform({parse(LINE)}, c -> array(struct(c[0] AS x, c[1] AS y)))"
        f" WHEN 'LineString' THEN array({_as_points(parse(LINE))})"
        f" WHEN 'MultiLineString' THEN {lines} WHEN 'Polygon' THEN {lines}"
        f" WHEN 'MultiPolygon' THEN flatten(transform({parse(MULTI_AREA)}, p -> transform(p, l -> {_as_points('l')}))) END")


def polygon_numbers(kind: str, coordinates: str, parts: str) -> str:
    """Number of the polygon that each part belongs to; 0 but for MultiPolygon."""
    many = f"flatten(transform(from_json({coordinates}, '{MULTI_AREA}'), (p, i) -> array_repeat(i, size(p))))"
    return f"CASE WHEN {kind} = 'MultiPolygon' THEN {many} ELSE transform({parts}, p -> 0) END"


def _features(rows: DataFrame, layer: str, *more: str) -> DataFrame:
    """Feature rows of (file, ord, f), and ``more`` columns of them."""
    parts = geometry_parts("g.type", "g.coordinates")
    # A geometry is one member, a collection has several; their parts follow each other.
    one = "array(struct(f.geometry.type AS type, f.geometry.coordinates AS coordinates))"
    members = f"CASE WHEN f.geometry.type = 'GeometryCollection' THEN f.geometry.geometries ELSE {one} END"
    d = rows.withColumn("_members", F.expr(f"transform({members}, g -> struct(g.type AS type, g.coordinates AS coordinates, {parts} AS parts))"))
    return d.selectExpr(
        "coalesce(f.id, concat(file, '#', ord)) AS feature_id", f"'{layer}' AS layer", "f.properties AS props",
        "f.geometry.type AS geom_type", "flatten(transform(_members, g -> g.parts)) AS parts",
        f"flatten(transform(_members, g -> {polygon_numbers('g.type', 'g.coordinates', 'g.parts')})) AS polygons",
        "CASE WHEN f.geometry.type = 'GeometryCollection' THEN transform(_members, g -> struct(g.type AS type, size(g.parts) AS n)) END AS members", *more)


def read_lines(spark: SparkSession, path: str | list[str], file: str = FILE_NAME) -> DataFrame:
    """Lines of feature files: file, ord (block of the file and number in it), line, kind, doc.

    ``kind`` is ``feature``, ``collection`` (a whole collection in the line), ``frame`` (a collection's brackets
    and other members, spread over lines) or ``broken``.
    """
    text = spark.read.text(path).selectExpr(
        f"{file} AS file", "concat(_metadata.file_block_start, ':', monotonically_increasing_id() & 8589934591L) AS ord",
        "regexp_replace(trim(value), ',$', '') AS line")
    docs = text.filter("line <> ''").selectExpr("*", f"from_json(line, '{LINE_DOC}', map('columnNameOfCorruptRecord', '_bad')) AS doc")
    # a frame line is an unfinished or closing part of a collection that names no feature
    frame = r"""line RLIKE '^[\\]\\}, ]+$' OR (line RLIKE '^[{"]' AND line NOT RLIKE '"type" *: *"Feature" *[,}]' AND (line RLIKE '^"' OR line RLIKE '^[{]$' OR line RLIKE '\\[$'))"""
    kind = (f"CASE WHEN doc._bad IS NULL AND doc.type = 'Feature' THEN 'feature' WHEN doc._bad IS NULL AND doc.type = 'FeatureCollection'"
            f" AND doc.features IS NOT NULL THEN 'collection' WHEN {frame} THEN 'frame' ELSE 'broken' END")
    return docs.withColumn("kind", F.expr(kind))


def read_documents(spark: SparkSession, path: str | list[str], file: str = FILE_NAME) -> DataFrame:
    """Whole files: file, features, reason (null for a readable collection)."""
    docs = (spark.read.schema(COLLECTION).option("multiLine", True).option("columnNameOfCorruptRecord", "_bad")
            .option("pathGlobFilter", "*").json(path))
    return docs.selectExpr(f"{file} AS file", "features",
                           "CASE WHEN _bad IS NOT NULL THEN 'invalid json' WHEN features IS NULL THEN 'no features' END AS reason")


def broken_parts(spark: SparkSession, path: str, by_line: bool = False) -> DataFrame:
    """What the readers refuse: file, place (line position; null for a whole file), reason."""
    if by_line:
        return read_lines(spark, path).filter("kind = 'broken'").selectExpr("file", "ord AS place", "'invalid line' AS reason")
    return read_documents(spark, path).filter("reason IS NOT NULL").selectExpr("file", "CAST(NULL AS STRING) AS place", "reason")


def _rows(spark: SparkSession, path: str | list[str], by_line: bool, bad: str, file: str = FILE_NAME) -> DataFrame:
    """(file, ord, f) of all features; broken lines and files raise, or are left out with ``bad="skip"``."""
    if by_line:
        d = read_lines(spark, path, file).filter("kind <> 'frame'")
        stop = "raise_error(concat('broken GeoJSON line in ', file, ' at ', ord))"
        one = "array(struct(doc.type, doc.id, doc.properties, doc.geometry))"
        found = f"CASE kind WHEN 'feature' THEN CAST({one} AS array<{FEATURE}>) WHEN 'collection' THEN doc.features"
        found += " END" if bad == "skip" else f" ELSE {stop} END"
        return d.selectExpr("file", "ord AS line", f"posexplode({found}) AS (k, f)").selectExpr("file", "concat(line, ':', k) AS ord", "f")
    stop = "raise_error(concat('unreadable GeoJSON file ', file, ': ', reason))"
    found = "features" if bad == "skip" else f"CASE WHEN reason IS NOT NULL THEN {stop} ELSE features END"
    return read_documents(spark, path, file).selectExpr("file", f"posexplode({found}) AS (ord, f)")


def read_features(spark: SparkSession, path: str, layer: str, by_line: bool = False, bad: str = "raise") -> DataFrame:
    """Feature rows (feature_id, layer, props, geom_type, parts, polygons, members) of GeoJSON files.

    ``by_line`` reads files with one feature per line, also inside a collection's brackets, or a whole
    collection in a line, and splits large files over many tasks.  Otherwise every file is one document,
    which one task must parse whole; large layers should be landed by line.  Ids are the feature's own, else file
    name and position, so equal features keep apart.  ``polygons`` numbers the polygon of each part,
    ``members`` has type and number of parts of the members of a geometry collection.  A broken line or
    file stops the read; with ``bad="skip"`` it is left out, and ``broken_parts`` lists it.
    """
    return _features(_rows(spark, path, by_line, bad).filter("f.geometry IS NOT NULL"), layer)


def data_files(names: DataFrame, name: str = "name") -> DataFrame:
    """Keep the file names that are data: ``*.geojson`` without examples and render tests."""
    return names.filter(F.col(name).endswith(".geojson") & ~F.col(name).rlike(REJECTS))


def read_feature_files(spark: SparkSession, folder: str, layer: str, by_line: bool = False, bad: str = "raise") -> DataFrame:
    """All data files of a folder as one layer; other files are not looked at."""
    rows = _rows(spark, f"{folder.rstrip('/')}/*.geojson", by_line, "skip" if bad == "skip" else "raise")
    return _features(data_files(rows, "file").filter("f.geometry IS NOT NULL"), layer)


def read_named_files(spark: SparkSession, folder: str, names: list[str], layer: str, by_line: bool = False, bad: str = "raise") -> DataFrame:
    """Only the named entries of a folder, as ``read_features`` with their ``file``.

    An entry is a file, or a folder of part files as Spark writes them; either way ``file`` is its name.
    """
    base = folder.rstrip("/")
    file = f"substring_index(substring_index(_metadata.file_path, '/{base.split('/')[-1]}/', -1), '/', 1)"
    rows = _rows(spark, [f"{base}/{n}" for n in names], by_line, bad, file)
    return _features(rows.filter("f.geometry IS NOT NULL"), layer, "file")


def read_osm_elements(spark: SparkSession, path: str, by_line: bool = False) -> DataFrame:
    """OSM elements (osm_type, osm_id, tags, geom_type, parts); a closed way is a polygon ring.

    ``by_line`` reads one element per line instead of one document per file.  What cannot be parsed raises.
    """
    if by_line:
        rows = spark.read.text(path).selectExpr("_metadata.file_name AS file", "regexp_replace(trim(value), ',$', '') AS line").filter("line LIKE '{%'")
        rows = rows.withColumn("e", F.expr(f"from_json(line, '{ELEMENT}', map('columnNameOfCorruptRecord', '_bad'))"))
        stop = "raise_error(concat('broken element in ', file, ': ', left(line, 80)))"
        rows = rows.filter(F.expr(f"CASE WHEN e._bad IS NOT NULL THEN {stop} ELSE true END"))
    else:
        docs = (spark.read.schema(ELEMENTS + ", _bad string").option("multiLine", True).option("columnNameOfCorruptRecord", "_bad").json(path))
        stop = "raise_error(concat('unreadable element file ', file))"
        rows = docs.selectExpr("_metadata.file_name AS file", "_bad", "elements").selectExpr(
            f"explode(CASE WHEN _bad IS NOT NULL OR elements IS NULL THEN {stop} ELSE elements END) AS e")
    way = "transform(filter(e.geometry, g -> g IS NOT NULL), g -> struct(g.lon AS x, g.lat AS y))"
    closed = "size(e.geometry) > 3 AND e.geometry[0] = e.geometry[size(e.geometry) - 1]"
    return rows.filter("e.type IN ('node', 'way')").selectExpr(
        "e.type AS osm_type", "e.id AS osm_id", "coalesce(e.tags, map()) AS tags",
        f"CASE WHEN e.type = 'node' THEN 'Point' WHEN {closed} THEN 'Polygon' ELSE 'LineString' END AS geom_type",
        f"CASE WHEN e.type = 'node' THEN array(array(struct(e.lon AS x, e.lat AS y))) ELSE array({way}) END AS parts")


def check_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``reason``, why a GeoJSON document is unusable, or null for a good one."""
    parsed = docs.withColumn("_doc", F.expr(f"from_json({text}, '{COLLECTION}', map('columnNameOfCorruptRecord', '_bad'))"))
    reason = (F.when(F.col(text).isNull() | (F.trim(text) == ""), "empty")
              .when(F.col("_doc._bad").isNotNull() | F.col("_doc").isNull(), "invalid json")
              .when(F.expr("_doc.type IS NULL"), "no type")
              .when(F.expr("_doc.type <> 'FeatureCollection'"), "not a collection")
              .when(F.expr("_doc.features IS NULL"), "no features")
              .when(F.expr("exists(_doc.features, f -> f.geometry IS NULL)"), "feature without geometry"))
    return parsed.withColumn("reason", reason).drop("_doc")


def good_and_bad(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable documents, and the rejected ones with their reason."""
    return checked.filter("reason IS NULL").drop("reason"), checked.filter("reason IS NOT NULL")


def feature_json(features: DataFrame, decimals: int = 6, extra: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One GeoJSON feature per row (column ``value``) from feature_id, props, geom_type, parts, polygons, members.

    ``extra`` adds members such as a tiling hint.  Missing properties are left out.  Without ``polygons`` all
    parts belong to one polygon, without ``members`` there are no geometry collections.  ``keep`` names columns that stay.
    """
    point = lambda c: f"array(round({c}.x, {decimals}), round({c}.y, {decimals}))"
    line = lambda p: f"transform({p}, c -> {point('c')})"
    of = lambda k, parts, polygons: f"filter({parts}, (p, pi) -> {polygons}[pi] = {k})"

    def geometry(kind: str, parts: str, polygons: str) -> str:
        areas = f"transform(array_distinct({polygons}), k -> transform({of('k', parts, polygons)}, p -> {line('p')}))"
        body = (
            f"CASE {kind} WHEN 'Point' THEN to_json({point(parts + '[0][0]')}) WHEN 'MultiPoint' THEN to_json(transform({parts}, p -> {point('p[0]')}))"
            f" WHEN 'LineString' THEN to_json({line(parts + '[0]')}) WHEN 'MultiPolygon' THEN to_json({areas})"
            f" ELSE to_json(transform({parts}, p -> {line('p')})) END")
        return f"concat('{{\"type\":\"', {kind}, '\",\"coordinates\":', {body}, '}}')"

    has = set(features.columns)
    polygons = "polygons" if "polygons" in has else "transform(parts, p -> 0)"
    whole = geometry("geom_type", "parts", "_polygons")
    if "members" in has:
        begin = "1 + aggregate(slice(members, 1, i), 0, (n, m) -> n + m.n)"
        inner = geometry("m.type", f"slice(parts, {begin}, m.n)", f"slice(_polygons, {begin}, m.n)")
        listed = f"concat_ws(',', transform(members, (m, i) -> {inner}))"
        whole = f"CASE WHEN members IS NOT NULL THEN concat('{{\"type\":\"GeometryCollection\",\"geometries\":[', {listed}, ']}}') ELSE {whole} END"
    d = features.withColumn("_polygons", F.expr(polygons)).withColumn("_geom", F.expr(whole))
    more = F.concat(F.lit(","), extra) if extra is not None else F.lit("")
    props = F.to_json("props") if "props" in features.columns else F.lit("{}")
    return d.select(*keep, F.concat(F.lit('{"type":"Feature","id":'), F.expr("trim(BOTH '[]' FROM to_json(array(CAST(feature_id AS STRING))))"),
                             more, F.lit(',"properties":'), props, F.lit(',"geometry":'), F.col("_geom"), F.lit("}")).alias("value"))


def write_features(features: DataFrame, path: str, decimals: int = 6, extra: Column | None = None) -> None:
    """Write one feature per line; the commit protocol publishes the folder as a whole."""
    feature_json(features, decimals, extra).write.mode("overwrite").text(path)


def write_feature_files(features: DataFrame, path: str, file: str = "file", decimals: int = 6) -> None:
    """``write_features`` into one folder of part files per value of ``file``, named ``file=value``."""
    feature_json(features, decimals, keep=(file,)).repartition(file).write.mode("overwrite").partitionBy(file).text(path)


def write_osm(elements: DataFrame, path: str) -> None:
    """Write one OSM element per line."""
    elements.write.mode("overwrite").json(path)
