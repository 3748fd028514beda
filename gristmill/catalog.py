"""Registry of the core's queries: name -> (spark, folder) -> DataFrame, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import geo
from gristmill.operators import schema_drift, spatial, split_values
from gristmill.plans import base_queries, entities, lifecycle_queries, registry, scalars, views  # noqa: F401  (they register themselves)
from gristmill.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

#: Fields of producteurs_export that hold several values; True where blanks separate.
PACKED_FIELDS = {"emails_autres": True, "sous_segment": False, "productions": False}


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each change of columns between a provider's file and the one before (problem 3)."""
    return schema_drift.change_report(table(spark, folder, "raw_rows"), table(spark, folder, "source_files"))


def p3_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """The column lifespan catalogue itself."""
    columns = schema_drift.catalogue(table(spark, folder, "raw_rows"), table(spark, folder, "source_files"))
    return schema_drift.lifespans(columns)


def p3_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Every column of every landed file with its main type and how many rows have its key."""
    columns = schema_drift.catalogue(table(spark, folder, "raw_rows"), table(spark, folder, "source_files"))
    return columns.select("source_file_id", "header", "json_type", "n_rows")


def p3_consolidated(spark: SparkSession, folder: str) -> DataFrame:
    """All landed rows in one table of canonical fields."""
    return schema_drift.consolidate(table(spark, folder, "raw_rows"))


def p3_typed(spark: SparkSession, folder: str) -> DataFrame:
    """The same with numbers, yes or no, and dates in one type each, and what didn't fit."""
    return schema_drift.cast_fields(p3_consolidated(spark, folder))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every value of a packed field that holds two or more, with its position (problem 4)."""
    return split_values.split_fields(table(spark, folder, "producteurs_export"), "export_no", PACKED_FIELDS, least=2).select("export_no", "field", "pos", "item")


def p4_all_values(spark: SparkSession, folder: str) -> DataFrame:
    """Every value of the packed fields with how it was written and what was wrong with it."""
    return split_values.split_fields(table(spark, folder, "producteurs_export"), "export_no", PACKED_FIELDS)


PACKED_CASES = ['a | b / c;"d, e"\tf', 'x - y-z - "q ""r"""', "fromages (frais / affinés) + œufs", ";; a ;; a ;", 'open "q; b', "a (b; c", "", None]


def p4_cases(spark: SparkSession, folder: str) -> DataFrame:
    """The cases a grammar of packed fields is judged by: separators, quotes, brackets, marks that never close."""
    cases = spark.createDataFrame(list(enumerate(PACKED_CASES)), "case_no int, packed string")
    return split_values.split_fields(cases, "case_no", {"packed": False}).select("case_no", "pos", "item")


def p4_lists(spark: SparkSession, folder: str) -> DataFrame:
    """How many values the packed fields without quotes and brackets hold, where only line breaks, bars and semicolons stand between them."""
    rows = table(spark, folder, "producteurs_export")
    plain = rows.filter(~F.col("sous_segment").rlike(r"[^\p{L}\p{N} |;]")).select("export_no", "sous_segment")
    return split_values.split_fields(plain, "export_no", {"sous_segment": False}).select("export_no", "pos", "item")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every located listing with every establishment within 100 m (problem 5)."""
    point = geo.located(F.col("lat"), F.col("lon"))
    listings = table(spark, folder, "listings").select("listing_no", point.alias("p")).filter("p IS NOT NULL").select("listing_no", "p.lat", "p.lon")
    places = table(spark, folder, "population").select("siret", point.alias("p")).filter("p IS NOT NULL").select("siret", "p.lat", "p.lon").distinct()
    return spatial.distance_join(listings, places, 100.0).select("listing_no", "siret").distinct()


def queries() -> dict[str, Query]:
    found = (p3_found, p3_catalogue, p3_columns, p3_consolidated, p3_typed, p4_found, p4_all_values, p4_cases, p4_lists, p5_found)
    return {f.__name__: f for f in found} | registry.QUERIES


NUMBER = "try_cast(replace(regexp_replace({c}, '[\\s' || chr(160) || ']+', '', 'g'), ',', '.') AS DOUBLE)"
POINTS = f"""(SELECT {{k}}, CASE WHEN a BETWEEN 41 AND 51.5 AND b BETWEEN -5.5 AND 10 THEN a ELSE b END AS lat, CASE WHEN a BETWEEN 41 AND 51.5 AND b BETWEEN -5.5 AND 10 THEN b ELSE a END AS lon FROM
 (SELECT {{k}}, {NUMBER.format(c="lat")} AS a, {NUMBER.format(c="lon")} AS b FROM {{t}}) WHERE (a BETWEEN 41 AND 51.5 AND b BETWEEN -5.5 AND 10) OR (b BETWEEN 41 AND 51.5 AND a BETWEEN -5.5 AND 10))"""
P5_SQL = f"""SELECT DISTINCT listing_no, siret FROM {POINTS.format(k="listing_no", t="listings")} l JOIN {POINTS.format(k="siret", t="population")} p ON abs(l.lat - p.lat) < 0.001 AND
 2 * 6371000 * asin(sqrt(least(1.0, pow(sin(radians(p.lat - l.lat) / 2), 2) + cos(radians(l.lat)) * cos(radians(p.lat)) * pow(sin(radians(p.lon - l.lon) / 2), 2)))) <= 100"""


P3_COLUMNS_SQL = """WITH k AS (SELECT source_file_id, raw_json, unnest(json_keys(raw_json)) AS header FROM raw_rows WHERE source_file_id IS NOT NULL AND json_valid(raw_json) AND json_type(raw_json) = 'OBJECT'),
t AS (SELECT k.source_file_id, header, CASE json_type(raw_json, '/' || replace(replace(header, '~', '~0'), '/', '~1')) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN NULL ELSE 'number' END AS jt FROM k JOIN source_files USING (source_file_id)),
n AS (SELECT source_file_id, header, jt, count(*) AS n FROM t GROUP BY ALL)
SELECT source_file_id, header, first(jt ORDER BY n DESC, jt) FILTER (WHERE jt IS NOT NULL) AS json_type, CAST(sum(n) AS BIGINT) AS n_rows FROM n GROUP BY source_file_id, header"""
ALIAS_ROWS = ", ".join(f"('{alias}', '{field}')" for field, aliases in schema_drift.ALIASES.items() for alias in aliases)
P3_SQL = f"""WITH {P3_COLUMNS_SQL.removeprefix('WITH ').rsplit('SELECT', 1)[0].rstrip()}, c AS (SELECT source_file_id, header, first(jt ORDER BY n DESC, jt) FILTER (WHERE jt IS NOT NULL) AS jt, regexp_replace(lower(strip_accents(header)), '[^a-z0-9]', '', 'g') AS hk FROM n GROUP BY source_file_id, header),
a(alias, field) AS (VALUES {ALIAS_ROWS}), f AS (SELECT c.*, coalesce((SELECT field FROM a WHERE alias = hk), (SELECT field FROM a WHERE length(alias) >= 4 AND contains(hk, alias) ORDER BY length(alias) DESC, alias LIMIT 1), hk) AS field FROM c),
o AS (SELECT source_file_id, provider, row_number() OVER (PARTITION BY provider ORDER BY received_at NULLS FIRST, source_file_id) AS k FROM source_files), x AS (SELECT f.*, provider, k FROM f JOIN o USING (source_file_id)), later AS (SELECT * FROM o WHERE k > 1),
cur AS (SELECT l.source_file_id AS file, header, jt, field FROM later l JOIN x ON x.provider = l.provider AND x.k = l.k), was AS (SELECT l.source_file_id AS file, header, jt, field FROM later l JOIN x ON x.provider = l.provider AND x.k = l.k - 1),
fresh AS (SELECT *, row_number() OVER (PARTITION BY file, field ORDER BY header) AS nth FROM cur ANTI JOIN was USING (file, header)), gone AS (SELECT *, row_number() OVER (PARTITION BY file, field ORDER BY header) AS nth FROM was ANTI JOIN cur USING (file, header))
SELECT file AS source_file_id, 'retyped' AS change_kind, header AS old_name, header AS new_name FROM cur JOIN was USING (file, header) WHERE cur.jt <> was.jt UNION ALL
SELECT coalesce(a.file, b.file), CASE WHEN b.header IS NULL THEN 'added' WHEN a.header IS NULL THEN 'removed' ELSE 'renamed' END, coalesce(b.header, ''), coalesce(a.header, '') FROM fresh a FULL JOIN gone b ON a.file = b.file AND a.field = b.field AND a.nth = b.nth"""
P4_CASES_SQL = """SELECT * FROM (VALUES (0, 1, 'a'), (0, 2, 'b'), (0, 3, 'c'), (0, 4, 'd, e'), (0, 5, 'f'), (1, 1, 'x'), (1, 2, 'y-z'), (1, 3, 'q "r"'), (2, 1, 'fromages (frais / affinés)'), (2, 2, 'œufs'), (3, 1, 'a'), (3, 2, 'a'), (4, 1, 'open "q'), (4, 2, 'b'), (5, 1, 'a (b'), (5, 2, 'c')) AS t(case_no, pos, item)"""
P4_LISTS_SQL = """SELECT export_no, CAST(generate_subscripts(v, 1) AS INT) AS pos, unnest(v) AS item FROM (SELECT export_no, list_filter(list_transform(string_split_regex(sous_segment, '[|;]'), lambda x: trim(x)), lambda x: x <> '') AS v FROM producteurs_export WHERE sous_segment IS NOT NULL AND NOT regexp_matches(sous_segment, '[^\\p{L}\\p{N} |;]'))"""


def oracle_sql() -> dict[str, str]:
    return registry.ORACLES | {"p3_found": P3_SQL, "p3_columns": P3_COLUMNS_SQL, "p4_cases": P4_CASES_SQL, "p4_lists": P4_LISTS_SQL, "p5_found": P5_SQL}
