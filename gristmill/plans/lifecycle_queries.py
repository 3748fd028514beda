"""Snapshots, folds, JSON and quality over the domain's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators import lifecycle as L
from gristmill.operators import quality as Q
from gristmill.plans.registry import query
from gristmill.sources.tables import table

SNAPSHOTS = " ".join(f"{a} AS (SELECT siret, min(raisonSociale) AS raisonSociale, min(telephone) AS telephone, min(email) AS email FROM {t} WHERE siret IS NOT NULL GROUP BY siret){c}" for a, t, c in (("o", "population", ","), ("n", "eleveurs_export", "")))


def _snapshots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The registry as it stands, with holes, and the rows of an export as they come in: one row a siret each."""
    one = lambda name: table(spark, d, name).filter("siret IS NOT NULL").groupBy("siret").agg(*[F.min(c).alias(c) for c in ("raisonSociale", "telephone", "email")])
    return one("population"), one("eleveurs_export")


@query(f"WITH {SNAPSHOTS} SELECT coalesce(o.siret, n.siret) AS siret, coalesce(o.raisonSociale, n.raisonSociale) AS raisonSociale, coalesce(o.telephone, n.telephone) AS telephone, coalesce(o.email, n.email) AS email FROM o FULL JOIN n ON o.siret = n.siret")
def upsert_coalesce(spark: SparkSession, d: str) -> DataFrame:
    """New rows that fill holes and never overwrite."""
    return L.upsert_keep(*_snapshots(spark, d), "siret")


@query(f"WITH {SNAPSHOTS} SELECT * FROM o UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.siret = n.siret)")
def insert_if_absent(spark: SparkSession, d: str) -> DataFrame:
    """Old rows and those new ones that weren't there."""
    return L.insert_absent(*_snapshots(spark, d), "siret")


@query(f"WITH {SNAPSHOTS} SELECT o.siret, o.raisonSociale, coalesce(o.telephone, n.telephone) AS telephone, coalesce(o.email, n.email) AS email FROM o LEFT JOIN n ON o.siret = n.siret")
def fill_null(spark: SparkSession, d: str) -> DataFrame:
    """Holes of the old rows filled."""
    old, new = _snapshots(spark, d)
    return L.fill_nulls(old, new, "siret", ["telephone", "email"])


@query("SELECT row_id, source_file_id FROM ingest_rows WHERE source_file_id IS DISTINCT FROM 3")
def unload_file(spark: SparkSession, d: str) -> DataFrame:
    """Everything but what one file brought."""
    return L.without_file(table(spark, d, "ingest_rows").select("row_id", "source_file_id"), 3)


@query("SELECT digest, file_name FROM (SELECT md5(provider || sector) AS digest, file_name, sector FROM source_files) WHERE sector <> 'boulangerie' QUALIFY row_number() OVER (PARTITION BY digest ORDER BY file_name) = 1")
def resume_files(spark: SparkSession, d: str) -> DataFrame:
    """Files still to be read, by content hash."""
    files = table(spark, d, "source_files").select(F.md5(F.concat("provider", "sector")).alias("digest"), "file_name", "sector")
    return L.unseen_files(files.select("digest", "file_name"), files.filter("sector = 'boulangerie'"), "digest")


@query("""WITH e AS (SELECT user_id, ts, event_id, CASE event_type WHEN 'purchase' THEN 'actif' WHEN 'signup' THEN 'nouveau' WHEN 'logout' THEN 'ferme' END AS s FROM events), f AS (SELECT * FROM e WHERE s IS NOT NULL AND ts IS NOT NULL),
l AS (SELECT user_id, s FROM f QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1), z AS (SELECT user_id, s FROM f WHERE s = 'ferme' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT l.user_id, coalesce(z.s, l.s) AS status, n AS events FROM l LEFT JOIN z ON l.user_id = z.user_id JOIN (SELECT user_id, count(*) AS n FROM f GROUP BY user_id) c ON c.user_id = l.user_id""")
def event_fold_status(spark: SparkSession, d: str) -> DataFrame:
    """Status by dated events: the last word, unless a definitive one was said."""
    kind = F.col("event_type")
    status = F.when(kind == "purchase", "actif").when(kind == "signup", "nouveau").when(kind == "logout", "ferme")
    return L.fold_status(table(spark, d, "events"), "user_id", "ts", "event_id", status, ["ferme"]).select("user_id", "status", "events")


@query("""SELECT user_id, count(DISTINCT f) AS score, coalesce(string_agg(DISTINCT f, '+' ORDER BY f), '') AS proofs FROM (SELECT user_id, CASE WHEN (event_type = 'purchase' AND date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') BETWEEN 0 AND 10)
 OR (event_type = 'click' AND date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') BETWEEN 0 AND 5) OR (event_type = 'view' AND date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') BETWEEN 0 AND 3) THEN event_type END AS f FROM events) GROUP BY user_id""")
def liveness_score(spark: SparkSession, d: str) -> DataFrame:
    """A point for each family of proof inside its window."""
    got = L.liveness(table(spark, d, "events"), "user_id", "event_type", "ts", F.lit("2024-01-31").cast("date"), {"purchase": 10, "click": 5, "view": 3})
    return got.withColumn("score", F.col("score").cast("bigint"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_attr(spark: SparkSession, d: str) -> DataFrame:
    """An attribute of semi-structured text."""
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT raw_id, coalesce(raw_json->>'CP', raw_json->>'CP ', raw_json->>'Code_Postal', raw_json->>'code postal') AS postcode FROM raw_rows")
def json_coalesced_keys(spark: SparkSession, d: str) -> DataFrame:
    """The first of several keys that a row has."""
    keys = [F.get_json_object("raw_json", f"$['{k}']") for k in ("CP", "CP ", "Code_Postal", "code postal")]
    return table(spark, d, "raw_rows").select("raw_id", F.coalesce(*keys).alias("postcode"))


@query("""SELECT row_id, naf_label AS a, coalesce(status_raw, naf_label) AS b, status_raw AS c FROM (SELECT row_id, coalesce(naf_label, '-') AS naf_label, status_raw FROM ingest_rows)""")
def json_merge_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """Attributes merged so that no key is lost and the later value of a key wins."""
    own = F.create_map(F.lit("a"), F.coalesce("naf_label", F.lit("-")), F.lit("b"), F.coalesce("naf_label", F.lit("-")))
    late = F.when(F.col("status_raw").isNotNull(), F.create_map(F.lit("b"), F.col("status_raw"), F.lit("c"), F.col("status_raw"))).otherwise(F.create_map().cast("map<string,string>"))
    entries = F.concat(F.filter(F.map_entries(own), lambda e: ~F.map_contains_key(late, e["key"])), F.map_entries(late))
    merged = table(spark, d, "ingest_rows").select("row_id", F.map_from_entries(entries).alias("m"))
    return merged.select("row_id", *[F.element_at("m", k).alias(k) for k in ("a", "b", "c")])


PROFILE_COLUMNS = ["siret", "raisonSociale", "enseigne", "telephone", "email", "codePostal", "ville", "lat"]


@query("WITH n AS (SELECT count(*) AS rows FROM population) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", any_value(n.rows) AS rows, count(*) FILTER (WHERE trim({c}) <> '') AS filled, round(100.0 * count(*) FILTER (WHERE trim({c}) <> '') / any_value(n.rows), 2) AS percent FROM population, n" for c in PROFILE_COLUMNS))
def profile_completeness(spark: SparkSession, d: str) -> DataFrame:
    """How full each column is."""
    return Q.completeness(table(spark, d, "population").select(*PROFILE_COLUMNS))


@query("SELECT source AS value, count(*) AS n FROM listings GROUP BY 1 ORDER BY n DESC, value LIMIT 20")
def profile_top_values(spark: SparkSession, d: str) -> DataFrame:
    """Most frequent sources."""
    return Q.value_counts(table(spark, d, "listings"), "source")


@query("""WITH a AS (SELECT DISTINCT siret FROM population WHERE siret IS NOT NULL), b AS (SELECT DISTINCT siret FROM eleveurs_export WHERE siret IS NOT NULL) SELECT (SELECT count(*) FROM a) AS in_a, (SELECT count(*) FROM b) AS in_b,
(SELECT count(*) FROM a JOIN b USING (siret)) AS common, round(100.0 * (SELECT count(*) FROM a JOIN b USING (siret)) / least((SELECT count(*) FROM a), (SELECT count(*) FROM b)), 2) AS percent_of_smaller""")
def set_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers that two tables have in common."""
    return Q.overlap(table(spark, d, "population"), table(spark, d, "eleveurs_export"), "siret")


@query("""SELECT 'population.siret_shape' AS "check", count(*) FILTER (WHERE NOT regexp_matches(siret, '^[0-9]{14}$')) AS value, 'FAIL' AS severity FROM population UNION ALL
SELECT 'population.siren_is_left_of_siret', count(*) FILTER (WHERE siren <> substr(siret, 1, 9)), 'FAIL' FROM population UNION ALL SELECT 'population.postcode_shape', count(*) FILTER (WHERE NOT regexp_matches(codePostal, '^[0-9]{5}$')), 'WARN' FROM population UNION ALL
SELECT 'listings.unique_listing_no', count(*), 'FAIL' FROM (SELECT listing_no FROM listings GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'ingest_rows.orphan_source_file_id', count(*), 'FAIL' FROM ingest_rows r WHERE source_file_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM source_files f WHERE f.source_file_id = r.source_file_id) UNION ALL
SELECT 'lineitem.orphan_l_orderkey', count(*), 'FAIL' FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)""")
def dq_report(spark: SparkSession, d: str) -> DataFrame:
    """Assertions about the tables with how many rows break each."""
    pop, lines = table(spark, d, "population"), table(spark, d, "lineitem").select("l_orderkey")
    rules = {"siret_shape": (F.col("siret").rlike("^[0-9]{14}$"), "FAIL"), "siren_is_left_of_siret": (F.col("siren") == F.substring("siret", 1, 9), "FAIL"), "postcode_shape": (F.col("codePostal").rlike("^[0-9]{5}$"), "WARN")}
    parts = [Q.checks(pop, "population", rules), Q.uniqueness(table(spark, d, "listings"), "listings", ["listing_no"]),
             Q.orphans(table(spark, d, "ingest_rows"), "ingest_rows", "source_file_id", table(spark, d, "source_files"), "source_file_id"), Q.orphans(lines, "lineitem", "l_orderkey", table(spark, d, "orders"), "o_orderkey")]
    return Q.report(parts).select("check", "value", "severity")


@query("""SELECT c_mktsegment, n, coalesce(CAST(low AS VARCHAR), '-') AS low, coalesce(CAST(ok0 AS VARCHAR), '-') AS ok FROM (SELECT c_mktsegment, n, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 WHEN c_mktsegment = 'MACHINERY' THEN 1000000 END AS low, n BETWEEN CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 WHEN c_mktsegment = 'MACHINERY' THEN 1000000.0 END AND 2000000.0 AS ok0
FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1))""")
def dq_bands(spark: SparkSession, d: str) -> DataFrame:
    """Counts against their expected bands."""
    counts = table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    got = Q.bands(counts, "c_mktsegment", "n", {"BUILDING": (1, 2_000_000), "MACHINERY": (1_000_000, 2_000_000)})
    return got.select("c_mktsegment", "n", F.coalesce(F.col("low").cast("int").cast("string"), F.lit("-")).alias("low"), F.coalesce(F.col("ok").cast("string"), F.lit("-")).alias("ok"))


@query("""WITH a AS (SELECT source, count(*) AS n FROM listings GROUP BY 1), b AS (SELECT source, count(*) AS n FROM listings WHERE phone IS NOT NULL GROUP BY 1)
SELECT a.source, a.n AS before, coalesce(b.n, 0) AS after, coalesce(b.n, 0) >= a.n * 0.8 AS ok FROM a LEFT JOIN b ON a.source = b.source""")
def no_regression(spark: SparkSession, d: str) -> DataFrame:
    """Counts that may not fall by more than a fifth."""
    rows = table(spark, d, "listings")
    before = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    after = rows.filter("phone IS NOT NULL").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return Q.no_regression(before, after, "source", "n", 0.2)


@query("SELECT coalesce(lower(trim(email_statut)), '-') AS known, CASE WHEN email_final LIKE '%@%.%' THEN 'shaped' ELSE 'broken' END AS judged, count(*) AS n FROM producteurs_export GROUP BY 1, 2")
def verifier_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Known verdicts against a judge's."""
    rows = table(spark, d, "producteurs_export").select(F.coalesce(F.lower(F.trim("email_statut")), F.lit("-")).alias("known"), F.when(F.col("email_final").like("%@%.%"), "shaped").otherwise("broken").alias("judged"))
    return Q.confusion(rows, "known", "judged")


@query("""SELECT siret, first_name, products FROM (SELECT siret, (SELECT g.gerant FROM eleveurs_export g WHERE g.siret = e.siret AND g.gerant IS NOT NULL ORDER BY g.export_no LIMIT 1) AS first_name,
 list_aggregate(list_sort(list_distinct(flatten(list(string_split_regex(productions, '\\s*[|;]\\s*')) FILTER (WHERE productions IS NOT NULL)))), 'string_agg', '|') AS products FROM eleveurs_export e WHERE siret IS NOT NULL GROUP BY siret)""")
def merged_certificates(spark: SparkSession, d: str) -> DataFrame:
    """Rows of one identifier merged: first scalar, lists without repeats."""
    rows = table(spark, d, "eleveurs_export").filter("siret IS NOT NULL").select("siret", "export_no", F.col("gerant").alias("first_name"), F.col("productions").alias("products"))
    got = L.merge_certificates(rows, "siret", ["first_name"], ["products"], "export_no")
    return got.withColumn("products", F.nullif("products", F.lit("")))


STATUS = "CASE WHEN contains(lower(trim({c})), 'actif') THEN true WHEN regexp_matches(lower(trim({c})), 'ferm|cess|radié|radie') THEN false END"


@query(f"""WITH t AS (SELECT CAST(source_file_id AS VARCHAR) || '/' || row_index AS k, raw_id, nullif(trim(coalesce(raw_json->>'Statut_Activite', raw_json->>'STATUT', raw_json->>'Etat', raw_json->>'etat')), '') AS said FROM raw_rows),
f AS (SELECT k, {STATUS.format(c='said')} AS s FROM t WHERE said IS NOT NULL AND k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY s IS NULL, coalesce(s, false), said, raw_id) = 1)
SELECT row_id, coalesce({STATUS.format(c='status_raw')}, f.s) AS is_active FROM ingest_rows LEFT JOIN f ON f.k = CAST(source_file_id AS VARCHAR) || '/' || row_index""")
def status_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Unknown states filled from the landed rows they came from."""
    from gristmill.functions.contact import normalize_status

    key = F.concat(F.col("source_file_id").cast("string"), F.lit("/"), F.col("row_index").cast("string")).alias("k")
    rows = table(spark, d, "ingest_rows").select("row_id", key, normalize_status(F.col("status_raw")).alias("is_active"))
    raw = table(spark, d, "raw_rows").select(key, "raw_json", "raw_id")
    return L.backfill_status(rows, raw, "k", "raw_json", ["Statut_Activite", "STATUT", "Etat", "etat"], "raw_id").select("row_id", "is_active")


@query("""SELECT 'load' AS run, '{"customers":' || (SELECT count(*) FROM customer) || ',"orders":' || (SELECT count(*) FROM orders) || '}' AS counts""")
def run_audit(spark: SparkSession, d: str) -> DataFrame:
    """What a run found, as a row to append."""
    return L.audit_row("load", orders=table(spark, d, "orders"), customers=table(spark, d, "customer"))


@query("""WITH p AS (SELECT user_id, count(DISTINCT event_type) AS n, max(event_type = 'signup') AS active, max(event_type = 'logout') AS alert, min(event_type = 'view') AS provider FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN active AND n >= 2 AND NOT provider AND NOT alert THEN 'Sûr' WHEN n >= 1 THEN 'Probable' END AS level FROM p""")
def confidence_levels(spark: SparkSession, d: str) -> DataFrame:
    """How sure an entity is, by its state, proofs and alerts."""
    kind = F.col("event_type")
    facts = table(spark, d, "events").groupBy("user_id").agg(F.countDistinct(kind).alias("n"), F.max(kind == "signup").alias("active"), F.max(kind == "logout").alias("alert"), F.min(kind == "view").alias("provider"))
    return facts.select("user_id", L.confidence_level(F.col("active"), F.col("n"), F.col("provider"), F.col("alert")).alias("level"))
