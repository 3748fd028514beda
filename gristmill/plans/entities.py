"""Duplicates, claims and matches over the domain's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import contact, names
from gristmill.functions.text import norm
from gristmill.operators import cascade, claims, dedup, lifecycle
from gristmill.plans.registry import query
from gristmill.plans.scalars import HOST_SQL, NORM_SQL
from gristmill.sources.tables import table


@query(f"""WITH r AS (SELECT row_id, siret, loaded_at, {NORM_SQL.format(c='trade_name')} AS k, postal_code FROM ingest_rows), g AS (SELECT *, count(*) OVER (PARTITION BY k, postal_code) AS members,
 first_value(row_id) OVER (PARTITION BY k, postal_code ORDER BY siret IS NULL, loaded_at, row_id) AS survivor FROM r WHERE k <> '' AND postal_code <> ''), h AS (SELECT g.*, s.siret AS ssiret FROM g JOIN r s ON s.row_id = survivor WHERE members > 1)
SELECT row_id, survivor, members FROM h WHERE row_id <> survivor AND (siret IS NULL OR siret IS NOT DISTINCT FROM ssiret)""")
def dedup_exact_key(spark: SparkSession, d: str) -> DataFrame:
    """Rows of equal name and postcode, with their survivor; different identifiers are never merged."""
    rows = table(spark, d, "ingest_rows").select("row_id", "siret", "loaded_at", "trade_name", "postal_code")
    return dedup.exact_key(rows, "row_id", [norm(F.col("trade_name")), F.col("postal_code")], "siret", [F.col("siret").isNull(), F.col("loaded_at")])


TRIGRAM_SQL = """WITH p AS (SELECT siret, codePostal, list_sort(list_distinct(flatten(list_transform(list_filter(string_split_regex(lower(n), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))) AS g FROM
 (SELECT siret, min(codePostal) AS codePostal, min({n}) AS n FROM population GROUP BY siret)), m AS (SELECT *, min(siret) OVER (PARTITION BY codePostal, g) AS rep FROM p WHERE codePostal IS NOT NULL AND len(g) > 0), r AS (SELECT * FROM m WHERE siret = rep),
j AS (SELECT a.siret AS id_a, b.siret AS id_b, len(list_intersect(a.g, b.g)) AS c, len(a.g) AS x, len(b.g) AS y FROM r a JOIN r b ON a.codePostal = b.codePostal AND a.siret < b.siret)
SELECT id_a, id_b, round(c / (x + y - c), 6) AS similarity FROM j WHERE c / (x + y - c) >= 0.6 UNION ALL SELECT rep, siret, 1.0 FROM m WHERE siret <> rep"""


@query(TRIGRAM_SQL.format(n="strip_accents(raisonSociale)"))
def dedup_fuzzy_trigram(spark: SparkSession, d: str) -> DataFrame:
    """Names of one postcode that are alike by trigrams: pairs of different names, and each copy with the first of its name."""
    from gristmill.functions.text import unaccent

    rows = table(spark, d, "population").groupBy("siret").agg(F.min("codePostal").alias("codePostal"), F.min(unaccent(F.col("raisonSociale"))).alias("n"))
    return dedup.similar_pairs(rows, "siret", F.col("n"), ["codePostal"], 0.6).withColumn("similarity", F.round("similarity", 6))


@query()
def dedup_three_passes(spark: SparkSession, d: str) -> DataFrame:
    """Rows marked by exact key, by key without legal form, and by likeness; marked rows stay."""
    rows = table(spark, d, "ingest_rows").select("row_id", "siret", "loaded_at", "trade_name", "postal_code", "phone_main")
    order = [F.col("siret").isNull(), F.col("loaded_at")]
    one = dedup.exact_key(rows, "row_id", [norm(F.col("trade_name")), F.col("postal_code")], "siret", order)
    two = dedup.exact_key(rows, "row_id", [names.stripped_key(F.col("trade_name")), F.col("postal_code")], "siret", order)
    alike = dedup.similar_pairs(rows, "row_id", F.lower("trade_name"), ["postal_code", "phone_main"], 0.85)
    three = alike.select(F.col("id_b").alias("row_id"), F.col("id_a").alias("survivor"))
    return dedup.mark(rows.select("row_id"), "row_id", [one, two, three])


WAYS_SQL = "CASE w " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in [("AV", "AVENUE"), ("AVE", "AVENUE"), ("BD", "BOULEVARD"), ("BLD", "BOULEVARD"), ("BVD", "BOULEVARD"), ("CH", "CHEMIN"), ("CHE", "CHEMIN"), ("CHEM", "CHEMIN"), ("RTE", "ROUTE"), ("R", "RUE"), ("PL", "PLACE"), ("IMP", "IMPASSE"), ("ALL", "ALLEE"), ("ST", "SAINT"), ("STE", "SAINTE")]) + " ELSE w END"
SET_SQL = "list_distinct(list_filter(string_split(" + NORM_SQL + ", ' '), lambda x: x <> ''))"
CP_SQL = """regexp_extract(CASE WHEN regexp_matches(substr(regexp_replace(regexp_replace(trim({c}), '\\.0+$', ''), '[\\s.]', '', 'g'), 1, 5), '^[0-9]{{4}}$') THEN '0' ELSE '' END || substr(regexp_replace(regexp_replace(trim({c}), '\\.0+$', ''), '[\\s.]', '', 'g'), 1, 5), '^([0-9]{{5}})$', 1)"""
TOWN_SQL = "nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(' ' || replace(" + NORM_SQL + ", ' ', '  ') || ' ', ' STE ', ' SAINTE ', 'g'), ' ST ', ' SAINT ', 'g'), '([A-Z0-9])  S  ([A-Z0-9])', '\\1  SUR  \\2', 'g'), '  +', ' ', 'g')), '')"
NUM_SQL = "try_cast(replace(regexp_replace({c}, '[\\s' || chr(160) || ']+', '', 'g'), ',', '.') AS DOUBLE)"
STREET_SQL = "regexp_replace(coalesce({c}, ''), '[\\s,;-]+[0-9]{{5}}(?:[^0-9A-Za-z_].*)?$', '')"
ALL_SQL = "concat_ws(' ', raisonSociale, denomination_legale, gerant)"
SIDE_SQL = f"""SELECT *, CASE WHEN right_way THEN a WHEN turned THEN b END AS lat, CASE WHEN right_way THEN b WHEN turned THEN a END AS lon, regexp_extract(bare, '\\b([0-9]{{{{1,4}}}})(?:BIS|TER|B|T)?\\b', 1) AS house,
 list_distinct(list_filter(list_transform(string_split(bare, ' '), lambda w: {WAYS_SQL}), lambda w: NOT regexp_matches(w, '^([0-9]+(BIS|TER|B|T)?|BIS|TER|N|NO|[A-Z])?$') AND w NOT IN ('DE', 'DU', 'DES', 'LA', 'LE', 'LES'))) AS street
 FROM (SELECT *, coalesce(a BETWEEN 41 AND 51.5 AND b BETWEEN -5.5 AND 10, false) AS right_way, coalesce(b BETWEEN 41 AND 51.5 AND a BETWEEN -5.5 AND 10, false) AS turned FROM ({{inner}}))"""
CASCADE_SQL = f"""WITH l AS MATERIALIZED ({SIDE_SQL.format(inner=f"SELECT DISTINCT ON (listing_no) listing_no AS l, {SET_SQL.format(c='name')} AS words, {SET_SQL.format(c='alt_name')} AS other, {TOWN_SQL.format(c='city')} AS commune, regexp_replace(coalesce(siret, ''), '[^0-9]', '', 'g') AS digits, nullif({CP_SQL.format(c='postcode')}, '') AS cp, {NUM_SQL.format(c='lat')} AS a, {NUM_SQL.format(c='lon')} AS b, {NORM_SQL.format(c=STREET_SQL.format(c='address'))} AS bare FROM listings")}),
p0 AS (SELECT * FROM population QUALIFY row_number() OVER (PARTITION BY siret ORDER BY raisonSociale NULLS FIRST, adresse NULLS FIRST, codePostal NULLS FIRST, lat NULLS FIRST, lon NULLS FIRST, date_creation NULLS FIRST, enseigne NULLS FIRST, denomination_legale NULLS FIRST, gerant NULLS FIRST, ville NULLS FIRST) = 1),
p AS MATERIALIZED ({SIDE_SQL.format(inner=f"SELECT siret AS p, list_filter([{', '.join(SET_SQL.format(c=c) for c in ['raisonSociale', 'enseigne', 'denomination_legale', 'gerant'])}, {SET_SQL.format(c=ALL_SQL)}], lambda s: len(s) > 0) AS sets, {TOWN_SQL.format(c='ville')} AS commune, nullif({CP_SQL.format(c='codePostal')}, '') AS cp, coalesce(nullif(CAST(try_strptime(date_creation, ['%Y-%m-%d', '%d/%m/%Y']) AS DATE), DATE '1900-01-01'), DATE '0001-01-01') AS opened, {NUM_SQL.format(c='lat')} AS a, {NUM_SQL.format(c='lon')} AS b, {NORM_SQL.format(c=STREET_SQL.format(c='adresse'))} AS bare FROM p0")}),
like_names AS MATERIALIZED (SELECT DISTINCT words, p, len(list_intersect(words, s)) / len(list_distinct(list_concat(words, s))) AS score FROM (SELECT DISTINCT words FROM (SELECT words FROM l UNION ALL SELECT other FROM l) WHERE len(words) > 0) w JOIN (SELECT p, unnest(sets) AS s FROM p) ON list_has_any(words, s) WHERE len(list_intersect(words, s)) / len(list_distinct(list_concat(words, s))) >= 0.62),
sib AS (SELECT l.l, max(p.p) FILTER (WHERE p.p = l.digits) AS exact, count(*) AS n, count(*) FILTER (WHERE p.cp = l.cp) AS n_cp, min(p.p) AS any_p, min(p.p) FILTER (WHERE p.cp = l.cp) AS local FROM l JOIN p ON length(l.digits) >= 9 AND substr(l.digits, 1, 9) = substr(p.p, 1, 9) GROUP BY l.l),
r1 AS (SELECT l, coalesce(exact, CASE WHEN n = 1 THEN any_p END, local) AS p, CASE WHEN exact IS NOT NULL THEN 'siret_exact' ELSE 'siren_unique' END AS rung, NULL AS reason FROM sib WHERE exact IS NOT NULL OR n = 1 OR n_cp = 1),
near AS (SELECT l.l, p.p, 2 * 6371000 * asin(sqrt(least(1.0, pow(sin(radians(p.lat - l.lat) / 2), 2) + cos(radians(l.lat)) * cos(radians(p.lat)) * pow(sin(radians(p.lon - l.lon) / 2), 2)))) AS m, l.words FROM l ANTI JOIN r1 ON r1.l = l.l JOIN p ON abs(l.lat - p.lat) < 0.0015
 AND CASE WHEN l.commune IN (SELECT commune FROM p WHERE commune IS NOT NULL) THEN p.commune IS NOT DISTINCT FROM l.commune WHEN l.cp IN (SELECT cp FROM p WHERE cp IS NOT NULL) THEN p.cp IS NOT DISTINCT FROM l.cp ELSE true END),
named AS (SELECT near.l, near.p, m, bool_or(n.p IS NOT NULL) AS named FROM near LEFT JOIN like_names n ON n.words = near.words AND n.p = near.p WHERE m <= 150 GROUP BY ALL),
top AS (SELECT l, row_number() OVER (PARTITION BY l ORDER BY named DESC, m, p) AS k, p, m, named FROM named), two AS (SELECT x.*, y.m AS m2, coalesce(y.named, false) AS named2 FROM top x LEFT JOIN top y ON y.l = x.l AND y.k = 2 WHERE x.k = 1),
r2 AS (SELECT l, CASE WHEN ok THEN p END AS p, rung, CASE WHEN NOT ok THEN 'several_near' END AS reason FROM (SELECT l, p, CASE WHEN named THEN 'geo_name' ELSE 'geo_only' END AS rung, CASE WHEN named THEN NOT named2 OR m2 - m >= 5 ELSE coalesce(m2 > 40, true) END AS ok FROM two WHERE named OR m <= 40)),
at_address AS (SELECT DISTINCT l.l, p.p, p.opened, n.p IS NOT NULL AS named FROM l ANTI JOIN r1 ON r1.l = l.l ANTI JOIN r2 ON r2.l = l.l JOIN p ON l.cp = p.cp AND l.house = p.house AND l.house <> '' LEFT JOIN like_names n ON n.words = l.words AND n.p = p.p
 WHERE len(list_intersect(l.street, p.street)) > 0 AND len(list_intersect(l.street, p.street)) / len(list_distinct(list_concat(l.street, p.street))) >= 0.6),
counted AS (SELECT l, count(*) AS n, count(*) FILTER (WHERE named) AS n_named, min(p) AS only_p, min(p) FILTER (WHERE named) AS name_p, list(p ORDER BY opened DESC, p)[1] AS newest, list(opened ORDER BY opened DESC, p) AS days FROM at_address GROUP BY l),
r3 AS (SELECT l, CASE WHEN n = 1 THEN only_p WHEN n_named = 1 THEN name_p WHEN days[1] - days[2] >= 365 THEN newest END AS p, CASE WHEN n = 1 THEN 'addr_street' WHEN n_named = 1 THEN 'addr_name' ELSE 'addr_recent' END AS rung, CASE WHEN n > 1 AND n_named <> 1 AND days[1] - days[2] < 365 THEN 'one_address' END AS reason FROM counted),
tries AS (SELECT l.l, t.turn * 2 + 0 AS k, t.words, p.p FROM l ANTI JOIN r1 ON r1.l = l.l ANTI JOIN r2 ON r2.l = l.l ANTI JOIN r3 ON r3.l = l.l JOIN (SELECT l, 0 AS turn, words FROM l UNION ALL SELECT l, 1, other FROM l) t ON t.l = l.l JOIN p ON p.cp = l.cp
 UNION ALL SELECT l.l, t.turn * 2 + 1, t.words, p.p FROM l ANTI JOIN r1 ON r1.l = l.l ANTI JOIN r2 ON r2.l = l.l ANTI JOIN r3 ON r3.l = l.l JOIN (SELECT l, 0 AS turn, words FROM l UNION ALL SELECT l, 1, other FROM l) t ON t.l = l.l JOIN p ON p.commune = l.commune),
scored AS (SELECT l, k, tries.p, max(score) AS score FROM tries JOIN like_names n ON n.words = tries.words AND n.p = tries.p GROUP BY ALL), ranked AS (SELECT *, row_number() OVER (PARTITION BY l, k ORDER BY score DESC, p) AS place FROM scored),
judged AS (SELECT a.l, a.k, a.p, a.score, a.score - coalesce(b.score, 0) > 0.02 AS clear FROM ranked a LEFT JOIN ranked b ON b.l = a.l AND b.k = a.k AND b.place = 2 WHERE a.place = 1),
r4 AS (SELECT l, first(p ORDER BY k) FILTER (WHERE clear) AS p, CASE WHEN coalesce(first(score ORDER BY k) FILTER (WHERE clear), 0) = 1 THEN 'name_exact' ELSE 'name_fuzzy' END AS rung, CASE WHEN NOT bool_or(clear) THEN 'several_names' END AS reason FROM judged GROUP BY l),
m AS (SELECT *, CASE WHEN p IS NULL THEN 'reject' ELSE 'hit' END AS outcome FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3 UNION ALL SELECT * FROM r4))"""


def _matched(spark: SparkSession, d: str) -> DataFrame:
    return cascade.match(cascade.listing_side(table(spark, d, "listings")), cascade.registry_side(table(spark, d, "population")))


@query(f"{CASCADE_SQL} SELECT l AS listing_no, p AS siret, rung, outcome FROM m")
def match_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Listings matched by rungs of falling evidence, rejections with their rung."""
    return _matched(spark, d).select(F.col("l").alias("listing_no"), F.col("p").alias("siret"), "rung", "outcome")


@query(f"{CASCADE_SQL} SELECT rung, outcome, count(*) AS n FROM m GROUP BY ALL")
def match_rungs(spark: SparkSession, d: str) -> DataFrame:
    """How many listings each rung decided."""
    return match_cascade(spark, d).groupBy("rung", "outcome").agg(F.count(F.lit(1)).alias("n"))


@query(f"{CASCADE_SQL} SELECT l AS listing_no, rung, reason FROM m WHERE outcome = 'reject'")
def match_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Listings a rung rejected and why."""
    return _matched(spark, d).filter("outcome = 'reject'").select(F.col("l").alias("listing_no"), "rung", "reason")


@query(f"""{CASCADE_SQL} SELECT p AS siret, source, list(l ORDER BY list_position(['siret_exact', 'siren_unique', 'geo_only', 'geo_name', 'addr_street', 'addr_name', 'addr_recent', 'name_exact', 'name_fuzzy'], rung), l)[1] AS listing_no, count(*) - 1 AS beaten
FROM m JOIN (SELECT DISTINCT listing_no AS l, source FROM listings) USING (l) WHERE outcome = 'hit' GROUP BY p, source""")
def match_winners(spark: SparkSession, d: str) -> DataFrame:
    """One listing for each establishment and source: the one matched by the best evidence."""
    sources = table(spark, d, "listings").select(F.col("listing_no").alias("l"), "source")
    return cascade.winners(_matched(spark, d), sources).select(F.col("p").alias("siret"), "source", F.col("l").alias("listing_no"), "beaten")


def _phones(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "producteurs_export")
    return rows.select(contact.clean_siret(F.col("siret")).alias("siret"), contact.national_digits(F.col("telephone_final")).alias("phone"), contact.source_label(F.col("source_telephone")).alias("source")).filter("siret IS NOT NULL")


SIRET_SQL = "regexp_replace(regexp_replace(trim(siret), '\\.0+$', ''), '[\\s.\\-]', '', 'g')"
DIGITS_SQL = "regexp_replace(regexp_replace(regexp_replace(telephone_final, '[^0-9]', '', 'g'), '^0033([0-9]{9})$', '0\\1'), '^33([0-9]{9})$', '0\\1')"
CLAIMS_SQL = f"""c AS (SELECT * FROM (SELECT {SIRET_SQL} AS siret, CASE WHEN regexp_matches({DIGITS_SQL}, '^0[1-9][0-9]{{8}}$') THEN {DIGITS_SQL} END AS phone,
 lower(trim(regexp_replace(source_telephone, '(?s)\\(.*$', ''))) AS source FROM producteurs_export) WHERE regexp_matches(siret, '^[0-9]{{14}}$'))"""


@query(f"WITH {CLAIMS_SQL} SELECT siret, phone, count(DISTINCT source) AS n_sources, 'corrobore(' || string_agg(DISTINCT source, '+' ORDER BY source) || ')' AS label FROM c WHERE phone IS NOT NULL AND source IS NOT NULL GROUP BY siret, phone HAVING count(DISTINCT source) >= 2")
def corroborated_claims(spark: SparkSession, d: str) -> DataFrame:
    """Phones that two sources or more give for an establishment."""
    return claims.corroborated(_phones(spark, d), "siret", "phone", "source").withColumn("n_sources", F.col("n_sources").cast("bigint"))


@query(f"WITH {CLAIMS_SQL} SELECT phone, count(DISTINCT siret) AS entities FROM c WHERE phone IS NOT NULL GROUP BY phone HAVING count(DISTINCT siret) > 2")
def switchboard_guard(spark: SparkSession, d: str) -> DataFrame:
    """Phones claimed for more than two establishments."""
    return claims.shared_values(_phones(spark, d), "siret", "phone", 2)


@query(f"""WITH {CLAIMS_SQL}, e AS (SELECT siret, source, list(DISTINCT phone) AS v FROM c WHERE phone IS NOT NULL AND source IS NOT NULL GROUP BY siret, source)
SELECT a.source, count(*) FILTER (WHERE list_has_any(a.v, b.v)) AS agree, count(*) FILTER (WHERE NOT list_has_any(a.v, b.v)) AS disagree FROM e a JOIN e b ON a.siret = b.siret AND a.source <> b.source GROUP BY a.source""")
def witness_agreement(spark: SparkSession, d: str) -> DataFrame:
    """How often each source agrees with the others."""
    return claims.agreement(_phones(spark, d), "siret", "phone", "source")


def _ranked(spark: SparkSession, d: str) -> DataFrame:
    ranks = table(spark, d, "source_ranks").filter("field = 'telephone_final'").select("source", "rank_hint")
    return _phones(spark, d).join(F.broadcast(ranks), "source", "left")


RANKED_SQL = f"WITH {CLAIMS_SQL}, r AS (SELECT c.*, coalesce(rank_hint, 1073741824) AS rank FROM c LEFT JOIN (SELECT * FROM source_ranks WHERE field = 'telephone_final') k ON k.source = c.source WHERE phone IS NOT NULL)"


@query(f"{RANKED_SQL} SELECT siret, phone, source FROM r QUALIFY row_number() OVER (PARTITION BY siret ORDER BY rank, phone, source NULLS FIRST) = 1")
def ranked_source_pick(spark: SparkSession, d: str) -> DataFrame:
    """Each establishment's phone of the best ranked source."""
    return claims.ranked_pick(_ranked(spark, d), "siret", "phone", "source", F.col("rank_hint"))


@query(f"""{RANKED_SQL}, e AS (SELECT siret, phone, row_number() OVER (PARTITION BY siret ORDER BY min(rank), phone) AS place FROM r GROUP BY siret, phone)
SELECT siret, max(phone) FILTER (WHERE place = 1) AS first, coalesce(string_agg(phone, ' | ' ORDER BY place) FILTER (WHERE place BETWEEN 2 AND 4), '') AS others FROM e GROUP BY siret""")
def ranked_list_alternates(spark: SparkSession, d: str) -> DataFrame:
    """First phone and up to three others, by rank."""
    return claims.ranked_list(_ranked(spark, d), "siret", "phone", F.col("rank_hint"))


@query(f"SELECT h AS host, count(DISTINCT listing_id) AS entities FROM (SELECT listing_id, {HOST_SQL.format(c='website')} AS h FROM listings) WHERE h IS NOT NULL GROUP BY h HAVING count(DISTINCT listing_id) > 1")
def shared_domain(spark: SparkSession, d: str) -> DataFrame:
    """Websites that several entries claim."""
    rows = table(spark, d, "listings").select("listing_id", contact.host_of(F.col("website")).alias("host"))
    return claims.shared_values(rows, "listing_id", "host", 1)


@query(f"""WITH p AS (SELECT export_no, CASE WHEN regexp_matches({SIRET_SQL}, '^[0-9]{{14}}$') THEN {SIRET_SQL} END AS siret, CASE WHEN regexp_matches({DIGITS_SQL}, '^0[1-9][0-9]{{8}}$') THEN {DIGITS_SQL} END AS phone FROM producteurs_export),
sent AS (SELECT DISTINCT {DIGITS_SQL.replace('telephone_final', 'telephone')} AS phone FROM eleveurs_export), k AS (SELECT *, phone IN (SELECT phone FROM sent WHERE phone IS NOT NULL) AS was FROM p), o AS (SELECT *, min(export_no) OVER (PARTITION BY coalesce(siret, 'x' || export_no)) AS s1 FROM k WHERE phone IS NOT NULL AND NOT was),
h AS (SELECT *, min(export_no) FILTER (WHERE s1 = export_no) OVER (PARTITION BY phone) AS p1 FROM o)
SELECT k.export_no, k.siret, k.phone, CASE WHEN k.phone IS NULL THEN 'no_phone' WHEN k.was THEN 'sent' WHEN h.s1 < k.export_no THEN 'repeat' WHEN h.p1 < k.export_no THEN 'merged' ELSE 'kept' END AS outcome, CASE WHEN k.phone IS NOT NULL AND NOT k.was AND h.s1 = k.export_no AND h.p1 < k.export_no THEN h.p1 END AS "into" FROM k LEFT JOIN h USING (export_no)""")
def call_sheet(spark: SparkSession, d: str) -> DataFrame:
    """Which exported rows reach the call sheet, and what became of the others."""
    rows = table(spark, d, "producteurs_export").select("export_no", contact.clean_siret(F.col("siret")).alias("siret"), contact.national_digits(F.col("telephone_final")).alias("phone"))
    sent = table(spark, d, "eleveurs_export").select(contact.national_digits(F.col("telephone")).alias("phone")).filter("phone IS NOT NULL")
    return lifecycle.call_sheet(rows, "export_no", "siret", "phone", sent)
