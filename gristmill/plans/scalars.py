"""Scalar functions over the domain's own columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import contact, dates, emails, geo, names, pages, places
from gristmill.functions.text import norm
from gristmill.plans.registry import query
from gristmill.sources.tables import table


@query("""WITH t AS (SELECT listing_no, regexp_replace(regexp_replace(CASE WHEN lower(trim(replace(siret, chr(160), ' '))) IN ('', 'nan', 'none', 'null') THEN NULL ELSE trim(replace(siret, chr(160), ' ')) END, '\\.0+$', ''), '[\\s.\\-]', '', 'g') AS d FROM listings)
SELECT listing_no, CASE WHEN regexp_matches(d, '^[0-9]{14}$') AND d <> '00000000000000' THEN d END AS siret, CASE WHEN regexp_matches(d, '^[0-9]{14}$') AND d <> '00000000000000' THEN substr(d, 1, 9) END AS siren,
CASE WHEN regexp_matches(d, '^([0-9]{8}|[0-9]{12}|[0-9]{13})$') THEN d END AS truncated FROM t""")
def clean_identifiers(spark: SparkSession, d: str) -> DataFrame:
    """Usable, derived and truncated identifiers."""
    s = contact.clean_siret(F.col("siret"))
    return table(spark, d, "listings").select("listing_no", s.alias("siret"), contact.siret_to_siren(s).alias("siren"), contact.truncated_identifier(F.col("siret")).alias("truncated"))


@query("""WITH t AS (SELECT listing_no, regexp_replace(phone, '[^0-9]', '', 'g') AS d FROM listings), n AS (SELECT listing_no, CASE WHEN regexp_matches(d, '^0033[0-9]{9}$') THEN '0' || substr(d, 5) WHEN regexp_matches(d, '^33[0-9]{9}$') THEN '0' || substr(d, 3) ELSE d END AS d FROM t)
SELECT listing_no, CASE WHEN regexp_matches(d, '^0[1-9][0-9]{8}$') THEN substr(d,1,2)||' '||substr(d,3,2)||' '||substr(d,5,2)||' '||substr(d,7,2)||' '||substr(d,9,2) END AS phone,
coalesce(regexp_matches(d, '^0[1-9][0-9]{8}$') AND regexp_matches(d, '^08[129]'), false) AS premium FROM n""")
def phone_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Phones in one notation, and whether they cost extra."""
    return table(spark, d, "listings").select("listing_no", contact.normalize_phone(F.col("phone")).alias("phone"), contact.is_premium(F.col("phone")).alias("premium"))


@query("""WITH t AS (SELECT listing_no, substr(regexp_replace(regexp_replace(trim(postcode), '\\.0+$', ''), '[\\s.]', '', 'g'), 1, 5) AS c FROM listings), u AS (SELECT listing_no, CASE WHEN regexp_matches(c, '^[0-9]{4}$') THEN '0' || c WHEN regexp_matches(c, '^[0-9]{5}$') THEN c END AS postcode FROM t)
SELECT listing_no, postcode, CASE WHEN regexp_matches(postcode, '^9[78]') THEN substr(postcode, 1, 3) WHEN regexp_matches(postcode, '^20[01]') THEN '2A' WHEN regexp_matches(postcode, '^20') THEN '2B' ELSE substr(postcode, 1, 2) END AS department FROM u""")
def postcode_department(spark: SparkSession, d: str) -> DataFrame:
    """Clean postcodes and their departments."""
    return table(spark, d, "listings").select("listing_no", contact.clean_postal_code(F.col("postcode")).alias("postcode"), places.department(F.col("postcode")).alias("department"))


@query("""SELECT siret, list_sum(list_transform(range(1, 15), lambda k: CASE WHEN k % 2 = 0 THEN (2 * CAST(substr(reverse(siret), k, 1) AS INT)) // 10 + (2 * CAST(substr(reverse(siret), k, 1) AS INT)) % 10
 ELSE CAST(substr(reverse(siret), k, 1) AS INT) END)) % 10 = 0 AS luhn FROM population""")
def luhn_check(spark: SparkSession, d: str) -> DataFrame:
    """Whether identifiers pass the Luhn check."""
    return table(spark, d, "population").select("siret", contact.luhn_ok(F.col("siret")).alias("luhn"))


TLD_SQL, SHIP_SQL = emails.TLDS, ",".join(f"'{t}'" for t in emails.SHIPPABLE_TLDS)


@query(f"""WITH t AS (SELECT export_no, replace(regexp_replace(lower(trim(replace(email_final, chr(160), ' '))), '^[.;,]+|[.;,]+$', '', 'g'), 'mailto:', '') AS s FROM producteurs_export),
u AS (SELECT *, replace(split_part(s, '@', 1), ' ', '') AS l, regexp_replace(trim(split_part(s, '@', -1)), '^\\.+|\\.+$', '', 'g') AS d FROM t),
v AS (SELECT *, regexp_replace(l || '@' || d, '^([^@]+)@([^@.]+?)({TLD_SQL})$', '\\1@\\2.\\3') AS w FROM u), x AS (SELECT *, split_part(w, '@', -1) AS h, regexp_extract(split_part(w, '@', -1), '^(.+?\\.(?:{TLD_SQL})).+$', 1) AS g FROM v)
SELECT export_no, CASE WHEN s IS NULL OR s IN ('', 'nan', 'none', 'null') THEN 'empty' WHEN length(s) - length(replace(s, '@', '')) <> 1 OR d LIKE '% %' OR h NOT LIKE '%.%' OR g <> '' OR NOT split_part(h, '.', -1) IN ({SHIP_SQL})
 OR NOT (regexp_matches(l, '^[a-z0-9._%+\\-'']+$') AND regexp_matches(h, '^[a-z0-9.\\-]+$') AND regexp_matches(w, '^[^@\\s]+@[^@\\s]+\\.[a-z]{{2,}}$')) THEN 'malformed' ELSE 'candidate' END AS verdict,
CASE WHEN s IS NULL OR s IN ('', 'nan', 'none', 'null') THEN NULL WHEN length(s) - length(replace(s, '@', '')) <> 1 THEN 'at_count' WHEN d LIKE '% %' THEN 'space_in_domain' WHEN h NOT LIKE '%.%' THEN 'no_tld' WHEN g <> '' THEN 'glued_domain'
 WHEN NOT split_part(h, '.', -1) IN ({SHIP_SQL}) THEN 'unknown_tld' WHEN NOT (regexp_matches(l, '^[a-z0-9._%+\\-'']+$') AND regexp_matches(h, '^[a-z0-9.\\-]+$') AND regexp_matches(w, '^[^@\\s]+@[^@\\s]+\\.[a-z]{{2,}}$')) THEN 'shape' END AS defect FROM x""")
def email_classify(spark: SparkSession, d: str) -> DataFrame:
    """Verdict and defect of each exported address."""
    c = emails.classify(F.col("email_final"))
    return table(spark, d, "producteurs_export").select("export_no", c.alias("c")).select("export_no", "c.verdict", "c.defect")


@query("""SELECT export_no, n_emails, list_aggregate(list_sort(e), 'string_agg', '|') AS emails FROM (SELECT export_no, e, len(e) AS n_emails FROM (
 SELECT export_no, list_distinct(list_filter(list_transform(regexp_extract_all(emails_autres, '[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}'), lambda x: regexp_replace(regexp_replace(lower(x), '^(u00[0-9a-f]{2}|x[0-9a-f]{2}|amp|quot|lt|gt|nbsp|039)+', ''), '^[^a-z0-9]+', '')),
 lambda x: NOT regexp_matches(x, '\\.(png|jpg|jpeg|gif|webp|svg|css|js)$') AND NOT split_part(x, '@', 1) IN ('noreply','no-reply','postmaster','webmaster','abuse','sentry','wordpress','wixpress','example','email','your')
 AND NOT regexp_matches(split_part(x, '@', -1), '(sentry\\.io|wixpress\\.com|example\\.com|wordpress\\.org|schema\\.org|w3\\.org|godaddy\\.com)') AND length(x) <= 120)) AS e FROM producteurs_export) WHERE len(e) > 0)""")
def email_extract(spark: SparkSession, d: str) -> DataFrame:
    """Addresses standing in a packed field."""
    found = table(spark, d, "producteurs_export").select("export_no", emails.extract(F.col("emails_autres")).alias("e")).filter(F.size("e") > 0)
    return found.select("export_no", F.size("e").cast("bigint").alias("n_emails"), F.array_join("e", "|").alias("emails"))


#: No look-around in this dialect: every mark is doubled first, so a number may end on one copy and the next begin behind the other.
PHONE_SQL = """WITH t AS (SELECT doc_id, regexp_replace(text, '([^0-9])', '\\1\\1', 'g') AS t FROM documents),
f AS (SELECT doc_id, unnest(regexp_extract_all(t, '(?:^|[^0-9/])((?:[+][+]33|0033|0)(?:[\\s.-]{2})?[1-9](?:(?:[\\s.-]{2})?[0-9]{2}){4})(?:$|[^0-9])', 1)) AS p FROM t),
d AS (SELECT DISTINCT doc_id, '0' || right(regexp_replace(p, '[^0-9]', '', 'g'), 9) AS p FROM f)
SELECT doc_id, string_agg(p, '|' ORDER BY p) AS phones FROM d GROUP BY doc_id"""


@query(PHONE_SQL)
def phone_extract(spark: SparkSession, d: str) -> DataFrame:
    """Phone numbers standing in documents."""
    got = table(spark, d, "documents").select("doc_id", contact.phones_in_text(F.col("text")).alias("p"))
    return got.filter(F.size("p") > 0).select("doc_id", F.array_join("p", "|").alias("phones"))


PHONE_CASES = ["SIRET 30819741700014", "SIRET 13000556789012 RCS", "Tel: 04.91.12.34.56 ou +33 4 91 12 34 56", "du 01 02 2026 au 03 04 2026", "0891 67 20 00 et 0033491123456", "fax 12/0491123456", "04 91 12 34 56 06 12 34 56 78", ""]


@query("""SELECT * FROM (VALUES (0, ''), (1, ''), (2, '0491123456'), (3, ''), (4, '0491123456|0891672000'), (5, ''), (6, '0491123456|0612345678'), (7, '')) AS t(case_no, phones)""")
def phone_extract_cases(spark: SparkSession, d: str) -> DataFrame:
    """The cases a phone pattern is judged by: identifiers, dates, two notations of one number, neighbours."""
    cases = spark.createDataFrame(list(enumerate(PHONE_CASES)), "case_no int, text string")
    return cases.select("case_no", F.array_join(contact.phones_in_text(F.col("text")), "|").alias("phones"))


HOST_SQL = """nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim({c})), '^[a-z][a-z0-9+.\\-]*://', ''), '[/?#].*$', ''), '^.*@', ''), ':\\d*$', ''), '^www\\.', ''), '')"""


@query(f"""SELECT listing_no, h AS host, CASE WHEN h IS NOT NULL THEN CASE WHEN len(string_split(h, '.')) > 1 THEN split_part(h, '.', -2) || '.' || split_part(h, '.', -1) ELSE h END END AS root FROM (SELECT listing_no, {HOST_SQL.format(c='website')} AS h FROM listings)""")
def host_root_domain(spark: SparkSession, d: str) -> DataFrame:
    """Hosts and root domains of websites."""
    return table(spark, d, "listings").select("listing_no", contact.host_of(F.col("website")).alias("host"), contact.root_domain(F.col("website")).alias("root"))


NORM_SQL = "trim(regexp_replace(upper(strip_accents({c})), '[^A-Z0-9]+', ' ', 'g'))"
LEGAL_SQL = ",".join(f"'{f}'" for f in names.LEGAL_FORMS)


@query(f"""SELECT siret, {NORM_SQL.format(c='raisonSociale')} AS norm, list_aggregate(list_sort(list_filter(string_split({NORM_SQL.format(c='raisonSociale')}, ' '), lambda x: x <> '' AND NOT x IN ({LEGAL_SQL}))), 'string_agg', ' ') AS sorted_key FROM population""")
def name_keys(spark: SparkSession, d: str) -> DataFrame:
    """Normal form and order-free key of names."""
    key = names.sorted_key(F.col("raisonSociale"))
    return table(spark, d, "population").select("siret", norm(F.col("raisonSociale")).alias("norm"), F.nullif(key, F.lit("")).alias("sorted_key"))


@query(f"""WITH p AS (SELECT siret, min(raisonSociale) AS raisonSociale FROM population GROUP BY siret), j AS (SELECT listing_no, string_split({NORM_SQL.format(c='name')}, ' ') AS a, string_split({NORM_SQL.format(c='raisonSociale')}, ' ') AS b FROM listings JOIN p USING (siret))
SELECT listing_no, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) AS jaccard FROM j""")
def jaccard_name(spark: SparkSession, d: str) -> DataFrame:
    """Word overlap of listings with the establishment they name."""
    pop = table(spark, d, "population").groupBy("siret").agg(F.min("raisonSociale").alias("raisonSociale"))
    both = table(spark, d, "listings").select("listing_no", "name", "siret").join(pop, "siret")
    return both.select("listing_no", F.round(names.jaccard(F.col("name"), F.col("raisonSociale")), 6).alias("jaccard"))


@query("""SELECT doc_id, length(t) AS n FROM (SELECT doc_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&#039;', ''''), '&quot;', '"'), '\\s+', ' ', 'g')) AS t FROM documents)""")
def strip_tags_len(spark: SparkSession, d: str) -> DataFrame:
    """Length of the visible text."""
    return table(spark, d, "documents").select("doc_id", F.length(pages.strip_tags(F.col("text"))).cast("bigint").alias("n"))


DIGITS_OF = "regexp_replace(regexp_replace(replace({c}, '(0)', ''), '[^0-9]', '', 'g'), '^(?:0033|33)([0-9]{{9}})$', '0\\1')"
CP_OF = "CASE WHEN regexp_matches(substr(regexp_replace(regexp_replace(trim({c}), '\\.0+$', ''), '[\\s.]', '', 'g'), 1, 5), '^[0-9]{{4}}$') THEN '0' ELSE '' END || substr(regexp_replace(regexp_replace(trim({c}), '\\.0+$', ''), '[\\s.]', '', 'g'), 1, 5)"
PHRASES_SQL = "['entreprises similaires','a proximite','autres etablissements','annuaire','trouvez','comparer les','avis clients verifies','fiche entreprise','numero siret','code naf','greffe','informations legales et financieres','bilans gratuits','dirigeants et actionnaires','tous les commerces','resultats pour']"
PARKED_SQL = "'ce domaine est a vendre|ce nom de domaine est a vendre|buy this domain|domain for sale|domaine reserve|site en construction|under construction|page en cours de construction|parking de domaine|acheter ce domaine|sedoparking|expired domain|bienvenue sur votre nouveau site|default web page|apache debian default page|welcome to nginx'"
FARM_SQL = "[" + ",".join(f"'{w}'" for w in pages.FARM_WORDS) + "]"


@query(f"""SELECT doc_id, len(list_intersect(list_distinct(string_split({NORM_SQL.format(c='text')}, ' ')), {FARM_SQL})) AS score FROM documents WHERE text IS NOT NULL""")
def vocabulary_score(spark: SparkSession, d: str) -> DataFrame:
    """Distinct words of the trade in each document."""
    return table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", pages.vocabulary_score(F.col("text"), pages.FARM_WORDS).cast("bigint").alias("score"))


TAGS_OFF = "trim(regexp_replace(replace(replace(replace(replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&#039;', chr(39)), '&quot;', chr(34)), '\\s+', ' ', 'g'))"
GENERIC_SQL = "'PAIN','PAINS','BOULANGERIE','BOULANGER','PATISSERIE','PATISSIER','FOURNIL','MAISON','ATELIER','MOULIN','FOUR','TRADITION','DELICE','DELICES','GOURMAND','GOURMANDE','BOUTIQUE','ARTISAN','PETRIN','MARSEILLE','AIX','PROVENCE','SARL','EURL','SAS','SASU','SNC'"
#: The sites of the documents end in a reserved label, so none is named after a business in this SQL; see the tests for that rung.
SITES_SQL = f"""WITH p AS (SELECT siret, min(raisonSociale) AS name, min(codePostal) AS cp, min({DIGITS_OF.format(c='telephone')}) AS tel FROM population GROUP BY siret), h AS (SELECT site_host, count(DISTINCT siret) AS n FROM documents WHERE site_host IS NOT NULL AND siret IS NOT NULL GROUP BY site_host),
t AS (SELECT doc_id, d.siret, {TAGS_OFF} AS txt, name, {CP_OF.format(c='cp')} AS cp, CASE WHEN regexp_matches(tel, '^0[1-9][0-9]{{8}}$') THEN tel END AS tel, coalesce(n > 2, false) AS shared FROM documents d LEFT JOIN p USING (siret) LEFT JOIN h USING (site_host)),
f AS (SELECT *, regexp_replace(coalesce(txt, ''), '[\\s.\\-()+]', '', 'g') AS digits, {NORM_SQL.format(c='txt')} AS up, regexp_replace(lower(strip_accents(txt)), '[^a-z]+', ' ', 'g') AS flat, len(list_intersect(list_distinct(string_split({NORM_SQL.format(c='txt')}, ' ')), {FARM_SQL})) AS score,
 len(list_distinct(list_filter(regexp_extract_all(txt, '\\b([0-9]{{5}})\\b', 1), lambda c: substr(c, 1, 2) BETWEEN '01' AND '98'))) AS cps, len(list_distinct(regexp_extract_all(txt, '\\b[0-9]{{14}}\\b'))) AS sirets FROM t),
g AS (SELECT *, len(list_filter({PHRASES_SQL}, lambda x: contains(flat, x))) AS phrases, coalesce(length(cp) = 5 AND contains(digits, cp), false) AS has_cp, coalesce(len(list_filter(string_split({NORM_SQL.format(c='name')}, ' '), lambda w: length(w) >= 4 AND contains(up, w))) > 0, false) AS has_name FROM f),
o AS (SELECT *, CASE WHEN length(siret) = 14 AND contains(digits, siret) THEN 'siret' WHEN length(siret) = 14 AND contains(digits, substr(siret, 1, 9)) THEN 'siren' WHEN length(tel) = 10 AND contains(digits, tel) THEN 'tel' WHEN has_cp AND has_name THEN 'cp+nom' WHEN has_cp THEN 'cp' ELSE 'none' END AS own,
 CASE WHEN cps >= 8 THEN 'cp_breadth:' || cps WHEN sirets >= 3 THEN 'siret_breadth:' || sirets WHEN phrases >= 2 AND cps >= 3 THEN 'phrases:' || phrases || '+breadth' ELSE '' END AS why, regexp_matches(flat, {PARKED_SQL}) AS parked FROM g)
SELECT doc_id, own AS ownership, CASE WHEN txt IS NULL THEN 'mort' WHEN parked THEN 'parked' WHEN why <> '' THEN 'annuaire' WHEN own IN ('siret', 'siren', 'tel') THEN 'valide' WHEN length(txt) < 500 THEN 'non_verifiable' WHEN shared THEN 'reseau' WHEN own = 'cp+nom' AND score >= 1 THEN 'valide' ELSE 'hors_sujet' END AS verdict,
CASE WHEN txt IS NULL THEN 'unreachable' WHEN parked THEN 'parking_page' WHEN why <> '' THEN why WHEN own IN ('siret', 'siren', 'tel') THEN 'own:' || own WHEN length(txt) < 500 THEN 'text:' || length(txt) WHEN shared THEN 'shared_domain+' || own WHEN own = 'cp+nom' AND score >= 1 THEN 'own:cp+nom'
 WHEN own = 'cp+nom' THEN 'cp+nom_no_trade:' || score WHEN score >= 2 THEN 'trade_other:' || own ELSE 'no_proof:' || own END AS reason FROM o"""


@query(SITES_SQL)
def site_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Verdict on each document as the page of the establishment it names."""
    pop = table(spark, d, "population").groupBy("siret").agg(F.min("raisonSociale").alias("name"), F.min("codePostal").alias("cp"), F.min(contact.national_digits(F.col("telephone"))).alias("tel"))
    docs = table(spark, d, "documents").select("doc_id", "siret", "site_host", pages.strip_tags(F.col("text")).alias("text"))
    hosts = docs.filter("site_host IS NOT NULL AND siret IS NOT NULL").groupBy("site_host").agg(F.countDistinct("siret").alias("n"))
    joined = docs.join(pop, "siret", "left").join(hosts, "site_host", "left")
    own = pages.ownership(F.col("text"), F.col("siret"), contact.clean_postal_code(F.col("cp")), F.col("name"), F.col("tel"))
    v = pages.site_verdict(F.col("text"), F.col("own"), F.coalesce(F.col("n") > 2, F.lit(False)), pages.vocabulary_score(F.col("text"), pages.FARM_WORDS))
    return joined.withColumn("own", own).select("doc_id", F.col("own").alias("ownership"), v.alias("v")).select("doc_id", "ownership", "v.verdict", "v.reason")


@query("""SELECT siret, CAST(try_strptime(date_creation, '%Y-%m-%d') AS DATE)::VARCHAR AS day, CAST(floor(date_diff('day', CAST(try_strptime(date_creation, '%Y-%m-%d') AS DATE), DATE '2025-06-30') / 365) AS INT) AS age_days,
CAST(2025 - year(try_strptime(date_creation, '%Y-%m-%d')) AS INT) AS age_years, coalesce(date_diff('day', CAST(try_strptime(date_creation, '%Y-%m-%d') AS DATE), DATE '2025-06-30') BETWEEN 0 AND 730, false) AS recent FROM population""")
def dates_and_ages(spark: SparkSession, d: str) -> DataFrame:
    """Creation dates, both definitions of age, and recency."""
    day, as_of = dates.parse_date(F.col("date_creation")), F.lit("2025-06-30").cast("date")
    return table(spark, d, "population").select("siret", day.cast("string").alias("day"), dates.age_by_days(day, as_of).alias("age_days"), dates.age_by_year(day, as_of).cast("int").alias("age_years"), dates.within(day, as_of, 730).alias("recent"))


@query("""SELECT a.listing_no, p.siret, round(2 * 6371000 * asin(sqrt(least(1.0, pow(sin(radians(p.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(p.lat)) * pow(sin(radians(p.lon - a.lon) / 2), 2)))), 3) AS metres FROM
(SELECT listing_no, siret, try_cast(trim(lat) AS DOUBLE) AS lat, try_cast(trim(lon) AS DOUBLE) AS lon FROM listings) a JOIN (SELECT siret, min(try_cast(trim(lat) AS DOUBLE)) AS lat, min(try_cast(trim(lon) AS DOUBLE)) AS lon FROM population GROUP BY siret) p USING (siret)
WHERE a.lat BETWEEN 41 AND 51.5 AND a.lon BETWEEN -5.5 AND 10 AND p.lat BETWEEN 41 AND 51.5 AND p.lon BETWEEN -5.5 AND 10""")
def haversine_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Distance of listings from the establishment they name."""
    number = lambda c: F.trim(c).try_cast("double")
    inside = "lat BETWEEN 41 AND 51.5 AND lon BETWEEN -5.5 AND 10"
    a = table(spark, d, "listings").select("listing_no", "siret", number("lat").alias("lat"), number("lon").alias("lon")).filter(inside)
    p = table(spark, d, "population").groupBy("siret").agg(F.min(number("lat")).alias("lat"), F.min(number("lon")).alias("lon")).filter(inside).withColumnsRenamed({"lat": "plat", "lon": "plon"})
    return a.join(p, "siret").select("listing_no", "siret", F.round(geo.haversine_m(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon")), 3).alias("metres"))


@query("""SELECT y, x, count(*) AS n FROM (SELECT CAST(round_even(lat / 0.0009, 0) AS BIGINT) AS y, CAST(round_even(lon / 0.0012, 0) AS BIGINT) AS x FROM (SELECT try_cast(trim(lat) AS DOUBLE) AS lat, try_cast(trim(lon) AS DOUBLE) AS lon FROM listings)
WHERE lat BETWEEN 41 AND 51.5 AND lon BETWEEN -5.5 AND 10) GROUP BY y, x""")
def grid_cells(spark: SparkSession, d: str) -> DataFrame:
    """Listings in each cell of about 100 m."""
    number = lambda c: F.trim(c).try_cast("double")
    y, x = geo.grid_cell(F.col("lat"), F.col("lon"))
    points = table(spark, d, "listings").select(number("lat").alias("lat"), number("lon").alias("lon")).filter("lat BETWEEN 41 AND 51.5 AND lon BETWEEN -5.5 AND 10")
    return points.groupBy(y.alias("y"), x.alias("x")).agg(F.count(F.lit(1)).alias("n"))


#: First names up to this many are broadcast, more are joined by a shuffle.
FEW_NAMES = 200_000


ASIDE_SQL = """'EARL','GAEC','SARL','EURL','SASU','SAS','SCEA','SCI','SCA','SNC','GFA','CUMA','SC','SA','EA','EI','COOP','SCV','SEP','M','MR','MME','MLLE','MONSIEUR','MADAME','ELEVAGE','ELEVEUR','ELEVEUSE','FERME','DOMAINE','EXPLOITATION','AGRICOLE','AGRICULTEUR',
'PRODUCTEUR','PRODUCTEURS','VERGER','RUCHER','HARAS','ECURIE','ECURIES','CHATEAU','MAS','CLOS','BERGERIE','LA','LE','LES','DE','DU','DES','ET','AU','AUX','D','L','EN'"""


@query(f"""WITH g AS (SELECT DISTINCT string_split({NORM_SQL.format(c='gerant')}, ' ')[1] AS w FROM population WHERE gerant IS NOT NULL), f AS (SELECT w FROM g WHERE length(w) >= 3),
w AS (SELECT DISTINCT siret, list_filter(string_split(regexp_replace(upper(strip_accents(raisonSociale)), '[^A-Z]+', ' ', 'g'), ' '), lambda x: x <> '') AS ws FROM population),
k AS (SELECT siret, ws, list_filter(range(1, len(ws) + 1), lambda i: ws[i] NOT IN ({ASIDE_SQL})) AS ix FROM w WHERE NOT list_has_any(ws, ['SAINT', 'SAINTE', 'SAINTS', 'SAINTES', 'ST', 'STE'])),
c AS (SELECT siret, ws[ix[1]] AS a, ws[ix[2]] AS b FROM k WHERE len(ix) = 2 AND ix[2] - ix[1] = 1), t AS (SELECT *, a IN (SELECT w FROM f) AS fa, b IN (SELECT w FROM f) AS fb FROM c WHERE length(a) >= 3 AND length(b) >= 3 AND a <> b)
SELECT DISTINCT siret, CASE WHEN fa THEN a ELSE b END AS first_name, CASE WHEN fa THEN b ELSE a END AS last_name FROM t WHERE fa <> fb""")
def parsed_people(spark: SparkSession, d: str) -> DataFrame:
    """Person's name read from a business name, with first names learned from the managers' column."""
    pop = table(spark, d, "population").select("siret", "raisonSociale", "gerant").distinct()
    first = F.upper(F.split(norm(F.col("gerant")), " ")[0])
    gazetteer = pop.filter("gerant IS NOT NULL").select(first.alias("w")).filter("length(w) >= 3").distinct()
    few = gazetteer.limit(FEW_NAMES + 1).count() <= FEW_NAMES  # counted before it is broadcast
    words = pop.select("siret", "raisonSociale", F.explode(F.transform(names.person_tokens(F.col("raisonSociale")), lambda p: p["word"])).alias("w"))
    hits = words.join(F.broadcast(gazetteer) if few else gazetteer, "w").groupBy("siret", "raisonSociale").agg(F.collect_set("w").alias("g"))
    named = hits.withColumn("x", names.parse_person(F.col("raisonSociale"), F.col("g")))
    return named.filter("x IS NOT NULL").select("siret", "x.first_name", "x.last_name").distinct()


TOWN_CASES = [("3   ", "- 59780Baisieux"), ("103 ", "Avenue De Flandres - 59650Villeneuve D Ascq"), ("1   ", "Chemin Des Prieures - 80260St Gratien"), ("62960", "BEAUMETZ LES AIRE 0626930077"), ("59145", "BERLAIMONT 06/82/90/56/83"), ("62112", "GOUY SOUS BELLONNE tel 0663269032"),
              ("29250", "29250 SANTEC"), ("17400", "17400  LA BENATE"), ("33520", "BRUGES (33520)"), ("02290", "AMBLENY 02290 AMBLENY"), ("36   ", "Azay le Ferron"), ("01027", "Rue De Lille - 59560Comines"), ("59000", "LILLE"), (None, None)]


@query("""SELECT * FROM (VALUES (0, '59780', 'Baisieux', true), (1, '59650', 'Villeneuve D Ascq', true), (2, '80260', 'St Gratien', true), (3, '62960', 'BEAUMETZ LES AIRE', true), (4, '59145', 'BERLAIMONT', true), (5, '62112', 'GOUY SOUS BELLONNE', true), (6, '29250', 'SANTEC', true), (7, '17400', 'LA BENATE', true),
 (8, '33520', 'BRUGES', true), (9, '02290', 'AMBLENY', true), (10, NULL, 'Azay le Ferron', true), (11, '59560', 'Comines', true), (12, '59000', 'LILLE', false), (13, NULL, '', false)) AS t(case_no, postcode, town, changed)""")
def repaired_town_cases(spark: SparkSession, d: str) -> DataFrame:
    """The cases a repair of town cells is judged by."""
    cases = spark.createDataFrame([(k, *c) for k, c in enumerate(TOWN_CASES)], "case_no int, cp string, city string")
    return cases.select("case_no", places.repair_town(F.col("cp"), F.col("city")).alias("r")).select("case_no", "r.postcode", "r.town", "r.changed")


@query()
def repaired_towns(spark: SparkSession, d: str) -> DataFrame:
    """Postcode and town cells set right where their parts slipped."""
    r = places.repair_town(F.col("postcode"), F.col("city"))
    return table(spark, d, "listings").select("listing_no", r.alias("r")).filter("r.changed").select("listing_no", "r.postcode", "r.town")


REGION_SQL = " ".join(f"WHEN dep IN ({codes}) THEN '{name}'" for name, codes in [
    ("Auvergne-Rhone-Alpes", "'01','03','07','15','26','38','42','43','63','69','73','74'"), ("Bourgogne-Franche-Comte", "'21','25','39','58','70','71','89','90'"), ("Bretagne", "'22','29','35','56'"), ("Centre-Val-de-Loire", "'18','28','36','37','41','45'"),
    ("Corse", "'2A','2B'"), ("Grand-Est", "'08','10','51','52','54','55','57','67','68','88'"), ("Hauts-de-France", "'02','59','60','62','80'"), ("Ile-de-France", "'75','77','78','91','92','93','94','95'"), ("Normandie", "'14','27','50','61','76'"),
    ("Nouvelle-Aquitaine", "'16','17','19','23','24','33','40','47','64','79','86','87'"), ("Occitanie", "'09','11','12','30','31','32','34','46','48','65','66','81','82'"), ("Pays-de-la-Loire", "'44','49','53','72','85'"), ("Provence-Alpes-Cote-d-Azur", "'04','05','06','13','83','84'")])


@query(f"""SELECT region, count(*) AS listings FROM (SELECT CASE WHEN dep IS NULL THEN NULL {REGION_SQL} ELSE 'Hors-region' END AS region FROM (SELECT CASE WHEN regexp_matches(c, '^9[78]') THEN substr(c, 1, 3) WHEN regexp_matches(c, '^20[01]') THEN '2A' WHEN regexp_matches(c, '^20') THEN '2B' ELSE substr(c, 1, 2) END AS dep FROM
 (SELECT CASE WHEN regexp_matches(c, '^[0-9]{{4}}$') THEN '0' || c WHEN regexp_matches(c, '^[0-9]{{5}}$') THEN c END AS c FROM (SELECT substr(regexp_replace(regexp_replace(trim(postcode), '\\.0+$', ''), '[\\s.]', '', 'g'), 1, 5) AS c FROM listings)))) GROUP BY region""")
def listings_by_region(spark: SparkSession, d: str) -> DataFrame:
    """Listings of each region, by their postcode's department."""
    got = table(spark, d, "listings").select(places.region(places.department(F.col("postcode"))).alias("region"))
    return got.groupBy("region").agg(F.count(F.lit(1)).alias("listings"))


@query("""SELECT doc_id, nullif(string_agg(e, '|' ORDER BY e), '') AS usable FROM (SELECT DISTINCT doc_id, e FROM (SELECT doc_id, name, site_host, unnest(list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}'), lambda x: lower(x)))) AS e FROM documents JOIN (SELECT siret, min(raisonSociale) AS name FROM population GROUP BY siret) USING (siret))
 WHERE len(list_filter(string_split(lower(trim(regexp_replace(upper(strip_accents(name)), '[^A-Z0-9]+', ' ', 'g'))), ' '), lambda w: length(w) >= 4 AND contains(regexp_replace(split_part(e, '@', 1) || split_part(e, '@', 2), '[-._]', '', 'g'), w))) > 0
 AND (split_part(e, '@', 2) IN ('gmail.com','googlemail.com','orange.fr','wanadoo.fr','free.fr','sfr.fr','neuf.fr','laposte.net','yahoo.fr','yahoo.com','hotmail.fr','hotmail.com','outlook.fr','outlook.com','live.fr','msn.com','bbox.fr','aliceadsl.fr','numericable.fr','icloud.com','me.com','protonmail.com','proton.me','gmx.fr','aol.com','club-internet.fr')
  OR array_to_string(list_reverse(list_reverse(string_split(split_part(e, '@', 2), '.'))[1:2]), '.') = array_to_string(list_reverse(list_reverse(string_split(regexp_replace(lower(site_host), '^www\\.', ''), '.'))[1:2]), '.')
  OR len(list_filter(string_split(lower(trim(regexp_replace(upper(strip_accents(name)), '[^A-Z0-9]+', ' ', 'g'))), ' '), lambda w: length(w) >= 4 AND contains(replace(split_part(e, '@', 2), '-', ''), w))) > 0)
 AND split_part(e, '@', 1) NOT IN ('noreply','no-reply','postmaster','webmaster','abuse','sentry','wordpress','wixpress','example','email','your')) GROUP BY doc_id""")
def usable_hits(spark: SparkSession, d: str) -> DataFrame:
    """Addresses in documents that carry the name of the establishment the document is of."""
    pop = table(spark, d, "population").groupBy("siret").agg(F.min("raisonSociale").alias("name"))
    found = table(spark, d, "documents").join(pop, "siret").select("doc_id", "name", "site_host", F.explode(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(emails.ADDRESS), F.lit(0)), F.lower))).alias("e"))
    kept = found.filter(emails.usable_hit(F.col("e"), F.col("site_host"), F.col("name"))).select("doc_id", "e").distinct()
    return kept.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list("e")), "|").alias("usable"))
