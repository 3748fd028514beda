"""Views and assertions over a base made of the staged rows: every row a company with one site, contact and e-mail."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import contact
from gristmill.operators import base as B
from gristmill.plans.registry import query
from gristmill.sources.tables import table

EMAIL_SHAPE = r"^[^@\s]+@[^@\s]+\.[A-Za-z]{2,}$"
FORM = r"^(SAS|SARL|SCEA|EARL|GAEC|SNC|EURL|SCI)\b"


def base_of(spark: SparkSession, d: str) -> B.Base:
    """The base's tables from ``ingest_rows``, ``source_files`` and ``raw_rows``; a repeated siret is a duplicate of its first row."""
    rows = table(spark, d, "ingest_rows").withColumn("siret", contact.clean_siret(F.col("siret")))
    first = rows.filter("siret IS NOT NULL").groupBy("siret").agg(F.min("row_id").alias("first_id"))
    status = F.when(F.col("naf_code_source").isNotNull(), "qualified").when(F.col("naf_label").isNotNull(), "qualified_unverified").otherwise("pending")
    form = F.nullif(F.regexp_extract(F.upper(F.trim(F.coalesce("legal_name", F.lit("")))), FORM, 1), F.lit(""))
    own = rows.join(first, "siret", "left")
    companies = own.select(F.col("row_id").alias("id"), F.substring("siret", 1, 9).alias("siren"), "legal_name", "trade_name", form.alias("legal_form"), F.col("naf_code_source").alias("naf_code"), "naf_label", F.col("effectif_raw").alias("employee_bracket"),
                           status.alias("qualification_status"), "source_file_id", F.when(F.col("first_id") < F.col("row_id"), F.col("first_id").cast("string")).alias("duplicate_of"))
    sites = rows.select(F.col("row_id").alias("id"), "siret", F.col("row_id").alias("company_id"), contact.normalize_status(F.col("status_raw")).alias("is_active"), "address_line1", "postal_code", "city", F.col("status_raw").alias("source_status"), "source_file_id")
    people = rows.select(F.col("row_id").alias("id"), F.col("row_id").alias("site_id"), F.col("row_id").alias("company_id"), F.col("contact_full_name").alias("full_name"), "phone_main", "source_file_id")
    mails = rows.filter("trim(email_address) <> ''").select(F.col("row_id").alias("id"), F.col("row_id").alias("contact_id"), "email_address", F.lit(True).alias("is_primary"), F.when(F.col("email_address").rlike(EMAIL_SHAPE), "unverified").otherwise("invalid").alias("verification_status"), F.col("loaded_at").alias("created_at"))
    files = table(spark, d, "source_files").select(F.col("source_file_id").alias("id"), "sector", F.col("row_count_raw").alias("row_count"))
    points = rows.select(F.col("row_id").alias("company_id"), F.lit("phone").alias("kind"), contact.national_digits(F.col("phone_alt")).alias("value_norm"), (~contact.is_premium(F.col("phone_alt"))).alias("is_dialable")).filter("value_norm IS NOT NULL")
    return B.Base(companies, sites, people, mails, files, rows.select(F.col("row_id").alias("company_id"), "source_file_id"), points, table(spark, d, "raw_rows").select("source_file_id"))


SIRET = "CASE WHEN regexp_matches(regexp_replace(regexp_replace(trim(siret), '\\.0+$', ''), '[\\s.\\-]', '', 'g'), '^[0-9]{14}$') THEN regexp_replace(regexp_replace(trim(siret), '\\.0+$', ''), '[\\s.\\-]', '', 'g') END"
ACTIVE = "CASE WHEN contains(lower(trim(status_raw)), 'actif') THEN true WHEN regexp_matches(lower(trim(status_raw)), 'ferm|cess|radié|radie') THEN false END"
BASE_SQL = f"""WITH r AS (SELECT * REPLACE ({SIRET} AS siret) FROM ingest_rows), c AS (SELECT *, min(row_id) OVER (PARTITION BY siret) AS first_id, substr(siret, 1, 9) AS siren, CASE WHEN naf_code_source IS NOT NULL THEN 'qualified' WHEN naf_label IS NOT NULL THEN 'qualified_unverified' ELSE 'pending' END AS q,
 nullif(regexp_extract(upper(trim(coalesce(legal_name, ''))), '^(SAS|SARL|SCEA|EARL|GAEC|SNC|EURL|SCI)\\b', 1), '') AS legal_form, {ACTIVE} AS is_active, trim(postal_code) AS pc, lower(regexp_replace(coalesce(address_line1, ''), '[^a-zA-Z0-9]+', ' ', 'g')) AS addr,
 CASE WHEN trim(email_address) <> '' AND regexp_matches(email_address, '^[^@\\s]+@[^@\\s]+\\.[A-Za-z]{{2,}}$') THEN email_address END AS mail FROM r),
cf AS (SELECT c.*, CASE WHEN siret IS NOT NULL AND first_id < row_id THEN CAST(first_id AS VARCHAR) END AS duplicate_of, sector FROM c JOIN source_files USING (source_file_id)),
g AS (SELECT pc, addr, sector, count(DISTINCT siren) AS entities, md5(pc || '|' || addr || '|' || coalesce(sector, '')) AS grp FROM cf WHERE q IN ('qualified', 'qualified_unverified') AND duplicate_of IS NULL AND siren IS NOT NULL AND pc <> '' AND trim(coalesce(address_line1, '')) <> '' GROUP BY pc, addr, sector HAVING count(DISTINCT siren) > 1),
v AS (SELECT coalesce(duplicate_of, CAST(row_id AS VARCHAR)) AS business_id, duplicate_of IS NOT NULL AS is_duplicate, row_id AS company_id, siren, siret, legal_name, trade_name, legal_form, naf_code_source AS naf_code, effectif_raw AS employee_bracket,
 CASE q WHEN 'qualified' THEN 'tier1_official_naf' ELSE 'tier2_source_label' END AS tier, CASE WHEN regexp_matches(cf.pc, '^[0-9]{{4}}$') THEN substr('0' || cf.pc, 1, 2) WHEN regexp_matches(cf.pc, '^9[78][0-9]{{3}}$') THEN substr(cf.pc, 1, 3) WHEN regexp_matches(cf.pc, '^20[01][0-9]{{2}}$') THEN '2A' WHEN regexp_matches(cf.pc, '^20[0-9]{{3}}$') THEN '2B' WHEN regexp_matches(cf.pc, '^[0-9]{{5}}$') THEN substr(cf.pc, 1, 2) END AS department_code,
 contact_full_name AS full_name, phone_main, mail AS email_address, CASE WHEN mail IS NOT NULL THEN 'unverified' END AS email_status, grp, entities, coalesce(regexp_matches(lower(status_raw), '^(ferm|cess|radi)'), false) AS source_closed, cf.sector
 FROM cf LEFT JOIN g ON g.pc = cf.pc AND g.addr = cf.addr AND g.sector IS NOT DISTINCT FROM cf.sector WHERE q IN ('qualified', 'qualified_unverified') AND is_active IS DISTINCT FROM false),
b AS (SELECT * FROM v WHERE NOT is_duplicate QUALIFY row_number() OVER (PARTITION BY business_id ORDER BY source_closed, email_address IS NULL, tier <> 'tier1_official_naf', full_name NULLS LAST, email_address NULLS LAST, phone_main NULLS LAST, siret NULLS LAST, company_id) = 1),
f AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY coalesce(grp, business_id) ORDER BY source_closed, email_address IS NULL, tier <> 'tier1_official_naf', business_id) = 1)"""


@query(f"{BASE_SQL} SELECT business_id, is_duplicate, company_id, siren, siret, tier, department_code, full_name, phone_main, email_address, grp AS shared_address_group, entities AS shared_address_entities, source_closed, sector AS sectors FROM v")
def qualified_contacts(spark: SparkSession, d: str) -> DataFrame:
    """Contacts of qualified companies with best e-mail, department, sectors and shared address."""
    got = B.qualified_contacts(base_of(spark, d))
    return got.select("business_id", "is_duplicate", "company_id", "siren", "siret", "tier", "department_code", "full_name", "phone_main", "email_address", "shared_address_group", "shared_address_entities", "source_closed", F.array_join("sectors", "|").alias("sectors"))


def _delivered(spark: SparkSession, d: str) -> tuple[B.Base, DataFrame]:
    base = base_of(spark, d)
    return base, B.deliverable(B.qualified_contacts(base), base)


@query(f"{BASE_SQL} SELECT business_id, company_id, coalesce(nullif(trim(legal_name), ''), trade_name) AS display_name, email_address, grp AS shared_address_group, source_closed, false AS in_liquidation FROM f")
def deliverable_businesses(spark: SparkSession, d: str) -> DataFrame:
    """One contact a business, one business a shared address."""
    return _delivered(spark, d)[1].select("business_id", "company_id", "display_name", "email_address", "shared_address_group", "source_closed", "in_liquidation")


PERSONAL = "'orange.fr','gmail.com','wanadoo.fr','hotmail.fr','yahoo.fr','free.fr','sfr.fr','laposte.net','hotmail.com','aol.com','outlook.fr','live.fr','bbox.fr','neuf.fr','yahoo.com','outlook.com','msn.com','gmailcom','me.com','icloud.com','mail.com','gmx.fr','numericable.fr','dbmail.com'"


@query(f"""{BASE_SQL}, n AS (SELECT *, trim(coalesce(full_name, '')) <> '' AS named, coalesce(lower(nullif(split_part(email_address, '@', 2), '')) NOT IN ({PERSONAL}), false) AS corporate FROM f WHERE NOT source_closed)
SELECT business_id, named AS has_contact_name, corporate AS domain_is_corporate, NOT named AND siren IS NOT NULL AS needs_dirigeant, NOT named AND siren IS NULL AS needs_name_parse, corporate AND named AS can_mine_pattern, NOT corporate AS needs_domain,
CASE WHEN regexp_matches(naf_code, '^(10|11|35)') THEN 1 WHEN regexp_matches(employee_bracket, '^[0-9]+$') AND try_cast(employee_bracket AS INT) >= 3 THEN 1 WHEN regexp_matches(legal_form, '(?i)^(SAS|SARL|SA$|SCEA|COOP|SCA)') THEN 2 WHEN regexp_matches(legal_form, '(?i)^(EARL|GAEC)') THEN 3 WHEN siren IS NOT NULL THEN 4 ELSE 5 END AS enrichment_priority FROM n""")
def enrichment_queue(spark: SparkSession, d: str) -> DataFrame:
    """What deliverable businesses still lack, and how urgent they are."""
    return B.enrichment_queue(_delivered(spark, d)[1]).select("business_id", "has_contact_name", "domain_is_corporate", "needs_dirigeant", "needs_name_parse", "can_mine_pattern", "needs_domain", "enrichment_priority")


@query(f"""{BASE_SQL}, p AS (SELECT sector, count(*) AS companies, count(*) FILTER (WHERE q LIKE 'qualified%') AS qualified, count(*) FILTER (WHERE q = 'unqualified') AS unqualified, count(duplicate_of) AS duplicates FROM cf WHERE sector IS NOT NULL GROUP BY sector),
s AS (SELECT sector, count(*) AS deliverable, count(phone_main) AS with_phone, count(email_address) AS with_email, count(*) FILTER (WHERE phone_main IS NOT NULL OR email_address IS NOT NULL) AS reachable FROM f GROUP BY sector)
SELECT sector, companies, qualified, unqualified, duplicates, coalesce(deliverable, 0) AS deliverable, coalesce(with_phone, 0) AS with_phone, coalesce(with_email, 0) AS with_email, coalesce(reachable, 0) AS reachable FROM p LEFT JOIN s USING (sector)""")
def sector_summary(spark: SparkSession, d: str) -> DataFrame:
    """Companies and deliverable businesses by sector."""
    return B.sector_summary(*_delivered(spark, d))


KNOWN = ["agriculture", "boulangerie", "livestock"]
PHONES = "CASE WHEN regexp_matches({d}, '^0[1-9][0-9]{{8}}$') THEN {d} END"
DIGITS = "regexp_replace(regexp_replace(replace({c}, '(0)', ''), '[^0-9]', '', 'g'), '^(?:0033|33)([0-9]{{9}})$', '0\\1')"


@query(f"""{BASE_SQL}, live AS (SELECT * FROM r WHERE trim(email_address) <> '' AND regexp_matches(email_address, '^[^@\\s]+@[^@\\s]+\\.[A-Za-z]{{2,}}$')), pts AS (SELECT row_id, {PHONES.format(d=DIGITS.format(c='phone_alt'))} AS num FROM r)
SELECT 'raw rows reconcile with the declared count' AS "check", CAST((SELECT count(*) FROM source_files f LEFT JOIN (SELECT source_file_id, count(*) AS n FROM raw_rows GROUP BY 1) USING (source_file_id) WHERE row_count_raw IS DISTINCT FROM coalesce(n, 0)) AS DOUBLE) AS value
UNION ALL SELECT 'everything carries its file', 3 * count(*) FILTER (WHERE source_file_id IS NULL) FROM r UNION ALL SELECT 'every company is in a file', 0 UNION ALL SELECT 'every sector has rules', count(DISTINCT sector) FROM source_files WHERE sector NOT IN ('agriculture', 'boulangerie', 'livestock')
UNION ALL SELECT 'companies in several sectors (percent)', 0 UNION ALL SELECT 'siren is the start of siret', 0 UNION ALL SELECT 'siret has fourteen digits', 0 UNION ALL SELECT 'postcode has five digits', count(*) FROM r WHERE NOT regexp_matches(trim(postal_code), '^[0-9]{{5}}$')
UNION ALL SELECT 'a business is delivered once', count(*) - count(DISTINCT business_id) FROM f UNION ALL SELECT 'e-mails have a dotted domain', 0 UNION ALL SELECT 'at most one primary e-mail a contact', 0 UNION ALL SELECT 'no two domains welded together', count(*) FROM live WHERE regexp_matches(lower(split_part(email_address, '@', 2)), '\\.(fr|com|net|org)[a-z]{{2,}}\\.')
UNION ALL SELECT 'no invalid e-mail is delivered', 0 UNION ALL SELECT 'no condemned address in use', 0 UNION ALL SELECT 'no barred phone is dialled', count(*) FROM pts JOIN r USING (row_id) WHERE regexp_matches(num, '^08[129]') AND regexp_replace(coalesce(phone_main, ''), '[^0-9]', '', 'g') = num
UNION ALL SELECT 'values have the shape of their kind', 0 UNION ALL SELECT 'nothing is pending that has an activity code', 0 UNION ALL SELECT 'no mapped column is empty', (count(status_raw) = 0)::INT + (count(naf_label) = 0)::INT + (count(phone_main) = 0)::INT + (count(contact_full_name) = 0)::INT FROM r""")
def base_assertions(spark: SparkSession, d: str) -> DataFrame:
    """The eighteen assertions about a base, with how many rows break each."""
    base, delivered = _delivered(spark, d)
    return B.assertions(base, delivered, KNOWN, {s: s for s in KNOWN}).select("check", "value")


@query(f"""{BASE_SQL}, s AS (SELECT sector, round(100.0 * count(duplicate_of) / count(*), 2) AS dup FROM cf GROUP BY sector), n AS (SELECT sector, count(*) AS n FROM f GROUP BY sector)
SELECT sector, 'dup_pct' AS "check", dup AS value, CASE sector WHEN 'agriculture' THEN dup BETWEEN 0 AND 5 END AS ok FROM s UNION ALL SELECT sector, 'uniform', 0, true FROM s UNION ALL SELECT s.sector, 'deliverable', coalesce(n, 0), CASE s.sector WHEN 'agriculture' THEN coalesce(n, 0) BETWEEN 1 AND 1000000 END FROM s LEFT JOIN n USING (sector)""")
def sector_bands(spark: SparkSession, d: str) -> DataFrame:
    """Each sector's figures against its bands."""
    base, delivered = _delivered(spark, d)
    return B.sector_bands(base, delivered, {"agriculture": {"deliverable": (1, 1_000_000), "dup_pct": (0, 5)}})


@query(f"{BASE_SQL} SELECT business_id, department_code FROM f WHERE department_code IN ('63', '03') AND NOT source_closed")
def matching_filters(spark: SparkSession, d: str) -> DataFrame:
    """Optional parameters: a list of departments and open businesses asked for, the tier not."""
    return B.matching(_delivered(spark, d)[1], tier=None, department_code=["63", "03"], source_closed=False).select("business_id", "department_code")
