"""Views over a base of companies, sites, contacts and e-mails: qualified contacts, deliverable businesses, queues, assertions.

Tables of a base (other columns may stand beside these; a missing optional column counts as NULL):
companies(id, siren, legal_name, trade_name, legal_form, naf_code, naf_label, employee_bracket, qualification_status,
source_file_id, duplicate_of, rule_version), sites(id, siret, company_id, is_active, address_line1, postal_code, city, department,
source_status, website_domain), contacts(id, site_id, company_id, full_name, phone_main, job_title, name_source),
emails(id, contact_id, email_address, is_primary, verification_status, created_at), source_files(id, sector,
row_count), company_sources(company_id, source_file_id), contact_points(company_id, kind, value_norm, verdict,
is_dialable), rows(source_file_id).
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.operators import quality
from gristmill.operators.relational import descending, first_per_group, nulls_last

#: What qualification gives, and the tier of each (fixed values).
TIERS = {"qualified": "tier1_official_naf", "qualified_unverified": "tier2_source_label"}
#: Mailbox domains that belong to nobody's own company (fixed values).
PERSONAL_DOMAINS = """orange.fr gmail.com wanadoo.fr hotmail.fr yahoo.fr free.fr sfr.fr laposte.net hotmail.com aol.com outlook.fr live.fr
bbox.fr neuf.fr yahoo.com outlook.com msn.com gmailcom me.com icloud.com mail.com gmx.fr numericable.fr dbmail.com""".split()
#: Titles of those who wind a company up (fixed values).
LIQUIDATORS = r"(?i)liquidateur|mandataire|administrateur judiciaire"
#: Ranks of the queue: pattern of the activity code, of the legal form (fixed values).
PRIORITY_NAF, PRIORITY_FORMS = r"^(10|11|35)", [(r"(?i)^(SAS|SARL|SA$|SCEA|COOP|SCA)", 2), (r"(?i)^(EARL|GAEC)", 3)]

OPTIONAL = {
    "companies": "siren legal_name trade_name legal_form naf_code naf_label employee_bracket qualification_status source_file_id duplicate_of rule_version",
    "sites": "siret is_active address_line1 postal_code city department source_status website_domain source_file_id", "contacts": "full_name phone_main job_title name_source source_file_id",
    "emails": "is_primary verification_status created_at", "contact_points": "verdict is_dialable",
}


@dataclass
class Base:
    """The tables; those a view doesn't name may be left out."""

    companies: DataFrame
    sites: DataFrame
    contacts: DataFrame
    emails: DataFrame
    source_files: DataFrame
    company_sources: DataFrame
    contact_points: DataFrame | None = None
    rows: DataFrame | None = None

    def __post_init__(self) -> None:
        for f in fields(self):
            df = getattr(self, f.name)
            if df is not None:
                missing = [c for c in OPTIONAL.get(f.name, "").split() if c not in df.columns]
                setattr(self, f.name, df.select("*", *[F.lit(None).cast("boolean" if c.startswith("is_") else "string").alias(c) for c in missing]))


def _blank(c: str | Column) -> Column:
    return F.trim(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))) == ""


def department_of(department: Column, postcode: Column) -> tuple[Column, Column]:
    """(code, provenance): the department given, else derived from a postcode of five digits, or of four with its zero restored."""
    pc = F.trim(postcode)
    given = F.nullif(F.trim(department), F.lit(""))
    island = F.when(F.substring(pc, 3, 1).isin("0", "1"), "2A").otherwise("2B")
    cases = [("^[0-9]{4}$", F.substring(F.lpad(pc, 5, "0"), 1, 2), "derived: postal, leading zero restored"), ("^9[78][0-9]{3}$", F.substring(pc, 1, 3), "derived: postal, DOM-TOM 3-digit"),
             ("^20[0-9]{3}$", island, "derived: postal, Corsica 2A/2B (approx)"), ("^[0-9]{5}$", F.substring(pc, 1, 2), "derived: postal, metropolitan")]
    code, said = F.when(given.isNotNull(), given), F.when(given.isNotNull(), "sites.department")
    for pattern, value, label in cases:
        code, said = code.when(pc.rlike(pattern), value), said.when(pc.rlike(pattern), label)
    return code, said.otherwise("unknown")


def best_email(emails: DataFrame) -> DataFrame:
    """Each contact's best address that isn't invalid: valid ones first, then the primary, then the oldest."""
    usable = emails.filter("verification_status <> 'invalid'")
    order = [F.col("verification_status") != "valid", ~F.coalesce(F.col("is_primary"), F.lit(False)), nulls_last(F.col("created_at")), F.col("id")]
    best = first_per_group(usable.select("contact_id", "id", "email_address", "verification_status", "is_primary", "created_at"), ["contact_id"], order)
    return best.select("contact_id", "email_address", F.col("verification_status").alias("email_status"))


def shared_addresses(base: Base, merged_sectors: dict[str, str]) -> DataFrame:
    """(pc, addr, family_sector, group, entities): addresses at which several qualified companies of one sector sit."""
    rows = base.companies.filter(F.col("qualification_status").isin(*TIERS) & F.col("duplicate_of").isNull() & F.col("siren").isNotNull()).select(F.col("id").alias("company_id"), "siren", "source_file_id")
    rows = rows.join(base.sites.select("company_id", "postal_code", "address_line1"), "company_id").join(base.source_files.select(F.col("id").alias("source_file_id"), "sector"), "source_file_id")
    rows = rows.filter(~_blank("postal_code") & ~_blank("address_line1")).select("siren", *address_key(), family_sector(merged_sectors).alias("family_sector"))
    groups = rows.groupBy("pc", "addr", "family_sector").agg(F.countDistinct("siren").alias("entities")).filter("entities > 1")
    return groups.withColumn("group", F.md5(F.concat("pc", F.lit("|"), "addr", F.lit("|"), F.coalesce("family_sector", F.lit("")))))


def address_key() -> list[Column]:
    return [F.trim("postal_code").alias("pc"), F.lower(F.regexp_replace(F.coalesce("address_line1", F.lit("")), "[^a-zA-Z0-9]+", " ")).alias("addr")]


def family_sector(merged: dict[str, str]) -> Column:
    """Sector under which addresses are compared: several may count as one."""
    out = F.col("sector")
    for sector, family in merged.items():
        out = F.when(F.col("sector") == sector, family).otherwise(out)
    return out


def qualified_contacts(base: Base, merged_sectors: dict[str, str] | None = None) -> DataFrame:
    """One row for each contact at an open site of a qualified company, with its best e-mail, sectors and shared address.

    Sectors are those of all files a company stands in, sorted; a company of no file has its own file's. Every join but
    those of the small dimension ``source_files`` is on a key of the larger side, so none multiplies rows.
    """
    member = base.company_sources.join(base.source_files.select(F.col("id").alias("source_file_id"), "sector"), "source_file_id").filter("sector IS NOT NULL")
    sectors = member.groupBy("company_id").agg(F.array_sort(F.collect_set("sector")).alias("all_sectors"))  # as many as there are sectors
    company = base.companies.filter(F.col("qualification_status").isin(*TIERS)).select(F.col("id").alias("company_id"), "siren", "legal_name", "trade_name", "legal_form", "naf_code", "naf_label", "employee_bracket", "qualification_status", "duplicate_of", "source_file_id", "rule_version")
    site = base.sites.filter(~F.col("is_active").eqNullSafe(F.lit(False))).select(F.col("id").alias("site_id"), "company_id", "siret", "address_line1", "postal_code", "city", "department", "source_status", "website_domain")
    person = base.contacts.select(F.col("id").alias("contact_id"), "site_id", "full_name", "phone_main")
    files = base.source_files.select(F.col("id").alias("source_file_id"), "sector")
    all_ = company.join(site, "company_id").join(person, "site_id").join(files, "source_file_id").join(best_email(base.emails), "contact_id", "left").join(sectors, "company_id", "left")
    all_ = all_.select("*", *address_key(), family_sector(merged_sectors or {}).alias("family_sector"))
    groups = shared_addresses(base, merged_sectors or {}).withColumnRenamed("family_sector", "group_sector")
    joined = all_.join(groups, (all_["pc"] == groups["pc"]) & (all_["addr"] == groups["addr"]) & all_["family_sector"].eqNullSafe(groups["group_sector"]), "left").drop(groups["pc"], groups["addr"])
    code, said = department_of(F.col("department"), F.col("postal_code"))
    tier = F.element_at(F.create_map(*[F.lit(x) for pair in TIERS.items() for x in pair]), F.col("qualification_status"))
    closed = F.coalesce(F.lower("source_status").rlike("^(ferm|cess|radi)"), F.lit(False))
    return joined.select(
        F.coalesce("duplicate_of", F.col("company_id").cast("string")).alias("business_id"), F.col("duplicate_of").isNotNull().alias("is_duplicate"), "company_id", "contact_id", "siren", "siret", "legal_name", "trade_name", "legal_form", "naf_code", "naf_label", "employee_bracket",
        "qualification_status", tier.alias("tier"), "address_line1", "postal_code", "city", code.alias("department_code"), said.alias("department_source"), "website_domain", "full_name", "phone_main", "email_address", "email_status",
        (F.col("email_status") == "valid").alias("email_verified"), F.col("group").alias("shared_address_group"), F.col("entities").alias("shared_address_entities"), "source_status", closed.alias("source_closed"),
        F.coalesce("all_sectors", F.array("sector")).alias("sectors"), F.col("sector").alias("primary_sector"), "rule_version")


def deliverable(contacts: DataFrame, base: Base) -> DataFrame:
    """One row for each family: the best contact of each business, then the best business of each shared address.

    ``in_liquidation`` says that the registry names somebody who winds the business up.
    """
    first = [F.col("source_closed"), F.col("email_address").isNull(), F.coalesce(F.col("tier") != "tier1_official_naf", F.lit(True))]
    by_business = [*first, nulls_last(~F.col("email_verified")), nulls_last(F.col("full_name")), nulls_last(F.col("email_address")), nulls_last(F.col("phone_main")), nulls_last(F.col("siret")), F.col("contact_id")]
    business = first_per_group(contacts.filter("NOT is_duplicate"), ["business_id"], by_business)
    family = first_per_group(business.withColumn("family", F.coalesce("shared_address_group", "business_id")), ["family"], [*first, F.col("business_id")]).drop("family")
    winding = base.contacts.filter((F.col("name_source") == "rne_dirigeant") & F.col("job_title").rlike(LIQUIDATORS)).select("company_id")
    winding = winding.join(base.companies.select(F.col("id").alias("company_id"), "duplicate_of"), "company_id").select(F.coalesce("duplicate_of", F.col("company_id").cast("string")).alias("business_id")).distinct().withColumn("wound", F.lit(True))
    return family.join(winding, "business_id", "left").withColumn("in_liquidation", F.coalesce("wound", F.lit(False))).withColumn("display_name", F.coalesce(F.nullif(F.trim("legal_name"), F.lit("")), "trade_name")).drop("wound")


def enrichment_queue(delivered: DataFrame) -> DataFrame:
    """What each open deliverable business still lacks, and how urgent it is (1 to 5)."""
    domain = F.nullif(F.lower(F.coalesce(F.get(F.split(F.coalesce("email_address", F.lit("")), "@"), F.lit(1)), F.lit(""))), F.lit(""))
    named, corporate = ~_blank("full_name"), F.coalesce(~F.col("email_domain").isin(*PERSONAL_DOMAINS), F.lit(False))
    bracket = F.coalesce(F.col("employee_bracket").try_cast("int") >= 3, F.lit(False)) & F.col("employee_bracket").rlike("^[0-9]+$")
    priority = F.when(F.col("naf_code").rlike(PRIORITY_NAF) | bracket, 1)
    for pattern, rank in PRIORITY_FORMS:
        priority = priority.when(F.col("legal_form").rlike(pattern), rank)
    priority = priority.when(F.col("siren").isNotNull(), 4).otherwise(5)
    rows = delivered.filter("NOT source_closed").withColumn("email_domain", domain).withColumn("has_contact_name", named).withColumn("has_email", F.col("email_address").isNotNull()).withColumn("domain_is_corporate", corporate)
    name = F.col("has_contact_name")
    return rows.withColumns({"needs_dirigeant": ~name & F.col("siren").isNotNull(), "needs_name_parse": ~name & F.col("siren").isNull(), "can_mine_pattern": F.col("domain_is_corporate") & name, "needs_domain": ~F.col("domain_is_corporate"), "enrichment_priority": priority})


def sector_summary(base: Base, delivered: DataFrame) -> DataFrame:
    """Companies and deliverable businesses of each sector; a business counts in every sector it is of."""
    member = base.company_sources.join(base.source_files.select(F.col("id").alias("source_file_id"), "sector"), "source_file_id").filter("sector IS NOT NULL").join(base.companies.select(F.col("id").alias("company_id"), "qualification_status", "duplicate_of"), "company_id")
    one = member.groupBy("sector", "company_id").agg(F.max("qualification_status").alias("q"), F.max("duplicate_of").alias("d"))
    per = one.groupBy("sector").agg(F.count(F.lit(1)).alias("companies"), F.count_if(F.col("q").isin(*TIERS)).alias("qualified"), F.count_if(F.col("q") == "unqualified").alias("unqualified"), F.count_if(F.col("d").isNotNull()).alias("duplicates"))
    reach = F.col("phone_main").isNotNull() | F.col("email_address").isNotNull()
    sent = delivered.select(F.explode("sectors").alias("sector"), "phone_main", "email_address").groupBy("sector").agg(
        F.count(F.lit(1)).alias("deliverable"), F.count("phone_main").alias("with_phone"), F.count("email_address").alias("with_email"), F.count_if(reach).alias("reachable"))
    return per.join(sent, "sector", "left").na.fill(0, ["deliverable", "with_phone", "with_email", "reachable"])


def matching(df: DataFrame, **wanted) -> DataFrame:
    """Rows whose columns have the wanted values; None asks nothing, a list any of its values, NULL never matches."""
    for column, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(column).isin(*value) if isinstance(value, (list, tuple, set)) else F.col(column) == value)
    return df


def stale(df: DataFrame, version: str, current: str, **scope) -> DataFrame:
    """Rows of a scope that another version of the rules judged, or none."""
    return matching(df, **scope).filter(~F.col(version).eqNullSafe(F.lit(current)))


#: Shape of a value of each kind (fixed values).
VALUE_SHAPES = {"phone": r"^0[1-9][0-9]{8}$", "email": r"^[^@\s]+@[^@\s]+\.[a-z]{2,}$", "website": r"^[a-z0-9.-]+\.[a-z]{2,}$", "facebook": r"^https?://", "instagram": r"^https?://", "linkedin": r"^https?://"}


def assertions(base: Base, delivered: DataFrame, known_sectors: list[str], sector_keys: dict[str, str], most_in_several: float = 5.0) -> DataFrame:
    """(check, value, severity, ok): the eighteen things that must hold of a base. Tables left out are not asked."""
    one = lambda name, df, severity="FAIL": df.select(F.lit(name).alias("check"), F.col("value").cast("double").alias("value"), F.lit(severity).alias("severity"), (F.coalesce("value", F.lit(0)) == 0).alias("ok"))
    count = lambda df: df.agg(F.count(F.lit(1)).alias("value"))
    none = lambda df, c: df.agg(F.count_if(F.col(c).isNull()).alias("value"))
    c, s, k, e = base.companies, base.sites, base.contacts, base.emails.filter("verification_status <> 'invalid'")
    parts = []
    if base.rows is not None:
        landed = base.rows.groupBy("source_file_id").agg(F.count(F.lit(1)).alias("n"))
        parts.append(one("raw rows reconcile with the declared count", count(base.source_files.join(landed, F.col("id") == F.col("source_file_id"), "left").filter(~F.col("row_count").eqNullSafe(F.coalesce("n", F.lit(0)))))))
    lineage = reduce(DataFrame.unionByName, [none(df, "source_file_id") for df in (c, s, k)]).agg(F.sum("value").alias("value"))
    parts.append(one("everything carries its file", lineage))
    parts.append(one("every company is in a file", count(c.join(base.company_sources.select(F.col("company_id").alias("id")), "id", "left_anti"))))
    parts.append(one("every sector has rules", count(base.source_files.select("sector").filter(F.col("sector").isNotNull() & ~F.col("sector").isin(*known_sectors)).distinct())))
    keys = F.element_at(F.create_map(*[F.lit(x) for pair in sector_keys.items() for x in pair]), F.col("sector"))
    several = base.company_sources.join(base.source_files.select(F.col("id").alias("source_file_id"), keys.alias("key")), "source_file_id").filter("key IS NOT NULL").groupBy("company_id").agg(F.countDistinct("key").alias("n"))
    share = several.agg(F.round(100 * F.try_divide(F.count_if(F.col("n") > 1), F.count(F.lit(1))), 2).alias("value"))
    parts.append(share.select(F.lit("companies in several sectors (percent)").alias("check"), "value", F.lit("WARN").alias("severity"), (F.coalesce("value", F.lit(0.0)) <= most_in_several).alias("ok")))
    both = s.join(c.select(F.col("id").alias("company_id"), "siren"), "company_id")
    parts.append(one("siren is the start of siret", count(both.filter("siret IS NOT NULL AND siren IS NOT NULL AND left(siret, 9) <> siren"))))
    parts.append(one("siret has fourteen digits", count(s.filter("siret IS NOT NULL AND NOT trim(siret) RLIKE '^[0-9]{14}$'"))))
    parts.append(one("postcode has five digits", count(s.filter("postal_code IS NOT NULL AND NOT trim(postal_code) RLIKE '^[0-9]{5}$'")), "WARN"))
    parts.append(one("a business is delivered once", delivered.agg((F.count(F.lit(1)) - F.countDistinct("business_id")).alias("value"))))
    parts.append(one("e-mails have a dotted domain", count(e.filter(~F.col("email_address").rlike(r"^[^@\s]+@[^@\s]+\.[A-Za-z]{2,}$"))), "WARN"))
    parts.append(one("at most one primary e-mail a contact", count(base.emails.filter("is_primary").groupBy("contact_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))))
    parts.append(one("no two domains welded together", count(e.filter(F.lower(F.get(F.split("email_address", "@"), F.lit(1))).rlike(r"\.(fr|com|net|org)[a-z]{2,}\.")))))
    parts.append(one("no invalid e-mail is delivered", count(delivered.filter("email_status = 'invalid'"))))
    if base.contact_points is not None:
        p = base.contact_points
        bad = p.filter("kind = 'email' AND verdict IN ('invalid', 'malformed')").select("company_id", F.col("value_norm").alias("address")).distinct()
        mails = e.join(k.select(F.col("id").alias("contact_id"), "company_id"), "contact_id").withColumn("address", F.lower("email_address"))
        parts.append(one("no condemned address in use", count(mails.join(bad, ["company_id", "address"], "left_semi"))))
        fine = p.filter("kind = 'phone' AND is_dialable").select("company_id", "value_norm")
        barred = p.filter("kind = 'phone' AND is_dialable = false").join(fine, ["company_id", "value_norm"], "left_anti")
        dialled = k.select("company_id", F.regexp_replace(F.coalesce("phone_main", F.lit("")), r"\D", "").alias("value_norm"))
        parts.append(one("no barred phone is dialled", count(barred.join(dialled, ["company_id", "value_norm"]))))
        shaped = F.lit(True)
        for kind, pattern in VALUE_SHAPES.items():
            shaped = F.when(F.col("kind") == kind, F.col("value_norm").rlike(pattern)).otherwise(shaped)
        parts.append(one("values have the shape of their kind", count(p.filter(~F.col("verdict").eqNullSafe(F.lit("malformed"))).filter(~shaped))))
    parts.append(one("nothing is pending that has an activity code", count(c.filter("qualification_status = 'pending' AND naf_code IS NOT NULL")), "WARN"))
    empty = [(s, "source_status"), (c, "naf_label"), (k, "phone_main"), (k, "full_name")]
    hollow = reduce(DataFrame.unionByName, [df.agg((F.count(name) == 0).cast("long").alias("value")) for df, name in empty]).agg(F.sum("value").alias("value"))
    parts.append(one("no mapped column is empty", hollow))
    return quality.report(parts)


def sector_bands(base: Base, delivered: DataFrame, bands: dict[str, dict[str, tuple[float, float]]]) -> DataFrame:
    """(sector, check, value, ok): delivered businesses, share of duplicates and versions of the rules of each primary sector against its bands.

    ``bands`` gives of a sector the limits of ``deliverable`` and ``dup_pct``; one without has ``ok`` NULL. More than
    one version at a time is never ok.
    """
    company = base.companies.join(base.source_files.select(F.col("id").alias("source_file_id"), "sector"), "source_file_id")
    facts = company.groupBy("sector").agg(F.round(100 * F.try_divide(F.count_if(F.col("duplicate_of").isNotNull()), F.count(F.lit(1))), 2).alias("dup_pct"),
                                          F.countDistinct(F.when(F.col("qualification_status") != "unqualified", F.col("rule_version"))).cast("double").alias("uniform"))
    sent = delivered.groupBy(F.col("primary_sector").alias("sector")).agg(F.count(F.lit(1)).cast("double").alias("deliverable"))
    long = facts.join(sent, "sector", "left").select("sector", F.explode(F.array(*[F.struct(F.lit(x).alias("check"), F.coalesce(F.col(x), F.lit(0.0)).alias("value")) for x in ("deliverable", "dup_pct", "uniform")])).alias("x")).select("sector", "x.*")
    ok = F.when(F.col("check") == "uniform", F.col("value") <= 1)
    for sector, limits in bands.items():
        for check, (low, high) in limits.items():
            ok = ok.when((F.col("sector") == sector) & (F.col("check") == check), F.col("value").between(low, high))
    return long.withColumn("ok", ok)
