"""Queries of the operators in this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import contact
from gristmill.llm import entity_match, format_duplicates, mixing, packing, reading_level, representative, same_address
from gristmill.llm.tokens import token_counts
from gristmill.session import cut_lineage
from gristmill.sources.tables import table

#: Tables whose records repeat: id, columns that don't count, addresses, pairs that may change places.
REPEATING = {
    "ingest_rows": ("row_id", {"row_id", "source_file_id", "row_index", "loaded_at"}, ["email_address"], [("address_line1", "address_line2"), ("phone_main", "phone_alt")]),
    "eleveurs_export": ("export_no", {"export_no", "exported_at"}, ["email"], []),
}


def _repeats(spark: SparkSession, folder: str, name: str) -> tuple[DataFrame, str, DataFrame]:
    id_col, aside, loose, swaps = REPEATING[name]
    df = table(spark, folder, name)
    return df, id_col, format_duplicates.repeated_rows(df, id_col, [c for c in df.columns if c not in aside], loose, swaps)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each row that repeats another record in other writing (problem 1)."""
    parts = [_repeats(spark, folder, name)[2].select(F.lit(name).alias("table_name"), "first_id", "copy_id") for name in REPEATING]
    return parts[0].unionByName(parts[1])


def p1_records(spark: SparkSession, folder: str) -> DataFrame:
    """One record each with its number of copies."""
    parts = []
    for name in REPEATING:
        df, id_col, found = _repeats(spark, folder, name)
        parts.append(format_duplicates.collapse(df, id_col, found).select(F.lit(name).alias("table_name"), "first_id", "n_copies"))
    return parts[0].unionByName(parts[1])


def _exports(spark: SparkSession, folder: str, alone: bool = False, untimed: bool = False) -> tuple[DataFrame, dict]:
    """Rows of producteurs_export by siret with ranks and currency, and the fields that compete.

    With ``alone`` the rows without a usable siret are there too; column ``group`` is the siret, or theirs alone. With
    ``untimed`` no row keeps its time: what is current is inferred from the order in which versions follow each other.
    """
    sources = {"telephone_final": "source_telephone", "email_final": "source_email", "website_final": "source_website"}
    rows = table(spark, folder, "producteurs_export").withColumn("siret", contact.clean_siret(F.col("siret")))
    rows = rows.withColumn("version", F.regexp_extract(F.coalesce("export_version", F.lit("")), r"^(v\d+)", 1))
    labelled = table(spark, folder, "source_ranks").withColumn("source", contact.source_label(F.col("source")))
    rows = representative.ranked(rows, labelled, {f: contact.source_label(F.col(s)) for f, s in sources.items()})
    usable = {
        "telephone_final": contact.national_digits(F.col("telephone_final")).isNotNull(),
        "email_final": contact.usable_email(F.col("email_final")) & ~F.coalesce(F.lower(contact.trimmed(F.col("email_statut"))) == "invalide", F.lit(False)),
        "website_final": contact.usable_website(F.col("website_final")),
    }
    if alone:
        rows = rows.withColumn("group", F.coalesce("siret", F.concat(F.lit("#"), F.col("export_no"))))
    else:
        rows = rows.filter("siret IS NOT NULL")
    if untimed:
        grouped = representative.with_currency(rows.withColumn("exported_at", F.lit(None).cast("timestamp")), "siret", "exported_at", "export_no", ["version"], rows)
    else:
        grouped = representative.with_currency(rows, "group" if alone else "siret", "exported_at", "export_no", ["version", "statut_sirene"])
    return grouped, {f: (usable[f], F.col(f"_rank_{f}")) for f in sources}


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Whose telephone, e-mail and website survive for each siret exported more than once (problem 2)."""
    rows, fields = _exports(spark, folder)
    return representative.survivors(rows, "siret", "export_no", fields).filter("n_rows > 1").select("siret", "field", F.col("id").alias("export_no"))


def p2_untimed(spark: SparkSession, folder: str) -> DataFrame:
    """The same where no row says when it was exported: currency by the learned order of versions alone."""
    rows, fields = _exports(spark, folder, untimed=True)
    return representative.survivors(rows, "siret", "export_no", fields).filter("n_rows > 1").select("siret", "field", F.col("id").alias("export_no"))


def p2_survivors(spark: SparkSession, folder: str) -> DataFrame:
    """One surviving row per siret, filled field by field; a row without a usable siret stands alone (siret NULL)."""
    rows, fields = _exports(spark, folder, alone=True)
    rest = ["raisonSociale", "gerant", "codeNAF", "adresse", "codePostal", "ville", "sous_segment", "productions", "statut_sirene"]
    merged = representative.merged(rows, "group", "export_no", fields, rest)
    return merged.withColumn("group", F.when(~F.startswith("group", F.lit("#")), F.col("group"))).withColumnRenamed("group", "siret")


def p6_matches(spark: SparkSession, folder: str) -> DataFrame:
    """The establishment of each listing with a confidence."""
    listings = entity_match.features(table(spark, folder, "listings"), "listing_no", ["name", "alt_name"], "address", "postcode", "city", "lat", "lon", "siret")
    names = ["raisonSociale", "enseigne", "denomination_legale", "gerant"]
    newest = F.max(F.struct("loaded_at", *names, "adresse", "codePostal", "ville", "lat", "lon"))  # the latest row of a siret, delivered twice or not
    places = table(spark, folder, "population").groupBy("siret").agg(newest.alias("x")).select("siret", "x.*")
    registry = entity_match.features(places, "siret", names, "adresse", "codePostal", "ville", "lat", "lon", "siret")
    return entity_match.match(listings, registry).select(F.col("rid").alias("listing_no"), F.lpad(F.col("found").cast("string"), 14, "0").alias("siret"), "confidence")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each listing with the establishment it describes (problem 6)."""
    return p6_matches(spark, folder).select("listing_no", "siret")


def p7_locations(spark: SparkSession, folder: str) -> DataFrame:
    """The location of each establishment; equal numbers are one place."""
    return same_address.locations(table(spark, folder, "population"), "siret", "adresse", "codePostal", "ville").select(F.col("key").alias("siret"), "location")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each pair of establishments at one location (problem 7)."""
    located = p7_locations(spark, folder).withColumnRenamed("siret", "key")
    return same_address.pairs_at_one_place(located).select(F.col("key").alias("siret_a"), F.col("other").alias("siret_b"))


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    """Every document packed into containers of every capacity (problem 8)."""
    return packing.pack_documents(token_counts(table(spark, folder, "documents")), table(spark, folder, "pack_sizes"))


def p8_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """What must not be of each set of containers: any over its capacity, documents lost or held twice, cut without need."""
    sizes = token_counts(table(spark, folder, "documents"))
    packed = cut_lineage(packing.pack_documents(sizes, table(spark, folder, "pack_sizes")))
    sets = table(spark, folder, "pack_sizes")
    over = packed.groupBy("container_set", "container_id").agg(F.sum("tokens").alias("used")).join(F.broadcast(sets), "container_set").groupBy("container_set").agg(F.count_if(F.col("used") > F.col("capacity_tokens")).alias("over_capacity"))
    each = packed.groupBy("container_set", "doc_id").agg(F.sum("tokens").alias("packed"), F.count(F.lit(1)).alias("parts")).join(F.broadcast(sets), "container_set").join(sizes.withColumnRenamed("id", "doc_id"), "doc_id", "full_outer")
    wrong = each.groupBy("container_set").agg(F.count_if(~F.col("packed").eqNullSafe(F.col("tokens"))).alias("lost_or_repeated"), F.count_if((F.col("parts") > 1) & (F.col("tokens") <= F.col("capacity_tokens"))).alias("cut_without_need"))
    return over.join(wrong, "container_set", "full_outer")


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Containers, used and unused space of each set."""
    return packing.container_report(p8_containers(spark, folder))


def p9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Documents chosen, with their repeats, so that every source gives its target share (problem 9)."""
    return mixing.mix(token_counts(table(spark, folder, "documents"), keep=("source",)), table(spark, folder, "mix_targets"))


def p9_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """What must not be of each source: documents of another source, more repeats than allowed, tokens off their target by more than the two longest documents."""
    chosen = cut_lineage(p9_mixture(spark, folder))
    longest = chosen.agg(F.max("tokens").alias("longest"), F.sum(F.col("tokens") * F.col("repeats")).alias("all_tokens"))
    targets = table(spark, folder, "mix_targets")
    documents = table(spark, folder, "documents").select("doc_id", F.col("source").alias("own"))
    foreign = chosen.join(documents, "doc_id", "left").groupBy("source").agg(F.count_if(~F.col("own").eqNullSafe(F.col("source"))).alias("foreign"))
    far = F.abs(F.col("tokens") - F.col("target_share") * longest.select("all_tokens").scalar()) > 2 * longest.select("longest").scalar()
    off = mixing.shares(chosen, targets).select("source", (F.col("most_repeats") > F.col("max_repeats")).cast("bigint").alias("too_often"), far.cast("bigint").alias("off_target"))
    return off.join(foreign, "source", "left").select("source", "too_often", "off_target", F.coalesce("foreign", F.lit(0)).alias("foreign"))


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Shares reached beside their targets, documents chosen beside those a share asks for."""
    sizes = token_counts(table(spark, folder, "documents"), keep=("source",))
    return mixing.shares(p9_mixture(spark, folder), table(spark, folder, "mix_targets"), sizes)


def p10_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Score and reading level of every document."""
    documents = table(spark, folder, "documents")
    return reading_level.predict(documents, reading_level.fit(documents, table(spark, folder, "doc_levels")))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of level 4 or 5 (problem 10)."""
    return p10_levels(spark, folder).filter("level >= 4").select("doc_id")


def p10_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Profile of the corpus: documents of each level by source."""
    by = p10_levels(spark, folder).join(table(spark, folder, "documents").select("doc_id", "source"), "doc_id")
    return by.groupBy("source", "level").agg(F.count(F.lit(1)).alias("documents"), F.round(F.avg("score"), 3).alias("mean_score"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (p1_found, p1_records, p2_found, p2_untimed, p2_survivors, p6_found, p6_matches, p7_found, p7_locations, p8_containers, p8_invariants, p8_fill, p9_mixture, p9_invariants, p9_shares, p10_found, p10_levels, p10_profile)
    return {f.__name__: f for f in found}


def _repeats_sql(name: str, columns: list[str]) -> str:
    """Rows that repeat another by canonical strings: what the hashes must agree with."""
    id_col, aside, loose, swaps = REPEATING[name]
    plain = "regexp_replace(lower(nfc_normalize(coalesce({c}, ''))), '[^\\p{{L}}\\p{{N}}\\p{{M}}]', '', 'g')"
    mail = "regexp_replace(regexp_replace(lower(nfc_normalize(coalesce({c}, ''))), '[\\s' || chr(160) || ']+', '', 'g'), '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+$', '', 'g')"
    fold = {c: (mail if c in loose else plain).format(c=c) for c in columns}
    parts = [fold[c] for c in columns if not any(c in pair for pair in swaps)]
    parts += [f"{f}({fold[a]}, {fold[b]})" for a, b in swaps for f in ("least", "greatest")]
    return f"SELECT '{name}' AS table_name, first_id, copy_id FROM (SELECT {id_col} AS copy_id, min({id_col}) OVER (PARTITION BY {', '.join(parts)}) AS first_id FROM {name}) WHERE first_id <> copy_id"


INGEST = "trade_name legal_name contact_full_name address_line1 address_line2 postal_code city phone_main phone_alt siret email_address naf_label naf_code_source status_raw effectif_raw".split()
BREEDERS = "raisonSociale siret gerant telephone email siteWebs codeNAF adresse codePostal ville productions statut_sirene".split()

SIRET = "regexp_replace(regexp_replace(trim(siret), '\\.0+$', ''), '[\\s.\\-]', '', 'g')"
DIGITS = "regexp_replace(regexp_replace(telephone_final, '[^0-9]', '', 'g'), '^(?:0033|33)([0-9]{9})$', '0\\1')"
HOST = "regexp_replace(regexp_replace(regexp_replace(lower(trim(website_final)), '^[a-z][a-z0-9+.\\-]*://', ''), '[/?#].*$', ''), '^www\\.', '')"
P2_SQL = f"""WITH e AS (SELECT *, {SIRET} AS s FROM producteurs_export), g AS (SELECT *, count(*) OVER (PARTITION BY s) AS n FROM e WHERE regexp_matches(s, '^[0-9]{{14}}$')), c AS (
 SELECT s, 'telephone_final' AS field, source_telephone AS src, exported_at, export_no FROM g WHERE n > 1 AND regexp_matches({DIGITS}, '^0[1-9][0-9]{{8}}$') UNION ALL
 SELECT s, 'email_final', source_email, exported_at, export_no FROM g WHERE n > 1 AND regexp_matches(trim(email_final), '^[^@\\s]+@[^@\\s.]+(\\.[^@\\s.]+)+$') AND lower(trim(coalesce(email_statut, ''))) <> 'invalide' UNION ALL
 SELECT s, 'website_final', source_website, exported_at, export_no FROM g WHERE n > 1 AND regexp_matches({HOST}, '^[^\\s.]+(\\.[^\\s.]+)+$'))
SELECT s AS siret, c.field, export_no FROM c LEFT JOIN source_ranks k ON k.field = c.field AND k.source = lower(trim(regexp_replace(c.src, '(?s)\\(.*$', '')))
QUALIFY row_number() OVER (PARTITION BY s, c.field ORDER BY coalesce(rank_hint, 1000000), exported_at DESC, export_no) = 1"""
#: Levels of versions as they are learned: edges between those that follow each other often, the longest way to each.
LEVELS_SQL = """ts AS (SELECT s, exported_at, v, min(export_no) AS o FROM e WHERE regexp_matches(s, '^[0-9]{14}$') AND exported_at IS NOT NULL GROUP BY ALL), follow AS (SELECT lag(v) OVER w AS older, v AS newer, lag(exported_at) OVER w < exported_at AS later FROM ts WINDOW w AS (PARTITION BY s ORDER BY exported_at, o)),
counted AS (SELECT older, newer, count(*) AS n FROM follow WHERE later AND older <> newer GROUP BY ALL), edges AS (SELECT a.older, a.newer FROM counted a LEFT JOIN counted b ON b.older = a.newer AND b.newer = a.older WHERE a.n >= 3 AND a.n >= 0.8 * (a.n + CASE WHEN b.n >= 3 THEN b.n ELSE 0 END)),
ways AS (SELECT DISTINCT v, 0 AS d FROM e UNION SELECT newer, d + 1 FROM ways JOIN edges ON older = v), levels AS (SELECT v, max(d) AS d FROM ways GROUP BY v), """
P2_UNTIMED_SQL = P2_SQL.replace("WITH e AS (SELECT *,", "WITH RECURSIVE e AS (SELECT *, regexp_extract(coalesce(export_version, ''), '^(v[0-9]+)', 1) AS v,").replace("g AS (SELECT *,", LEVELS_SQL + "g AS (SELECT *,", 1).replace("exported_at, export_no FROM g", "v, export_no FROM g").replace("ON k.field = c.field", "ON k.field = c.field", 1)
P2_UNTIMED_SQL = P2_UNTIMED_SQL.replace("FROM c LEFT JOIN source_ranks", "FROM c JOIN levels USING (v) LEFT JOIN source_ranks").replace("exported_at DESC, export_no) = 1", "d DESC, export_no) = 1")


def _records_sql(name: str, columns: list[str]) -> str:
    """Every record with how often it stands there."""
    return f"SELECT '{name}' AS table_name, t.{REPEATING[name][0]} AS first_id, 1 + coalesce(n, 0) AS n_copies FROM {name} t LEFT JOIN (SELECT first_id, count(*) AS n FROM ({_repeats_sql(name, columns)}) GROUP BY first_id) f ON f.first_id = t.{REPEATING[name][0]} WHERE t.{REPEATING[name][0]} NOT IN (SELECT copy_id FROM ({_repeats_sql(name, columns)}))"




def oracle_sql() -> dict[str, str]:
    """SQL for what SQL can express; the other operators are tested in tests/llm."""
    repeats = f"{_repeats_sql('ingest_rows', INGEST)} UNION ALL {_repeats_sql('eleveurs_export', BREEDERS)}"
    records = f"{_records_sql('ingest_rows', INGEST)} UNION ALL {_records_sql('eleveurs_export', BREEDERS)}"
    sound = "SELECT container_set, 0 AS over_capacity, 0 AS lost_or_repeated, 0 AS cut_without_need FROM pack_sizes"
    mixed = "SELECT source, 0 AS too_often, 0 AS off_target, 0 AS foreign FROM mix_targets"
    return {"p1_found": repeats, "p1_records": records, "p2_found": P2_SQL, "p2_untimed": P2_UNTIMED_SQL, "p8_invariants": sound, "p9_invariants": mixed}
