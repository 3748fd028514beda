"""Views: best child, collapses, counts and families over parents and children."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators import relational as R
from gristmill.plans.registry import query
from gristmill.sources.tables import table


def _best_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    order = [F.when(F.col("l_returnflag") == "N", 0).otherwise(1), R.descending(F.col("l_extendedprice")), F.col("l_linenumber")]
    children = lines.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag", "l_extendedprice")
    parents = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return R.best_child(parents, children, "o_orderkey", F.col("l_returnflag") != "R", order).withColumn("l_linenumber", F.col("l_linenumber").cast("string"))


BEST = """SELECT o_orderkey, o_custkey, o_totalprice, CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_returnflag, l_extendedprice FROM orders LEFT JOIN (
  SELECT * FROM lineitem WHERE l_returnflag <> 'R'
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END, l_extendedprice DESC, l_linenumber) = 1) ON l_orderkey = o_orderkey"""


@query(BEST)
def best_child_lateral(spark: SparkSession, d: str) -> DataFrame:
    """Each order with its best admissible line."""
    return _best_lines(spark, d)


@query(f"""WITH best AS ({BEST}), business AS (
  SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) = 1)
SELECT c_nationkey, c_mktsegment, o_custkey, o_orderkey, o_totalprice FROM business JOIN customer ON c_custkey = o_custkey
QUALIFY row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) = 1""")
def deliverable_two_pass(spark: SparkSession, d: str) -> DataFrame:
    """One order a customer, then one customer a family (nation and segment)."""
    business = R.first_per_group(_best_lines(spark, d), ["o_custkey"], [R.descending(F.col("o_totalprice")), F.col("o_orderkey")])
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    family = R.first_per_group(business.join(customers, "o_custkey"), ["c_nationkey", "c_mktsegment"], [R.descending(F.col("o_totalprice")), F.col("o_orderkey")])
    return family.select("c_nationkey", "c_mktsegment", "o_custkey", "o_orderkey", "o_totalprice")


@query("""SELECT r_name, count(*) AS leads, count(*) FILTER (WHERE c_acctbal > 0) AS positive, count(DISTINCT c_mktsegment) AS segments
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY r_name""")
def leads_by_region(spark: SparkSession, d: str) -> DataFrame:
    """Filtered counts by region."""
    nations = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    joined = table(spark, d, "customer").join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("r_name").agg(F.count(F.lit(1)).alias("leads"), F.count_if(F.col("c_acctbal") > 0).alias("positive"), F.countDistinct("c_mktsegment").alias("segments"))


@query("""SELECT sector, provider, count(DISTINCT f.source_file_id) AS files, count(r.row_id) AS n_rows, count(DISTINCT r.siret) AS sirets
FROM source_files f LEFT JOIN ingest_rows r USING (source_file_id) GROUP BY sector, provider""")
def pipeline_summary(spark: SparkSession, d: str) -> DataFrame:
    """Files, rows and identifiers of each sector and provider."""
    rows = table(spark, d, "ingest_rows").select("source_file_id", "row_id", "siret")
    files = table(spark, d, "source_files").select("source_file_id", "sector", "provider")
    per = files.join(rows, "source_file_id", "left").groupBy("sector", "provider")
    return per.agg(F.countDistinct("source_file_id").alias("files"), F.count("row_id").alias("n_rows"), F.countDistinct("siret").alias("sirets"))


@query("""SELECT md5(upper(trim(adresse)) || '|' || codePostal) AS family, count(DISTINCT siren) AS companies, string_agg(DISTINCT siren, ',' ORDER BY siren) AS sirens
FROM population WHERE trim(adresse) <> '' AND codePostal IS NOT NULL GROUP BY 1 HAVING count(DISTINCT siren) > 1""")
def shared_address_families(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of several companies."""
    rows = table(spark, d, "population").filter("trim(adresse) <> '' AND codePostal IS NOT NULL")
    key = F.md5(F.concat(F.upper(F.trim("adresse")), F.lit("|"), F.col("codePostal"))).alias("family")
    members = rows.select(key, "siren").distinct()  # copies are gone before anything is gathered
    groups = members.groupBy("family").agg(F.count("siren").alias("companies"), F.array_join(F.array_sort(F.collect_list("siren")), ",").alias("sirens"))
    return groups.filter("companies > 1")


@query("""SELECT siren, string_agg(DISTINCT sector, '|' ORDER BY sector) AS sectors, count(DISTINCT sector) AS n FROM (
  SELECT substr(siret, 1, 9) AS siren, sector FROM ingest_rows JOIN source_files USING (source_file_id) WHERE length(siret) = 14) GROUP BY siren""")
def sector_membership(spark: SparkSession, d: str) -> DataFrame:
    """Sectors a company is a member of, as a sorted list."""
    rows = table(spark, d, "ingest_rows").filter("length(siret) = 14").join(table(spark, d, "source_files").select("source_file_id", "sector"), "source_file_id")  # it grows: whether it is broadcast is the optimizer's to say
    got = rows.groupBy(F.substring("siret", 1, 9).alias("siren")).agg(F.array_sort(F.collect_set("sector")).alias("s"))
    return got.select("siren", F.array_join("s", "|").alias("sectors"), F.size("s").cast("bigint").alias("n"))


@query("""SELECT r_name, n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def rollup_region(spark: SparkSession, d: str) -> DataFrame:
    """National roll-up: totals, by region, by nation."""
    nations = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    joined = table(spark, d, "customer").join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.rollup("r_name", "n_name").agg(F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("""SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 100""")
def priority_queue_topk(spark: SparkSession, d: str) -> DataFrame:
    """The hundred most urgent orders."""
    return table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("""SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 250000)""")
def anti_already_sent(spark: SparkSession, d: str) -> DataFrame:
    """Customers not in the registry of those already served."""
    sent = table(spark, d, "orders").filter("o_totalprice > 250000").select(F.col("o_custkey").alias("c_custkey"))
    return R.missing_from(table(spark, d, "customer").select("c_custkey", "c_name"), sent, "c_custkey")


@query("""SELECT 'listings' AS source, name, postcode, phone, NULL AS gerant FROM listings UNION ALL SELECT 'population', raisonSociale, codePostal, telephone, gerant FROM population
UNION ALL SELECT 'eleveurs', raisonSociale, codePostal, telephone, gerant FROM eleveurs_export""")
def source_union(spark: SparkSession, d: str) -> DataFrame:
    """Differing sources in one schema."""
    rename = {"raisonSociale": "name", "codePostal": "postcode", "telephone": "phone"}
    frames = {"listings": table(spark, d, "listings"), "population": table(spark, d, "population").withColumnsRenamed(rename), "eleveurs": table(spark, d, "eleveurs_export").withColumnsRenamed(rename)}
    return R.union_to(["name", "postcode", "phone", "gerant"], frames)


@query("""SELECT DISTINCT l.listing_no, p.siret FROM listings l JOIN population p ON (l.name = p.raisonSociale) OR (upper(l.city) = upper(p.ville) AND l.alt_name = p.enseigne)""")
def either_match(spark: SparkSession, d: str) -> DataFrame:
    """Disjunctive join as two hash joins."""
    left = table(spark, d, "listings").select("listing_no", "name", "alt_name", F.upper("city").alias("lc"))
    right = table(spark, d, "population").select("siret", "raisonSociale", "enseigne", F.upper("ville").alias("pc"))
    return R.either_join(left, right, [F.col("name") == F.col("raisonSociale"), (F.col("lc") == F.col("pc")) & (F.col("alt_name") == F.col("enseigne"))], ["listing_no", "siret"])


@query("""SELECT p_type, p_partkey, p_retailprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part) WHERE rank <= 3""")
def verdict_samples(spark: SparkSession, d: str) -> DataFrame:
    """Three samples of each type."""
    parts = table(spark, d, "part").select("p_type", "p_partkey", "p_retailprice")
    return R.top_k(parts, ["p_type"], [F.desc("p_retailprice"), F.col("p_partkey")], 3)


VERDICT = """CASE WHEN p_size IS NULL THEN 'pending|no_size' WHEN p_brand LIKE 'Brand#1%' OR p_brand LIKE 'Brand#3%' THEN 'tier1|prefix' WHEN regexp_matches(p_type, '(?i)\\b(steel|brass)\\b') THEN 'tier2|keyword'
  WHEN p_size > 40 THEN 'out|too_large' ELSE 'out|none' END"""


def _verdict(spark: SparkSession, d: str) -> DataFrame:
    said = (
        F.when(F.col("p_size").isNull(), "pending|no_size").when(F.col("p_brand").rlike("^Brand#[13]"), "tier1|prefix")
        .when(F.col("p_type").rlike(r"(?i)\b(steel|brass)\b"), "tier2|keyword").when(F.col("p_size") > 40, "out|too_large").otherwise("out|none")
    )
    return table(spark, d, "part").select("p_partkey", F.split(said, r"\|").alias("v")).select("p_partkey", F.col("v")[0].alias("status"), F.col("v")[1].alias("reason"))


@query(f"SELECT p_partkey, split_part({VERDICT}, '|', 1) AS status, split_part({VERDICT}, '|', 2) AS reason FROM part")
def verdict_case(spark: SparkSession, d: str) -> DataFrame:
    """First rule that holds, split into status and reason."""
    return _verdict(spark, d)


@query(f"SELECT split_part({VERDICT}, '|', 1) AS status, split_part({VERDICT}, '|', 2) AS reason, count(*) AS n FROM part GROUP BY 1, 2")
def verdict_distribution(spark: SparkSession, d: str) -> DataFrame:
    """What the rules would decide, before they are applied."""
    return _verdict(spark, d).groupBy("status", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT row_id, sector FROM ingest_rows JOIN source_files USING (source_file_id) WHERE sector = 'agriculture' AND naf_code_source IS DISTINCT FROM '01.13Z'""")
def stale_selector(spark: SparkSession, d: str) -> DataFrame:
    """Rows of one sector whose version (here the activity code) differs or is missing."""
    from gristmill.operators.base import stale

    files = table(spark, d, "source_files").select("source_file_id", "sector")
    rows = table(spark, d, "ingest_rows").select("row_id", "source_file_id", "naf_code_source").join(files, "source_file_id")
    return stale(rows, "naf_code_source", "01.13Z", sector="agriculture").select("row_id", "sector")
