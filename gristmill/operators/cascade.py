"""Matching cascade: listings to establishments by rungs of falling evidence; a rung hits, rejects or misses.

Every rung is a blocked equi-join and takes only the listings that no earlier one decided. Rungs that compare words meet
only where both share a word of the prefix that a similarity of ``least`` forces, so a postcode that holds a third of
all rows isn't squared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions import contact, dates, geo, names, places
from gristmill.functions.text import norm
from gristmill.operators.dedup import rarest_first
from gristmill.operators.spatial import distance_join
from gristmill.session import cut_lineage

#: Methods in order of their evidence (fixed values).
RUNGS = ["siret_exact", "siren_unique", "geo_only", "geo_name", "addr_street", "addr_name", "addr_recent", "name_exact", "name_fuzzy"]
NAME_LEAST, GEO_M, GEO_ALONE_M, STREET_LEAST = 0.62, 150.0, 40.0, 0.6
#: How much nearer, and how much more alike, the first must be than the next.
GEO_LEAD_M, NAME_LEAD = 5.0, 0.02


def _with_missing(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with those of ``columns`` that it lacks as NULL."""
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in columns if c not in df.columns])


def _commune(c: Column) -> Column:
    """Normal form of a town, ``ST``, ``STE`` and a lone ``S`` between words written out; NULL where nothing is left."""
    out = norm(c)
    for short, full in ((r"\bSTE\b", "SAINTE"), (r"\bST\b", "SAINT"), (r"(?<=\w )S(?= \w)", "SUR")):
        out = F.regexp_replace(out, short, full)
    return F.nullif(out, F.lit(""))


def _name_sets(*columns: str) -> Column:
    """Word sets of several names in order, NULL and blank ones as empty sets."""
    return F.array(*[F.array_distinct(names.tokens(F.coalesce(c, F.lit("")))) for c in columns])


def listing_side(df: DataFrame) -> DataFrame:
    """Listings in the shape the rungs take: id l, words of its names in order and of the address, postcode, commune, point, digits of its identifier."""
    df = _with_missing(df, "alt_name", "city")
    point, parts = geo.located(F.col("lat"), F.col("lon")), places.address_parts(F.coalesce("address", F.lit("")))
    df = df.select("*", point.alias("_at"), parts.alias("_parts"))
    point, parts = F.col("_at"), F.col("_parts")
    return df.select(F.col("listing_no").alias("l"), _name_sets("name")[0].alias("l_words"), _name_sets("name", "alt_name").alias("l_names"), _commune(F.col("city")).alias("commune"), F.regexp_replace(F.coalesce("siret", F.lit("")), "[^0-9]", "").alias("digits"),
                     contact.clean_postal_code(F.col("postcode")).alias("cp"), parts["house"].alias("house"), parts["words"].alias("l_street"), point["lat"].alias("lat"), point["lon"].alias("lon")).dropDuplicates(["l"])


def registry_side(df: DataFrame) -> DataFrame:
    """Establishments likewise: id p, each name and all of them together; several rows of one siret count as its first by name and address."""
    df = _with_missing(df, "date_creation", "enseigne", "denomination_legale", "gerant", "ville")
    first = df.groupBy("siret").agg(F.min(F.struct("raisonSociale", "adresse", "codePostal", "lat", "lon", "date_creation", "enseigne", "denomination_legale", "gerant", "ville")).alias("x")).select("siret", "x.*")
    point, parts = geo.located(F.col("lat"), F.col("lon")), places.address_parts(F.coalesce("adresse", F.lit("")))
    first = first.select("*", point.alias("_at"), parts.alias("_parts"), F.concat_ws(" ", "raisonSociale", "denomination_legale", "gerant").alias("_all"))
    point, parts = F.col("_at"), F.col("_parts")
    return first.select(F.col("siret").alias("p"), dates.parse_date(F.col("date_creation")).alias("opened"), F.array_distinct(F.filter(_name_sets("raisonSociale", "enseigne", "denomination_legale", "gerant", "_all"), lambda w: F.size(w) > 0)).alias("p_names"), _commune(F.col("ville")).alias("commune"),
                        contact.clean_postal_code(F.col("codePostal")).alias("cp"), parts["house"].alias("house"), parts["words"].alias("p_street"), point["lat"].alias("lat"), point["lon"].alias("lon"))


def _prefix(words: Column, least: float) -> Column:
    """Words of which two sets with a Jaccard similarity of ``least`` share one, of sets in an order that all rows use."""
    return F.slice(words, 1, F.greatest(F.size(words) - F.ceil(F.size(words) * F.lit(least)).cast("int") + 1, F.lit(0)))


def _jaccard(a: str | Column, b: str | Column) -> Column:
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def _named() -> Column:
    """Whether the listing's name is like one of the establishment's names."""
    return F.exists("p_names", lambda w: _jaccard("l_words", w) >= NAME_LEAST)


def _decided(df: DataFrame, rung: Column, hit: Column, reason: str) -> DataFrame:
    """(l, p, rung, reason) where ``hit`` says which row of (l, p, ...) is taken; else ``p`` is NULL and ``reason`` says why."""
    return df.select("l", F.when(hit, F.col("p")).alias("p"), rung.alias("rung"), F.when(~hit, reason).alias("reason"))


def by_identifier(listings: DataFrame, registry: DataFrame) -> DataFrame:
    """The siret itself, else the only establishment of its company, or the only one of the listing's postcode."""
    siblings = registry.select(F.substring("p", 1, 9).alias("siren"), "p", F.col("cp").alias("p_cp"))
    same = listings.filter("length(digits) >= 9").select("l", "cp", "digits", F.substring("digits", 1, 9).alias("siren")).join(siblings, "siren")
    local = F.col("cp") == F.col("p_cp")
    counted = same.groupBy("l").agg(
        F.max(F.when(F.col("digits") == F.col("p"), F.col("p"))).alias("exact"), F.count(F.lit(1)).alias("n"), F.count_if(local).alias("n_cp"), F.min("p").alias("any"), F.min(F.when(local, F.col("p"))).alias("local"))
    found = counted.filter("exact IS NOT NULL OR n = 1 OR n_cp = 1").withColumn("p", F.coalesce("exact", F.when(F.col("n") == 1, F.col("any")), "local"))
    return _decided(found, F.when(F.col("exact").isNotNull(), RUNGS[0]).otherwise(RUNGS[1]), F.lit(True), "")


def by_point(listings: DataFrame, registry: DataFrame) -> DataFrame:
    """The nearest establishment of a like name within ``GEO_M``, else the only one within ``GEO_ALONE_M``.

    Only those of the listing's commune count where the registry knows that commune, else those of its postcode, else
    all. Two of a like name about as near, or several that near without one, are a rejection.
    """
    known = lambda c: registry.select(F.col(c)).filter(F.col(c).isNotNull()).distinct().withColumn(f"has_{c}", F.lit(True))
    pooled = listings.filter("lat IS NOT NULL").select("l", "l_words", "commune", "cp", "lat", "lon").join(known("commune"), "commune", "left").join(known("cp"), "cp", "left")
    near = distance_join(pooled.select("l", "l_words", F.when(F.col("has_commune"), F.col("commune")).alias("l_commune"), F.when(F.col("has_cp"), F.col("cp")).alias("l_cp"), "lat", "lon"), registry.select("p", "p_names", "commune", "cp", "lat", "lon"), GEO_M)
    pool = F.when(F.col("l_commune").isNotNull(), F.col("commune").eqNullSafe(F.col("l_commune"))).when(F.col("l_cp").isNotNull(), F.col("cp").eqNullSafe(F.col("l_cp"))).otherwise(True)
    near = near.filter(pool).select("l", "p", "distance_m", _named().alias("named"))
    placed = near.withColumn("place", F.row_number().over(Window.partitionBy("l").orderBy(F.desc("named"), "distance_m", "p"))).filter("place <= 2")
    at = lambda k, c: F.max(F.when(F.col("place") == k, F.col(c)))
    two = placed.groupBy("l").agg(*[at(k, c).alias(f"{c}{k}") for k in (1, 2) for c in ("p", "distance_m", "named")]).withColumn("p", F.col("p1"))
    by_name, second = F.col("named1"), F.coalesce("named2", F.lit(False))
    clear = F.when(by_name, ~second | (F.col("distance_m2") - F.col("distance_m1") >= GEO_LEAD_M)).otherwise(F.coalesce(F.col("distance_m2") > GEO_ALONE_M, F.lit(True)))
    return _decided(two.filter(by_name | (F.col("distance_m1") <= GEO_ALONE_M)), F.when(by_name, "geo_name").otherwise("geo_only"), clear, "several_near")


def by_address(listings: DataFrame, registry: DataFrame, min_gap_days: int) -> DataFrame:
    """The only establishment at the number and street of the postcode, else the only one of a like name there, else one opened long after the next."""
    block = ["cp", "house", "word"]
    left = listings.filter("cp IS NOT NULL AND house IS NOT NULL").select("l", "l_words", "l_street", "cp", "house", F.explode(_prefix(F.col("l_street"), STREET_LEAST)).alias("word"))
    right = registry.filter("cp IS NOT NULL AND house IS NOT NULL").select("p", "p_names", "p_street", "opened", "cp", "house", F.explode(_prefix(F.col("p_street"), STREET_LEAST)).alias("word"))
    met = left.join(right, block).filter(_jaccard("l_street", "p_street") >= STREET_LEAST)
    met = met.select("l", "p", F.coalesce("opened", F.lit("0001-01-01").cast("date")).alias("opened"), _named().alias("named")).distinct()
    placed = met.withColumn("place", F.row_number().over(Window.partitionBy("l").orderBy(F.desc("opened"), "p")))
    at = lambda k, c: F.max(F.when(F.col("place") == k, F.col(c)))
    one = placed.groupBy("l").agg(at(1, "p").alias("newest"), F.datediff(at(1, "opened"), at(2, "opened")).alias("gap"), F.count(F.lit(1)).alias("n"), F.count_if("named").alias("n_named"), F.min("p").alias("only"), F.min(F.when(F.col("named"), F.col("p"))).alias("with_name"))
    one = one.withColumn("p", F.when(F.col("n") == 1, F.col("only")).when(F.col("n_named") == 1, F.col("with_name")).otherwise(F.col("newest")))
    rung = F.when(F.col("n") == 1, "addr_street").when(F.col("n_named") == 1, "addr_name").otherwise("addr_recent")
    return _decided(one, rung, (F.col("n") == 1) | (F.col("n_named") == 1) | (F.col("gap") >= min_gap_days), "one_address")


def by_name(listings: DataFrame, registry: DataFrame) -> DataFrame:
    """By name in one place: each name of a listing in turn, within the postcode and then the commune.

    The first of these tries whose best establishment is more than ``NAME_LEAD`` ahead of the next is a hit; where there
    is none but some try was ambiguous, it is a rejection.
    """
    places_of = F.array(*[F.struct(F.lit(k).alias("pool"), F.col(c).alias("at")) for k, c in enumerate(["cp", "commune"])])
    placed = lambda df, *columns: df.select(*columns, F.explode(F.filter(places_of, lambda x: x["at"].isNotNull())).alias("x")).select(*columns, "x.*")
    block = ["pool", "at", "word"]
    left = placed(listings.select("l", "cp", "commune", F.posexplode("l_names").alias("turn", "l_words")), "l", "turn", "l_words").withColumn("word", F.explode(_prefix(F.col("l_words"), NAME_LEAST)))
    right = placed(registry.select("p", "cp", "commune", F.explode("p_names").alias("p_words")), "p", "p_words").withColumn("word", F.explode(_prefix(F.col("p_words"), NAME_LEAST)))
    alike = left.join(right, block).select("l", (F.col("turn") * 2 + F.col("pool")).alias("try"), "p", _jaccard("l_words", "p_words").alias("score")).filter(F.col("score") >= NAME_LEAST)
    scored = alike.groupBy("l", "try", "p").agg(F.max("score").alias("score"))
    ranked = scored.withColumn("place", F.row_number().over(Window.partitionBy("l", "try").orderBy(F.desc("score"), "p"))).filter("place <= 2")
    at = lambda k, c: F.max(F.when(F.col("place") == k, F.col(c)))
    tries = ranked.groupBy("l", "try").agg(at(1, "p").alias("p"), at(1, "score").alias("score"), (at(1, "score") - F.coalesce(at(2, "score"), F.lit(0.0)) > NAME_LEAD).alias("clear"))
    best = tries.groupBy("l").agg(F.min(F.when(F.col("clear"), F.struct("try", "p", "score"))).alias("x")).select("l", "x.p", "x.score")
    return _decided(best, F.when(F.coalesce(F.col("score"), F.lit(0.0)) == 1, "name_exact").otherwise("name_fuzzy"), F.col("p").isNotNull(), "several_names")


def match(listings: DataFrame, registry: DataFrame, min_gap_days: int = 365) -> DataFrame:
    """(l, p, rung, outcome, reason) of every listing that some rung decides; ``p`` is NULL for a rejection.

    Several establishments at one address that no name tells apart: the one opened at least ``min_gap_days`` after the
    next is taken, else the rung rejects. A missing date counts as the oldest. Listings that no rung decides have no row.
    """
    every_word = registry.select(F.explode(F.concat(F.flatten("p_names"), "p_street")).alias("w"))
    order = rarest_first(every_word)  # so that sets meet at their rarest words
    names_in_order = lambda c: F.transform(c, lambda w: order(w))
    listings = cut_lineage(listings.withColumns({"l_words": order("l_words"), "l_names": names_in_order("l_names"), "l_street": order("l_street")}))  # taken apart once, read by every rung
    registry = cut_lineage(registry.withColumns({"p_names": names_in_order("p_names"), "p_street": order("p_street")}))
    found: list[DataFrame] = []
    for rung in (by_identifier, by_point, lambda a, b: by_address(a, b, min_gap_days), by_name):
        found.append(cut_lineage(rung(listings, registry)))
        listings = listings.join(found[-1].select("l"), "l", "left_anti")
    return reduce(DataFrame.unionByName, found).select("l", "p", "rung", F.when(F.col("p").isNotNull(), "hit").otherwise("reject").alias("outcome"), "reason")


def winners(matched: DataFrame, sources: DataFrame) -> DataFrame:
    """(p, source, l, rung, beaten): of the listings of one source matched to one establishment the one of best evidence, then the least id.

    ``sources`` is (l, source); ``beaten`` counts the others. A NULL source is one of its own.
    """
    rank = F.array_position(F.array(*map(F.lit, RUNGS)), F.col("rung"))
    each = matched.filter("outcome = 'hit'").join(sources.dropDuplicates(["l"]), "l")
    best = each.groupBy("p", "source").agg(F.min(F.struct(rank.alias("k"), "l", "rung")).alias("x"), (F.count(F.lit(1)) - 1).alias("beaten"))
    return best.select("p", "source", "x.l", "x.rung", "beaten")
