"""Snapshots that change without losing anything: upserts, fills, unloads, resumes, identity, folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.operators.relational import first_per_group


def upsert_keep(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Full outer merge on a unique key where an existing value is never overwritten, only NULLs are filled."""
    o, n = old.alias("o"), new.alias("n")
    columns = [c for c in old.columns if c != key]
    picked = [F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c) if c in new.columns else F.col(f"o.{c}") for c in columns]
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(F.coalesce(F.col(f"o.{key}"), F.col(f"n.{key}")).alias(key), *picked)


def fill_nulls(rows: DataFrame, facts: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``rows`` with NULLs of ``columns`` filled from the facts of the same key."""
    small = facts.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    filled = rows.join(small, key, "left")
    return filled.select(*[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) if c in columns else F.col(c) for c in rows.columns])


def insert_absent(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The old rows and those new ones whose key isn't there yet."""
    return old.unionByName(new.join(old.select(key), key, "left_anti"), allowMissingColumns=True)


def without_file(rows: DataFrame, file_id: int, column: str = "source_file_id") -> DataFrame:
    """Everything but what one file contributed; rows of no file stay."""
    return rows.filter(~F.col(column).eqNullSafe(F.lit(file_id)))


def unseen_files(files: DataFrame, done: DataFrame, digest: str) -> DataFrame:
    """Files whose content hash hasn't been processed; among equal ones the first by name."""
    fresh = files.join(done.select(digest).distinct(), digest, "left_anti")
    return first_per_group(fresh, [digest], [F.col("file_name")])


def keep_verdict(old: DataFrame, new: DataFrame, key: str, verdict: str = "verdict", unknown: str = "inconnu") -> DataFrame:
    """Earlier verdicts stay unless they were unknown or absent and the new run knows better."""
    o, n = F.nullif(F.col("o"), F.lit(unknown)), F.nullif(F.col("n"), F.lit(unknown))
    both = old.select(key, F.col(verdict).alias("o")).join(new.select(key, F.col(verdict).alias("n")), key, "full_outer")
    return both.select(key, F.coalesce(o, n, F.lit(unknown)).alias(verdict))


def merge_certificates(rows: DataFrame, key: str, scalars: list[str], lists: list[str], order: str) -> DataFrame:
    """Rows of one key merged: each scalar from the first row that has it, each list without repeats, in sorted order."""
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(order).alias("o"), F.col(c).alias("v"))))["v"].alias(c)
    return rows.groupBy(key).agg(*[first(c) for c in scalars], *[F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.split(c, r"\s*[|;]\s*"))))), "|").alias(c) for c in lists])


def resolve_owner(found: DataFrame, owners: DataFrame, row: str, identifier: str, owner: str) -> DataFrame:
    """What becomes of recovered identifiers: ``duplicate`` of the owner that has it, else the first row of the batch owns it and the others are ``collision``."""
    first = found.filter(F.col(identifier).isNotNull()).groupBy(identifier).agg(F.min(row).alias("_first"))
    joined = found.join(first, identifier, "left").join(owners.select(identifier, owner), identifier, "left")
    outcome = F.when(F.col(identifier).isNull(), "none").when(F.col(owner).isNotNull(), "duplicate").when(F.col(row) == F.col("_first"), "owned").otherwise("collision")
    return joined.select(row, identifier, outcome.alias("outcome"), F.coalesce(F.col(owner), F.when(F.col(row) != F.col("_first"), F.col("_first"))).alias("of"))


def verify_fold(probes: DataFrame) -> DataFrame:
    """Verdict on recorded mailbox probes (email, domain, dns, catch_all, rcpt_code): our own failure never condemns.

    Bad syntax or a dead domain is invalid; a catch-all is risky; 250 is valid, 5xx invalid; anything else unknown.
    """
    verdict = (
        F.when(~F.coalesce(F.col("email").rlike(r"^[^@\s]+@[^@\s]+\.[a-z]{2,}$"), F.lit(False)), "invalide")
        .when(F.col("dns") == "dead", "invalide").when(F.coalesce(F.col("dns"), F.lit("")) != "mail_ok", "inconnu")
        .when(F.col("catch_all"), "risque").when(F.col("rcpt_code") == 250, "valide").when(F.col("rcpt_code").between(500, 599), "invalide").otherwise("inconnu")
    )
    return probes.withColumn("verdict", verdict)


def fold_status(events: DataFrame, entity: str, time: str, tie: str, status: Column, definitive: list[str]) -> DataFrame:
    """Status of each entity by its dated events: the last word wins, unless a definitive one was said.

    Two map-side maxima, so an entity with any number of events is never collected or sorted. Events without a
    status or a date say nothing.
    """
    said = events.withColumn("_status", status).filter(F.col("_status").isNotNull() & F.col(time).isNotNull())
    last = F.struct(F.col(time).alias("t"), F.col(tie).alias("i"), F.col("_status").alias("s"))
    agg = said.groupBy(entity).agg(F.max(last).alias("last"), F.max(F.when(F.col("_status").isin(*definitive), last)).alias("final"), F.count(F.lit(1)).alias("events"))
    return agg.select(entity, F.coalesce("final.s", "last.s").alias("status"), F.coalesce("final.t", "last.t").alias("since"), "events")


def liveness(proofs: DataFrame, entity: str, family: str, day: str, as_of: Column, windows: dict[str, int]) -> DataFrame:
    """One point for each independent family with a proof inside its window of days, and which they are."""
    fresh = F.lit(False)
    for name, days in windows.items():
        fresh = fresh | ((F.col(family) == name) & F.datediff(as_of, F.col(day)).between(0, days))
    return proofs.groupBy(entity).agg(F.array_sort(F.collect_set(F.when(fresh, F.col(family)))).alias("proofs")).select(entity, F.size("proofs").alias("score"), F.array_join("proofs", "+").alias("proofs"))


def call_sheet(rows: DataFrame, order: str, siret: str, phone: str, sent: DataFrame) -> DataFrame:
    """Which rows reach the sheet: filters come before claims, then the first row of a phone claims it.

    Outcome: ``no_phone``, ``sent`` (phone already delivered), ``repeat`` (siret seen before), ``merged`` (phone
    claimed before, into row ``into``), ``kept``. Claims are minima by the declared order, no sequential pass.
    """
    known = rows.join(F.broadcast(sent.select(phone).distinct().withColumn("_sent", F.lit(True))) if sent.limit(200_001).count() <= 200_000 else sent.select(phone).distinct().withColumn("_sent", F.lit(True)), phone, "left")
    open_ = known.filter(F.col(phone).isNotNull() & F.col("_sent").isNull())
    by_siret = open_.filter(F.col(siret).isNotNull()).groupBy(siret).agg(F.min(order).alias("_first_siret"))
    kept = open_.join(by_siret, siret, "left").filter(F.coalesce(F.col("_first_siret"), F.col(order)) == F.col(order))
    by_phone = kept.groupBy(phone).agg(F.min(order).alias("_first_phone"))
    joined = known.join(by_siret, siret, "left").join(by_phone, phone, "left")
    outcome = (
        F.when(F.col(phone).isNull(), "no_phone").when(F.col("_sent"), "sent").when(F.col("_first_siret") < F.col(order), "repeat")
        .when(F.col("_first_phone") < F.col(order), "merged").otherwise("kept")
    )
    return joined.select(order, siret, phone, outcome.alias("outcome"), F.when(outcome == "merged", F.col("_first_phone")).alias("into"))


def last_verdict(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of each key said last."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last()))).filter("_rank = 1").drop("_rank")


def elect_primary(rows: DataFrame, group: str, flag: str, usable: Column, order: list[Column]) -> DataFrame:
    """``rows`` where a group without a usable flagged row gets one: the first usable by ``order``; flags of unusable rows go."""
    kept = rows.withColumn("_usable", F.coalesce(usable, F.lit(False))).withColumn(flag, F.coalesce(F.col(flag), F.lit(False)) & F.col("_usable"))
    keys = [o.alias(f"o{i}") for i, o in enumerate(order)]
    need = kept.groupBy(group).agg(F.max(flag).alias("_has"), F.min(F.when(F.col("_usable"), F.struct(*keys))).alias("_first"))
    joined = kept.join(need, group, "left")
    chosen = F.col("_usable") & ~F.col("_has") & (F.struct(*keys) == F.col("_first"))
    return joined.withColumn(flag, F.col(flag) | F.coalesce(chosen, F.lit(False))).drop("_usable", "_has", "_first")


def propagate_invalid(emails: DataFrame, verdicts: DataFrame, address: str, verdict: str) -> DataFrame:
    """Every row of an address that any source found invalid is invalid; other verdicts stay."""
    bad = verdicts.filter(F.col(verdict) == "invalide").select(F.lower(F.trim(address)).alias("_bad")).distinct().withColumn("_hit", F.lit(True))
    return emails.join(bad, F.lower(F.trim(emails[address])) == F.col("_bad"), "left").withColumn(verdict, F.when(F.col("_hit"), "invalide").otherwise(F.col(verdict))).drop("_bad", "_hit")


def recovery_verdict(found: DataFrame, query: str, identifier: str, score: str) -> DataFrame:
    """What a search says of each query: one exact name is confident, several ambiguous, else probable from 0.8, else weak."""
    exact = F.col(score) >= 1.0
    got = found.groupBy(query).agg(F.countDistinct(F.when(exact, F.col(identifier))).alias("n"), F.min(F.when(exact, F.col(identifier))).alias("exact"),
                                   F.max(F.when(F.col(identifier).isNotNull(), F.struct(F.col(score).alias("s"), F.col(identifier).alias("i")))).alias("best"))
    verdict = F.when(F.col("best").isNull(), "no_result").when(F.col("n") == 1, "confident").when(F.col("n") > 1, "ambiguous").when(F.col("best.s") >= 0.8, "probable").otherwise("weak")
    return got.select(query, verdict.alias("verdict"), F.when(F.col("n") == 1, F.col("exact")).when(F.col("n") == 0, F.col("best.i")).alias(identifier))


def unit_state(asked: DataFrame, units: DataFrame, siret: str) -> DataFrame:
    """State of each asked establishment: its own of the unit with its siren, else that unit's head office, else unknown.

    ``units`` is (siren, etabs ARRAY<STRUCT<siret, etat, siege>>); a unit with another siren is never taken.
    """
    joined = asked.select(siret, F.substring(siret, 1, 9).alias("siren")).join(units, "siren", "left")
    own = F.get(F.filter("etabs", lambda e: e["siret"] == F.col(siret)), F.lit(0))["etat"]
    head = F.get(F.filter("etabs", lambda e: e["siege"]), F.lit(0))["etat"]
    state = F.coalesce(own, head)
    return joined.select(siret, F.when(state == "A", "actif").when(state == "F", "ferme").otherwise("inconnu").alias("state"), F.when(own.isNotNull(), "own").when(head.isNotNull(), "head").alias("by"))


def confidence_level(active: Column, score: Column, provider_only: Column, alert: Column) -> Column:
    """How sure a business is: ``Sûr`` (active in the registry, two dated proofs or more, known not only from a provider, no
    alert), ``Probable`` (at least one proof), NULL without any, which drops it. NULL counts as no and as zero.
    """
    yes = lambda c: F.coalesce(c, F.lit(False))
    proofs = F.coalesce(score, F.lit(0))
    return F.when(yes(active) & (proofs >= 2) & ~yes(provider_only) & ~yes(alert), "Sûr").when(proofs >= 1, "Probable")


def backfill_status(rows: DataFrame, raw: DataFrame, key: str, json: str, keys: list[str], order: str, status: str = "is_active") -> DataFrame:
    """``rows`` whose NULL ``status`` is filled from landed JSON: definitive words before unknown ones, closed before active, then by ``order``.

    ``raw`` is (key, json, order); of several spellings of the field the first a row has counts. What is known stays.
    """
    from gristmill.functions.contact import normalize_status

    said = F.coalesce(*[F.nullif(F.trim(F.get_json_object(json, f"$['{k}']")), F.lit("")) for k in keys])
    told = raw.filter(F.col(key).isNotNull()).select(key, said.alias("said"), F.col(order).alias("_o")).filter("said IS NOT NULL").withColumn("s", normalize_status(F.col("said")))
    facts = first_per_group(told, [key], [F.col("s").isNull(), F.coalesce(F.col("s"), F.lit(False)), F.col("said"), F.col("_o")]).select(key, F.col("s").alias(status))
    return fill_nulls(rows, facts, key, [status])


def audit_row(name: str, **frames: DataFrame) -> DataFrame:
    """(run, counts) of one run: the rows of each named table as one JSON object, to be appended where runs are kept."""
    counts = None
    for label, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("label"), "n")
        counts = one if counts is None else counts.unionByName(one)
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "n"))))
    return counts.agg(F.to_json(entries).alias("counts")).select(F.lit(name).alias("run"), "counts")
