import random

import numpy as np
import pytest
from gristmill import catalog
from gristmill.functions.geo import haversine_np
from gristmill.operators import cascade, claims, dedup, lifecycle, quality, relational, schema_drift, spatial, split_values
from gristmill.operators.split_values import FieldGrammar
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_grammar():
    g, e = FieldGrammar(), FieldGrammar(True)
    items = lambda p, t: [x[0] for x in p.parse(t)]
    assert items(g, 'a | b / c;"d, e"\tf') == ["a", "b", "c", "d, e", "f"]
    assert items(g, 'x - y-z - "q ""r"""') == ["x", "y-z", 'q "r"']
    assert items(g, "fromages (frais / affinés) + œufs") == ["fromages (frais / affinés)", "œufs"]
    assert items(g, ";; a ;; a ;") == ["a", "a"]
    assert items(e, "a@b.c d@e.f,g@h.i") == ["a@b.c", "d@e.f", "g@h.i"]
    assert items(e, "a+x@b.c + d@e.f") == ["a+x@b.c", "d@e.f"]
    assert g.parse('open "q; b')[0][2] == "open_quote" and g.parse("a (b; c")[0][2] == "open_bracket"
    assert g.parse(None) == [] and g.parse("") == [] and g.parse(" ; ") == []
    assert len(g.parse("((((" * 5000)) == 1 and len(g.parse('"' * 9999)) <= 1


@given(st.text(alphabet='ab "();,|/•+-\t\n.', max_size=40))
@settings(max_examples=300, deadline=None)
def test_grammar_never_fails(text):
    for g in (FieldGrammar(), FieldGrammar(True)):
        for item, kind, _ in g.parse(text):
            assert item == item.strip() and item and kind in ("bare", "quoted", "bracketed")


@given(st.lists(st.text(alphabet="abcé", min_size=1, max_size=5), min_size=1, max_size=6), st.sampled_from([";", ",", " | ", " - ", "\t", " + "]))
@settings(max_examples=200, deadline=None)
def test_grammar_round_trip(values, sep):
    assert [x[0] for x in FieldGrammar().parse(sep.join(f'"{v}"' if k % 2 else v for k, v in enumerate(values)))] == values


def test_split_fields(spark):
    df = spark.createDataFrame([(1, "a;b", None, "z"), (1, "a;b", "x", "z"), (2, None, "", "z"), (3, "solo", "p q", "z")], "k int, f string, g string, pos string")
    assert rows(split_values.split_fields(df, "k", {"f": False, "g": True}, least=2).select("k", "field", "pos", "item")) == [
        (1, "f", 1, "a"), (1, "f", 1, "a"), (1, "f", 2, "b"), (1, "f", 2, "b"), (3, "g", 1, "p"), (3, "g", 2, "q")]
    assert split_values.split_fields(df.limit(0), "k", {"f": False}).count() == 0


def test_drift(spark):
    files = spark.createDataFrame([(1, "p", "2025-01-01"), (9, "p", "2025-01-02"), (3, "p", "2025-01-03"), (4, "q", "2025-01-01")], "source_file_id bigint, provider string, received_at string").withColumn("received_at", F.to_timestamp("received_at"))
    raw = spark.createDataFrame([
        (1, '{"CP": "1", "Rue": "a", "N": 1}'), (1, '{"CP": "2", "N": null}'), (9, '{"CP ": "1", "Rue": ["a"], "N": 2}'), (9, '{"CP ": "1", "Rue": "junk", "N": 2}'), (9, '{"Rue": ["b"]}'),
        (3, '{"CP ": "1", "X": true}'), (3, "broken"), (3, None), (4, '{"A": 1}'),
    ], "source_file_id bigint, raw_json string")
    assert rows(schema_drift.change_report(raw, files)) == [
        (3, "added", "", "X"), (3, "removed", "N", ""), (3, "removed", "Rue", ""), (9, "renamed", "CP", "CP "), (9, "retyped", "Rue", "Rue")]
    assert schema_drift.change_report(raw.limit(0), files).count() == 0
    wide = schema_drift.consolidate(raw.withColumn("raw_id", F.monotonically_increasing_id()).withColumn("row_index", F.lit(0)))
    assert wide.count() == raw.count() and wide.filter("address_line1 = 'a'").count() == 2


@pytest.fixture(autouse=True)
def under_both_plans(plans):
    """Every operator here runs with adaptive execution and without."""


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_distance_join_needs_no_merged_partitions(spark, partitions):
    """A result must not depend on groups that meet by chance in one partition."""
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    rng = np.random.default_rng(5)
    a, b = (np.stack([45 + rng.random(1500) * 0.5, 3 + rng.random(1500) * 0.5], axis=1) for _ in range(2))
    left = spark.createDataFrame([(k, *map(float, p)) for k, p in enumerate(a)], "a int, lat double, lon double")
    right = spark.createDataFrame([(k, *map(float, p)) for k, p in enumerate(b)], "b int, lat double, lon double")
    metres = haversine_np(a[:, None, 0], a[:, None, 1], b[None, :, 0], b[None, :, 1])
    want = {(int(i), int(j)) for i, j in zip(*np.nonzero(metres <= 500))}
    for sample in (20_000, 100):
        got = [(r["a"], r["b"]) for r in spatial.distance_join(left, right, 500.0, sample_rows=sample).collect()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


@pytest.mark.parametrize("n,m", [(0, 5), (5, 0), (400, 300)])
def test_distance_join_against_brute_force(spark, n, m):
    rng = random.Random(n)
    hot = (45.0, 3.0)
    point = lambda k: hot if k % 3 == 0 else (45 + rng.random() * 0.02, 3 + rng.random() * 0.02)
    a = [(k, *point(k)) for k in range(n)] + [(10_000, None, 3.0), (10_001, float("nan"), 3.0)]
    b = [(k, *point(k)) for k in range(m)]
    left, right = spark.createDataFrame(a, "a int, lat double, lon double"), spark.createDataFrame(b, "b int, lat double, lon double")
    want = {(x[0], y[0]) for x in a[:n] for y in b if haversine_np(*map(np.float64, (x[1], x[2], y[1], y[2]))) <= 150}
    got = [(r["a"], r["b"]) for r in spatial.distance_join(left, right, 150.0, leaves=16).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_rtree():
    rng = np.random.default_rng(1)
    lat, lon = rng.random(1000), rng.random(1000)
    tree = spatial.PackedRTree(lat, lon, fanout=8)
    who, what = tree.probe(np.array([0.2, 0.9]), np.array([0.2, 0.9]), np.array([0.4, 0.91]), np.array([0.4, 0.91]))
    assert set(what[who == 0]) == set(np.nonzero((lat >= 0.2) & (lat <= 0.4) & (lon >= 0.2) & (lon <= 0.4))[0])


def test_first_per_group_ties_and_nulls(spark):
    df = spark.createDataFrame([("g", None, 2), ("g", 1, 3), ("g", 1, 2), (None, None, 1), ("h", None, 7)], "k string, v int, i int")
    assert rows(relational.first_per_group(df, ["k"], [relational.nulls_last(F.col("v")), F.col("i")])) == [("g", 1, 2), ("h", None, 7), (None, None, 1)]
    assert rows(relational.first_per_group(df.repartition(3), ["k"], [relational.descending(F.col("v")), F.col("i")]))[0] == ("g", 1, 2)


def test_dedup(spark):
    df = spark.createDataFrame([(1, "A", "x", None), (2, "A", "x", "s1"), (3, "A", "x", "s2"), (4, "A", "x", "s1"), (5, "", "x", None), (6, None, None, None)], "id int, k string, p string, siret string")
    got = rows(dedup.exact_key(df, "id", [F.col("k"), F.col("p")], "siret", [F.col("siret").isNull()]).select("id", "survivor"))
    assert got == [(1, 2), (4, 2)]
    marked = rows(dedup.mark(df.select("id"), "id", [dedup.exact_key(df, "id", [F.col("k")], "siret", [F.col("siret").isNull()])]))
    assert [r[0] for r in marked if r[1] is None] == [2, 3, 5, 6]


def test_similar_pairs_against_brute_force(spark):
    rng = random.Random(3)
    base = ["ferme du moulin", "ferme du moulin vert", "domaine des chenes", "rucher bleu", "rucher bleue", "fermes du moulin"]
    data = [(k, rng.choice(base) + rng.choice(["", " a", " xy"]), rng.choice(["p", "p", "q"])) for k in range(60)]
    from gristmill.functions.names import trigrams

    df = spark.createDataFrame(data, "id int, n string, b string")
    sets = {r["id"]: (frozenset(r["g"]), r["b"]) for r in df.select("id", "b", trigrams(F.col("n")).alias("g")).collect()}
    first = {i: min(j for j in sets if sets[j] == sets[i]) for i in sets}
    want = {(i, j) for i in set(first.values()) for j in set(first.values()) if i < j and sets[i][1] == sets[j][1] and len(sets[i][0] & sets[j][0]) / len(sets[i][0] | sets[j][0]) >= 0.7}
    want |= {(first[i], i) for i in sets if first[i] != i}  # copies are linked to the first of them
    for hot_from in (2_000, 3):
        got = [(r[0], r[1]) for r in dedup.similar_pairs(df, "id", F.col("n"), ["b"], 0.7, hot_from).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert dedup.similar_pairs(df.limit(0), "id", F.col("n"), ["b"], 0.7).count() == 0


def test_claims(spark):
    df = spark.createDataFrame([("e", "v", "a"), ("e", "v", "b"), ("e", "w", "a"), ("f", "v", "c"), ("g", "v", None), ("h", None, "a")], "e string, v string, s string")
    assert rows(claims.corroborated(df, "e", "v", "s")) == [("e", "v", 2, "corrobore(a+b)")]
    assert rows(claims.shared_values(df, "e", "v", 2)) == [("v", 3)]
    assert rows(claims.guarded(df, "e", "v", 2).select("e", "v")) == [("e", "w"), ("h", None)]
    rank = F.when(F.col("s") == "b", 1).when(F.col("s") == "a", 2)
    assert rows(claims.ranked_pick(df, "e", "v", "s", rank)) == [("e", "v", "b"), ("f", "v", "c"), ("g", "v", None)]
    assert rows(claims.ranked_list(df, "e", "v", rank)) == [("e", "v", "w"), ("f", "v", ""), ("g", "v", "")]


def test_lifecycle(spark):
    old = spark.createDataFrame([(1, "a", None), (2, None, "x")], "k int, v string, w string")
    new = spark.createDataFrame([(2, "n", "n"), (3, "n", None)], "k int, v string, w string")
    merged = lifecycle.upsert_keep(old, new, "k")
    assert rows(merged) == [(1, "a", None), (2, "n", "x"), (3, "n", None)]
    assert rows(lifecycle.upsert_keep(merged, new, "k")) == rows(merged)  # running again changes nothing
    probes = spark.createDataFrame([("a@b.fr", "mail_ok", False, 250), ("a@b.fr", "mail_ok", True, 250), ("a@b.fr", "mail_ok", False, 550), ("a@b.fr", "mail_ok", False, 451), ("a@b.fr", "dead", None, None), ("x", "mail_ok", False, 250), ("a@b.fr", None, None, None), (None, None, None, None)],
                                  "email string, dns string, catch_all boolean, rcpt_code int")
    assert [r["verdict"] for r in lifecycle.verify_fold(probes).collect()] == ["valide", "risque", "invalide", "inconnu", "invalide", "invalide", "inconnu", "invalide"]
    sheet = spark.createDataFrame([(1, "s1", "p1"), (2, "s2", "p1"), (3, "s1", "p2"), (4, None, None), (5, "s5", "sent"), (6, "s6", "p6")], "o int, siret string, phone string")
    got = {r["o"]: (r["outcome"], r["into"]) for r in lifecycle.call_sheet(sheet, "o", "siret", "phone", spark.createDataFrame([("sent",)], "phone string")).collect()}
    assert got == {1: ("kept", None), 2: ("merged", 1), 3: ("repeat", None), 4: ("no_phone", None), 5: ("sent", None), 6: ("kept", None)}
    found = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "r int, siren string")
    owners = spark.createDataFrame([("b", 99)], "siren string, owner int")
    assert [r[2] for r in rows(lifecycle.resolve_owner(found, owners, "r", "siren", "owner"))] == ["owned", "collision", "duplicate", "none"]
    verdicts = lifecycle.keep_verdict(spark.createDataFrame([("a", "valide"), ("b", "inconnu")], "e string, verdict string"), spark.createDataFrame([("a", "invalide"), ("b", "risque"), ("c", "valide")], "e string, verdict string"), "e")
    assert rows(verdicts) == [("a", "valide"), ("b", "risque"), ("c", "valide")]


def test_event_fold_is_order_free(spark):
    events = spark.createDataFrame([("u", 3, 1, "actif"), ("u", 2, 2, "ferme"), ("v", 1, 1, "actif"), ("v", 5, 2, "nouveau"), ("w", None, 3, "actif")], "u string, t int, i int, s string")
    want = [("u", "ferme", 2, 2), ("v", "nouveau", 5, 2)]
    for df in (events, events.orderBy(F.desc("i")).repartition(3)):
        assert rows(lifecycle.fold_status(df, "u", "t", "i", F.col("s"), ["ferme"])) == want


def test_quality(spark):
    df = spark.createDataFrame([("1", "a"), ("1", " "), (None, None)], "k string, v string")
    assert rows(quality.completeness(df)) == [("k", 3, 2, 66.67), ("v", 3, 1, 33.33)]
    assert rows(quality.completeness(df.limit(0)))[0][3] is None
    assert rows(quality.uniqueness(df, "t", ["k"])) == [("t.unique_k", 1, "FAIL", False)]
    assert quality.contract(df, ["k", "x"], ["y"]) == ["x", "y"]


def test_cascade(spark):
    pop = spark.createDataFrame([
        ("66666666600066", "Tri Un", "7 rue Tri", "03000", None, None), ("77777777700077", "Tri Deux", "7 rue Tri", "03000", None, None), ("11111111100011", "Ferme Dupont", "12 rue de la Gare", "63370", "45.0", "3.0"), ("22222222200022", "Rucher Bleu", "3 rue Haute", "63370", "45.1", "3.1"),
        ("33333333300033", "Domaine Vert", "9 rue Basse", "01000", None, None), ("44444444400044", "Chai Un", "5 rue Neuve", "02000", None, None), ("55555555500055", "Chai Deux", "5 rue Neuve", "02000", None, None),
    ], "siret string, raisonSociale string, adresse string, codePostal string, lat string, lon string")
    pop = pop.withColumn("date_creation", F.when(F.col("siret").startswith("6"), "2001-01-01").when(F.col("siret").startswith("7"), "03/04/2020"))
    listings = spark.createDataFrame([
        (1, "x", None, None, "11111111100011", None, None), (2, "Rucher Bleu", None, None, None, "45.1001", "3.1"), (3, "Autre", "9, r. Basse", "01000", None, None, None),
        (4, "Domaine Vert", None, "01000", None, None, None), (5, "Inconnu", "5 rue Neuve", "02000", None, None, None), (6, "rien", None, None, None, None, None), (8, "Zzz", "7 r Tri", "03000", None, None, None), (7, None, None, None, "33333333399999", None, None),
    ], "listing_no int, name string, address string, postcode string, siret string, lat string, lon string")
    got = {r["l"]: (r["p"], r["rung"], r["outcome"]) for r in cascade.match(cascade.listing_side(listings), cascade.registry_side(pop)).collect()}
    assert got == {1: ("11111111100011", "siret_exact", "hit"), 2: ("22222222200022", "geo_name", "hit"), 3: ("33333333300033", "addr_street", "hit"), 4: ("33333333300033", "name_exact", "hit"), 5: (None, "addr_recent", "reject"), 7: ("33333333300033", "siren_unique", "hit"), 8: ("77777777700077", "addr_recent", "hit")}


def test_cascade_pools_and_winners(spark):
    pop = spark.createDataFrame([
        ("11111111100011", "Ferme Un", "63370", "Ville", "45.0", "3.0"), ("22222222200022", "Ferme Deux", "63000", "Autre", "45.0001", "3.0"), ("33333333300033", "Ferme Un", "63370", "Ville", "45.00002", "3.0"), ("44444444400044", "Seul", "01000", "Loin", "46.0", "4.0"),
    ], "siret string, raisonSociale string, codePostal string, ville string, lat string, lon string").withColumn("adresse", F.lit(None).cast("string"))
    listings = spark.createDataFrame([
        (1, "Ferme Deux", "63370", "Autre", "45.0", "3.0"), (2, "Ferme Un", None, "Ville", "45.0", "3.0"), (3, "x", None, "Inconnue", "46.0", "4.0"), (4, "Seul", None, "Loin", "46.0", "4.0"), (4, "Seul", None, "Loin", "46.0", "4.0"), (5, "Ferme Deux", None, "Ville", "45.0001", "3.0"),
    ], "listing_no int, name string, postcode string, city string, lat string, lon string").withColumns({c: F.lit(None).cast("string") for c in ("address", "siret")})
    matched = cascade.match(cascade.listing_side(listings), cascade.registry_side(pop))
    got = {r["l"]: (r["p"], r["rung"], r["reason"]) for r in matched.collect()}
    assert got == {1: ("22222222200022", "geo_name", None), 2: (None, "geo_name", "several_near"), 3: ("44444444400044", "geo_only", None), 4: ("44444444400044", "geo_name", None), 5: (None, "geo_only", "several_near")}
    sources = spark.createDataFrame([(1, "a"), (3, "a"), (4, "a"), (4, "a"), (2, "b")], "l int, source string")
    assert rows(cascade.winners(matched, sources)) == [("22222222200022", "a", 1, "geo_name", 0), ("44444444400044", "a", 3, "geo_only", 1)]
    assert cascade.match(cascade.listing_side(listings.limit(0)), cascade.registry_side(pop)).count() == 0


def test_cascade_second_names_and_commune(spark):
    pop = spark.createDataFrame([
        ("11111111100011", "SARL Zig", "Ferme Dupont", None, None, "63370", "Saint-Jean"), ("22222222200022", "Rucher Bleu", None, None, None, "63000", "Clermont"),
        ("33333333300033", "EARL Zag", None, None, "Jeanne Martin", "03000", "Moulins"), ("44444444400044", "Chai Un", None, None, None, "02001", "Laon"), ("55555555500055", "Chai Un", None, None, None, "02002", "Laon"),
    ], "siret string, raisonSociale string, enseigne string, denomination_legale string, gerant string, codePostal string, ville string")
    pop = pop.withColumns({c: F.lit(None).cast("string") for c in ("adresse", "lat", "lon")})
    listings = spark.createDataFrame([
        (1, "Ferme Dupont", None, None, "St Jean"), (2, "Rucher Bleu", None, "63100", "CLERMONT"), (3, "Les Poules", "Jeanne Martin", "03000", None), (4, "Chai Un", None, None, "Laon"),
        (5, "Chai Un", None, "02002", "Laon"), (6, "Chai Un", "Jeanne Martin", "03000", "Laon"), (7, "Rucher Bleu", None, None, "Moulins"),
    ], "listing_no int, name string, alt_name string, postcode string, city string").withColumns({c: F.lit(None).cast("string") for c in ("address", "siret", "lat", "lon")})
    got = {r["l"]: (r["p"], r["outcome"]) for r in cascade.match(cascade.listing_side(listings), cascade.registry_side(pop)).collect()}
    assert got == {1: ("11111111100011", "hit"), 2: ("22222222200022", "hit"), 3: ("33333333300033", "hit"), 4: (None, "reject"), 5: ("55555555500055", "hit"), 6: ("33333333300033", "hit")}


def test_incremental(spark, tmp_path):
    from gristmill.streaming import incremental

    schema = "k string, v string, o int"
    source, snap, check = (str(tmp_path / x) for x in ("in", "snap", "check"))
    spark.createDataFrame([("a", None, 1), ("b", "x", 1), ("b", "y", 2), (None, "z", 3)], schema).write.mode("append").parquet(source)
    run = lambda: incremental.ingest(spark, source, spark.createDataFrame([], schema).schema, snap, check, "k", "o").awaitTermination()
    run()
    assert rows(incremental.snapshot_of(spark, snap).select("k", "v")) == [("a", None), ("b", "x")]
    spark.createDataFrame([("a", "late", 9), ("b", "other", 9), ("c", "n", 9)], schema).write.mode("append").parquet(source)
    run()
    run()
    assert rows(incremental.snapshot_of(spark, snap).select("k", "v")) == [("a", "late"), ("b", "x"), ("c", "n")]


def test_sources(spark, tmp_path):
    from gristmill.sources import tables

    path = str(tmp_path / "t.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write('a;b\n1;"x;y"\n2;\n')
    assert rows(tables.read_delimited(spark, path, ["a", "b", "c"])) == [("1", "x;y", None), ("2", None, None)]
    assert tables.read_delimited(spark, path + ".missing", ["a"]).count() == 0
    one, two = spark.createDataFrame([(1, "o")], "k int, v string"), spark.createDataFrame([(1, "n"), (2, "n")], "k int, v string")
    assert rows(tables.overlay([one, two], ["k"])) == [(1, "n"), (2, "n")]
    tables.write_delimited(spark.createDataFrame([("a\x00b", "p")], "t string, d string"), str(tmp_path / "out"), partition_by=("d",))
    assert spark.read.option("sep", ";").option("header", True).csv(str(tmp_path / "out")).collect()[0]["t"] == "ab"


def test_workbooks(spark, tmp_path):
    from gristmill.sources import sheets

    df = spark.createDataFrame([("00012", 3, 1.5, "a<b & \x0bc", None, "Sûr"), ("7", None, 2.0, " x ", "é", "Probable"), (None, 5, None, "", "z", "other")], "siret string, n int, v double, t string, u string, level string").repartition(2)
    path = str(tmp_path / "out.xlsx")
    sheets.write_workbook(spark, path, sheets.level_sheets(df, "level", ["Sûr", "Probable"], ["n"]) | {"all": df.orderBy("v")}, identifiers=("siret",))
    got = sheets.read_sheets(spark, path, ["siret", "n", "t", "missing"])
    assert rows(got) == [("out.xlsx", 0, "00012", "3", "a<b & c", None)]
    assert rows(sheets.read_sheets(spark, path, ["siret", "v", "u"], "all")) == [("out.xlsx", 0, None, None, "z"), ("out.xlsx", 1, "00012", "1.5", None), ("out.xlsx", 2, "7", "2", "é")]
    assert sheets.read_sheets(spark, path + ".missing", ["a"]).count() == 0
    assert sheets._column_number("AA10") == 26 and sheets._column_name(26) == "AA" and sheets._column_name(0) == "A"


def test_typed_fields(spark):
    raw = spark.createDataFrame([(1, 1, 0, '{"SAU": "12,5", "Bio": "oui", "Date_Crea": "03/04/2020", "CP": "1"}'), (2, 1, 1, '{"SAU": "many", "Bio": true, "Date_Crea": null}'), (3, 1, 2, "broken")], "raw_id bigint, source_file_id bigint, row_index int, raw_json string")
    typed = schema_drift.cast_fields(schema_drift.consolidate(raw))
    assert rows(typed.select("raw_id", "farm_area", "organic_label", F.col("creation_date").cast("string"), "misfits")) == [(1, 12.5, True, "2020-04-03", None), (2, None, True, None, '{"farm_area":"many"}'), (3, None, None, None, None)]


def test_base_edges(spark):
    """NULL in any column, repeated rows, empty tables and extra columns of clashing names."""
    from gristmill.operators import base as B

    companies = spark.createDataFrame([(1, "111111111", "qualified", 9, None, "x"), (2, "222222222", "qualified", 9, None, "x"), (3, None, "pending", None, None, "x"), (4, "444444444", "qualified", 9, "1", "x")], "id bigint, siren string, qualification_status string, source_file_id bigint, duplicate_of string, pc string")
    sites = spark.createDataFrame([(1, "11111111100011", 1, None, "1 Rue A", "1250", None), (2, None, 2, True, "1, rue a", "1250", "Fermé"), (3, None, 3, None, None, None, None), (4, None, 4, False, None, None, None)], "id bigint, siret string, company_id bigint, is_active boolean, address_line1 string, postal_code string, source_status string")
    people = spark.createDataFrame([(1, 1, 1, None, None, "Liquidateur", "rne_dirigeant"), (2, 2, 2, "B", "0491123456", None, None)], "id bigint, site_id bigint, company_id bigint, full_name string, phone_main string, job_title string, name_source string")
    mails = spark.createDataFrame([(1, 1, "a@b.fr", False, "unverified", "2020"), (2, 1, "v@b.fr", False, "valid", "2021"), (3, 1, "i@b.fr", True, "invalid", "2019")], "id bigint, contact_id bigint, email_address string, is_primary boolean, verification_status string, created_at string")
    files = spark.createDataFrame([(9, "agriculture", 1)], "id bigint, sector string, row_count int")
    base = B.Base(companies, sites, people, mails, files, spark.createDataFrame([(1, 9), (1, 9), (2, 9)], "company_id bigint, source_file_id bigint"))
    got = {r["company_id"]: r for r in B.qualified_contacts(base).collect()}
    assert set(got) == {1, 2} and got[1]["email_address"] == "v@b.fr" and got[1]["department_code"] == "01" and got[1]["shared_address_group"] == got[2]["shared_address_group"] is not None and got[2]["source_closed"] and got[1]["sectors"] == ["agriculture"]
    sent = B.deliverable(B.qualified_contacts(base), base)
    assert {r["business_id"]: r["in_liquidation"] for r in sent.collect()} == {"1": True}
    assert [r["enrichment_priority"] for r in B.enrichment_queue(sent).collect()] == [4]
    assert B.assertions(base, sent, ["agriculture"], {"agriculture": "a"}).filter("NOT ok AND severity = 'FAIL'").count() > 0
    empty = B.Base(*[df.limit(0) for df in (companies, sites, people, mails, files, base.company_sources)])
    assert B.qualified_contacts(empty).count() == 0 and B.assertions(empty, B.deliverable(B.qualified_contacts(empty), empty), [], {"a": "a"}).count() == 14


def test_confidence_and_backfill(spark):
    df = spark.createDataFrame([(True, 2, False, False), (True, 2, True, False), (None, None, None, None), (False, 1, False, True)], "a boolean, s int, p boolean, al boolean")
    assert [r[0] for r in df.select(lifecycle.confidence_level(F.col("a"), F.col("s"), F.col("p"), F.col("al"))).collect()] == ["Sûr", "Probable", None, "Probable"]
    base = spark.createDataFrame([("k", None), ("l", True), ("m", None)], "k string, is_active boolean")
    raw = spark.createDataFrame([("k", '{"Etat": "Actif"}', 1), ("k", '{"ETAT": "Fermé"}', 2), ("l", '{"Etat": "Fermé"}', 3), ("m", "broken", 4), (None, None, 5)], "k string, j string, o int")
    assert rows(lifecycle.backfill_status(base, raw, "k", "j", ["Etat", "ETAT"], "o")) == [("k", False), ("l", True), ("m", None)]
    assert rows(lifecycle.audit_row("r", a=df, b=df.limit(0))) == [("r", '{"a":4,"b":0}')]


def test_catalog_names():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
