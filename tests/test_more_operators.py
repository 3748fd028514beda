import pytest
from gristmill.functions import pages
from gristmill.operators import claims, lifecycle, quality, relational
from pyspark.sql import functions as F


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_relational_extras(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", None)], "k string, v string")
    assert rows(relational.most_frequent(df, ["k"], "v")) == [("a", "x", 2)]
    ids = spark.range(100)
    assert rows(relational.sample_by_hash(ids, "id", 5)) == rows(relational.sample_by_hash(ids.repartition(7), "id", 5))
    tags = spark.createDataFrame([({"phone": " ", "contact:phone": "1"},)], "t map<string,string>")
    assert tags.select(relational.first_tag(F.col("t"), "phone", "contact:phone").alias("p")).collect()[0]["p"] == "1"


def test_claim_extras(spark):
    df = spark.createDataFrame([("d", "1"), ("d", "2"), ("d", "3"), ("e", "1")], "domain string, email string")
    assert rows(claims.crowded(df, "domain", "email", 2)) == [("e", "1")]
    c = spark.createDataFrame([("e", 2, "b", "x|y"), ("e", 1, " ", "y|z"), ("f", None, None, None)], "e string, r int, d string, s string")
    assert rows(claims.context(c, "e", F.col("r"), ["d"], ["s"])) == [("e", "b", "x|y|z"), ("f", None, "")]
    s = spark.createDataFrame([("site", True), ("site", False), ("client", None)], "source string, ok boolean")
    assert rows(claims.admissible(s, [((F.col("source") == "site") & ~F.col("ok"), None), (F.col("source") == "client", F.lit("provider"))], "source").select("source")) == [("provider",), ("site",)]
    r = spark.createDataFrame([("e", 1, "pages.example"), ("e", 2, "own.example"), ("e", 3, "late.example"), ("f", 1, None)], "e string, n int, h string")
    assert rows(claims.first_site(r, "e", "n", "h", ["pages.example"])) == [("e", "own.example", 2)]


def test_lifecycle_extras(spark):
    df = spark.createDataFrame([(1, "c", True, "invalide"), (2, "c", False, "valide"), (3, "c", None, None), (4, "d", True, None)], "id int, c string, p boolean, v string")
    got = {r["id"]: r["p"] for r in lifecycle.elect_primary(df, "c", "p", ~F.col("v").eqNullSafe(F.lit("invalide")), [F.col("id")]).collect()}
    assert got == {1: False, 2: True, 3: False, 4: True}
    mails = spark.createDataFrame([(1, "A@b.fr", "valide"), (2, "c@d.fr", None)], "id int, a string, v string")
    assert rows(lifecycle.propagate_invalid(mails, spark.createDataFrame([("a@b.fr ", "invalide")], "a string, v string"), "a", "v").select("id", "v")) == [(1, "invalide"), (2, None)]
    found = spark.createDataFrame([("q1", "a", 1.0), ("q1", "b", 0.5), ("q2", "a", 1.0), ("q2", "b", 1.0), ("q3", "a", 0.85), ("q4", "a", 0.2), ("q5", None, None)], "q string, i string, s double")
    assert rows(lifecycle.recovery_verdict(found, "q", "i", "s")) == [("q1", "confident", "a"), ("q2", "ambiguous", None), ("q3", "probable", "a"), ("q4", "weak", "a"), ("q5", "no_result", None)]
    units = spark.createDataFrame([("111111111", [("11111111100011", "F", False), ("11111111100022", "A", True)])], "siren string, etabs array<struct<siret:string,etat:string,siege:boolean>>")
    asked = spark.createDataFrame([("11111111100011",), ("11111111100099",), ("22222222200011",)], "siret string")
    assert rows(lifecycle.unit_state(asked, units, "siret")) == [("11111111100011", "ferme", "own"), ("11111111100099", "actif", "head"), ("22222222200011", "inconnu", None)]


def test_ceiling(spark):
    df = spark.range(10)
    assert quality.ceiling(df, F.col("id") < 1, 0.2, 5, "x") == 0.1
    with pytest.raises(quality.CeilingExceeded):
        quality.ceiling(df, F.col("id") < 5, 0.2, 5, "x")
    assert quality.ceiling(df.limit(0), F.col("id") < 5, 0.2, 0, "x") == 0.0


def test_page_extras(column):
    html = '<h1>Ferme <b>X</b></h1><span itemprop="telephone">04 91 12 34 56</span><p itemprop="postalCode">13001</p> a@b.fr <a href="tel:+33 6 12 34 56 78">x</a> Tél : 04.91.00.00.01'
    got = column(pages.listing_of, [html, None])
    assert (got[0]["name"], got[0]["phone"], got[0]["email"], got[0]["postcode"], got[0]["town"]) == ("Ferme X", "04 91 12 34 56", "a@b.fr", "13001", None) and got[1]["name"] is None
    assert column(pages.phones_in_context, [html, "04 91 12 34 56", None]) == [["0491000001", "0612345678"], [], None]
    assert column(pages.in_place, [("x 13001 y", "13001", "Aix"), ("à Aix-en-P", "13100", "Aix"), ("Aixois", "13100", "Aix"), (None, None, None)]) == [True, True, False, False]
    assert column(pages.slug, ["L'Été à X!", ""]) == ["l-ete-a-x", ""]
    match = lambda h, n: pages.domain_matches_name(h, n, ["BOULANGERIE", "PAIN"])
    assert column(match, [("ohfaon.example", "OH FAON"), ("lamiedepain-boulangerie.fr", "La Mie du Pain"), ("alyncake.fr", "ALYN CAKE"), ("other.fr", None)]) == [True, False, True, False]


def test_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    import pytest

    from gristmill import session

    unset = SimpleNamespace(get=lambda *a: None)
    cluster = SimpleNamespace(conf=unset, sparkContext=SimpleNamespace(master="yarn", getConf=lambda: unset))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(cluster)
