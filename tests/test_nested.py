import json

from gristmill.functions import nested
from pyspark.sql import functions as F


def test_registry_units(spark, tmp_path):
    unit = {"siren": "111111111", "nom_raison_sociale": "EARL ROGNANT", "activite_principale": "01.45Z", "dirigeants": [
        {"type_dirigeant": "personne physique", "nom": "PINSON (BRISARD)", "prenoms": "Anne", "qualite": "Gérant"}, {"type_dirigeant": "personne physique", "nom": "ROGNANT", "prenoms": "Éric", "qualite": "Gérant"},
        {"type_dirigeant": "personne physique", "nom": "AAA", "qualite": "Commissaire aux comptes titulaire"}, {"type_dirigeant": "personne morale", "nom": "ROGNANT"}],
        "matching_etablissements": [{"siret": "11111111100011", "etat_administratif": "A", "code_postal": "63000", "liste_enseignes": ["", "Brand"]}, {"siret": "11111111100022", "etat_administratif": "F", "code_postal": "63000"}, {"siret": "11111111100033", "etat_administratif": "A", "code_postal": "01000", "nom_commercial": "Shop"}]}
    path = tmp_path / "u.jsonl"
    path.write_text(json.dumps(unit) + "\n" + json.dumps({"siren": "2", "nom_raison_sociale": None}) + "\nbroken\n")
    from gristmill.sources.tables import read_json_units

    units = read_json_units(spark, str(path), nested.UNIT_SCHEMA)
    rows = {r["siret"]: r for r in nested.establishments(units).withColumn("reject", nested.reject_reason("63", ["01."])).collect()}
    assert {k: (r["reject"], r["enseigne"]) for k, r in rows.items()} == {"11111111100011": ("", "Brand"), "11111111100022": ("closed", None), "11111111100033": ("elsewhere", "Shop")}
    best = {r["siren"]: r["o"] for r in units.filter("siren IS NOT NULL").select("siren", nested.best_officer(F.col("dirigeants"), F.col("nom_raison_sociale")).alias("o")).collect()}
    assert (best["111111111"]["last_name"], best["111111111"]["first_names"]) == ("ROGNANT", "Éric") and best["2"] is None


def test_role_rank(column):
    assert column(nested.role_rank, ["Gérant", "Président de SAS", "Vice-président", "Liquidateur", "Associé", "Commissaire aux comptes", "Autre", None]) == [1, 1, 3, 5, 2, None, 4, 4]


def test_linked_data(column):
    page = '<script type="application/ld+json">{"@graph":[{"@type":["Thing","Farm"],"name":"Ferme X","telephone":"04","email":"A@B.fr","address":{"streetAddress":"1 r","postalCode":"63000","addressLocality":"V"}}]}</script><script type="application/ld+json">oops</script>'
    plain = '<script type="application/ld+json">[{"@type":"Organization"},{"@type":"Store","name":"S","address":"all in one"}]</script>'
    got = column(nested.business_of, [page, plain, "<p>none</p>", None])
    assert tuple(got[0]) == ("Ferme X", "04", "a@b.fr", "1 r", "63000", "V") and (got[1]["name"], got[1]["street"]) == ("S", "all in one") and got[2] is None and got[3] is None


def test_registrant(column):
    card = lambda *p: ["vcard", [list(x) for x in p]]
    both = json.dumps({"entities": [{"roles": ["administrative"], "vcardArray": card(("fn", {}, "text", "Admin"), ("email", {}, "text", "ADM@x.fr"))}, {"roles": ["registrant"], "vcardArray": card(("fn", {}, "text", "Holder"))}]})
    assert [tuple(x) for x in column(nested.registrant, [both, '{"entities":[]}', "x", None])] == [("Admin", "adm@x.fr"), (None, None), (None, None), (None, None)]


def test_social_page(column):
    cases = [("https://www.facebook.com/BoulangerieMarius/", "https://www.facebook.com/BoulangerieMarius"), ("https://facebook.com/X/posts/1", None), ("https://facebook.com/sharer.php?u=x", None), ("https://m.facebook.com/profile.php?id=123456", "https://www.facebook.com/profile.php?id=123456"),
             ("https://instagram.com/some.one/?hl=fr", "https://www.instagram.com/some.one"), ("https://instagram.com/p/abc", None), ("https://fr.linkedin.com/Company/acme/about", "https://www.linkedin.com/company/acme"), ("", None), (None, None)]
    assert column(nested.social_page, [c[0] for c in cases]) == [c[1] for c in cases]


def test_notice_roles(spark):
    person = lambda n: {"numeroImmatriculation": {"numeroIdentification": n}}
    data = [("1", "vente", ["333 333 333"], json.dumps({"personne": [person("111 111 111")]}), json.dumps({"precedentExploitant": person("222222222")})), ("2", "collective", ["444444444", "x"], None, "broken"), ("3", "vente", None, None, None)]
    df = spark.createDataFrame(data, "id string, familleavis string, registre array<string>, listepersonnes string, listeprecedentexploitant string")
    assert sorted(map(tuple, nested.notice_roles(df).collect())) == [("1", "111111111", "acquéreur"), ("1", "222222222", "cédant"), ("1", "333333333", "partie"), ("2", "444444444", "principal")]


def test_small_helpers(column, spark):
    assert column(lambda c: nested.detail_get(c, "b"), ["a=1; b=2", "a=1", None]) == ["2", None, None]
    assert column(lambda a, b: nested.merge_tags(a, b), [("x|y", "y| z"), (None, "")]) == ["x|y|z", ""]
    assert column(lambda c: nested.tags_by_rule(c, {"lait": "lait|fromage", "miel": r"\bmiel"}), ["Miel et fromage", "pain", None]) == ["lait|miel", "", ""]
    assert column(lambda a, b: nested.first_reason({"name": (a, "vin"), "site": (b, "biere|vin")}), [("du vin", "x"), ("x", "biere.fr"), (None, None)]) == ["name:vin", "site:biere", ""]
    assert column(lambda c: nested.code_label(c, {"1": "one"}), ["1", "2", None]) == ["one", "2", None]
    got = spark.createDataFrame([(["0891000000", "0600000000", "0400000000", "0600000000"],)], "p array<string>").select(nested.split_phones(F.col("p")).alias("s"), nested.premium_last(F.col("p")).alias("l")).collect()[0]
    assert got["s"]["mobiles"] == ["0600000000"] and got["l"][-1] == "0891000000"
    assert column(lambda d, f, n: nested.email_shapes(d, f, n), [("x.fr", "Éric", "Le Goff")])[0] == ["eric.legoff@x.fr", "elegoff@x.fr", "contact@x.fr", "e.legoff@x.fr", "eric@x.fr", "legoff@x.fr"]
