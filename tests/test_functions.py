from gristmill.functions import contact, dates, emails, names, pages, places
from gristmill.functions.text import norm, words
from pyspark.sql import functions as F


def check(column, function, cases):
    assert column(function, [c[0] for c in cases]) == [c[1] for c in cases]


def test_siret(column):
    check(column, contact.clean_siret, [("123 456 789 00012", "12345678900012"), ("1234567890001", None), ("123456789000123", None), ("1234567890001X", None), ("nan", None), ("30819741700014.0", "30819741700014"), ("0.0", None), (None, None), ("", None), ("\xa0", None)])


def test_truncated(column):
    check(column, contact.truncated_identifier, [("2000700000012.0", "2000700000012"), ("30819741700014", None), (None, None)])


def test_luhn(column):
    check(column, contact.luhn_ok, [("30819741700014", True), ("30819741700015", False), ("x", None), (None, None)])


def test_status(column):
    check(column, contact.normalize_status, [("Actif", True), ("ACTIF", True), ("Fermé", False), ("FERMEE", False), ("Radié", False), ("Cessation d'activite", False), ("???", None), ("", None), (None, None)])


def test_postcode(column):
    check(column, contact.clean_postal_code, [("1250", "01250"), ("59000.0", "59000"), ("59 000", "59000"), ("2988.0", "02988"), ("1 RUE PASTEUR", None), ("123", None), (None, None)])


def test_department(column):
    check(column, contact.clean_department, [("69", "69"), ("26.0", "26"), ("2a", "2A"), ("SO", None)])
    check(column, places.department, [("20190", "2A"), ("20200", "2B"), ("20600", "2B"), ("97400", "974"), ("1250", "01"), (None, None)])


def test_phones(column):
    check(column, contact.clean_phone, [("33472897000", "04 72 89 70 00"), ("475591313.0", "04 75 59 13 13"), ("33GUEUGNON", None), ("333631", None), ("N/A", None), ("0899123456", "08 99 12 34 56")])
    check(column, contact.normalize_phone, [("0033491123456", "04 91 12 34 56"), ("04.91.12.34.56", "04 91 12 34 56"), ("33491123456", "04 91 12 34 56"), ("0091123456", None), ("+1 415 555 0100", None), (None, None)])
    check(column, contact.is_premium, [("0891000000", True), ("0820000000", True), ("+33 891 00 00 00", True), ("0800000000", False), ("0600000000", False), (None, False)])


def test_phones_in_text(column):
    check(column, contact.phones_in_text, [("Appelez le 04 91 12 34 56 !", ["0491123456"]), ('<a href="tel:+33491123456">', ["0491123456"]), ("SIRET 13000556789012 RCS Marseille", []), ("SIRET 30819741700014", []), ("Tél: 04.91.12.34.56 ou +33 4 91 12 34 56", ["0491123456"]),
                                          ("du 01 02 2026 au 03 04 2026", []), ("Service client 0891 67 20 00", ["0891672000"]), ("", []), (None, None)])


def test_naf(column):
    check(column, contact.clean_naf, [("4711D", "47.11D"), (" 55.20z ", "55.20Z"), ("011A", "01.1A"), ("47-11C", "47.11C"), ("word", None), (None, None)])


def test_hosts(column):
    check(column, contact.host_of, [("https://www.a-b.example/x?y", "a-b.example"), ("a.b.example", "a.b.example"), ("", None), (None, None), ("http://", None)])
    check(column, contact.root_domain, [("https://x.y.example/", "y.example"), ("solo", "solo"), (None, None)])


def test_classify_email(column):
    got = column(emails.classify, ["x@gmailcom", "a b@x.fr", "x@systeme u.fr", "x@gmail.coml.com", "x@y.comm", "a@b@c.fr", "x@y.paris", "x@me.com", "nan", None, "", "x@y"])
    assert [(g["verdict"], g["defect"]) for g in got] == [
        ("candidate", None), ("candidate", None), ("malformed", "space_in_domain"), ("malformed", "glued_domain"), ("malformed", "glued_domain"), ("malformed", "at_count"),
        ("candidate", None), ("candidate", None), ("empty", None), ("empty", None), ("empty", None), ("malformed", "no_tld")]
    assert got[0]["value"] == "x@gmail.com" and got[2]["candidate"] == "x@systeme-u.fr" and got[3]["candidate"] == "x@gmail.com"


def test_email_repair(column):
    check(column, emails.repair_all, [("a @x.fr", ["a@x.fr"]), ("a@x.fr - b@y.com", ["a@x.fr", "b@y.com"]), ("x@protonme", ["x@proton.me"]), ("a@gmail.c", []), ("y@yahoo", []), (None, None)])
    check(column, emails.repair_domain, [("x@gmailcom", "x@gmail.com"), ("x@keltikfoodbzh", "x@keltikfood.bzh"), ("x@laposteinfo", "x@laposte.info"), ("x@fermelapomme", "x@fermelapomme"), ("x@a.b", "x@a.b")])
    check(column, emails.split_glued, [("orange.frnadoo.fr", "orange.fr"), ("gmail.comgmail.com", "gmail.com"), ("laposte.netaposte.net", "laposte.net"), ("orange.fr", None), ("mail.free.fr", "mail.fr"), (None, None)])


def test_email_extract(column):
    check(column, emails.extract, [("Write to A@B.fr, or c [at] d [dot] com; logo@2x.png noreply@b.fr", ["a@b.fr", "c@d.com"]), ("u003emarius@x.fr", ["marius@x.fr"]), ("none", []), (None, None)])
    check(column, emails.extract, [("a (at) b.fr", []), ("jean at ferme dot fr", ["jean@ferme.fr"]), ("x@cdn.sentry-next.wixpress.com", []), ("(a@b.fr).", ["a@b.fr"]), ("x&#64;y(dot)net", ["x@y.net"]), ("é" * 3000, [])])


def test_third_party_and_ownership(column):
    check(column, emails.is_third_party, [(("a@gmail.com", "x.example"), False), (("a@www.x.example", "x.example"), False), (("a@y.example", "x.example"), True), (("a@proton.me", "x.example"), False), (("a@msn.com", "x.example"), False)])
    own = lambda e, n: emails.belongs_to(e, n, ["FERME", "SARL"])
    check(column, own, [(("info@becfin.fr", "AU BEC FIN"), True), (("dupont@x.fr", "SARL Dupont"), True), (("contact@ferme.fr", "La Ferme"), False), (("a@b.fr", None), False)])


def test_names(column):
    check(column, norm, [("  Éé-à l’Œuvre ", "EE A L OEUVRE"), ("", ""), (None, None)])
    check(column, names.sorted_key, [("SARL Dupont Jean", "DUPONT JEAN"), ("Jean DUPONT", "DUPONT JEAN")])
    check(column, names.jaccard, [(("a b", "b a"), 1.0), (("a b", "b c"), 1 / 3), (("", ""), 0.0)])
    check(column, names.shares_evidence, [(("LES VIOLETTES", "Violet"), True), (("A B C", "A B C"), False), (("Dupont", "Durand"), False), ((None, "x"), False)])
    assert abs(column(lambda a, b: names.trigram_similarity(a, b), [("word", "two words")])[0] - 4 / 11) < 1e-9
    assert column(names.sequence_ratio, [("abcd", "bcde"), (None, "a")]) == [0.75, 0.0]


def test_parse_person(column):
    known = F.array(*map(F.lit, ["PATRICK", "RICHARD", "JEROME", "GEORGES", "DIANE", "JEAN", "SERGE"]))
    cases = [("GOURDIN PATRICK", ("PATRICK", "GOURDIN")), ("RICHARD GILLIS", ("RICHARD", "GILLIS")), ("SCEA LARROQUE JEROME", ("JEROME", "LARROQUE")), ("M PATRICK GOURDIN", ("PATRICK", "GOURDIN")),
             ("Domaine Saint Georges", None), ("AUX ARMES DE DIANE", None), ("JEAN SERGE", None), ("J PATRICK", None), ("FERME DUPONT", None), (None, None)]
    got = column(lambda c: names.parse_person(c, known), [c[0] for c in cases])
    assert [tuple(g) if g else None for g in got] == [c[1] for c in cases]


def test_town_repair(column):
    cases = [(("3   ", "- 59780Baisieux"), ("59780", "Baisieux")), (("103 ", "Avenue De Flandres - 59650Villeneuve D Ascq"), ("59650", "Villeneuve D Ascq")), (("1   ", "Chemin Des Prieures - 80260St Gratien"), ("80260", "St Gratien")),
             (("62960", "BEAUMETZ LES AIRE 0626930077"), ("62960", "BEAUMETZ LES AIRE")), (("59145", "BERLAIMONT 06/82/90/56/83"), ("59145", "BERLAIMONT")), (("62112", "GOUY SOUS BELLONNE tel 0663269032"), ("62112", "GOUY SOUS BELLONNE")),
             (("29250", "29250 SANTEC"), ("29250", "SANTEC")), (("17400", "17400  LA BENATE"), ("17400", "LA BENATE")), (("33520", "BRUGES (33520)"), ("33520", "BRUGES")), (("59260", "HELLEMMES LILLE (59260)"), ("59260", "HELLEMMES LILLE")),
             (("02290", "AMBLENY 02290 AMBLENY"), ("02290", "AMBLENY")), (("36   ", "Azay le Ferron"), (None, "Azay le Ferron")), (("0    ", "Chamoy"), (None, "Chamoy")), (("01027", "Rue De Lille - 59560Comines"), ("59560", "Comines")),
             (("59000", "LILLE"), None), (("75000", "PARIS"), None)]
    cases += [(("59000", "59650Villeneuve"), None), ((None, "59650"), ("59650", "59650")), (("x", "LILLE (59000)"), ("59000", "LILLE")), (("59000", "0612345678"), None), (("59000", ""), None), (("", "Rue X 59000 LILLE tél. 03 20 12 34 56"), ("59000", "LILLE")), (("2", "LILLE 59000"), ("59000", "LILLE"))]
    got = column(places.repair_town, [c[0] for c in cases])
    assert [(g["postcode"], g["town"]) if g["changed"] else None for g in got] == [c[1] for c in cases]


def test_pages(column):
    check(column, pages.strip_tags, [("<p>a&nbsp;b</p><script>x()</script>", "a b"), (None, None)])
    check(column, pages.is_parked, [("Ce domaine est à vendre", True), ("bonjour", False), (None, False)])
    assert column(pages.directory_reason, [" ".join(f"{k}4000 Ville" for k in range(1, 10)), "short", "12345678900012 " * 5, "12345678900012 22345678900012 32345678900012"]) == ["cp_breadth:9", "", "", "siret_breadth:3"]
    verdict = column(lambda t: pages.site_verdict(t, F.lit("none"), F.lit(False), F.lit(0)), [None, "domain for sale", "short", "x " * 600])
    assert [v["verdict"] for v in verdict] == ["mort", "parked", "non_verifiable", "hors_sujet"]


def test_site_ladder(column):
    long, name = "pain " * 200, "OH FAON"
    check(column, lambda t, s, cp, n, tel: pages.ownership(t, s, cp, n, tel), [
        (("siret 123 456 789 00012", "12345678900012", "13000", name, None), "siret"), (("123456789", "12345678900012", "13000", name, None), "siren"), (("tél 04.91.12.34.56", "12345678900012", "13000", name, "0491123456"), "tel"),
        (("13000 faon", None, "13000", name, "0491123456"), "cp+nom"), (("13000", None, "13000", name, None), "cp"), (("x", None, None, None, None), "none"), ((None, None, None, None, None), "none")])
    check(column, lambda t, d, n: pages.ownership(t, F.lit(None).cast("string"), F.lit("13000"), n, domain=d), [(("13000", "ohfaon.com", name), "nom_domaine"), (("13000", "x.com", name), "cp"), (("13000", "alyncake.fr", "ALYN CAKE"), "nom_domaine"), (("x", "pain-boulangerie.fr", "PAIN"), "none")])
    towns = F.array(F.lit("AIX"), F.lit("ARLES"), F.lit("ISTRES"), F.lit("MARTIGUES"))
    check(column, lambda t: pages.directory_reason(t, towns), [("Aix Arles Istres Martigues", "commune_breadth:4"), ("Aix Arles annuaire trouvez", "phrases:2+breadth"), ("Aix annuaire trouvez", ""), (None, "")])
    verdict = lambda t, own, **k: column(lambda c: pages.site_verdict(c, F.lit(own), k.pop("shared", F.lit(False)), k.pop("score", F.lit(0)), **k), [t])[0]
    assert tuple(verdict(None, "none", blocked=F.lit(True))) == ("non_verifiable", "blocked")
    assert tuple(verdict(None, "none", blocked=F.lit(True), shared=F.lit(True))) == ("reseau", "blocked+shared")
    assert tuple(verdict("Aix Arles Istres Martigues", "cp", communes=towns, shop_page=F.lit(True))) == ("valide", "shop_page+cp")
    assert tuple(verdict("x", "tel", shared=F.lit(True))) == ("valide", "own:tel") and tuple(verdict(long, "cp", shared=F.lit(True))) == ("reseau", "shared_domain+cp")
    assert tuple(verdict(long, "nom_domaine", score=F.lit(1))) == ("valide", "own:nom_domaine") and tuple(verdict(long, "cp+nom")) == ("hors_sujet", "cp+nom_no_trade:0")
    assert tuple(verdict(long, "none", score=F.lit(5))) == ("hors_sujet", "trade_other:none")
    check(column, pages.site_confidence, [(("valide", "tel"), "confirme"), (("valide", "cp+nom"), "probable"), (("non_verifiable", "none"), "non verifie"), (("parked", "none"), "")])
    urls = F.array(*map(F.lit, ["/pain-marseille/", "/aix-en-provence-centre", "/13006-x", "/contact"]))
    assert column(lambda t, cp: pages.shop_pages(urls, t, cp), [("Marseille", "13006"), ("Aix en Provence", ""), (None, None)]) == [["/pain-marseille/", "/13006-x"], ["/aix-en-provence-centre"], []]


def test_kept_addresses(column):
    generic = ["BOULANGERIE", "SARL"]
    saved = lambda e, v, d, n: emails.recoverable(e, v, d, F.lit(False), n, generic)
    check(column, saved, [(("info@becfin.fr", "hors_sujet", "x.fr", "AU BEC FIN"), "nom"), (("a@gmail.com", "annuaire", "x.fr", "Y"), "boite"), (("a@gmail.com", "hors_sujet", "x.fr", "Y"), ""), (("contact@x.fr", "reseau", "www.x.fr", "Y"), "domaine"),
                          (("contact@x.fr", "annuaire", "x.fr", "Y"), ""), (("contact@z.fr", "reseau", "x.fr", "Y"), ""), ((None, "reseau", "x.fr", None), ""), (("nobody", "reseau", "x.fr", "Y"), "")])
    shared = lambda e, v, d, n: emails.recoverable(e, v, d, F.lit(True), n, generic)
    assert column(shared, [("contact@x.fr", "reseau", "x.fr", "Y")]) == [""]
    kept = lambda e, s, v, n, t: emails.keep_reason(e, s, v, n, t, generic)
    check(column, kept, [(("contact@vitrinesvenelles.org", "pain.fr", "valide", "Pain de Venelles", "Venelles"), ""), (("a@dupont.com", "dupont.fr", "x", "Y", None), "soeur"), (("a@free.fr", "x.fr", "valide", "Y", "Z"), "boite"), (("a@free.fr", "x.fr", "annuaire", "Y", "Z"), ""), (("dupont@y.fr", "x.fr", "x", "SARL Dupont", "Aix"), "nom"), ((None, None, None, None, None), "")])
    check(column, emails.usable_hit, [(("lea.morin@gmail.com", "x.fr", "MORIN Lea"), True), (("contact@x.fr", "x.fr", "MORIN"), False), (("morin@guide.fr", "x.fr", "MORIN"), False), (("morin@x.fr", "www.x.fr", "MORIN"), True), (("a@ferme-morin.fr", "x.fr", "MORIN"), True), (("noreply@morin.fr", "x.fr", "MORIN"), False), ((None, None, None), False)])


def test_regions(column):
    check(column, places.region, [("63", "Auvergne-Rhone-Alpes"), ("2B", "Corse"), ("974", "Hors-region"), (None, None)])
    assert places.departments_of("15, 32,2b,15") == ["15", "32", "2B"] and places.departments_of("region:Corse") == ["2A", "2B"] and places.departments_of("pays de la loire")[0] == "44"
    assert len(places.departments_of("ALL")) == 96 and places.departments_of(None) == [] and places.departments_of("1") == ["01"]
    try:
        places.departments_of("99")
    except ValueError as e:
        assert "99" in str(e)
    else:
        raise AssertionError


def test_dates(column):
    check(column, lambda c: dates.parse_date(c).cast("string"), [("03/04/2020", "2020-04-03"), ("2020-04-03", "2020-04-03"), ("2020-04-03 10:11:12", "2020-04-03"), ("2020 04 03 10 11 12", "2020-04-03"), ("03-04-2020", "2020-04-03"), ("1900-01-01", None), ("x", None), (None, None)])


def test_words_and_addresses(column):
    check(column, words, [("L'Été <b>dehors</b> a@b.fr", ["ete", "dehors"]), ("", []), (None, None), ("ŒUVRE e\u0301te\u0301 aæ", ["oeuvre", "ete", "aae"]), (f"<a {'x' * 600}>mot a < bien <i>", ["mot", "bien"]), ("ab " * 50_000, ["ab"] * 50_000)])
    got = column(places.address_parts, ["12 bis av. de la Gare - 63370 X", "Lieu-dit Y", None])
    assert (got[0]["house"], got[0]["words"]) == ("12", ["AVENUE", "GARE"]) and got[1]["house"] is None


def test_parsed_people_rare_first_name(spark, tmp_path, monkeypatch):
    from gristmill.plans import scalars

    pop = [("1", "Ferme Zéphirine Dupont", "Zéphirine Dupont"), ("2", "SARL Martin", "Al Martin"), ("3", "Bertrand Al", "Jean Paul")]
    spark.createDataFrame(pop, "siret string, raisonSociale string, gerant string").write.parquet(str(tmp_path / "population.parquet"))
    for most in (200_000, 0):
        monkeypatch.setattr(scalars, "FEW_NAMES", most)
        assert [tuple(r) for r in scalars.parsed_people(spark, str(tmp_path)).collect()] == [("1", "ZEPHIRINE", "DUPONT")]
