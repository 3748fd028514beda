import random
import tracemalloc
import types

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from gristmill.llm import address_parts, entity_match, format_duplicates, graph, mixing, packing, reading_level, representative, same_address
from gristmill.llm.address_parts import Address, near, parse, sounds
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# 1: duplicates hidden by formatting

def folded(text, loose=False):
    if loose:
        text = format_duplicates._trim_marks(text)
    return "".join(format_duplicates.fold_symbols(c, loose) for c in text)


@given(st.lists(st.text(alphabet="aAéÉé .-'ßœ1@(\xa0", max_size=12), min_size=1, max_size=12), st.booleans())
@settings(max_examples=200, deadline=None)
def test_hash_equals_iff_folded_equal(texts, loose):
    h = format_duplicates.polynomial_hashes(*format_duplicates.FoldTable(loose).symbols(pa.array(texts)))
    memo = {}
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            same = folded(a, loose) == folded(b, loose)
            assert (h[0][i] == h[0][j] and h[1][i] == h[1][j]) == same
            assert format_duplicates._skip_equal(a, b, loose, memo) == same


def test_repeated_rows(spark):
    data = [(1, "SARL Été", "12 rue A", None, "a@b.fr", 9), (2, "s.a.r.l. ÉTÉ", None, "12, Rue A", " A@B.FR;", 8), (3, "SARL Ete", "12 rue A", None, "a@b.fr", 7), (4, "SARL Été", "12 rue A", "", "ab@b.fr", 6),
            (5, None, None, None, None, 5), (6, "", "", None, None, 4), (7, "SARL Été", "12 rue A", None, "a@b.fr", 3), (8, "x" * 20_000, None, None, None, 2)]
    df = spark.createDataFrame(data, "id bigint, key string, a1 string, a2 string, `first id` string, other int")
    args = ("id", ["key", "a1", "a2", "first id"], ["first id"], [("a1", "a2")])
    found = format_duplicates.repeated_rows(df, *args)
    assert rows(found) == [(1, 2), (1, 7), (5, 6)]
    assert rows(format_duplicates.collapse(df, "id", found)) == [(1, 3), (3, 1), (4, 1), (5, 2), (8, 1)]
    assert format_duplicates.repeated_rows(df.limit(0), *args).count() == 0


def test_hot_group_and_true_collision(spark, monkeypatch):
    hot = spark.range(30_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("Hot, Name")).otherwise(F.concat(F.lit("n"), F.col("id"))).alias("n"))
    assert format_duplicates.repeated_rows(hot, "id", ["n"]).count() == 9_999
    real = format_duplicates.with_key
    monkeypatch.setattr(format_duplicates, "with_key", lambda *a: real(*a).withColumn("key", F.lit(1).cast("bigint")))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A."), (4, "B"), (5, "c")], "id bigint, n string")
    assert rows(format_duplicates.repeated_rows(df, "id", ["n"])) == [(1, 3), (2, 4)]


# 2: best representative

def test_precedence_levels():
    assert representative.precedence_levels([("v1", "v2", 9), ("v2", "v3", 9), ("v1", "v3", 5), ("v3", "v1", 1)]) == {"v1": 0, "v2": 1, "v3": 2}
    assert set(representative.precedence_levels([("a", "b", 5), ("b", "a", 5)]).values()) == {0}
    assert set(representative.precedence_levels([("a", "b", 9), ("b", "c", 8), ("c", "a", 7)]).values()) == {0, 1, 2}


def test_survivors_with_and_without_times(spark):
    teach = [(f"t{k}", f"2025-01-0{v}", f"v{v}", 1000 + 10 * k + v, "x", 1) for k in range(5) for v in (1, 2, 3)]
    data = teach + [("g", "2025-02-01", "v1", 1, "old", 1), ("g", None, "v3", 2, "newest", 1), ("g", None, "v1", 3, "late?", 1), ("h", None, "v1", 4, "a", None), ("h", None, "v2", 5, "b", None), ("h", None, "v2", 6, "c", None), ("i", "2025-01-01", "v1", 7, None, 1)]
    df = spark.createDataFrame(data, "g string, t string, v string, id bigint, value string, rank int").withColumn("t", F.to_timestamp("t"))
    current = representative.with_currency(df, "g", "t", "id", ["v"])
    got = {r["g"]: r["id"] for r in representative.survivors(current, "g", "id", {"value": (F.col("value").isNotNull(), F.col("rank"))}).collect()}
    assert got["g"] == 2 and got["h"] == 5 and "i" not in got and got["t0"] == 1003
    merged = {r["g"]: r["value"] for r in representative.merged(current, "g", "id", {"value": (F.col("value").isNotNull(), F.col("rank"))}, ["v"]).collect()}
    assert merged["g"] == "newest" and merged["i"] is None
    assert representative.survivors(representative.with_currency(df.limit(0), "g", "t", "id", ["v"]), "g", "id", {"value": (F.lit(True), F.col("rank"))}).count() == 0


# 7: addresses

def test_parse():
    assert parse("N°8 boulevard de la paix - 77886 Valvichères", None, "valvichères") == Address("8", "", "BOULEVARD", "PAIX", "77886", "VALVICHERES")
    assert parse("107TER DE L'HÊTRE", "48744.0", None) == Address("107", "T", "", "HETRE", "48744", "")
    assert parse("Hameau du bas, 36 R. René X", "1250", "St Y CEDEX 2") == Address("36", "", "RUE", "RENE X", "01250", "SAINT Y")
    assert parse("RUE DE LA POSTE N° 126", "", "A s/ B") == Address("126", "", "RUE", "POSTE", "", "A SUR B")
    assert parse('"LAVAGAGNE"', "x", "").kind == "PLACE_NAME" and parse("L.D. : Les Prés", None, None).name == "PRES"
    assert parse("impasse du bûcheron n° 23", "", "")[:4] == ("23", "", "IMPASSE", "BUCHERON") and parse("DE LA FORGE, 12 bis", "", "")[:4] == ("12", "B", "", "FORGE")
    assert parse("7 R D.Bessevchon", "", "").name == "D BESSEVCHON" and parse(None, None, None) == Address("", "", "", "", "", "")
    assert parse("x" * 50_000, None, None).kind == "PLACE_NAME"


@given(st.text(alphabet="ABCD", min_size=5, max_size=14), st.integers(0, 13), st.sampled_from("cdsw"), st.sampled_from("ABCD"))
@settings(max_examples=300, deadline=None)
def test_a_slip_is_near_and_shares_a_sound(name, at, how, letter):
    at %= len(name)
    other = {"c": name[:at] + letter + name[at + 1 :], "d": name[:at] + name[at + 1 :], "s": name[:at] + name[at : at + 2][::-1] + name[at + 2 :], "w": name[:at] + letter + name[at:]}[how]
    assert near(name, other) and near(other, name)
    if len(other) >= 5 and not (how == "s" and any(len(name) // 2 - 3 <= at <= len(name) // 2 + 3 for _ in (0,))):
        assert set(sounds(name)) & set(sounds(other))


def test_locations(spark):
    data = [("a", "12 rue de la Paix", "63000", "Ville"), ("b", "12, R. PAIX", "63000", "VILLE"), ("c", "rue de la paix n° 12 63000 Ville", None, None), ("d", "12 bis rue de la Paix", "63000", "Ville"), ("e", "12 avenue de la Paix", "63000", "Ville"),
            ("f", "12 rue de la Paix", "64000", "Ville"), ("g", "Lieu-dit Les Chanterelles", "63000", "Ville"), ("h", "les chantrelles", "63000", "Ville"), ("i", None, None, None), ("j", "rue de la Paix", "63000", "Ville"), ("a", "12 rue de la Paix", "63000", "Ville")]
    data += [(f"x{k}", f"{k} rue de la Paix", "63000", "Ville") for k in range(20, 40)] + [(f"y{k}", "Lieu-dit Les Chanterelles", "63000", "Ville") for k in range(3)]
    df = spark.createDataFrame(data, "k string, adr string, cp string, town string")
    got = {(r[0], r[1]) for r in same_address.pairs_at_one_place(same_address.locations(df, "k", "adr", "cp", "town")).collect()}
    assert {("a", "b"), ("a", "c"), ("b", "c"), ("g", "h")} <= got
    assert not any({x, y} & {"d", "e", "f", "i", "j"} for x, y in got)
    assert same_address.locations(df.limit(0), "k", "adr", "cp", "town").count() == 0


def test_components_against_union_find(spark):
    rng = random.Random(5)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(k, k + 1) for k in range(1000, 1040)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    want = {x: min(y for y in parent if find(y) == find(x)) for x in parent}
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == want


def test_slip_links_however_often_rows_repeat(spark):
    """A way name written 2 times links to one a letter away written 8 times; the same rows three times over give the same."""
    data = [(k, f"{n} rue de {way}", "63370", "LEMPDES") for k, (n, way) in enumerate([(n, "Marguerite") for n in range(1, 9)] + [(1, "Margerite"), (2, "Margerite")])]
    data += [(100 + k, f"{k} rue {w}", "63370", "LEMPDES") for w in ("Haute", "Neuve", "Basse") for k in range(1, 20)]
    schema = "k string, a string, p string, c string"
    once = same_address.locations(spark.createDataFrame([(str(k), *x) for k, *x in data], schema), "k", "a", "p", "c").collect()
    thrice = same_address.locations(spark.createDataFrame([(str(1000 * j + k), *x) for j in range(3) for k, *x in data], schema), "k", "a", "p", "c").collect()
    place, again = {r["key"]: r["location"] for r in once}, {r["key"]: r["location"] for r in thrice}
    assert place["0"] == place["8"] and again["0"] == again["8"] and again["2000"] == again["1008"]


def test_weights_decide_between_slips_and_neighbours(spark, monkeypatch):
    """Two common names a letter apart stay two places and a rare slip of one is linked: by the estimated weights alone, as without them both are."""
    data = [(f"b{k}", f"{k} rue des Bergers", "63000", "Ville") for k in range(1, 60)] + [(f"v{k}", f"{k} rue des Vergers", "63000", "Ville") for k in range(1, 60)] + [(f"s{k}", f"{k} rue des Bergres", "63000", "Ville") for k in range(1, 4)]
    data += [(f"p{j}{k}", f"{k} rue de la {w}", "63000", "Ville") for j, w in enumerate(["Poste", "Gare", "Mairie", "Fontaine"]) for k in range(1, 40)] + [(f"q{k}", f"{k} r. Psote", "63000", "Ville") for k in range(1, 12)]
    data += [(f"c{k}", f"{k} rue de la Porte", "63000", "Ville") for k in range(1, 40)] + [(f"a{k}", f"{k} avenue de la Gare", "63000", "Ville") for k in range(1, 20)]
    data += [(f"{t}{w}{k}", f"{k} rue des {w}", "63000", t) for t in ("Autreville", "Lointaine") for w in ("Bergers", "Vergers") for k in range(1, 60)]
    data += [(f"h{t}{w}{k}", f"{k} rue du {w}", "63000", t) for t in ("Ville", "Autreville", "Lointaine") for w in ("Chataignier", "Chateau", "Chatelet", "Chaton", "Chatoyant", "Chatreix", "Chatouille") for k in range(1, 60)]  # what neighbours look like is learned from these
    df = spark.createDataFrame(data, "k string, adr string, cp string, town string")
    place = lambda: {r["key"]: r["location"] for r in same_address.locations(df, "k", "adr", "cp", "town").collect()}
    got = place()
    assert got["s2"] == got["b2"] and got["b2"] != got["v2"] and got["q5"] == got["p05"] and got["c5"] != got["p05"] and got["a5"] != got["p15"]
    monkeypatch.setattr(same_address, "estimate", lambda patterns, counts: np.ones(len(counts)))
    assert place() != got and place()["b2"] == place()["v2"]


def test_estimate_separates():
    patterns = np.array([[3, 3], [0, 0], [1, 3], [3, 0]])
    p = same_address.estimate(patterns, np.array([900.0, 2000.0, 60.0, 40.0]))
    assert p[0] > 0.9 and p[1] < 0.1 and len(same_address.estimate(np.zeros((0, 2), int), np.zeros(0))) == 0


# 6: matching without keys

def _world(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ba", "lo", "mi", "ru", "te", "sa", "vi", "no"]) for _ in range(4)).upper()
    towns = [(f"{10000 + 37 * k}", word()) for k in range(12)]
    pop, listings = [], []
    for k in range(n):
        code, town = towns[k % 12] if k % 3 else towns[0]
        name, way, number = f"FERME {word()} {word()}", word(), str(rng.randrange(1, 150))
        lat, lon = str(45 + rng.random()), str(3 + rng.random())
        pop.append((str(10**13 + k), name, None, None, f"SARL {name}", f"{number} rue {way}", code, town, lat, lon))
        slip = name[:9] + name[10:] if k % 4 == 0 else name
        listings.append((k, slip.lower() if k % 2 else slip, None, f"{number}, R. {way}" if k % 5 else None, code if k % 6 else None, town, lat if k % 7 else None, lon, str(10**13 + k) if k % 3 == 0 else None))
    listings += [(n + k, f"RUCHER {word()} {word()}", None, f"{k} rue {word()}", *towns[k % 12], None, None, None) for k in range(n // 4)]
    return pop, listings


def test_match(spark):
    n = 600
    pop, listings = _world(n, 1)
    p = spark.createDataFrame(pop, "siret string, e string, d string, g string, n string, a string, cp string, town string, lat string, lon string")
    left = spark.createDataFrame(listings, "id bigint, n string, alt string, a string, cp string, town string, lat string, lon string, siret string")
    registry = entity_match.features(p, "siret", ["n", "e", "d", "g"], "a", "cp", "town", "lat", "lon", "siret")
    probe = entity_match.features(left, "id", ["n", "alt"], "a", "cp", "town", "lat", "lon", "siret")
    got = {r["rid"]: r["found"] for r in entity_match.match(probe, registry).collect()}
    right = sum(got.get(k) == 10**13 + k for k in range(n))
    assert right >= 0.95 * n and sum(k >= n for k in got) <= 0.02 * n and right >= 0.97 * len(got)
    assert entity_match.match(probe.limit(0), registry).count() == 0


def test_index_recall_against_brute_force(spark):
    pop, listings = _world(400, 2)
    p = spark.createDataFrame(pop, "siret string, e string, d string, g string, n string, a string, cp string, town string, lat string, lon string")
    left = spark.createDataFrame([(*x[:8], None) for x in listings], "id bigint, n string, alt string, a string, cp string, town string, lat string, lon string, siret string")
    registry = entity_match.features(p, "siret", ["n", "e"], "a", "cp", "town", "lat", "lon", "siret")
    probe = entity_match.features(left, "id", ["n", "alt"], "a", "cp", "town", "lat", "lon", "siret")
    model = spark.sparkContext.broadcast(entity_match.train(probe.unionByName(registry)))
    met = {(r["rid"], r["found"]) for r in entity_match.candidates(probe, registry, model).collect()}
    assert sum((k, 10**13 + k) in met for k in range(400)) >= 0.9 * 400
    assert len(met) < 40 * 500


def test_survivors_keep_rows_without_siret(spark, tmp_path):
    from gristmill.llm import registry

    data = [(1, "345 292 378 00014", "A"), (2, "34529237800014", "A"), (3, None, "B"), (4, "12", "C"), (5, "", "D")]
    none = lambda *cs: {c: F.lit(None).cast("string") for c in cs}
    df = spark.createDataFrame(data, "export_no bigint, siret string, raisonSociale string").withColumn("exported_at", F.lit("2025-01-01").cast("timestamp"))
    df = df.withColumns(none("export_version", "telephone_final", "source_telephone", "email_final", "source_email", "email_statut", "website_final", "source_website", "gerant", "codeNAF", "adresse", "codePostal", "ville", "sous_segment", "productions", "statut_sirene"))
    df.write.parquet(str(tmp_path / "producteurs_export.parquet"))
    spark.createDataFrame([], "field string, source string, rank_hint int").write.parquet(str(tmp_path / "source_ranks.parquet"))
    got = registry.p2_survivors(spark, str(tmp_path)).select("siret", "first_id", "n_rows", "raisonSociale")
    assert rows(got) == sorted([("34529237800014", 1, 2, "A"), (None, 3, 1, "B"), (None, 4, 1, "C"), (None, 5, 1, "D")], key=str)
    assert registry.p2_found(spark, str(tmp_path)).count() == 0


def test_space_grows_while_it_is_asked():
    space = entity_match.Space(entity_match.initial_vectors(), np.ones(entity_match.BUCKETS, dtype=np.int64))
    for k in range(3000):
        assert space.rarest([f"W{k}", f"V{k}"])[0] in (f"W{k}", f"V{k}") and entity_match.heavier_half(f"X{k} Y{k}", space)
    assert len(space.texts) == 12_000 and len(space.slip_hashes(np.arange(12_000))[0]) > 0


@pytest.mark.parametrize("whole,chunk", [(1 << 16, 1 << 13), (1 << 16, 256), (64, 32)])
def test_index_recall_does_not_fall_with_the_crowd(spark, monkeypatch, whole, chunk):
    """Slips and partial names without a way, in one town: few or many records there, one block, chunks or cut by hyperplanes and exact keys, the index finds them alike."""
    real = entity_match.blocks_of

    def small(records, model, names_alone):  # the bounds are read in the workers
        def set_bounds(batches):
            entity_match.WHOLE, entity_match.CHUNK = whole, chunk
            yield from batches

        return real(records.mapInArrow(set_bounds, records.schema), model, names_alone)

    monkeypatch.setattr(entity_match, "blocks_of", small)
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["ba", "lo", "mi", "ru", "te", "sa", "vi", "no", "ke", "fu"]) for _ in range(4)).upper()
    for n in (100, 2000):
        pop, listings = [], []
        for k in range(n):
            a, b = word(), word()
            pop.append((str(10**13 + k), f"SARL FERME {a} {b}", f"{k} rue {word()}", "63370", "VILLE", None, None))
            at = rng.randrange(1, 7)
            listings.append((k, f"Ferme {a[:at] + a[at + 1:]} {b}" if k % 2 else f"Ferme {a}", None, "63370", "VILLE", None, None, None))
        p = spark.createDataFrame(pop, "siret string, n string, a string, cp string, town string, lat string, lon string")
        left = spark.createDataFrame(listings, "id bigint, n string, a string, cp string, town string, lat string, lon string, siret string")
        registry = entity_match.features(p, "siret", ["n"], "a", "cp", "town", "lat", "lon", "siret")
        probe = entity_match.features(left, "id", ["n"], "a", "cp", "town", "lat", "lon", "siret")
        model = spark.sparkContext.broadcast(entity_match.train(probe.unionByName(registry)))
        met = {(r["rid"], r["found"]) for r in entity_match.candidates(probe, registry, model).collect()}
        assert sum((k, 10**13 + k) in met for k in range(n)) >= 0.98 * n


def _soft(a, b, space):
    """Shared weight over all weight and over the lighter name's, word by word: what the arrays must agree with."""
    from gristmill.llm.address_parts import near as close

    weight = lambda t: 1.5 if len(t) == 1 else float(space.rarity[space.token(t)])
    da, db = {t: weight(t) for t in a.split()}, {t: weight(t) for t in b.split()}
    wa, wb = sum(da.values()), sum(db.values())
    shared, left = sum(w for t, w in da.items() if t in db), [s for s in db if s not in da]
    for t in (t for t in da if t not in db):
        for s in left:
            if len(t) >= 5 and len(s) >= 5 and (t[0] == s[0] or t[-1] == s[-1]) and close(t, s):
                shared += 0.9 * min(da[t], db[s])
            elif (len(t) == 1) != (len(s) == 1) and t[0] == s[0]:
                shared += 0.5 * min(da[t], db[s])
            else:
                continue
            left.remove(s)
            break
    return shared / max(wa + wb - shared, 1e-9), min(1.0, shared / max(min(wa, wb), 1e-9))


@given(st.lists(st.text(alphabet="ABC", max_size=8), min_size=1, max_size=8), st.integers(1, 2))
@settings(max_examples=300, deadline=None)
def test_close_against_near(texts, most):
    texts = texts + ["A" * 70, "A" * 69 + "B"]
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(len(texts))))
    assert entity_match.close(texts, a, b, most, together=7).tolist() == [near(texts[i], texts[j], most) for i, j in zip(a, b)]


def test_block_against_pair_by_pair():
    """Every pair of a block that shares the better part of a name, an address or an identifier is found, with the overlap a plain loop gives."""
    rng = random.Random(8)
    words = ["MOULIN", "MOULINS", "CHENE", "CHENES", "DUPONT", "DUPOND", "DUPNT", "PRE", "J", "JEAN", "FERME", "VERGER"]
    name = lambda: "|".join(" ".join(rng.sample(words, rng.randrange(1, 4))) for _ in range(rng.randrange(0, 3)))
    rows = [dict(key=k // 40, side=k % 2, rid=k, names=name(), number=rng.choice(["", "1", "12"]), suffix=rng.choice(["", "B"]), kind=rng.choice(["RUE", "", "PLACE_NAME"]), way=rng.choice(["", "HAUTE", "HAUT", "BASSE RUELLE"]),
                 postcode="63370", commune=rng.choice(["", "VILLE", "VILE"]), lat=None, lon=None, siret=rng.choice([None, "1", "2"])) for k in range(120)]
    packed = lambda r: entity_match.PACK.join(r[c] or "" for c in entity_match.PACKED)
    schema = pa.schema([("key", pa.int64()), ("side", pa.int8()), ("rid", pa.int64()), ("facts", pa.string()), ("lat", pa.float64()), ("lon", pa.float64())])
    space = entity_match.Space(entity_match.initial_vectors(), np.zeros(entity_match.BUCKETS, dtype=np.int64) + 5)
    block = entity_match.Block(pa.Table.from_pylist([r | {"facts": packed(r)} for r in rows], schema=schema), space)
    for most in (3_000_000, 50):
        got = {}
        for l, r, jaccard, contained, _, _ in block.pairs(most):
            got.update({(i, j): (x, y) for i, j, x, y in zip(l.tolist(), r.tolist(), jaccard.tolist(), contained.tolist())})
        for i, a in enumerate(rows):
            for j, b in enumerate(rows):
                if a["side"] == 0 and b["side"] == 1 and a["key"] == b["key"]:
                    best = max([_soft(x, y, space) for x in a["names"].split("|") for y in b["names"].split("|") if x and y], key=sum, default=(0, 0))
                    site = a["way"] and a["number"] == b["number"] and a["way"] == b["way"]
                    if best[1] >= 0.62 or site or (a["siret"] and a["siret"] == b["siret"]):
                        assert (i, j) in got
                    if (i, j) in got and best[1] >= 0.5:
                        assert abs(got[i, j][0] - best[0]) < 0.03 and abs(got[i, j][1] - best[1]) < 0.03  # a word that may stand for several is given to another in few
                else:
                    assert (i, j) not in got


def _scored(rows: list[dict], together: int = 500) -> dict:
    """(listing, establishment) -> (jaccard, contained) as a worker scores sorted rows of blocks."""
    packed = lambda r: entity_match.PACK.join(r[c] or "" for c in entity_match.PACKED)
    schema = pa.schema([("key", pa.int64()), ("side", pa.int8()), ("rid", pa.int64()), ("facts", pa.string()), ("lat", pa.float64()), ("lon", pa.float64())])
    model = types.SimpleNamespace(value=entity_match.Model(entity_match.initial_vectors(), np.zeros(entity_match.BUCKETS, dtype=np.int64) + 5))
    run = entity_match.score_blocks(types.SimpleNamespace(mapInArrow=lambda run, shape: run), model)
    batches, got = pa.Table.from_pylist([r | {"facts": packed(r)} for r in rows], schema=schema).to_batches(together), {}
    tracemalloc.start()
    for b in run(iter(batches)):
        l, r = b["rid"].to_numpy(), b["found"].to_numpy()
        got.setdefault("pairs", []).append(l * len(rows) + r)
        got.setdefault("shares", []).append(np.stack([b["jaccard"].to_numpy(), b["contained"].to_numpy()]))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return {"pairs": np.concatenate(got["pairs"]), "shares": np.concatenate(got["shares"], axis=1), "mb": peak}


def test_scoring_holds_few_pairs_at_a_time():
    """A block whose records all meet by an address, a table or a slip, not by equal words, takes no more memory for it."""
    record = lambda k: dict(key=1, side=int(k >= 1000), rid=k, names=f"MOULIN{'S' * (k >= 1000)}", number="1", suffix="", kind="RUE", way="HAUTE", postcode="63370", commune="VILLE", lat=None, lon=None, siret=None)
    got = _scored([record(k) for k in range(2000)])
    assert len(np.unique(got["pairs"])) == len(got["pairs"]) == 1_000_000
    assert got["mb"] < 400  # all pairs at once: 695


def test_large_block_in_pieces_gives_what_the_whole_gives(monkeypatch):
    """Every listing of a block meets every establishment, also where the block is compared piece by piece."""
    rng = random.Random(9)
    words = ["MOULIN", "MOULINS", "CHENE", "CHENES", "DUPONT", "DUPOND", "JEAN", "FERME", "VERGER"]
    name = lambda: "|".join(" ".join(rng.sample(words, rng.randrange(1, 4))) for _ in range(rng.randrange(1, 3)))
    rows = [dict(key=k // 90, side=k % 2, rid=k, names=name(), number=rng.choice(["", "1"]), suffix="", kind="RUE", way=rng.choice(["", "HAUTE", "HAUT"]), postcode="63370", commune="VILLE", lat=None, lon=None, siret=rng.choice([None, "1"])) for k in range(180)]
    whole = _scored(rows, 1000)
    monkeypatch.setattr(entity_match, "PIECE", 16)
    monkeypatch.setattr(entity_match, "MOST_TOKENS", 4)
    parts = _scored(rows, 1000)
    at = {p: k for k, p in enumerate(parts["pairs"].tolist())}
    assert len(at) == len(parts["pairs"]) and set(whole["pairs"].tolist()) <= set(at)
    assert np.allclose(whole["shares"], parts["shares"][:, [at[p] for p in whole["pairs"].tolist()]])
    assert {(p // 180 // 90, p % 180 // 90) for p in at} == {(0, 0), (1, 1)}


def test_training_brings_words_of_one_meaning_together(spark):
    """Sources that say one trade in two words: only what was learned makes the two alike, so untrained vectors fail this."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["ba", "lo", "mi", "ru", "te", "sa", "vi", "no"]) for _ in range(4)).upper()
    trades = [("FOURNIL", "BOULANGERIE"), ("RUCHER", "APICULTEUR"), ("CAVEAU", "VIGNERON"), ("ETABLE", "LAITIER")]
    rows = []
    for k in range(3000):
        owner, trade = word(), trades[k % 4]
        rows += [(2 * k + side, f"{trade[side]} {owner}", "", "", "RUE", "", f"{10000 + k % 50}", "", None, None, None) for side in (0, 1)]
    records, tasks = spark.createDataFrame(rows, entity_match.FEATURES), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # so few records are one task's
    model = entity_match.train(records)
    spark.conf.set("spark.sql.shuffle.partitions", tasks)

    def margin(learned):
        v = entity_match.Space(learned, model.counts).learned
        at = lambda t: v[entity_match.zlib.crc32(t.encode()) % entity_match.BUCKETS]
        own = [float(at(a) @ at(b)) for a, b in trades]
        other = [float(at(a) @ at(b)) for i, (a, _) in enumerate(trades) for j, (_, b) in enumerate(trades) if i != j]
        return np.mean(own) - np.mean(other)

    assert margin(model.learned) > 0.5 and abs(margin(entity_match.initial_vectors())) < 0.3


@given(st.text("ABCD", min_size=5, max_size=11), st.integers(0, 10), st.sampled_from("ABCDE"), st.sampled_from(["change", "omit", "add", "swap"]))
@settings(max_examples=300, deadline=None)
def test_slip_keys(word, at, letter, kind):
    at = min(at, len(word) - 2)
    slip = {"change": word[:at] + letter + word[at + 1 :], "omit": word[:at] + word[at + 1 :], "add": word[:at] + letter + word[at:], "swap": word[:at] + word[at + 1] + word[at] + word[at + 2 :]}[kind]
    assert len(slip) < 5 or set(entity_match.slip_keys(word)) & set(entity_match.slip_keys(slip))


# 8: packing

@given(st.lists(st.integers(1, 30), max_size=12), st.integers(0, 60))
@settings(max_examples=200, deadline=None)
def test_fullest_against_brute_force(lengths, space):
    from collections import Counter

    best = {0}
    for n in lengths:
        best |= {s + n for s in best if s + n <= space}
    chosen = packing.fullest(Counter(lengths), space)
    assert sum(chosen) == max(best) and not Counter(chosen) - Counter(lengths)


def test_pack_documents(spark):
    rng = random.Random(2)
    sizes = [(k, rng.choice([0, 1, 50, 200, 511, 512, 513, 3000]) if k % 3 else 77) for k in range(3000)]
    sets = spark.createDataFrame([("s", 512), ("none", 0)], "container_set string, capacity_tokens int")
    got = packing.pack_documents(spark.createDataFrame(sizes, "id bigint, tokens bigint"), sets, window=256).toPandas()
    assert set(got["container_set"]) == {"s"}
    total = got.groupby("doc_id")["tokens"].sum().to_dict()
    assert total == dict(sizes)
    parts = got.groupby("doc_id")["part"].count()
    assert all(parts[k] == max(1, -(-n // 512)) for k, n in sizes)
    used = got.groupby("container_id").agg(u=("tokens", "sum"), used=("used", "first"), slack=("slack", "first"))
    assert (used["u"] == used["used"]).all() and (used["used"] + used["slack"] == 512).all() and used["u"].sum() / (512 * len(used)) > 0.98
    empty = packing.pack_documents(spark.createDataFrame([], "id bigint, tokens bigint"), sets)
    assert empty.count() == 0
    assert packing.pack_documents(spark.createDataFrame(sizes, "id bigint, tokens bigint"), sets.limit(0)).count() == 0


# 9: mixing

@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 500)), max_size=40), st.integers(0, 99))
@settings(max_examples=100, deadline=None)
def test_flight(units, seed):
    p, size = np.array([u[0] for u in units]), np.array([float(u[1]) for u in units])
    q = mixing.flight(p, size, seed)
    assert ((q > mixing.EPS) & (q < 1 - mixing.EPS)).sum() <= 2 and (q >= 0).all() and (q <= 1).all()
    if len(p):
        assert abs((q * size).sum() - (p * size).sum()) < 1e-3 * max(1, size.sum())


def test_flight_keeps_expectations():
    p, size = np.array([0.3, 0.5, 0.7, 0.2, 0.9]), np.array([10.0, 20.0, 35.0, 40.0, 55.0])
    mean = np.mean([mixing.flight(p, size, s) for s in range(3000)], axis=0)
    assert np.abs(mean - p).max() < 0.03


def test_mix(spark):
    rng = random.Random(4)
    sizes = [(k, rng.choice(["a", "a", "a", "b", "c", None, "z"]), rng.choice([0, 5, 80, 400])) for k in range(4000)]
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    df = spark.createDataFrame(sizes, "id bigint, source string, tokens bigint")
    chosen = mixing.mix(df, targets.filter("source <> 'none'"), block=500)
    got = {r["source"]: r for r in mixing.shares(chosen, targets.filter("source <> 'none'")).collect()}
    for s, r in got.items():
        assert abs(r["actual_share"] - r["target_share"]) < 0.003 and r["most_repeats"] <= r["max_repeats"]
    again = mixing.mix(df.repartition(7), targets.filter("source <> 'none'"), block=500)
    assert rows(chosen) == rows(again)
    assert mixing.mix(df.limit(0), targets).count() == 0


# 10: reading level

def test_reading_level_on_held_out_texts(spark):
    rng = random.Random(6)
    vocabulary = {g: ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60)] for g in range(1, 6)}
    easy = ["le", "la", "de", "un"]
    docs, levels = [], []
    for k in range(500):
        g = 1 + k % 5
        words = [rng.choice(vocabulary[rng.choice([g, g, max(1, g - 1)])]) for _ in range(40)] + [rng.choice(easy) for _ in range(40)]
        rng.shuffle(words)
        docs.append((k, " ".join(words)))
        if k < 300:
            levels.append((k, g))
    docs += [(900, None), (901, ""), (902, "12 34"), (903, "la " * 50_000)]
    levels += [(0, 1), (5, 99), (7, None), (12345, 3)]
    d, lv = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(levels, "doc_id bigint, grade int")
    got = {r["doc_id"]: r["level"] for r in reading_level.predict(d, reading_level.fit(d, lv)).collect()}
    assert sum(got[k] == 1 + k % 5 for k in range(300, 500)) >= 0.9 * 200
    assert got[900] is None and got[901] is None and got[902] is None and got[903] is not None
    assert all(v is None for v in (r["level"] for r in reading_level.predict(d, reading_level.fit(d, lv.limit(0))).collect()))


def test_acquisition():
    grade = reading_level.acquisition(np.array([[9.0, 0, 0, 0, 0], [0, 0, 0, 0, 9.0], [0, 0, 1, 0, 0]]), np.full(5, 10.0))
    assert grade[0] < 1.5 and grade[1] > 4.5 and np.isnan(grade[2])


def test_token_counts(spark):
    tokens = pytest.importorskip("gristmill.llm.tokens")
    df = spark.createDataFrame([(1, "Bonjour le monde"), (2, None), (3, ""), (4, "a" * 10_000)], "doc_id bigint, text string")
    got = {r["id"]: r["tokens"] for r in tokens.token_counts(df).collect()}
    assert got[1] == len(tokens.load().encode_ordinary("Bonjour le monde")) and got[2] == got[3] == 0 and got[4] > 100


def test_many_texts_at_once_as_one_by_one():
    """Names and addresses folded a batch at a time give what each gives alone, also where a text has several lines."""
    texts = ["Gaec du Pré, l'Île", None, "", "M. Œuf M. Ï", "sarl à la ferme", "S.C.E.A. Straße sur rendez-vous", "M", "12 bis, av. de l'Église - 63370 St-X", "\"N° 5 TER,  LIEU-DIT «Y»", "rue haute 12 T", "hameau, 3 rte. d'Aix", "L'Orée", "5", "de l É"]
    codes, towns = ["63370", None, "6337.0"] * 5, ["S/ Mer", None, "Cedex"] * 5
    for some in (texts, [*texts, "12\nrue X\n"], []):
        assert list(address_parts.parsed(some, codes[: len(some)], towns[: len(some)])) == [tuple(parse(*x)) for x in zip(some, codes, towns)]
        assert entity_match.names_tokens(some) == [entity_match.name_tokens(t) for t in some]


def test_slip_codes_meet_as_slip_keys_do(monkeypatch):
    """Words share a code made by arrays where they share a key; a block makes no key word by word."""
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("ABÉ") for _ in range(rng.randrange(1, 12))) for _ in range(150)})
    n, codes = entity_match.slip_codes(words)
    ends = np.cumsum(n)
    mine = [set(codes[e - k : e].tolist()) for k, e in zip(n.tolist(), ends.tolist())]
    keys = [set(entity_match.slip_keys(w)) for w in words]
    assert all(bool(mine[i] & mine[j]) == bool(keys[i] & keys[j]) for i in range(len(words)) for j in range(len(words)))

    def none(word):
        raise AssertionError("a key by itself")

    monkeypatch.setattr(entity_match, "slip_keys", none)
    record = lambda k: dict(key=1, side=k % 2, rid=k, names=f"MOULIN{'S' * (k % 2)}", number="", suffix="", kind="", way="", postcode="63370", commune="VILLE", lat=None, lon=None, siret=None)
    assert len(np.unique(_scored([record(k) for k in range(40)])["pairs"])) == 20 * 20


def test_close_beside_longer_texts():
    """Texts too long for their partner, or for the arrays, don't hinder the pairs compared as one."""
    texts = ["HAUTE", "HAUT", "A DE LA TRES LONGUE RUELLE", "X" * 100, "X" * 99 + "Y"]
    a, b = np.array([0, 0, 0, 3]), np.array([1, 2, 3, 4])
    assert entity_match.close(texts, a, b, 2).tolist() == [True, False, False, True]


def test_inputs_of_scored_pairs(spark):
    """What is worked out from the few fields written of a pair; without points it is neither near nor far."""
    rows = [(1, 1, True, True, metres, place, commune, 0.5, 0.75, 0.25, 0.5) for metres, place, commune in ((float("nan"), 3, 2), (200.0, 0, 0), (300.0, 2, 1), (2000.0, 1, 1))]
    got = spark.createDataFrame(rows, entity_match.SCORED).select(*[x.alias(c) for c, x in entity_match.inputs().items()])
    assert got.columns == entity_match.INPUTS and [tuple(r)[4:] for r in got.collect()] == [
        (1, 0, 0, 1, 0, 0, 0, 0, 0.75, 0), (0, 0, 1, 0, 1, 1, 0, 0, 0, 0.75), (0, 1, 0, 0, 0, 0, 1, 0, 0.75, 0), (0, 0, 0, 0, 0, 0, 0, 1, 0, 0)]


def test_parts_are_pandas_free():
    assert isinstance(pd.DataFrame([parse("1 rue X", None, None)], columns=same_address.PARTS), pd.DataFrame) and address_parts.upper("œuf é") == "OEUF E"
