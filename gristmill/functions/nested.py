"""Nested and semi-structured records: registry units, officers, schema.org blocks, vCards, legal notices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.names import clean_surname, tokens
from gristmill.functions.text import let, unaccent

UNIT_SCHEMA = (
    "siren string, nom_raison_sociale string, activite_principale string, nature_juridique string, date_creation string, "
    "dirigeants array<struct<type_dirigeant:string,nom:string,prenoms:string,qualite:string>>, matching_etablissements array<struct<siret:string,etat_administratif:string,code_postal:string,"
    "activite_principale:string,liste_enseignes:array<string>,nom_commercial:string,adresse:string,libelle_commune:string,latitude:string,longitude:string,est_siege:boolean>>"
)
#: Roles of officers by rank, tried in this order; an auditor is never picked (fixed values).
ROLE_RANKS = [
    (r"liquidateur|administrateur judiciaire|mandataire|curateur", 5), (r"vice.?president|president.?adjoint", 3), (r"\bgerant", 1), (r"\bpresident", 1),
    (r"directeur general|\bdirecteur\b|\bdirectrice\b", 1), (r"\bexploitant", 1), (r"associe", 2), (r"administrateur|tresorier|secretaire|membre du", 3),
]
AUDITOR, DEFAULT_RANK = "commissaire aux comptes", 4
#: First path segments of a social network that are no business's own page: its services, and what hangs below a page (fixed values).
FACEBOOK_JUNK = """sharer sharer.php share share.php login login.php plugins dialog hashtag events watch reel groups policies help privacy legal
tr l.php photo.php story.php home.php recover pages marketplace about""".split()
FACEBOOK_DEEP = "posts photos photo videos video permalink story story.php reviews notes live media watch reel reels events groups".split()
INSTAGRAM_ASIDE = "p reel reels explore accounts stories share developer about legal directory invites".split()


def establishments(units: DataFrame) -> DataFrame:
    """One row per establishment of each registry unit, with the unit's own fields; units without any give none."""
    each = units.select("*", F.explode("matching_etablissements").alias("e"))
    brand = F.coalesce(F.get(F.filter("e.liste_enseignes", lambda x: F.trim(x) != ""), F.lit(0)), F.nullif(F.trim("e.nom_commercial"), F.lit("")))
    return each.select("siren", "nom_raison_sociale", "dirigeants", F.col("e.siret").alias("siret"), F.col("e.etat_administratif").alias("etat"), F.col("e.code_postal").alias("code_postal"),
                       F.coalesce("e.activite_principale", "activite_principale").alias("naf"), brand.alias("enseigne"), F.col("e.adresse").alias("adresse"), F.col("e.est_siege").alias("est_siege"))


def reject_reason(department: str, naf_prefixes: list[str]) -> Column:
    """Why an establishment is left out ('' where it is kept): the first of closed, elsewhere, other activity, no identifier."""
    wanted = F.lit(False)
    for prefix in naf_prefixes:
        wanted = wanted | F.startswith(F.col("naf"), F.lit(prefix))
    return (
        F.when(~F.col("etat").eqNullSafe(F.lit("A")), "closed").when(~F.coalesce(F.startswith(F.col("code_postal"), F.lit(department)), F.lit(False)), "elsewhere")
        .when(~F.coalesce(wanted, F.lit(False)), "activity").when(F.col("siret").isNull(), "no_siret").otherwise("")
    )


def role_rank(role: Column) -> Column:
    """Rank of an officer's role, the least first; NULL for auditors, ``DEFAULT_RANK`` for none or any other."""
    def ranked(r: Column) -> Column:
        out = F.when(r.rlike(AUDITOR), F.lit(None).cast("int"))
        for pattern, rank in ROLE_RANKS:
            out = out.when(r.rlike(pattern), rank)
        return out.otherwise(DEFAULT_RANK)

    return let(F.lower(unaccent(F.coalesce(role, F.lit("")))), ranked)


def best_officer(officers: Column, company: Column) -> Column:
    """The natural person to talk to: least role rank, then one the company is named after, then by name; NULL without any.

    The array's own minimum, no join: auditors, companies and nameless officers don't count.
    """
    company_words = tokens(F.coalesce(company, F.lit("")))
    usable = F.filter(officers, lambda d: (d["type_dirigeant"] == "personne physique") & (F.trim(d["nom"]) != "") & role_rank(d["qualite"]).isNotNull())
    ranked = F.transform(usable, lambda d: F.struct(
        role_rank(d["qualite"]).alias("rank"), (~F.arrays_overlap(tokens(clean_surname(d["nom"])), company_words)).alias("other"),
        F.upper(unaccent(d["nom"])).alias("a"), F.upper(unaccent(F.coalesce(d["prenoms"], F.lit("")))).alias("b"), clean_surname(d["nom"]).alias("last_name"), d["prenoms"].alias("first_names")))
    return let(F.array_min(ranked), lambda x: F.when(x.isNotNull(), F.struct(x["rank"].alias("rank"), x["last_name"].alias("last_name"), x["first_names"].alias("first_names"))))


def linked_data(html: Column) -> Column:
    """schema.org objects of a page as ARRAY of VARIANT: blocks that parse, lists and @graph flattened, graphs first."""
    blocks = F.transform(F.regexp_extract_all(html, F.lit(r'(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>'), F.lit(1)), lambda b: F.try_parse_json(F.trim(b)))
    as_list = lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))
    graph = lambda v: F.coalesce(F.try_variant_get(v, "$['@graph']", "array<variant>"), F.array().cast("array<variant>"))
    items = F.flatten(F.transform(F.filter(blocks, lambda v: v.isNotNull()), as_list))
    return F.flatten(F.transform(items, lambda v: F.concat(graph(v), F.array(v))))


def business_of(html: Column, kinds: tuple[str, ...] = ("LocalBusiness", "Bakery", "Store", "FoodEstablishment", "Farm")) -> Column:
    """STRUCT(name, telephone, email, street, postcode, town) of the first business object of a page; NULL without one."""
    kind = lambda v: F.coalesce(F.try_variant_get(v, "$['@type']", "array<string>"), F.array(F.try_variant_get(v, "$['@type']", "string")))
    wanted = F.filter(linked_data(html), lambda v: F.arrays_overlap(kind(v), F.array(*map(F.lit, kinds))))
    text = lambda v, path: F.try_variant_get(v, path, "string")
    street = lambda v: F.coalesce(text(v, "$.address.streetAddress"), F.when(F.schema_of_variant(F.try_variant_get(v, "$.address", "variant")) == "STRING", text(v, "$.address")))
    return let(F.get(wanted, F.lit(0)), lambda v: F.when(v.isNotNull(), F.struct(
        text(v, "$.name").alias("name"), text(v, "$.telephone").alias("telephone"), F.lower(text(v, "$.email")).alias("email"), street(v).alias("street"),
        text(v, "$.address.postalCode").alias("postcode"), text(v, "$.address.addressLocality").alias("town"))))


RDAP_SCHEMA = "entities array<struct<roles:array<string>,vcardArray:array<string>>>"


def registrant(payload: Column) -> Column:
    """STRUCT(name, email) of a domain's holder, else of its administrative contact; vCard entries are positional."""
    entities = F.from_json(payload, RDAP_SCHEMA)["entities"]
    entries = lambda e: F.from_json(F.get(e["vcardArray"], F.lit(1)), "array<array<string>>")
    value = lambda e, names: F.get(F.filter(F.transform(F.filter(entries(e), lambda p: (F.size(p) >= 4) & F.get(p, F.lit(0)).isin(*names)), lambda p: F.trim(F.get(p, F.lit(3)))), lambda t: t != ""), F.lit(0))
    read = lambda role: F.transform(F.filter(entities, lambda e: F.array_contains(e["roles"], role)), lambda e: F.struct(value(e, ["fn", "org"]).alias("name"), F.lower(value(e, ["email"])).alias("email")))

    def pick(both: Column) -> Column:
        with_mail = F.get(F.filter(both, lambda x: x["email"].isNotNull()), F.lit(0))
        with_name = F.get(F.filter(both, lambda x: x["name"].isNotNull()), F.lit(0))
        return F.struct(F.coalesce(with_mail["name"], with_name["name"]).alias("name"), with_mail["email"].alias("email"))

    return let(F.concat(read("registrant"), read("administrative")), pick)


def social_page(url: Column) -> Column:
    """Canonical page of a social URL, NULL for shares, posts and deep links: those are rejected, never cut short."""
    u = F.trim(url)
    profile = F.regexp_extract(u, r"(?i)facebook\.com/profile\.php\?id=(\d{5,})", 1)
    facebook = F.regexp_extract(u, r"(?i)https?://(?:www\.|m\.|fr-fr\.|web\.)?(?:facebook|fb)\.com/([^?#\s]+?)/?(?:[?#].*)?$", 1)
    instagram = F.regexp_extract(u, r"(?i)https?://(?:www\.)?instagram\.com/([A-Za-z0-9._]+?)\.?/?(?:[?#].*)?$", 1)
    linkedin = r"(?i)https?://(?:[a-z]+\.)?linkedin\.com/(company|in)/([^/?#\s]+)"
    return (
        F.when(profile != "", F.concat(F.lit("https://www.facebook.com/profile.php?id="), profile))
        .when((facebook != "") & ~facebook.contains("/") & ~F.lower(facebook).isin(*FACEBOOK_JUNK, *FACEBOOK_DEEP) & ~F.lower(facebook).endswith(".php"), F.concat(F.lit("https://www.facebook.com/"), facebook))
        .when((instagram != "") & ~F.lower(instagram).isin(*INSTAGRAM_ASIDE), F.concat(F.lit("https://www.instagram.com/"), instagram))
        .when(u.rlike(linkedin), F.concat(F.lit("https://www.linkedin.com/"), F.lower(F.regexp_extract(u, linkedin, 1)), F.lit("/"), F.regexp_extract(u, linkedin, 2)))
    )


def notice_roles(notices: DataFrame) -> DataFrame:
    """One row per company a legal notice names, with its role: buyer or seller of a sale, party to it, else principal.

    ``listepersonnes`` and ``listeprecedentexploitant`` hold JSON text whose inner value may be one object or a list.
    """
    def sirens(c: str, key: str) -> Column:
        v = F.try_parse_json(F.col(c))
        people = F.coalesce(F.try_variant_get(v, f"$.{key}", "array<variant>"), F.array(F.try_variant_get(v, f"$.{key}", "variant")))
        number = lambda p: F.substring(F.regexp_replace(F.coalesce(F.try_variant_get(p, "$.numeroImmatriculation.numeroIdentification", "string"), F.lit("")), "[^0-9]", ""), 1, 9)
        return F.filter(F.transform(people, number), lambda s: F.length(s) == 9)

    registered = F.filter(F.transform("registre", lambda x: F.substring(F.regexp_replace(x, "[^0-9]", ""), 1, 9)), lambda s: F.length(s) == 9)
    empty = F.array().cast("array<string>")
    found = notices.select("id", "familleavis", F.coalesce(registered, empty).alias("named"), F.coalesce(sirens("listepersonnes", "personne"), empty).alias("buyers"), F.coalesce(sirens("listeprecedentexploitant", "precedentExploitant"), empty).alias("sellers"))
    each = found.withColumn("siren", F.explode(F.array_distinct(F.concat("named", "buyers", "sellers"))))
    role = F.when(F.col("familleavis") != "vente", "principal").when(F.array_contains("buyers", F.col("siren")), "acquéreur").when(F.array_contains("sellers", F.col("siren")), "cédant").otherwise("partie")
    return each.select("id", "siren", role.alias("role"))


def detail_get(detail: Column, key: str) -> Column:
    """Value of a key in ``k=v; k=v`` text, the first where the key is repeated."""
    own = F.get(F.filter(F.split(detail, r"\s*;\s*"), lambda x: F.startswith(x, F.lit(f"{key}="))), F.lit(0))
    return F.nullif(F.trim(F.substr(own, F.lit(len(key) + 2))), F.lit(""))


def merge_tags(*groups: Column) -> Column:
    """Tags of several ``|``-joined lists, in order, each once."""
    parts = F.flatten(F.array(*[F.split(F.coalesce(g, F.lit("")), r"\|") for g in groups]))
    return F.array_join(F.array_distinct(F.filter(F.transform(parts, lambda t: F.trim(t)), lambda t: t != "")), "|")


def tags_by_rule(text: Column, rules: dict[str, str]) -> Column:
    """Every tag whose pattern a text has, in the order of the rules."""
    return F.array_join(F.array_compact(F.array(*[F.when(text.rlike(f"(?i){pattern}"), tag) for tag, pattern in rules.items()])), "|")


def first_reason(rules: dict[str, tuple[Column, str]]) -> Column:
    """``label:matched text`` of the first field its pattern is found in; '' where none is."""
    out = F.lit("")
    for label, (field, pattern) in reversed(list(rules.items())):
        hit = F.regexp_extract(F.coalesce(field, F.lit("")), f"(?i)({pattern})", 1)
        out = F.when(hit != "", F.concat(F.lit(f"{label}:"), hit)).otherwise(out)
    return out


def code_label(code: Column, labels: dict[str, str]) -> Column:
    """Label of a code; a code without one stands for itself."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]), code), code)


def split_phones(phones: Column) -> Column:
    """STRUCT(landlines, mobiles) of an array of ten-digit numbers, in order, each once."""
    unique = F.array_distinct(phones)
    mobile = lambda p: p.rlike("^0[67]")
    return F.struct(F.filter(unique, lambda p: ~mobile(p)).alias("landlines"), F.filter(unique, mobile).alias("mobiles"))


def premium_last(phones: Column) -> Column:
    """Numbers in their order, premium-rate ones behind."""
    premium = lambda p: p.rlike("^08[129]")
    return F.concat(F.filter(phones, lambda p: ~premium(p)), F.filter(phones, premium))


def email_shapes(domain: Column, first: Column, last: Column, most: int = 6) -> Column:
    """Likely addresses of a person at a domain, in order of how common the shape is; at most ``most``, each once."""
    f, n = F.regexp_replace(F.lower(unaccent(first)), "[^a-z]", ""), F.regexp_replace(F.lower(unaccent(last)), "[^a-z]", "")
    locals_ = F.array(F.concat(f, F.lit("."), n), F.concat(F.substring(f, 1, 1), n), F.lit("contact"), F.concat(F.substring(f, 1, 1), F.lit("."), n), f, n, F.concat(n, F.lit("."), f))
    return F.slice(F.array_distinct(F.transform(locals_, lambda x: F.concat(x, F.lit("@"), domain))), 1, most)
