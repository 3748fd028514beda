"""Text of web pages: tags, vocabulary, parking and directory tests, ownership, the verdict on a site."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import let, norm, unaccent

#: What parked domains say, digits left out as they are of the text (fixed values).
PARKED = [
    "ce domaine est a vendre", "ce nom de domaine est a vendre", "buy this domain", "domain for sale", "this domain is for sale", "domaine reserve",
    "site en construction", "under construction", "page en cours de construction", "parking de domaine", "acheter ce domaine", "sedoparking",
    "expired domain", "bienvenue sur votre nouveau site", "default web page", "apache debian default page", "welcome to nginx",
]
#: What directories say (fixed values).
DIRECTORY = [
    "entreprises similaires", "a proximite", "autres etablissements", "annuaire", "trouvez", "comparer les", "avis clients verifies", "fiche entreprise",
    "numero siret", "code naf", "greffe", "informations legales et financieres", "bilans gratuits", "dirigeants et actionnaires", "tous les commerces", "resultats pour",
]
#: Words of farms and their trade (fixed values).
FARM_WORDS = "FERME ELEVAGE MARAICHER VERGER RUCHER MIEL FROMAGE LAIT LEGUMES FRUITS VIANDE PRODUCTEUR RECOLTE TROUPEAU BREBIS CHEVRES VACHES POULES MARCHE".split()


def strip_tags(c: Column) -> Column:
    """Visible text: scripts and styles first, then tags, four entities, white space squeezed."""
    text = F.regexp_replace(c, r"(?is)<(script|style|noscript)\b.*?</\1>", " ")
    text = F.regexp_replace(text, r"<[^>]+>", " ")
    for entity, mark in (("&nbsp;", " "), ("&amp;", "&"), ("&#039;", "'"), ("&quot;", '"')):
        text = F.replace(text, F.lit(entity), F.lit(mark))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def flat(c: Column) -> Column:
    """Lower-case letters and single blanks."""
    return F.regexp_replace(F.lower(unaccent(c)), "[^a-z]+", " ")


def vocabulary_score(c: Column, words: list[str]) -> Column:
    """How many distinct words of a list a text uses."""
    return F.size(F.array_intersect(F.split(norm(c), " "), F.array(*map(F.lit, words))))


def any_phrase(c: Column, phrases: list[str]) -> Column:
    return c.rlike("(" + "|".join(phrases) + ")")


def is_parked(c: Column) -> Column:
    return F.coalesce(any_phrase(flat(c), PARKED), F.lit(False))


def breadth(c: Column, pattern: str) -> Column:
    """Distinct matches of a pattern."""
    return F.size(F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), F.lit(0))))


#: From how many distinct postcodes, identifiers and communes on a text is about many businesses (fixed values).
MOST_POSTCODES, MOST_SIRETS, MOST_COMMUNES = 8, 3, 4
#: Words that say a trade, not which business (fixed values).
GENERIC_WORDS = """PAIN PAINS BOULANGERIE BOULANGER PATISSERIE PATISSIER FOURNIL MAISON ATELIER MOULIN FOUR TRADITION DELICE
DELICES GOURMAND GOURMANDE BOUTIQUE ARTISAN PETRIN MARSEILLE AIX PROVENCE SARL EURL SAS SASU SNC""".split()


def breadths(text: Column, communes: Column | None = None) -> Column:
    """STRUCT(postcodes, sirets, communes, phrases): how many distinct ones of each a text names.

    ``communes`` is an ARRAY of normal forms that are looked for as substrings; without it none is counted.
    """
    towns = F.lit(0) if communes is None else let(norm(text), lambda t: F.size(F.filter(F.array_distinct(communes), lambda c: (c != "") & t.contains(c))))
    first = F.regexp_extract_all(text, F.lit(r"\b([0-9]{5})\b"), F.lit(1))
    postcodes = F.size(F.array_distinct(F.filter(first, lambda c: F.substring(c, 1, 2).between("01", "98"))))
    return F.struct(postcodes.alias("postcodes"), breadth(text, r"\b\d{14}\b").alias("sirets"), towns.alias("communes"),
                    let(flat(text), lambda t: sum((t.contains(p).cast("int") for p in DIRECTORY), F.lit(0))).alias("phrases"))


def directory_reason(text: Column, communes: Column | None = None) -> Column:
    """Why a text looks like a directory ('' where it doesn't): breadth of postcodes, identifiers or communes, or phrases with some of it."""
    wide = [("postcodes", MOST_POSTCODES, "cp"), ("sirets", MOST_SIRETS, "siret"), ("communes", MOST_COMMUNES, "commune")]

    def why(x: Column) -> Column:
        said = F.when((x["phrases"] >= 2) & ((x["postcodes"] >= 3) | (x["communes"] >= 2)), F.concat(F.lit("phrases:"), x["phrases"], F.lit("+breadth"))).otherwise(F.lit(""))
        for part, least, label in reversed(wide):
            said = F.when(x[part] >= least, F.concat(F.lit(f"{label}_breadth:"), x[part])).otherwise(said)
        return said

    return F.coalesce(let(breadths(text, communes), why), F.lit(""))


#: Proofs that a page is of a business, strongest first (fixed values).
PROOFS = ["siret", "siren", "tel", "cp+nom", "nom_domaine", "cp", "none"]


def ownership(text: Column, siret: Column, postcode: Column, name: Column, phone: Column | None = None, domain: Column | None = None) -> Column:
    """The first of ``PROOFS`` a page gives: identifier or phone printed on it, postcode and name, a domain named after it, postcode.

    ``phone`` is ten national digits known from elsewhere. A missing fact proves nothing.
    """
    digits = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\s.\-()+]", "")

    def proven(d: Column) -> Column:
        printed = lambda c, n: F.coalesce((F.length(c) == n) & d.contains(c), F.lit(False))
        named = F.coalesce(let(norm(text), lambda t: F.exists(F.split(norm(name), " "), lambda w: (F.length(w) >= 4) & t.contains(w))), F.lit(False))
        held = [printed(siret, 14), F.coalesce((F.length(siret) == 14) & d.contains(F.substring(siret, 1, 9)), F.lit(False)), F.lit(False) if phone is None else printed(phone, 10),
                printed(postcode, 5) & named, F.lit(False) if domain is None else domain_matches_name(domain, name, GENERIC_WORDS), printed(postcode, 5), F.lit(True)]
        return F.get(F.filter(F.array(*[F.when(h, F.lit(p)) for h, p in zip(held, PROOFS)]), lambda p: p.isNotNull()), F.lit(0))

    return let(digits, proven)


def site_verdict(text: Column, own: Column, shared: Column, score: Column, communes: Column | None = None, shop_page: Column | None = None, blocked: Column | None = None, least_chars: int = 500, least_score: int = 2) -> Column:
    """STRUCT(verdict, reason): the first rule that holds; their order is the design.

    ``text`` NULL is a page not reached: dead, or blocked (which says nothing of the business unless its domain is
    shared). Then: parked, a page of its own on a chain's site, directory, owned by identifier or phone, too short to
    judge, shared domain, owned by name and of the trade (``score`` counts its words), somebody else's of the trade,
    anything else.
    """
    facts = F.struct(directory_reason(text, communes).alias("why"), own.alias("own"), F.coalesce(shared, F.lit(False)).alias("shared"), F.coalesce(score, F.lit(0)).alias("score"),
                     (F.lit(False) if shop_page is None else F.coalesce(shop_page, F.lit(False))).alias("shop"), (F.lit(False) if blocked is None else F.coalesce(blocked, F.lit(False))).alias("blocked"))

    def ladder(x: Column) -> Column:
        rungs = [
            (text.isNull() & x["blocked"] & x["shared"], "reseau", F.lit("blocked+shared")), (text.isNull() & x["blocked"], "non_verifiable", F.lit("blocked")), (text.isNull(), "mort", F.lit("unreachable")),
            (is_parked(text), "parked", F.lit("parking_page")), (x["shop"], "valide", F.concat(F.lit("shop_page+"), x["own"])), (x["why"] != "", "annuaire", x["why"]),
            (x["own"].isin(*PROOFS[:3]), "valide", F.concat(F.lit("own:"), x["own"])), (F.length(text) < least_chars, "non_verifiable", F.concat(F.lit("text:"), F.length(text))),
            (x["shared"], "reseau", F.concat(F.lit("shared_domain+"), x["own"])),
            (x["own"].isin("cp+nom", "nom_domaine") & (x["score"] >= 1), "valide", F.concat(F.lit("own:"), x["own"])), (x["own"].isin("cp+nom", "nom_domaine"), "hors_sujet", F.concat(x["own"], F.lit("_no_trade:"), x["score"])),
            (x["score"] >= least_score, "hors_sujet", F.concat(F.lit("trade_other:"), x["own"])),
        ]
        said = F.struct(F.lit("hors_sujet").alias("verdict"), F.concat(F.lit("no_proof:"), x["own"]).alias("reason"))
        for holds, verdict, reason in reversed(rungs):
            said = F.when(holds, F.struct(F.lit(verdict).alias("verdict"), reason.alias("reason"))).otherwise(said)
        return said

    return let(facts, ladder)


def site_confidence(verdict: Column, own: Column) -> Column:
    """What a reader is told of a site: ``confirme``, ``probable``, ``non verifie`` or ''."""
    return F.when(verdict == "non_verifiable", "non verifie").when((verdict == "valide") & own.isin(*PROOFS[:3]), "confirme").when(verdict == "valide", "probable").otherwise("")


def shop_pages(urls: Column, commune: Column, postcode: Column) -> Column:
    """Those of an ARRAY of URLs that look like the shop's own page on a chain's site: its postcode, its town or every long word of it."""
    town = slug(commune)

    def kept(facts: Column) -> Column:
        words = F.filter(F.split(facts["town"], "-"), lambda w: F.length(w) > 3)
        own = lambda u: F.coalesce((postcode != "") & u.contains(postcode), F.lit(False)) | ((facts["town"] != "") & u.contains(facts["town"])) | ((F.size(words) > 0) & F.forall(words, lambda w: u.contains(w)))
        return F.filter(urls, lambda u: own(F.lower(u)))

    return let(F.struct(F.coalesce(town, F.lit("")).alias("town")), kept)


def item_property(html: Column, name: str) -> Column:
    """Text of the first element with an ``itemprop``; NULL without one."""
    return F.nullif(strip_tags(F.regexp_extract(html, rf'(?is)itemprop="{name}"[^>]*>(.*?)</', 1)), F.lit(""))


def listing_of(html: Column) -> Column:
    """STRUCT(name, phone, email, street, postcode, town, description) of a directory page with item properties."""
    from gristmill.functions.contact import normalize_phone
    from gristmill.functions.emails import extract

    title = F.nullif(strip_tags(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)), F.lit(""))
    return F.struct(
        F.coalesce(title, item_property(html, "name")).alias("name"), normalize_phone(item_property(html, "telephone")).alias("phone"), F.get(extract(html), F.lit(0)).alias("email"),
        item_property(html, "streetAddress").alias("street"), item_property(html, "postalCode").alias("postcode"), item_property(html, "addressLocality").alias("town"), item_property(html, "description").alias("description"))


def phones_in_context(html: Column) -> Column:
    """Distinct phones of a page that stand in a ``tel:`` link or at most 60 characters behind a phone word; sorted."""
    from gristmill.functions.contact import national_digits, plausible_number

    links = F.regexp_extract_all(html, F.lit(r"(?i)href=[\"']tel:([+0-9 .()\-]{9,20})"), F.lit(1))
    near = F.regexp_extract_all(strip_tags(html), F.lit(r"(?i)(?:t[ée]l[ée]?phone|t[ée]l|portable|mobile|appelez)\b.{0,60}?((?:\+33|0033|0)[ .]?[1-9](?:[ .\-]?\d{2}){4})"), F.lit(1))
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.concat(links, near), lambda p: national_digits(p)), lambda d: d.isNotNull() & plausible_number(d))))


def in_place(text: Column, postcode: Column, commune: Column) -> Column:
    """Whether a search result is of a place: its postcode stands in the text, else its commune does."""
    town = norm(commune)
    return F.coalesce((F.length(postcode) == 5) & text.contains(postcode), F.lit(False)) | F.coalesce((F.length(town) > 2) & F.concat(F.lit(" "), norm(text), F.lit(" ")).contains(F.concat(F.lit(" "), town, F.lit(" "))), F.lit(False))


def slug(c: Column) -> Column:
    """Lower-case words without accents, joined by hyphens."""
    return F.regexp_replace(F.regexp_replace(F.lower(unaccent(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def domain_matches_name(host: Column, name: Column, generic: list[str], least: float = 0.6) -> Column:
    """Whether a domain is named after a business: words of its name, one of four letters, cover most of the domain's own part."""
    core = F.regexp_replace(F.split(F.lower(host), r"\.")[0], "[^a-z0-9]", "")
    for word in sorted(generic, key=len, reverse=True):
        core = F.replace(core, F.lit(word.lower()), F.lit(""))

    def covered(own: Column) -> Column:
        hits = F.filter(F.array_distinct(F.split(F.lower(norm(name)), " ")), lambda t: (F.length(t) > 2) & ~t.isin(*[g.lower() for g in generic]) & own.contains(t))
        return let(hits, lambda h: (F.length(own) >= 4) & F.exists(h, lambda t: F.length(t) >= 4) & (F.length(F.array_join(h, "")) / F.length(own) >= least))

    return F.coalesce(let(core, covered), F.lit(False))
