"""Schemas that drift between files: a column lifespan catalogue, its change log, and one consistent table.

The footer of a landed file is the set of its keys with the JSON type of each. The catalogue holds one row per
(file, column); islands of consecutive files with the same (producer, column, type) are its lifespans. A start that
isn't the producer's first file and an ending that isn't its last are changes; a start and an ending at the same file
that stand for the same field of the alias table are one renaming.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions.dates import parse_date
from gristmill.session import cut_lineage

#: Alias table: canonical field -> headers of the providers, written as their letters and digits only (fixed values).
ALIASES = {
    "trade_name": ["societe", "nomentreprise", "name", "nomcommercial", "enseigne", "entreprise"],
    "legal_name": ["raisonsociale", "denomination", "nomlegal", "nomofficiel", "denominationlegale"],
    "contact_full_name": ["contact", "dirigeant", "responsable", "gerant", "nomcontact", "interlocuteur"],
    "address_line1": ["adresse", "adresse1", "adresseligne1", "rue", "address", "voie", "addressline1"],
    "address_line2": ["adresse2", "adresseligne2", "complement", "compladresse", "complementadresse", "addressline2"],
    "postal_code": ["cp", "codepostal", "zipcode", "postalcode", "codepost"],
    "city": ["ville", "commune", "city", "localite"],
    "phone_main": ["tel", "telfixe", "telephone", "phone", "fixe", "telephone1", "tel1"],
    "phone_alt": ["mobile", "portable", "phonenumber", "gsm", "telephone2", "tel2", "telmobile"],
    "siret": ["siret", "siretverifie", "nsiret", "numerosiret"],
    "siren": ["siren", "nsiren", "numerosiren"],
    "email_address": ["email", "courriel", "mail", "adressemail", "emailaddress"],
    "website": ["site", "siteweb", "website", "url", "siteinternet"],
    "naf_label": ["activite", "metier", "category", "libelleape", "libellenaf"],
    "naf_code_source": ["naf", "ape", "codenaf", "codeape"],
    "status_raw": ["etat", "statutactivite", "statut", "status"],
    "effectif_raw": ["effectif", "nbsalaries", "salaries", "effectifs"],
    "creation_date": ["datecrea", "datecreation", "creation", "creele"],
    "organic_label": ["labelbio", "bio", "agriculturebio"],
    "farm_area": ["sau", "surfaceha", "surface", "hectares"],
}

#: Accented letters and what they fold to (fixed values).
ACCENTED = "àâäáãåçéèêëîïíìñôöóòõûüúùÿœæ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyoa"

def header_key(header: Column) -> Column:
    """Letters and digits of a header, lower case, without accents."""
    return F.regexp_replace(F.translate(F.lower(header), ACCENTED, PLAIN), "[^a-z0-9]", "")


def _stems(aliases: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(alias, field) of at least four letters, longest first: what a header that is no alias itself may contain."""
    return sorted(((a, f) for f, names in aliases.items() for a in names if len(a) >= 4), key=lambda x: (-len(x[0]), x[0]))


def field_of(key: str, aliases: dict[str, list[str]] | None = None) -> str:
    """Canonical field of a header key: its alias, else that of the longest alias it contains, else the key itself."""
    table = aliases or ALIASES
    known = {alias: field for field, names in table.items() for alias in names}
    return known.get(key) or next((field for alias, field in _stems(table) if alias in key), key)


def field_column(key: Column, aliases: dict[str, list[str]] | None = None) -> Column:
    """``field_of`` as a Column; for tables of headers, which are few."""
    table = aliases or ALIASES
    exact = F.create_map(*[F.lit(x) for field, names in table.items() for alias in names for x in (alias, field)])
    contained = key
    for alias, field in reversed(_stems(table)):
        contained = F.when(key.contains(alias), field).otherwise(contained)
    return F.coalesce(F.element_at(exact, key), contained)


#: Names of the types a VARIANT may have and the JSON type of each (fixed values).
JSON_TYPES = {"STRING": "string", "BOOLEAN": "boolean", "OBJECT": "object", "ARRAY": "array", "BIGINT": "number", "DECIMAL": "number", "DOUBLE": "number", "FLOAT": "number"}


def explode_footers(rows: DataFrame, file_key: str = "source_file_id", body: str = "raw_json") -> DataFrame:
    """Counts of (file, header, JSON type) over landed JSON rows; NULL values have type NULL.

    Keys are exploded and counted in each partition before anything is shuffled, so what moves is proportional to files
    times columns. Text that is no JSON object, or repeats a key, holds no column.
    """
    landed = rows.filter(F.col(file_key).isNotNull()).select(F.col(file_key).cast("bigint").alias("source_file_id"), F.try_parse_json(F.col(body)).alias("row"))
    objects = landed.filter(F.schema_of_variant("row").startswith("OBJECT"))
    each = objects.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("row").outer()))
    kinds = F.create_map(*[F.lit(x) for pair in JSON_TYPES.items() for x in pair])
    kind = F.element_at(kinds, F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0))
    return each.select("source_file_id", F.col("key").alias("header"), kind.alias("json_type")).groupBy("source_file_id", "header", "json_type").agg(F.count(F.lit(1)).alias("n"))


def catalogue(rows: DataFrame, files: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per (file, header): its main JSON type, counts, the producer, the file's place, the canonical field.

    The type is that of most non-null values, at a tie the alphabetically first; a column of NULLs only has type NULL.
    Files without rows keep their place in the order but have no columns. ``ordinal`` counts the files of a producer
    by (received_at, source_file_id). Repeated rows of ``files`` count once.
    """
    order = Window.partitionBy("provider").orderBy(F.col("received_at").asc_nulls_first(), "source_file_id")
    placed = (
        files.select("source_file_id", "provider", "received_at").dropDuplicates(["source_file_id"])
        .withColumn("ordinal", F.row_number().over(order))
        .withColumn("last_ordinal", F.count(F.lit(1)).over(Window.partitionBy("provider")))
    )
    typed = explode_footers(rows).groupBy("source_file_id", "header").agg(
        F.max(F.when(F.col("json_type").isNotNull(), F.struct("n", F.negative(F.ascii("json_type")).alias("o"), "json_type")))["json_type"].alias("json_type"),
        F.sum("n").alias("n_rows"),
    )
    named = typed.withColumn("alias", header_key(F.col("header"))).withColumn("field", field_column(F.col("alias"), aliases)).drop("alias")
    return named.join(placed, "source_file_id")


def lifespans(columns: DataFrame) -> DataFrame:
    """Islands of consecutive files with one (provider, header, json_type): started and ended ordinals.

    A file begins an island where the one before it, by ``lag``, isn't the file just before.
    """
    key = ["provider", "header", "json_type"]
    run = Window.partitionBy(*key).orderBy("ordinal")
    begins = F.coalesce(F.lag("ordinal").over(run) != F.col("ordinal") - 1, F.lit(True))
    islands = columns.withColumn("begins", begins.cast("int")).withColumn("island", F.sum("begins").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return islands.groupBy(*key, "field", "island").agg(
        F.min("ordinal").alias("started"), F.max("ordinal").alias("ended"), F.max("last_ordinal").alias("last_ordinal")
    ).drop("island")


def changes(columns: DataFrame) -> DataFrame:
    """The change log: (source_file_id, change_kind, old_name, new_name) against the producer's file just before.

    change_kind is ``added`` (old_name ''), ``removed`` (new_name ''), ``renamed`` or ``retyped``. Lifespan starts
    and endings are paired per (producer, ordinal): same header, other type -> retyped; same canonical field, other
    header -> renamed (several are paired in order of header); what is left was added or removed. A column whose
    values are all NULL has no type and is never retyped.
    """
    spans = lifespans(columns)
    begun = spans.filter("started > 1").select("provider", F.col("started").alias("ordinal"), "header", "field", "json_type")
    over = spans.filter("ended < last_ordinal").select("provider", (F.col("ended") + 1).alias("ordinal"), "header", "field", "json_type")
    place = ["provider", "ordinal"]
    same = begun.alias("b").join(over.alias("o"), [*place, "header"], "full_outer").select(
        *place, "header", F.coalesce("b.field", "o.field").alias("field"),
        F.col("b.field").isNotNull().alias("starts"), F.col("o.field").isNotNull().alias("ends"),
        (F.col("b.json_type") != F.col("o.json_type")).alias("other_type"),
    )
    retyped = same.filter("starts AND ends AND other_type").select(*place, F.lit("retyped").alias("change_kind"), F.col("header").alias("old_name"), F.col("header").alias("new_name"))
    nth = Window.partitionBy(*place, "field").orderBy("header")
    fresh = same.filter("starts AND NOT ends").withColumn("nth", F.row_number().over(nth)).select(*place, "field", "nth", F.col("header").alias("new_name"))
    gone = same.filter("ends AND NOT starts").withColumn("nth", F.row_number().over(nth)).select(*place, "field", "nth", F.col("header").alias("old_name"))
    moved = fresh.join(gone, [*place, "field", "nth"], "full_outer").select(
        *place,
        F.when(F.col("old_name").isNull(), "added").when(F.col("new_name").isNull(), "removed").otherwise("renamed").alias("change_kind"),
        F.coalesce("old_name", F.lit("")).alias("old_name"), F.coalesce("new_name", F.lit("")).alias("new_name"),
    )
    return retyped.unionByName(moved)


def change_report(rows: DataFrame, files: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """``changes`` under the later file's id."""
    columns = cut_lineage(catalogue(rows, files, aliases))  # a few rows a file, used four times
    order = Window.partitionBy("provider").orderBy(F.col("received_at").asc_nulls_first(), "source_file_id")
    placed = files.select("source_file_id", "provider", "received_at").dropDuplicates(["source_file_id"]).withColumn("ordinal", F.row_number().over(order))
    return changes(columns).join(placed, ["provider", "ordinal"]).select("source_file_id", "change_kind", "old_name", "new_name")


def _flat(value: object) -> str | None:
    """A JSON value as one text: lists joined by '; ', objects by blanks in the order of their keys."""
    if value is None:
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (list, tuple)):
        return "; ".join(x for x in map(_flat, value) if x) or None
    if isinstance(value, dict):
        return " ".join(x for x in map(_flat, value.values()) if x) or None
    return str(value)


def consolidate(rows: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """Every landed row in one table: keys, one string column per canonical field, and ``rest`` (JSON) for the others.

    Headers are mapped by the alias table, values cast to text. Two headers of one row for the same field: the first
    non-empty in order of header wins, the other goes to ``rest``. Broken JSON gives a row of NULLs with
    ``rest`` holding the text.
    """
    table = aliases or ALIASES
    fields = list(table)
    fold = str.maketrans(ACCENTED, PLAIN)

    def widen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys: dict[str, str | None] = {}
        for batch in batches:
            out = []
            for raw_id, file_id, index, text in zip(batch["raw_id"], batch["source_file_id"], batch["row_index"], batch["raw_json"]):
                try:
                    row = json.loads(text)
                except (TypeError, ValueError):
                    row = None
                if not isinstance(row, dict):
                    out.append((raw_id, file_id, index, *[None] * len(fields), text))
                    continue
                got: dict[str, str] = {}
                rest = {}
                for header in sorted(row):
                    if header not in keys:
                        keys[header] = field_of("".join(c for c in header.lower().translate(fold) if c.isascii() and c.isalnum()), table)
                    field, value = keys[header], _flat(row[header])
                    if field in table and value and field not in got:
                        got[field] = value
                    elif value:
                        rest[header] = value
                out.append((raw_id, file_id, index, *[got.get(f) for f in fields], json.dumps(rest, ensure_ascii=False) if rest else None))
            if out:
                yield pd.DataFrame(out, columns=["raw_id", "source_file_id", "row_index", *fields, "rest"])

    lean = rows.select(F.col("raw_id").cast("bigint"), F.col("source_file_id").cast("bigint"), F.col("row_index").cast("int"), "raw_json")
    return lean.mapInPandas(widen, "raw_id bigint, source_file_id bigint, row_index int, " + ", ".join(f"{f} string" for f in fields) + ", rest string")


#: Fields that are no text and what they are cast to (fixed values).
CASTS = {"farm_area": "double", "organic_label": "boolean", "creation_date": "date"}
YES, NO = ["oui", "yes", "true", "vrai", "x", "1"], ["non", "no", "false", "faux", "0"]


def cast_fields(wide: DataFrame, casts: dict[str, str] | None = None) -> DataFrame:
    """``consolidate``'s table with each field of ``casts`` in one type, whatever types its files gave it.

    A decimal comma, French words for yes and no, and the known ways of writing a date are understood. What can't be
    cast is NULL and stands, as it was, in ``misfits`` (JSON, NULL where all fit).
    """
    casts = casts or CASTS

    def converted(field: str, kind: str) -> Column:
        text = F.trim(F.col(field))
        if kind == "date":
            return parse_date(text)
        if kind == "boolean":
            return F.when(F.lower(text).isin(*YES), F.lit(True)).when(F.lower(text).isin(*NO), F.lit(False))
        return F.replace(F.regexp_replace(text, r"[\s\xa0]+", ""), F.lit(","), F.lit(".")).try_cast(kind)

    lost = F.filter(F.array(*[F.struct(F.lit(f).alias("key"), F.when(converted(f, k).isNull() & (F.trim(F.col(f)) != ""), F.col(f)).alias("value")) for f, k in casts.items()]), lambda e: e["value"].isNotNull())
    misfits = F.when(F.size(lost) > 0, F.to_json(F.map_from_entries(lost))).alias("misfits")
    return wide.select(*[converted(c, casts[c]).alias(c) if c in casts else F.col(c) for c in wide.columns], misfits)
