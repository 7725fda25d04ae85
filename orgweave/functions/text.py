"""Scalar functions on names, places and metadata text. Column to Column but for the map parser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"[\s\p{Z}]+"
EDGES = r"^[\s\p{Z}]+|[\s\p{Z}]+$"
PUNCTUATION = r"[^\p{L}\p{N}_\s]"
PARENTHESES = r"\s*\([^)]*\)\s*$"

# Legal forms that end a company's name. A documented subset of what lists of legal forms hold.
LEGAL_FORMS = "inc incorporated corp corporation ltd limited llc llp lp plc co company gmbh ag kg kgaa ohg ug se sa sas sarl srl spa bv nv ab as asa aps oy oyj pty pte sdn bhd kk kabushiki kaisha sp z o o zoo doo kft zrt ltda".split()
LEGAL = r"(?i)([\s,]+(" + "|".join(sorted(set(LEGAL_FORMS) | {r"s\.a\.", r"b\.v\.", r"n\.v\.", r"s\.r\.l\.", r"s\.p\.a\.", r"l\.l\.c\.", r"pty\.? ltd"})) + r")\.?)+\s*$"

# Words that do not tell one organization from another.
SKIP_WORDS = "the a an university univ college institute hospital center centre national international royal state federal central".split()
GRAMMAR_WORDS = "of the and for in on at to a an".split()
GENERIC_PATTERNS = ["research site", "study site", "investigative site", "clinical site", "site name", "not available", "n/a", "unknown", "tbd", "to be determined"]
ORG_KINDS = [("Department", ["department"]), ("Division", ["division"]), ("Center", ["center", "centre"]), ("Institute", ["institute"]), ("School", ["school of"]), ("University", ["university"]), ("Hospital", ["hospital"])]

# Accented letters and what Soundex reads them as.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿßøœæ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyysooa"


def strip(c: Column) -> Column:
    """Without white space at either end, Unicode's included."""
    return F.regexp_replace(c, EDGES, "")


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, BLANKS, " "))


def clean_name(c: Column) -> Column:
    """Lower case with single blanks; an empty name is null."""
    return null_if_empty(collapse(F.lower(c)))


def strip_legal_suffix(c: Column) -> Column:
    return F.regexp_replace(c, LEGAL, "")


def normalize_name(c: Column) -> Column:
    """Without one closing parenthesis, legal forms and punctuation; lower case; an empty name is null."""
    bare = strip_legal_suffix(F.regexp_replace(strip(c), PARENTHESES, ""))
    return null_if_empty(collapse(F.regexp_replace(F.lower(bare), PUNCTUATION, "")))


def prefix(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def words(c: Column) -> Column:
    """Lower-cased words; empty for a blank text, null for null."""
    return F.filter(F.split(F.lower(c), BLANKS), lambda w: w != "")


def first_word(c: Column) -> Column:
    return F.get(words(c), F.lit(0))


def first_significant_word(c: Column) -> Column:
    """The first word of over two letters that is no common one, else the first."""
    w = words(c)
    return F.coalesce(F.get(F.filter(w, lambda x: ~x.isin(SKIP_WORDS) & (F.length(x) > 2)), F.lit(0)), F.get(w, F.lit(0)))


def soundex(c: Column) -> Column:
    """Soundex of the word with accents folded; a word that doesn't begin with a letter stays as it is."""
    return F.soundex(F.translate(F.lower(c), ACCENTED, PLAIN))


def city_name3(city: Column, name: Column) -> Column:
    """Town and the first three letters of the name, null if either is empty."""
    c, n = F.lower(strip(F.coalesce(city, F.lit("")))), F.substring(F.coalesce(name, F.lit("")), 1, 3)
    return F.when((c != "") & (n != ""), F.concat_ws("_", c, n))


def country_code(c: Column, names: dict[str, str] | None = None) -> Column:
    """The first of several countries: two letters in upper case, a known name's code, else the text itself."""
    from .places import COUNTRY_CODES

    first = strip(F.substring_index(strip(c), ";", 1))
    known = F.create_map(*(F.lit(x) for pair in (names or COUNTRY_CODES).items() for x in pair))
    code = F.when(F.length(first) == 2, F.upper(first)).otherwise(F.coalesce(F.element_at(known, F.lower(first)), first))
    return F.when(strip(c) != "", code)


def several_countries(c: Column) -> Column:
    return F.coalesce(F.contains(c, F.lit(";")), F.lit(False))


def is_generic(c: Column) -> Column:
    low = F.lower(strip(c))
    found = F.lit(False)
    for p in GENERIC_PATTERNS:
        found = found | F.contains(low, F.lit(p))
    return F.coalesce(found, F.lit(False))


def classify(c: Column) -> Column:
    """The kind of organization that its name tells, by the first rule that fits."""
    out = F.when(c.isNull(), "Unknown")
    for kind, parts in ORG_KINDS:
        test = F.lit(False)
        for p in parts:
            test = test | F.contains(F.lower(c), F.lit(p))
        out = out.when(test, kind)
    return out.otherwise("Other")


def contains_text(c: Column, text: str) -> Column:
    return F.coalesce(F.contains(F.lower(c), F.lit(text.lower())), F.lit(False))


def name_array(name: Column, aliases: Column | None = None, acronyms: Column | None = None) -> Column:
    """Distinct trimmed names, sorted; null if there is none."""
    none = F.array().cast("array<string>")
    parts = [F.array(name), *(F.coalesce(x, none) for x in (aliases, acronyms) if x is not None)]
    names = F.filter(F.transform(F.concat(*parts), strip), lambda x: x.isNotNull() & (x != ""))
    names = F.array_sort(F.array_distinct(names))
    return F.when(F.size(names) > 0, names)


def alias_text(c: Column) -> Column:
    """Aliases in text: a bracketed list is read as one, anything else is one name."""
    listed = F.from_json(F.translate(c, "'", '"'), "array<string>", {"mode": "PERMISSIVE"})
    return F.when(F.startswith(strip(c), F.lit("[")), F.coalesce(listed, F.array(c))).when(strip(c) != "", F.array(c))


def token_set(c: Column) -> Column:
    """Sorted distinct words less grammatical ones; empty for null."""
    return F.coalesce(F.array_sort(F.array_except(words(c), F.array(*map(F.lit, GRAMMAR_WORDS)))), F.array().cast("array<string>"))


def safe_double(c: Column) -> Column:
    x = c.try_cast("double")
    return F.when(~F.isnan(x), x)


def safe_long(c: Column) -> Column:
    return safe_double(c).try_cast("long")


def with_java_map(df: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` with text ``{k=v, k2=v2}`` as a map.

    Keys are identifiers before an equals sign, wherever they stand; the last of equal keys wins; ``null`` is
    null. It is done in steps of one column each, so that no step's work is repeated inside a lambda.
    """
    text = strip(F.col(column))
    braces = F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}")) & (F.length(text) > 1)
    inner = F.when(braces, F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(text)
    parts = F.split(F.regexp_replace(inner, r"([a-zA-Z_][a-zA-Z0-9_]*)\s*=", "\u0001$1\u0002"), "\u0001")
    out_df = df.withColumn("_parts", parts).withColumn("_pairs", F.transform(F.slice("_parts", F.lit(2), F.greatest(F.size("_parts") - 1, F.lit(0))), lambda x: F.split(x, "\u0002")))
    last = F.size("_pairs") - 1
    keys = F.transform("_pairs", lambda x: F.get(x, F.lit(0)))
    raw = F.transform("_pairs", lambda x, k: F.when(k < last, F.regexp_replace(F.get(x, F.lit(1)), "[, ]+$", "")).otherwise(F.get(x, F.lit(1))))
    values = F.transform(raw, lambda x: F.when(F.lower(strip(x)) != "null", strip(x)))
    out_df = out_df.withColumns({"_keys": keys, "_values": values}).drop("_parts", "_pairs").withColumn("_one", F.array_distinct("_keys"))
    newest = F.transform("_one", lambda k: F.element_at("_values", F.size("_keys") - F.array_position(F.reverse("_keys"), k).cast("int") + 1))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    chosen = F.when(F.size("_one") == F.size("_keys"), F.col("_values")).otherwise(newest)
    return out_df.withColumn(out, F.when(F.size("_one") > 0, F.map_from_arrays("_one", chosen)).otherwise(empty)).drop("_keys", "_values", "_one")


def metadata_fields(m: Column) -> list[Column]:
    """The twelve fields that are taken from the map of a record's metadata."""

    def get(key: str) -> Column:
        return F.element_at(m, F.lit(key))

    def either(a: str, b: str) -> Column:
        return F.coalesce(null_if_empty(get(a)), get(b))

    plain = ["name_clean", "name_normalized", "name_prefix_5", "name_prefix_10", "city", "state", "name_aliases", "rp_type"]
    return [
        *(get(k).alias(k) for k in plain),
        either("class", "category").alias("type"),
        either("country", "countries").alias("country"),
        safe_double(get("latitude")).alias("latitude"),
        safe_double(get("longitude")).alias("longitude"),
    ]


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere of radius 6371 km; null if a coordinate is missing."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    d = 2 * 6371.0 * F.atan2(F.sqrt(a), F.sqrt(1 - a))
    return F.when(~F.isnan(d), d)


def tier(p: Column, low: bool = True) -> Column:
    """Confidence tiers, closed on the right; ``low``: with a tier from 0 to 0.5, else that range is null."""
    out = F.when((p > 0) & (p <= 0.5), "0-0.5 (Very Low)") if low else F.when(p <= 0.5, F.lit(None).cast("string"))
    for a, b, name in ((0.5, 0.7, "0.5-0.7 (Low)"), (0.7, 0.85, "0.7-0.85 (Medium)"), (0.85, 0.95, "0.85-0.95 (High)"), (0.95, 1.0, "0.95-1.0 (Very High)")):
        out = out.when((p > a) & (p <= b), name)
    return out


def match_weight(m: float, u: float) -> float:
    """log2(m / u), 0 where either isn't positive."""
    from math import log2

    return log2(m / u) if m > 0 and u > 0 else 0.0
