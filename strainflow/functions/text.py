"""Text expressions on columns: trimming, folding, code and label normalization."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accented letters that are folded, and what they become.
ACCENTED = "áéíóúÁÉÍÓÚýÝàèìòùÀÈÌÒÙâêîôûÂÊÎÔÛãõÃÕñÑäëïöüÄËÏÖÜÿçÇ"
FOLDED = "aeiouAEIOUyYaeiouAEIOUaeiouAEIOUaoAOnNaeiouAEIOUycC"
# Words that never are an epithet.
NOT_EPITHETS = ["ou", "et", "en", "a", "à", "de", "du", "des", "d", "sur", "avec", "sans", "cours", "presence", "présence", "absence", "colonisation", "contamination", "non"]


#: What \s matches in a pattern.
BLANKS = " \t\n\x0b\f\r"


def trim_or_null(x: Column) -> Column:
    """x without white space at its ends; null if nothing is left. Without a pattern, as it is evaluated
    often: expressions on it are repeated in conditions and in filters."""
    return F.nullif(F.btrim(x, F.lit(BLANKS)), F.lit(""))


def squish(x: Column) -> Column:
    """trim_or_null with inner white space as one space."""
    return trim_or_null(F.regexp_replace(x, r"\s+", " "))


def strip_accents(x: Column) -> Column:
    return F.translate(x, ACCENTED, FOLDED)


def to_ascii(x: Column) -> Column:
    """Accents, ligatures and curly apostrophes in ASCII."""
    for old, new in (("œ", "oe"), ("Œ", "OE"), ("æ", "ae"), ("Æ", "AE"), ("’", "'")):
        x = F.replace(x, F.lit(old), F.lit(new))
    return strip_accents(x)


def phenotype_text(x: Column) -> Column:
    """Folded lower-case text; null if it says nothing."""
    plain = squish(F.lower(strip_accents(x)))
    return F.when(~plain.isin("na", "n/a"), plain)


def antibiotic_label(x: Column) -> Column:
    return squish(F.regexp_replace(F.lower(strip_accents(x)), r"\p{Pd}+", "-"))


def domain_label(x: Column, canonical: list[str]) -> Column:
    """The canonical label that x equals but for accents and case; else x, trimmed."""
    key, out = F.upper(to_ascii(trim_or_null(x))), trim_or_null(x)
    for label in canonical:
        out = F.when(key == F.upper(to_ascii(F.lit(label))), F.lit(label)).otherwise(out)
    return out


def sir(x: Column) -> Column:
    """Susceptibility codes as S, R, ZIT or null; what else there is stays as it is."""
    code = F.upper(trim_or_null(x))
    return (
        F.when(code.isin("S", "SFP", "---S"), "S")
        .when(code.isin("R", "---R"), "R")
        .when(code.isin("I", "ZIT"), "ZIT")
        .when(code.isNull() | code.isin("NC", "NA", "N/A"), None)
        .otherwise(code)
    )


def activity_code(x: Column) -> Column:
    """All-digit codes as whole numbers of two digits at least."""
    code = trim_or_null(x)
    digits = F.regexp_replace(code, "^0+(?=[0-9])", "")
    return F.when(code.rlike("^[0-9]+$"), F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits)).otherwise(code)


def discipline_code(x: Column) -> Column:
    """All-digit codes without leading zeros."""
    code = trim_or_null(x)
    return F.when(code.rlike("^[0-9]+$"), F.regexp_replace(code, "^0+(?!$)", "")).otherwise(code)


def flag(x: Column) -> Column:
    """Truth values in English and French; null if it is none."""
    code = F.lower(trim_or_null(x))
    return F.when(code.isin("true", "t", "1", "yes", "y", "oui", "o", "vrai"), True).when(code.isin("false", "f", "0", "no", "n", "non", "faux"), False)


def values(x: Column, sep: str = r"\|") -> Column:
    """Distinct trimmed values of a list in text, in order; empty for null."""
    parts = F.transform(F.split(F.coalesce(x, F.lit("")), sep), trim_or_null)
    return F.array_distinct(F.filter(parts, lambda v: v.isNotNull()))


def slug(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(to_ascii(x)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def genus(x: Column) -> Column:
    return F.nullif(F.regexp_extract(squish(x), r"(?i)^([A-Z][a-z]+)\b", 1), F.lit(""))


def epithet(x: Column) -> Column:
    found = F.lower(F.regexp_replace(F.regexp_extract(squish(x), r"^[A-Z][a-z]+\s+([A-Za-z][A-Za-z\-.]*)\b", 1), r"\.$", ""))
    return F.when((found != "") & ~found.isin(NOT_EPITHETS) & ~found.rlike(r"^(spp?|sp)\.?$"), found)


def species_name(genus_: Column, epithet_: Column) -> Column:
    return F.concat(F.lower(genus_), F.lit("_"), F.coalesce(F.lower(epithet_), F.lit("spp")))


def collapse(x: Column, sep: str = "|") -> Column:
    """Aggregate: sorted distinct values in one text, null if there is none."""
    return F.nullif(F.concat_ws(sep, F.array_sort(F.collect_set(x))), F.lit(""))
