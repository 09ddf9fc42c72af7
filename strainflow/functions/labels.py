"""French names that a report shows for the codes of a catalogue of indicators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strainflow.functions.text import trim_or_null

# The report's words for the codes.
KINDS = {
    "molecule_direct": "résistance lue sur une molécule unique",
    "molecule_priority": "résistance lue sur une molécule prioritaire",
    "class_any_r": "résistance lue sur une classe (au moins une résistance)",
    "phenotype_flag": "phénotype dérivé",
}
FORMS = "résistance lue sur plusieurs formes d'une même molécule"
FORMS_ID, FORMS_NOTE = "fosfomycine", "Combines IV and trometamol forms"
DENOMINATORS = {"tested_isolates": "isolats testés", "all_isolates": "tous les isolats", "hospital_days": "nuits d'hospitalisation"}
PUBLISHED = {(True, True): "proportion et densité d'incidence", (True, False): "proportion", (False, True): "densité d'incidence", (False, False): "non publié"}
VIEWS = {"global_and_by_type": "globale et par type", "global_only": "globale", "by_type_only": "par type"}


def shown(x: Column, names: dict[str, str]) -> Column:
    """The name of a code; a code without one shows itself."""
    if not names:
        return x
    table = F.create_map(*[F.lit(part) for pair in names.items() for part in pair])
    return F.coalesce(F.try_element_at(table, x), x)


def indicator_kind(kind: Column, indicator: Column, notes: Column) -> Column:
    """The kind's name; a class whose members are forms of one molecule, by its id or notes, has its own."""
    forms = F.coalesce(indicator.contains(FORMS_ID), F.lit(False)) | F.coalesce(notes.contains(FORMS_NOTE), F.lit(False))
    return F.when((kind == "class_any_r") & forms, FORMS).otherwise(shown(kind, KINDS))


def denominator_kind(x: Column) -> Column:
    return shown(x, DENOMINATORS)


def publication_metric(proportion: Column, incidence: Column) -> Column:
    """What is published; null counts as no."""
    told = lambda x: F.coalesce(x, F.lit(False))
    out = F.lit(None).cast("string")
    for (a, b), name in PUBLISHED.items():
        out = F.when((told(proportion) == a) & (told(incidence) == b), name).otherwise(out)
    return out


def publication_view(mode: Column, types: Column) -> Column:
    """The view's name; sample types, parted by |, are listed behind a view by type."""
    listed = F.concat(F.lit(" (`"), F.regexp_replace(trim_or_null(types), r"\|", "`, `"), F.lit("`)"))
    return F.when(mode == "by_type_only", F.concat(F.lit(VIEWS["by_type_only"]), F.coalesce(listed, F.lit("")))).otherwise(shown(mode, VIEWS))


def notes(x: Column, translations: dict[str, str]) -> Column:
    """Notes in translation; blank ones are empty, those without a translation stay."""
    return F.when(F.trim(x) == "", "").otherwise(shown(x, translations))
