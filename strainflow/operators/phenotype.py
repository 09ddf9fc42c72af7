"""Resistance phenotypes from result lines: positive, negative, unknown or no signal."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainflow.functions.text import phenotype_text
from strainflow.sources.stage import staged

#: Strongest first.
PRIORITY = ["positive", "negative", "unknown", "no_signal"]

# Fixed values: (analysis or null, result labels, value, status) of extended-spectrum lines.
BLSE_EXACT = [
    ("recherche blse", ["resultat"], "positive", "positive"),
    ("recherche blse", ["resultat"], "negative", "negative"),
    ("recherche blse", ["resultat"], "non effectuee", "unknown"),
    ("commentaire blse", ["resultat blse"], "r", "positive"),
    ("commentaire blse", ["resultat blse"], "s", "negative"),
    (None, ["blse"], "presence de blse", "positive"),
    (None, ["blse"], "presence de blse+presence de carba", "positive"),
    (None, ["blse"], "absence de blse", "negative"),
    (None, ["isolat et commentaire germe"], "producteur de blse", "positive"),
    (None, ["isolat et commentaire germe"], "non producteur de blse", "negative"),
]
@dataclass(frozen=True)
class Line:
    """A condition on a line's value: it is one of `equals`, or it contains all patterns of `matches`
    and none of `lacks`."""

    matches: tuple[str, ...] = ()
    lacks: tuple[str, ...] = ()
    equals: tuple[str, ...] = ()

    def holds(self, value: Column) -> Column:
        out = value.isin(*self.equals) if self.equals else F.lit(True)
        for p in self.matches:
            out &= value.rlike(p)
        for p in self.lacks:
            out &= ~value.rlike(p)
        return out


# What other extended-spectrum lines say, by status.
BLSE_LOOSE = {
    "unknown": [
        Line(matches=(r"\bcote blse\b",)),
        Line(matches=("cote blse et carba|cote carba et blse",)),
        Line(matches=(r"\bblse uniquement\b",)),
        Line(matches=(r"\bblse\b", r"e\.coli|kleb|enterobacter|hormaechei|aerogenes|baumanii|baumannii|pseudomonas|citrobacter|serratia|morganella|proteus")),
    ],
    "negative": [
        Line(matches=("^absence de blse",)),
        Line(matches=(r"\bnon producteur de blse\b",)),
        Line(equals=("blse-",)),
    ],
    "positive": [
        Line(matches=("^presence de blse",)),
        Line(matches=("^presence blse$",)),
        Line(matches=(r"(^|\b)producteur de blse\b",), lacks=(r"\bnon producteur de blse\b",)),
        Line(matches=("souche egalement productrice de blse",)),
        Line(matches=("egalement producteur de blse",)),
        Line(equals=("blse+", "producteur de blse.")),
    ],
}
# The same for carbapenemase lines.
CARBA_EXACT = [
    ("recherche carba", ["resultat"], "positive", "positive"),
    ("recherche carba", ["resultat"], "negative", "negative"),
    ("recherche carba", ["resultat"], "non effectuee", "unknown"),
    ("commentaire carba", ["resultat carba"], "r", "positive"),
    ("commentaire carba", ["resultat carba"], "s", "negative"),
    (None, ["carba"], "presence de carba", "positive"),
    (None, ["carba"], "absence de carba", "negative"),
    (None, ["isolat et commentaire germe"], "producteur de carbapenemase", "positive"),
    ("resultat carba par methode enzymatique", ["resultat"], "positive", "positive"),
    ("resultat carba par methode enzymatique", ["resultat"], "negative", "negative"),
    ("resultat carba par methode immunologique", ["neg/pos", "resultat"], "positive", "positive"),
    ("resultat carba par methode immunologique", ["neg/pos", "resultat"], "negative", "negative"),
]
CARBA_LOOSE = {
    "unknown": [
        Line(matches=(r"\bcote carba\b",)),
        Line(matches=("cote blse et carba|cote carba et blse",)),
        Line(matches=("sur le cote",)),
        Line(matches=("carba|carbapen", r"e\.coli|kleb|enterobacter|hormaechei|aerogenes|baumanii|baumannii|pseudomonas")),
    ],
    "negative": [
        Line(matches=("^absence de carba",)),
        Line(matches=(r"\bcarba neg\b",)),
        Line(equals=("carba-",)),
        Line(matches=("non producteur de carbapen",)),
    ],
    "positive": [
        Line(matches=("producteur de carbapen",), lacks=("non producteur de carbapen",)),
        Line(matches=("production de carbapen",)),
        Line(matches=("^presence de carba",)),
        Line(equals=("oxa-48", "vim", "ndm", "oxa-23")),
        Line(matches=("^souche productrice de carbapen",)),
    ],
}


def normalized(lines: DataFrame, *columns: str) -> DataFrame:
    """lines with the named text columns as classify() takes them: folded once, not in each rule."""
    return lines.withColumns({c: phenotype_text(F.col(c)) for c in columns})


def classify(analysis: Column, label: Column, value: Column, exact: list, loose: dict) -> Column:
    """The status of a normalized() line: exact rules first, then patterns, of which unknown
    outranks negative and that positive; null if none applies."""
    out = None
    for a, labels, v, status in exact:
        test = label.isin(labels) & (value == v) & (F.lit(True) if a is None else analysis == a)
        out = F.when(test, status) if out is None else out.when(test, status)
    for status in ("unknown", "negative", "positive"):
        out = out.when(reduce(lambda a, b: a | b, [line.holds(value) for line in loose[status]]), status)
    return out


def blse(analysis: Column, label: Column, value: Column) -> Column:
    return classify(analysis, label, value, BLSE_EXACT, BLSE_LOOSE)


def carbapenemase(analysis: Column, label: Column, value: Column) -> Column:
    return classify(analysis, label, value, CARBA_EXACT, CARBA_LOOSE)


def strongest(status: Column) -> Column:
    """Aggregate: the strongest status of a group; no_signal if there is none."""
    rank = F.max(F.when(status == "positive", 3).when(status == "negative", 2).when(status == "unknown", 1).otherwise(0))
    return F.get(F.array(*map(F.lit, reversed(PRIORITY))), rank)


def any_positive(status: Column) -> Column:
    """Aggregate: positive if any is, else negative."""
    return F.when(F.coalesce(F.bool_or(status == "positive"), F.lit(False)), "positive").otherwise("negative")


def as_result(status: Column) -> Column:
    return F.when(status == "positive", "R").otherwise("S")


def line_statuses(lines: DataFrame, analysis: str, label: str, value: str) -> DataFrame:
    """lines with blse_line and carbapenemase_line, null where a line says nothing. Lines repeat, so
    different ones are classified once each and joined back; nulls match nulls."""
    text = [analysis, label, value]
    side = lines.select(*[F.col(c).alias(f"_{c}") for c in text]).distinct()
    folded = [phenotype_text(F.col(f"_{c}")) for c in text]
    known = side.withColumns({f"_f{k}": c for k, c in enumerate(folded)})
    cells = [F.col(f"_f{k}") for k in range(3)]
    known = known.select(*[f"_{c}" for c in text], blse(*cells).alias("blse_line"), carbapenemase(*cells).alias("carbapenemase_line"))
    # most lines say nothing: only those that do are joined. Written first, since the filter would
    # have Spark evaluate both ladders twice
    known = staged(known, "lines").filter("blse_line is not null or carbapenemase_line is not null")
    on = F.lit(True)
    for c in text:
        on &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return lines.join(known, on, "left").drop(*[f"_{c}" for c in text])


def lookup(lines: DataFrame, keys: list[str], analysis: str, label: str, value: str) -> DataFrame:
    """(keys, blse_status_row, carbapenemase_status_row, blse_flag, carbapenemase_flag): the strongest
    status of each isolate's lines."""
    found = line_statuses(lines, analysis, label, value).groupBy(*keys).agg(strongest(F.col("blse_line")).alias("blse_status_row"), strongest(F.col("carbapenemase_line")).alias("carbapenemase_status_row"))
    return found.withColumns({"blse_flag": F.col("blse_status_row") == "positive", "carbapenemase_flag": F.col("carbapenemase_status_row") == "positive"})
