"""Free text by ordered or unordered pattern rules, and dictionary lookups.

Labels repeat, so they are classified once each and joined back (broadcast only where Spark's own
size estimate allows it)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strainflow.functions import text as X


def first_match(x: Column, rules: list[tuple[str, str | None]]) -> Column:
    """The value of the first rule, in order, whose pattern x contains; null if none."""
    out = None
    for pattern, value in rules:
        test = x.rlike(pattern.replace("(?i)", "(?iu)"))
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    return F.lit(None).cast("string") if out is None else out


def matched_rule(x: Column, rules: list[tuple[str, str | None]]) -> Column:
    """The number of the first rule that matches, from 0; null if none."""
    return first_match(x, [(p, str(k)) for k, (p, _) in enumerate(rules)]).cast("int")


def all_matches(labels: DataFrame, label: str, rules: list[tuple[str, str]]) -> DataFrame:
    """(label, n_patterns, n_targets, targets, target, status): all rules that match each distinct
    label, whatever their order. Rules of different targets conflict."""
    hits = F.array_compact(F.array(*[F.when(F.col(label).rlike(p.replace("(?i)", "(?iu)")), F.lit(t)) for p, t in rules]))
    found = labels.select(label).distinct().withColumn("_hits", hits)
    targets = F.array_sort(F.array_distinct("_hits"))
    n, k = F.size("_hits"), F.size(targets)
    status = F.when(n == 0, "unmatched").when(k > 1, "conflict").when(n > 1, "multiple_same_target").otherwise("one_pattern")
    return found.select(label, n.alias("n_patterns"), k.alias("n_targets"), F.nullif(F.concat_ws("|", targets), F.lit("")).alias("targets"), F.when(k == 1, F.get(targets, F.lit(0))).alias("target"), status.alias("status"))


def species(df: DataFrame, column: str, rules: list[tuple[str, str | None, str]]) -> DataFrame:
    """df with taxon_type, bact_genus, bact_norm: first rule of (pattern, name or null, taxon
    type); a bacterium without a name is named by its genus and epithet. Labels that offer a
    choice ("ou", "et/ou") are ambiguous and stay without a name."""
    label = X.squish(F.col(column))
    pairs = [(p, name) for p, name, _ in rules]
    unsure = label.rlike(r"(?iU)\bou\b")
    taxon = F.when(unsure, "ambiguous").otherwise(F.coalesce(first_match(label, [(p, t) for p, _, t in rules]), F.lit("bacterium")))
    out = df.withColumn("taxon_type", taxon).withColumn("_named", F.when(~unsure, first_match(label, pairs)))
    bacterium = F.col("taxon_type") == "bacterium"
    genus = F.when(bacterium, F.coalesce(F.initcap(F.split("_named", "_")[0]), X.genus(label)))
    out = out.withColumn("bact_genus", genus)
    made = F.when(bacterium & F.col("bact_genus").isNotNull(), X.species_name(F.col("bact_genus"), X.epithet(label)))
    return out.withColumn("bact_norm", F.coalesce("_named", made)).drop("_named")


def antibiotics(df: DataFrame, column: str, kind: str, rules: list[tuple[str, str]]) -> DataFrame:
    """df with atb_norm, atb_matched and atb_match_origin: the first rule of (pattern, name) that the
    folded label matches, for rows whose kind is SIR."""
    named = F.when(F.col(kind) == "SIR", first_match(X.antibiotic_label(F.col(column)), rules))
    out = df.withColumn("atb_norm", named)
    hit = F.col("atb_norm").isNotNull()
    return out.withColumns({"atb_matched": hit, "atb_match_origin": F.when(hit, "explicit")})


def taxonomy(df: DataFrame, column: str, rules: list[tuple[str, str | None, str, str | None, str | None, str | None]]) -> DataFrame:
    """df with taxon_type, bact_genus, bact_family, bact_order, bact_norm and bact_matched. The first rule
    (pattern, name, taxon type, genus, family, order) that the label meets says what it knows: family and
    order come from rules alone, the genus of a bacterium from its name or its label, too, and its name
    from genus and epithet. Ambiguous labels have no taxonomy. Matched is what isn't noise and has a
    genus; without a label nothing is."""
    label = X.squish(F.col(column))
    unsure = label.rlike(r"(?iU)\bou\b")
    rule = F.when(~unsure, matched_rule(label, [(r[0], None) for r in rules]))
    said = lambda k: F.get(F.array(*[F.lit(r[k]) for r in rules]).cast("array<string>"), F.col("_rule"))
    out = df.withColumns({"_label": label, "_unsure": F.coalesce(unsure, F.lit(False)), "_rule": rule})
    taxon = F.when(F.col("_unsure"), "ambiguous").otherwise(F.coalesce(said(2), F.lit("bacterium")))
    out = out.withColumns({"taxon_type": taxon, "bact_genus": said(3), "bact_family": said(4), "bact_order": said(5), "bact_norm": said(1)})
    bacterium = F.col("taxon_type") == "bacterium"
    out = out.withColumn("bact_genus", F.coalesce("bact_genus", F.when(bacterium, F.coalesce(F.initcap(F.split("bact_norm", "_")[0]), X.genus(F.col("_label"))))))
    made = F.when(bacterium & F.col("bact_genus").isNotNull(), X.species_name(F.col("bact_genus"), X.epithet(F.col("_label"))))
    matched = (F.col("taxon_type") != "noise") & F.col("bact_genus").isNotNull()
    return out.withColumns({"bact_norm": F.coalesce("bact_norm", made), "bact_matched": matched}).drop("_label", "_unsure", "_rule")


def families(df: DataFrame, table: list[tuple[str | None, str | None, str | None]], name: str = "atb_norm") -> DataFrame:
    """df with atb_family and atb_subfamily of its antibiotic, from (antibiotic, family, subfamily); the first
    of several entries for an antibiotic holds, and one without a name is left out."""
    first: dict[str, tuple[str | None, str | None]] = {}
    for key, *rest in table:
        if key is not None:
            first.setdefault(key, tuple(rest))
    if not first:
        return df.withColumns({c: F.lit(None).cast("string") for c in ("atb_family", "atb_subfamily")})
    pair = lambda k: F.create_map(*[F.lit(x).cast("string") for key, v in first.items() for x in (key, v[k])])
    return df.withColumns({c: F.try_element_at(pair(k), F.col(name)) for k, c in enumerate(("atb_family", "atb_subfamily"))})


def expand(df: DataFrame, column: str, classes: dict[str, list[str]]) -> DataFrame:
    """df with a row for each member of the class in column; other values stay."""
    if not classes:
        return df
    table = F.create_map(*[x for k, v in classes.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    members = F.coalesce(F.try_element_at(table, F.col(column)), F.array(F.col(column)))
    return df.withColumn(column, F.explode(members))


def mapping(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) once each; keys with several values raise when the result is used."""
    grouped = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(F.coalesce(value, F.lit("\0"))).alias("_n"), F.min(value).alias(value))
    return grouped.select(key, F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit(f"several values of {value} for "), F.col(key)))).otherwise(F.col(value)).alias(value))


def lookup(df: DataFrame, column: str, pairs: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """df with `out`, the mapped value of column, and `out`_unmapped (a value without mapping)."""
    side = mapping(pairs, key, value).select(F.col(key).alias("_key"), F.col(value).alias("_value"))
    joined = df.join(side, F.col(column) == F.col("_key"), "left")
    return joined.withColumns({out: F.col("_value"), f"{out}_unmapped": F.col(column).isNotNull() & F.col("_key").isNull()}).drop("_key", "_value")


def audit_key(x: Column) -> Column:
    """A label as decisions know it: without accents, in upper case, with single spaces."""
    return F.upper(X.to_ascii(X.squish(x)))


def decided(labels: DataFrame, label: str, patterns: list[tuple[str, str]], decisions: DataFrame) -> DataFrame:
    """(label, key, n_patterns, n_targets, candidates, candidate_state, mapping_state, target) of each
    different label. All patterns are tried on the label's key, in no order: one target, of however
    many patterns, is taken; several are none. A decision about a key (key, action, target) goes
    before: `map` to its target, or `defer`, which leaves the label without one but known. Repeated keys,
    other actions and a map without target raise when the result is used."""
    own = labels.select(X.squish(F.col(label)).alias(label)).filter(F.col(label).isNotNull()).distinct().withColumn("key", audit_key(F.col(label)))
    hits = F.array_compact(F.array(*[F.when(F.col("key").rlike(p), F.lit(t)) for p, t in patterns]).cast("array<string>"))
    targets = F.array_sort(F.array_distinct(hits))
    own = own.withColumns({"_n": F.size(hits), "_targets": targets}).withColumn("_k", F.size("_targets"))
    action = F.lower(X.squish(F.col("action")))
    side = decisions.select(audit_key(F.col("key")).alias("_key"), action.alias("_action"), X.squish(F.col("target")).alias("_target"))
    side = side.withColumn("_same", F.count("*").over(Window.partitionBy("_key")))
    wrong = F.when(F.col("_same") > 1, "two decisions for").when(~F.coalesce(F.col("_action").isin("map", "defer"), F.lit(False)), "neither map nor defer:").when((F.col("_action") == "map") & F.col("_target").isNull(), "a map without target:")
    side = side.filter(F.when(wrong.isNotNull(), F.raise_error(F.concat_ws(" ", wrong, F.col("_key"))).cast("boolean")).otherwise(True))
    joined = own.join(side, F.col("key").eqNullSafe(F.col("_key")), "left")
    n, k, only = F.col("_n"), F.col("_k"), F.get("_targets", F.lit(0))
    state = F.when(n == 0, "unmatched").when((k == 1) & (n == 1), "one_pattern_one_target").when(k == 1, "multiple_patterns_same_target").otherwise("multiple_canonical_targets")
    mapping_state = F.when(F.col("_action") == "map", "reviewed_override").when(F.col("_action") == "defer", "review_deferred").otherwise(state)
    target = F.when(F.col("_action") == "map", F.col("_target")).when(F.col("_action").isNull() & (k == 1), only)
    listed = F.nullif(F.array_join("_targets", " | "), F.lit(""))
    return joined.select(label, "key", n.alias("n_patterns"), k.alias("n_targets"), listed.alias("candidates"), state.alias("candidate_state"), mapping_state.alias("mapping_state"), target.alias("target"))
