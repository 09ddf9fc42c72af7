"""Which hospital unit a sample was taken in: a point-in-interval join with a tie-break."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attribute_units(samples: DataFrame, intervals: DataFrame, *, sample_id: str, patient: str, stay: str, moment: str, unit: tuple[str, str], status: str | None = None) -> DataFrame:
    """samples with the unit pair active at `moment`. intervals: the same patient, stay and unit
    names, and entry and exit; an interval holds its entry and not its exit.

    One active complete pair is assigned; of several, the one that equals the sample's own pair;
    else the sample is ambiguous, or unassigned if no pair is active. `status` names a column of
    the moment's validity (valid or a reason). sample_id must be unique. Null keys never match.
    The equi-join on patient and stay carries the range as a residual condition."""
    um, uf = unit
    i = intervals.select(F.col(patient).alias("_p"), F.col(stay).alias("_e"), F.col(um).alias("_um"), F.col(uf).alias("_uf"), "entry", "exit")
    usable = F.lit(True) if status is None else F.col(status) == "valid"
    probe = samples.filter(usable).select(F.col(sample_id).alias("_id"), F.col(patient).alias("_sp"), F.col(stay).alias("_se"), F.col(moment).alias("_t"), F.col(um).alias("_own_um"), F.col(uf).alias("_own_uf"))
    hits = probe.join(i, (F.col("_sp") == F.col("_p")) & (F.col("_se") == F.col("_e")) & (F.col("_t") >= F.col("entry")) & (F.col("_t") < F.col("exit")))
    complete = F.col("_um").isNotNull() & F.col("_uf").isNotNull()
    pair = F.when(complete, F.struct("_um", "_uf"))
    own = F.coalesce((F.col("_um") == F.col("_own_um")) & (F.col("_uf") == F.col("_own_uf")), F.lit(False))
    found = hits.groupBy("_id").agg(
        F.count("*").alias("n_active_interval_records"),
        F.count_if(~complete).alias("n_active_incomplete_unit_records"),
        F.count_distinct(pair).alias("n_active_unit_pairs"),
        F.max(F.when(complete & own, 1).otherwise(0)).cast("bigint").alias("n_own_pair_matches"),
        F.min(pair).alias("_only"),
    )
    out = samples.join(found, F.col(sample_id) == F.col("_id"), "left").drop("_id")
    counts = ["n_active_interval_records", "n_active_incomplete_unit_records", "n_active_unit_pairs", "n_own_pair_matches"]
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    single, tie = F.col("n_active_unit_pairs") == 1, (F.col("n_active_unit_pairs") > 1) & (F.col("n_own_pair_matches") == 1)
    chosen = F.when(single, F.col("_only")).when(tie, F.struct(F.col(um).alias("_um"), F.col(uf).alias("_uf")))
    bad = F.lit(None).cast("string") if status is None else (
        F.when(F.col(status) == "missing_date_or_time", "missing_sample_datetime")
        .when(F.col(status) == "invalid_time_of_day", "invalid_sample_time_of_day")
        .when(F.col(status) == "nonexistent_local_time", "nonexistent_local_sample_datetime")
        .when(F.col(status) == "ambiguous_local_time", "ambiguous_local_sample_datetime")
    )
    reason = (
        F.when(F.col(patient).isNull() | F.col(stay).isNull(), "missing_patient_or_event_key")
        .when(bad.isNotNull(), bad)
        .when(F.col(moment).isNull(), "missing_sample_datetime")
        .when(single, "single_active_unit_pair")
        .when(tie, "microbiology_unit_pair_breaks_tie")
        .when(F.col("n_active_unit_pairs") > 1, "multiple_active_unit_pairs")
        .when(F.col("n_active_incomplete_unit_records") > 0, "active_interval_missing_complete_unit_pair")
        .otherwise("no_active_interval")
    )
    state = F.when(single | tie, "assigned_hebergement").when(F.col("n_active_unit_pairs") > 1, "ambiguous_hebergement").otherwise("unassigned_hebergement")
    return out.withColumns({"hospitalization_um": chosen["_um"], "hospitalization_uf": chosen["_uf"], "attribution_status": state, "attribution_reason": reason}).drop("_only")
