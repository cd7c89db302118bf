"""DuckDB twins for what is certain about fitted models: who is scored, where, and how inputs are scaled."""

from carepanel.operators.encounter_features import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from duckcheck.readmission_checks import FOLDED, F_

_SCALED = ", ".join(f"round(coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 0), 6) + CAST(0 AS DOUBLE) AS {c}" for c in NUMERIC_FEATURES)
_N_TRAIN = "count(*) OVER () - count(*) OVER (PARTITION BY fold)"
_LEVELS = " + ".join(f"(SELECT count(DISTINCT {c}) FROM feats)" for c in CATEGORICAL_FEATURES)

CHECKS = {
    "d23_d26_model_checks": F_ + f""", {FOLDED} SELECT unnest(['logreg', 'gbm']) AS model, count(*) FILTER (readmit_30d = 1) AS positives,
        count(*) FILTER (readmit_30d = 0) AS negatives, true AS auroc_in_range FROM folded WHERE fold = 0""",
    "d24_preprocessing": F_ + f"SELECT patient_nbr, {_SCALED}, CAST({len(NUMERIC_FEATURES)} + {_LEVELS} AS INT) AS width FROM feats",
    "d25_logistic_gradient": F_ + f"SELECT CAST(unnest(range({len(NUMERIC_FEATURES)} + {_LEVELS})) AS INT) AS feature, true AS at_optimum",
    "d34_out_of_fold": F_ + f", {FOLDED} SELECT patient_nbr, readmit_30d, fold, {_N_TRAIN} AS n_train, true AS scored FROM folded",
    "d34_out_of_fold_boosted": F_ + f", {FOLDED} SELECT patient_nbr, readmit_30d, fold, {_N_TRAIN} AS n_train, true AS scored FROM folded",
    "d33_registered_model": F_ + "SELECT patient_nbr, true AS same_probability FROM feats",
    "d43_contributions_add_up": F_ + "SELECT patient_nbr, true AS adds_up FROM feats",
    "d43_boosted_contributions_add_up": F_ + "SELECT patient_nbr, true AS adds_up FROM feats",
}
