"""Twins of the read-back queries: the rows of the queries whose tables they publish."""

from duckcheck import population_checks, readmission_checks, resource_checks

_SUBGROUPS, _GAPS = readmission_checks.CHECKS["d52_d53_d55_subgroups"], readmission_checks.CHECKS["d54_fairness_gaps"]

CHECKS = {
    "d55_fairness_report": f"""SELECT g.attribute, s.n_subgroups, s.patients, s.largest_n, g.equal_opportunity_diff, g.demographic_parity_diff,
        g.worst_fnr_subgroup, g.worst_fnr FROM ({_GAPS}) g JOIN (SELECT attribute, count(*) AS n_subgroups, CAST(sum(n) AS BIGINT) AS patients,
        CAST(max(n) AS BIGINT) AS largest_n FROM ({_SUBGROUPS}) GROUP BY attribute) s USING (attribute)""",
    "a34_versioned_snapshot": resource_checks.CHECKS["a19_a21_a24_a31_a32_patient_features"],
    "c54_published_tables": population_checks.CHECKS["c23_c35_care_gaps"],
    "d61_bi_export": readmission_checks.CHECKS["d56_d57_patient_level"],
}
