from twinledger.plans.lookup import failed_report, lookup_report, lookup_sources, run_source_lookup
from twinledger.plans.migration import dedup, migrate, mismatch_report, verify, verify_published
from twinledger.plans.multiplicity import (
    key_multiplicity,
    run_key_multiplicity,
    run_source_multiplicity,
    source_multiplicity,
)
from twinledger.plans.pyramid import grow_pyramid, reconcile_stored
from twinledger.plans.reconciliation import (
    Reconciliation,
    mistagged_rows,
    reconcile,
    reconcile_exact,
    reconcile_sketched,
    run_reconcile,
    undated_rows,
)
from twinledger.plans.replaying import deliver, replay, split_listed
from twinledger.plans.yearly import run_year_counts, year_counts, year_counts_report

__all__ = [
    "Reconciliation",
    "dedup",
    "deliver",
    "failed_report",
    "grow_pyramid",
    "key_multiplicity",
    "lookup_report",
    "lookup_sources",
    "migrate",
    "mismatch_report",
    "mistagged_rows",
    "reconcile",
    "reconcile_exact",
    "reconcile_sketched",
    "reconcile_stored",
    "replay",
    "run_key_multiplicity",
    "run_reconcile",
    "run_source_lookup",
    "run_source_multiplicity",
    "run_year_counts",
    "source_multiplicity",
    "split_listed",
    "undated_rows",
    "verify",
    "verify_published",
    "year_counts",
    "year_counts_report",
]
