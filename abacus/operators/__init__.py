"""Generic DataFrame operators the ledger models are composed of."""

from abacus.operators.bounds import bounded_by_max
from abacus.operators.cobuckets import CoBuckets, write_cobucketed
from abacus.operators.conditional import (conditional_columns, conditional_sums, sum_measures,
                                          when_else_zero)
from abacus.operators.joins import expand_cobucketed, lookup, split_expand
from abacus.operators.latest import latest_per_key
from abacus.operators.positions import positions
from abacus.operators.quality import (AuditFailure, CountMismatch, assert_audits, audit_forall, grain_check,
                                      raise_on, write_counted, write_observed)
from abacus.operators.reshape import to_series
from abacus.operators.sanitize import nonfinite_to_null
from abacus.operators.spine import (bounded_month_spine, expand_months, month_sequence, scalar_max,
                                    scalar_min)

__all__ = [
    "bounded_by_max", "CoBuckets", "write_cobucketed", "conditional_columns", "conditional_sums", "sum_measures", "when_else_zero",
    "expand_cobucketed", "lookup", "split_expand", "latest_per_key", "AuditFailure",
    "CountMismatch", "assert_audits", "audit_forall", "raise_on", "write_observed", "grain_check", "write_counted", "to_series",
    "nonfinite_to_null", "positions", "bounded_month_spine", "expand_months", "month_sequence",
    "scalar_max", "scalar_min",
]
