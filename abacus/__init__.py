"""abacus: ledger and budget analytics as Spark DataFrame transformations.

Every public operator is a pure ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function built from Spark's own expressions, so Catalyst and adaptive execution
plan all of it and the same code runs on a laptop sample or a cluster.
"""

from abacus.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
