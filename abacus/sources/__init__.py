"""Sources: budget documents (JSON), spreadsheet exports (CSV), landing Parquet."""

from abacus.sources.budget_document import (current_budget, current_budgets, flatten_entity,
                                            flatten_monthly_categories, landing_frames,
                                            parse_budget_documents, read_budget_documents,
                                            saved_documents, stored)
from abacus.sources.landing import landing_path, scan, scan_project
from abacus.sources.sheets import read_sheet_csv, read_with_row_ids, with_row_ids

__all__ = [
    "current_budget", "current_budgets", "flatten_entity", "flatten_monthly_categories", "landing_frames", "parse_budget_documents",
    "read_budget_documents", "saved_documents", "stored", "landing_path", "scan", "scan_project", "read_sheet_csv",
    "read_with_row_ids", "with_row_ids",
]
