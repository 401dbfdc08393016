"""The data jobs: quality, reconciliation, matching and reporting operators."""
