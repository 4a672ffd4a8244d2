"""Data quality: declared checks, reports, contracts and key audits."""
