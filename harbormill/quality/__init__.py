"""Data-contract checks. Every check is one row: (check, model, status, total, bad, bad_pct)."""
