"""Table builders, from staging to reports."""
