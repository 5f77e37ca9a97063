"""Composite pipelines: indicators per admin unit, the combined table, risk scores, the scheduler."""
