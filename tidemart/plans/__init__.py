"""Analytic queries over the star schema, and the daily job."""
