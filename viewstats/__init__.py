"""Viewing and search analytics as plain PySpark DataFrame functions.

Layers: raw -> bronze (checked, quarantined) -> silver (per-contract tables) -> gold (KPI views).
Every function is keyed by ``_load_date``, so one day and a long backfill are the same job.
"""
