"""Pipelines: source profiles, reconcile, summaries, ledgers, reports."""
