"""Landed documents, ledgers and target tables."""
