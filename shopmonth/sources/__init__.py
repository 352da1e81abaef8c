"""Scans, sinks, the month ledger and the shared work folder."""
