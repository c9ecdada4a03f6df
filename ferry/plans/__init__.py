"""Whole jobs: transfers, ledger jobs, declared routes and their reports."""
