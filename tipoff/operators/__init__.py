"""Reusable DataFrame operators: upserts, latest records, running totals, reshaping."""
