"""Operators: scans, dependency analysis, findings queries, risk, gates, summaries, evidence."""
