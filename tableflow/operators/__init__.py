"""Table operators: projection, joins, reconciliation, quality rules, dead letters, writes, run logs, profiling."""
