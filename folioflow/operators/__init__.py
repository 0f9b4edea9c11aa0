"""Relational operators: joins, aggregates, windows, events, snapshots, state."""
