"""Reusable DataFrame operators (dedupe, reshape, joins, windows, sets)."""
