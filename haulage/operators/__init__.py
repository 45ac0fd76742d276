"""Reusable DataFrame operators: latest row per key, rules, distance joins, links, nesting, checks."""
