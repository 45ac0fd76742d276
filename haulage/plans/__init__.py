"""Whole results built from the operators: gold aggregates, views, dispatch, demand, checks."""
