"""Compositions of operators: the model graph, checks, metrics and the dashboard."""
