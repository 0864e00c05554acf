"""Whole jobs made of the operators: training, scoring and reporting."""
