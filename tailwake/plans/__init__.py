"""Compositions of the operators: lake layers, live view, served queries, training."""
