"""Whole jobs composed from the operators: cleaning, reports, training, evaluation, scoring."""
