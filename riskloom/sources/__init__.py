"""Inputs and outputs: tables, datasets, logs, generators, and views over the star-schema test tables."""
