"""Whole jobs composed of the operators: features, scoring, registry, telemetry, end-to-end flow."""
