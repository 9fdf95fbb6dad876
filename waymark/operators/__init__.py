"""Operators on telemetry: landing, enrichment, the stateful fold, episodes."""
