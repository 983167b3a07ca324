"""Streaming jobs (built-in operators) and state processors for the rest."""
