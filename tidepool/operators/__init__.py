"""Batch/stream DataFrame operators (pure DataFrame -> DataFrame functions)."""
