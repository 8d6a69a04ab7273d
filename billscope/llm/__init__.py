"""Operators and pipeline for large training-data corpora; nothing outside this folder imports it."""
