"""Forecasters that fit and predict every segment in parallel."""
