"""Operators for preparing text and records for training; nothing outside this package imports it."""
