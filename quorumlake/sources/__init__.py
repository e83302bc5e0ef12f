"""Readers of the formats that civic records come in."""
