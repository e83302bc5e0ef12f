"""Operators over streams, each with the same result as a query over the landed rows."""
