"""Spark-first analytics over civic records: minutes, votes, transcripts, ledgers and corpora."""
