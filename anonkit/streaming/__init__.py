"""Structured Streaming jobs: new files in, anonymized rows out, each once."""
