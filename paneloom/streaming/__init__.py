"""Structured Streaming side: bulletins and the keyed upsert."""
