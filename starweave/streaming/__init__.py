"""Arrival-triggered reload of the warehouse (Structured Streaming)."""
