"""Structured Streaming forms of the batch operators (ST1-ST7)."""
