"""Structured Streaming forms of message intake and record updates."""
