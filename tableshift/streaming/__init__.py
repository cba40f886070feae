"""Structured Streaming jobs: triggered and continuous sync, resend tolerance, windows, sessions."""
