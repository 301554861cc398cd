"""Helpers that shape physical plans: size-checked broadcasts, spreading of heavy keys, durable storage."""
