"""Readers of requests, events, user properties and state."""
