"""Readers for the Bronze layer and for raw JSON payloads."""
