"""Readers. Every reader returns a lazy DataFrame."""
