"""Transcript and text-quality analytics as DataFrame transformations."""
