"""Reusable logical plans."""
