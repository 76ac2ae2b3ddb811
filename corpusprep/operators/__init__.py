"""Grouped DataFrame operators."""
