"""Readers for the five source systems."""
