"""Tests."""
