"""Datasets and reports."""
