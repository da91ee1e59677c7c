"""Readers and writers for tables, parameters, reports and tree dumps."""
