"""Readers for the bronze layer and for tables written earlier."""
