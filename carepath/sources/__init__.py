"""Inputs, staged tables and published outputs."""
