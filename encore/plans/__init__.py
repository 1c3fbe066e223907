"""Staging, star schema, reports and the whole build, composed from the operators."""
