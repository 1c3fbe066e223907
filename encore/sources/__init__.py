"""Landed JSON and pages, raw tables, inline reference rows and table writers."""
