"""Encore: live-event demand analytics as composable Spark DataFrame functions.

Layers: ``sources`` (landed JSON, raw tables, sinks), ``functions`` (Column
builders), ``operators`` (DataFrame building blocks), ``plans`` (staging, star
schema, reports, whole build).
"""
