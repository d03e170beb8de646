"""Spark-first market-share warehouse and BI layer.

``functions``  Column expressions (keys, periods, ratios, formats)
``operators``  DataFrame → DataFrame building blocks
``sources``    layer tables and CSV in and out
``plans``      pipelines, marts, calendars, measures and reports
``streaming``  the incremental load as a Structured Streaming job
"""
