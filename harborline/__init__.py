"""Layered delivery-and-reviews analytics as composable PySpark operators.

The package is organised by what a Spark user composes:

* ``functions``  – ``Column`` builders (keys, tiers, guarded maths, predicates)
* ``operators``  – ``DataFrame -> DataFrame`` transforms
* ``sources``    – readers and sinks
* ``streaming``  – Structured Streaming ingest and current-state upserts
* ``plans``      – bronze / silver / gold / mart pipelines built from the above
* ``registry``   – every query over the driver's tables, with its SQL oracle
"""
