"""Retail-bank warehouse jobs expressed as PySpark DataFrame plans.

Layers: ``raw`` (all text) -> ``staging`` (typed, cleaned, deduplicated)
-> ``mart`` (star schema) -> controls, measures and report queries.
"""
