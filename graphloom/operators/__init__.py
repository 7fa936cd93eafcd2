"""Operators over DataFrames: segmentation, graph construction, joins on keys, enrichment, reports."""
