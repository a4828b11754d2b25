"""macrolake: a Spark pipeline for macro-economic and market time series.

Landed source files become an append-only bronze table, one long silver
observation table, monthly gold marts, joined views, forecasts and serving
queries. Every operator is a function from DataFrame to DataFrame.
"""
