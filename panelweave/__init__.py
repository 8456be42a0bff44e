"""Panel (entity x period) analytics on Spark DataFrames.

Sub-packages
------------
sources    table scans, ranking files, model and prediction stores
functions  column expressions
operators  joins, reshaping, series windows, ordering, encoders, metrics
models     Spark ML stages, time-ordered model selection, scoring
plans      the two end-to-end panels, training and reports
"""
