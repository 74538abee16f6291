"""leaguespark: sports-league analytics as Spark plans.

``functions`` holds column expressions, ``sources`` parsers and readers,
``operators`` table operators (snapshots, merges, joins, grouping),
``plans`` named queries, ``streaming`` Structured Streaming jobs and ``llm``
operators for training-data pipelines.  Nothing outside ``llm`` imports it.
"""
