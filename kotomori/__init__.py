"""Text moderation as Spark DataFrame operators.

Sub-packages
------------
functions   Column -> Column text, evasion and n-gram expressions
operators   DataFrame -> DataFrame cleaning, features, models, metrics, triage
sources     corpus and policy readers, result writers
plans       training and scoring flows, and the query catalogue
streaming   the scoring flow on Structured Streaming
"""
