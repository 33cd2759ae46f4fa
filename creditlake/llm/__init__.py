"""Operators of a training-data pipeline, each with one registered query.

``queries`` holds the thin queries and their SQL.
"""
