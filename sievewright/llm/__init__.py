"""Operators for large training-data pipelines.

``queries`` holds one thin query per operator; nothing outside this package imports it.
"""
