"""Operators of a training-data pipeline, each one a plain DataFrame function.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its queries when it is there.
"""
