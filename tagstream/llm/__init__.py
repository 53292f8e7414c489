"""Operators of a large-scale training-data pipeline, one module per operator.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries only when the subpackage is present.
"""
