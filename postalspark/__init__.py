"""Postal-code data engine on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` (or a Column
expression); the heavy lifting is left to Catalyst, whole-stage codegen and
the shuffle. See README.md for the operator map.
"""

from postalspark.session import get_session, scratch_dir  # noqa: F401

__all__ = ["get_session", "scratch_dir"]
