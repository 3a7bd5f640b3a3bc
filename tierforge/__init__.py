"""Layered (bronze / silver / gold) table building on Spark.

Everything here is a plain ``DataFrame -> DataFrame`` function, a reader, or a thin
writer; the caller owns the session and its settings.
"""

from tierforge.contract import Column, Contract

__all__ = ["Column", "Contract"]
