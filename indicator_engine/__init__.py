"""Indicator analytics on layered tables, written as DataFrame-to-DataFrame Spark functions.

``sources`` and ``sinks`` touch storage, ``functions`` builds columns,
``operators`` holds the transforms, ``streaming`` the event ingest and
``plans`` wires them into the layered load.  No transform runs an action.
"""

from indicator_engine.names import Names

__all__ = ["Names"]
