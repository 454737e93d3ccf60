"""sparkloom: a PySpark-native analytics engine.

Relational operators, sources, sinks, functions, streaming windows and a client facade, all declared on
the DataFrame, SQL and Structured Streaming APIs so that Catalyst picks the physical plan.
"""

__version__ = "0.1.0"
