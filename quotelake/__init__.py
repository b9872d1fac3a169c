"""quotelake: market-quote ingestion, modelling and analytics as Spark jobs.

Every operator is a DataFrame -> DataFrame function of Spark's own expressions.
The same functions serve batch queries and Structured Streaming jobs.
"""

from quotelake.session import build_session, configure

__all__ = ["build_session", "configure"]
