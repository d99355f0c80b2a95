"""Analytics over logs of AI-suggested support replies, as PySpark jobs."""
