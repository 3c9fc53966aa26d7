"""Analytics over labelled text posts, as Spark DataFrame operators."""
