"""Text search, text classification, graph and message-stream analytics as Spark DataFrame operators."""
