"""opstide: operations-log analytics expressed as Spark DataFrame operators."""
