"""tidemark: customer-review analytics as Spark DataFrame operators."""
