"""datamill: analytics jobs written as Spark DataFrame operators."""
