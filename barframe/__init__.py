"""barframe: market-data tables and streams as Spark DataFrame operators."""
