"""The operators on the driver tables: Spark queries and the SQL they are checked against."""
