"""Column expressions. All are built-in Spark functions, none is a UDF."""
