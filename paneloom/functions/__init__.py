"""Column expressions. Every function returns a Spark ``Column``; none of them is a UDF."""
