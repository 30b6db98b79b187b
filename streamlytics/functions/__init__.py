"""Column expressions. All run inside code generation; none is a Python UDF."""
