"""Column-expression builders; none of them needs a Python UDF."""
