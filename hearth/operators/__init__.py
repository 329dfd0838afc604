"""DataFrame operators: ``f(df, ...) -> DataFrame`` with column names as parameters."""
