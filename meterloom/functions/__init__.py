"""Expression builders: rules and column names in, Spark SQL expressions out.

Each returns the text of one native expression for selectExpr, filter or expr, so a rule set
of any size costs a single call into the session and nothing runs in Python per row."""
