"""SQL expressions of the wire format and of record text.

Each function takes SQL expressions and returns one.  All are built from
Spark's own functions, so they stay in generated code.
"""
