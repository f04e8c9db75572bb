"""Column expressions: a report text or a scalar in, a Column out.

Nothing here is a Python UDF, so every extraction stays on the JVM and a stage
is one projection over one scan.
"""
