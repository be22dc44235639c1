"""DataFrame-in, DataFrame-out operators.

Unless its description says otherwise an operator is lazy: it runs no job,
reads no clock and collects nothing.
"""
