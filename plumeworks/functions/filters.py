"""Filter tuples ``(column, op, value)`` folded into one predicate."""

from pyspark.sql import functions as F

from plumeworks.functions.expressions import all_of

_OPS = {
    "=": lambda c, v: c == v,
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "in": lambda c, v: c.isin(list(v)),
}


def predicate(filters):
    """AND of all tuples; an unknown operator is an error, no tuples means no filter."""
    unknown = [op for _, op, _ in filters if op not in _OPS]
    if unknown:
        raise ValueError(f"unsupported filter operator: {unknown[0]}")
    return all_of([F.lit(True)] + [_OPS[op](F.col(c), v) for c, op, v in filters])
