"""Row predicates, with the three notions of "nothing there" kept apart.

=========== ======= ======= ===========
predicate   NULL    ``''``  only spaces
=========== ======= ======= ===========
is_null     yes     no      no
is_empty    yes     yes     no
=========== ======= ======= ===========

``not_null`` and ``not_empty`` are their complements, ``not_blank`` that of all
three together; none of them is ever NULL. They spell out ``isNotNull`` because that part can reach a columnar scan; ``trim`` cannot.
"""

from functools import reduce

from pyspark.sql import functions as F


def _column(c):
    return F.col(c) if isinstance(c, str) else c


def is_null(c):
    return _column(c).isNull()


def is_empty(c):
    c = _column(c)
    return c.isNull() | (c == "")


def not_null(c):
    return _column(c).isNotNull()


def not_empty(c):
    c = _column(c)
    return c.isNotNull() & (c != "")


def not_blank(c):
    c = _column(c)
    return c.isNotNull() & (F.trim(c) != "")


def equals(c, value):
    """Exact match: case and spaces count, NULL does not match."""
    return _column(c) == F.lit(value)


def matches(c, pattern):
    """Whether the upper-cased text contains a match of a Java regex."""
    return F.upper(_column(c)).rlike(pattern)


def all_of(predicate, columns):
    """AND of one predicate over several columns; true for no columns."""
    return reduce(lambda a, b: a & b, [predicate(c) for c in columns], F.lit(True))
