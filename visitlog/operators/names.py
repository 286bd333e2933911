"""Names for helper columns."""


def free_name(columns, wanted):
    """``wanted``, or the first longer form of it that is in none of ``columns``."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
