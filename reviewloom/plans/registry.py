"""The registered queries, by name, and the SQL that states their answers."""

QUERIES, ORACLE = {}, {}


def query(sql=None):
    """Register the function under its name, with its SQL if there is one."""
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return add
