"""Registry of queries and of the ANSI SQL that must give the same rows."""

QUERIES = {}
ORACLES = {}


def query(name, oracle=None):
    """Register ``fn(spark, folder) -> DataFrame`` and, where one exists, its SQL."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register
