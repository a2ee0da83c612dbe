"""One decorator keeps a Spark query and its SQL together."""

from barsmith.session import configure

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark, sf_dir):
            return build(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return build
    return register
