"""The registered queries of the core and their SQL."""

from gristmill.plans import nested, pipelines, reference, runs

MODULES = [nested, pipelines, reference, runs]


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
