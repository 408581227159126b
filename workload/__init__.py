"""Every operator as a named query over the test tables, with its DuckDB counterpart."""

from importlib import import_module

MODULES = ("sources", "contracts", "functions", "relational", "checks", "analytics", "catalogs")


def load():
    """(Spark queries, DuckDB texts) of all modules, by name."""
    from workload import registry

    for module in MODULES:
        import_module(f"workload.{module}")
    return registry.SPARK, registry.ORACLE
