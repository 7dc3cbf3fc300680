"""Queries over the given tables and their DuckDB equivalents."""


def all_queries():
    from checks import q_choice, q_files, q_network, q_plans, q_run, q_skims, q_tables  # noqa: F401
    from checks.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
