"""Check queries: the package's operators over the test tables, with SQL oracles."""


def load():
    """All queries and oracles, registered on import."""
    from workloads import (  # noqa: F401
        q_answers,
        q_cohort,
        q_daily,
        q_evaluate,
        q_followup,
        q_scan,
        q_stages,
        q_text,
    )
    from workloads.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
