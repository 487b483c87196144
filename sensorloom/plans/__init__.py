"""Ready-made queries over the given tables."""


def catalog():
    """All registered queries by name."""
    from sensorloom.plans import analytics, incidents, scans  # noqa: F401  (they register themselves)
    from sensorloom.plans.registry import QUERIES

    return QUERIES
