"""Errors of the engine."""


class PlanError(ValueError):
    """A query or definition that can't be planned."""


class StaleRecord(LookupError):
    """A single-row update or delete that met no row."""


class QueryTimeout(TimeoutError):
    """A query that was stopped because it took too long."""


class ConstraintError(ValueError):
    """Rows that break a constraint; ``errors`` says which fields and why."""

    def __init__(self, errors: list[dict]):
        super().__init__("; ".join(f"{e['field']}: {e['message']}" for e in errors))
        self.errors = errors
