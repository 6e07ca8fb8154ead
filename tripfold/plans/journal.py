"""States and events of work on a month, filed whatever becomes of the work."""

import logging
from collections.abc import Callable
from contextlib import ExitStack

from tripfold.config import check_run_id
from tripfold.functions.months import check_month
from tripfold.sources.store import MonthStore

LOG = logging.getLogger(__name__)

#: The state that each event of a service puts its month in (fixed values).  A month leaves
#: SUCCESS before any of its data is touched, which keeps a half-written month from gold.
STATES = {
    "ingestion": {"STARTED": "RUNNING", "SUCCESS": "INGESTED", "FAILED": "FAILED"},
    "preparation": {"STARTED": "RUNNING", "SUCCESS": "SUCCESS", "FAILED": "FAILED"},
}


def perform(
    store: MonthStore, service: str, month: str, run_id: str, work: Callable[[], dict]
) -> dict:
    """Do the work and file its start and its end as events, with the states they mean.

    Services without states file events alone; the others' results are the counts of the
    month.  An error is filed by its type and raised again, also one met while filing."""
    about = {"month": check_month(month), "run_id": check_run_id(run_id)}

    def enter(event: str, counts: dict | None = None, error_type: str | None = None) -> None:
        if service in STATES:
            state = STATES[service][event]
            store.record("month_status", **about, status=state, **(counts or {}))
        store.record("run_events", **about, service=service, status=event, error_type=error_type)

    def on_error(kind, error, trace) -> None:
        if kind is not None and issubclass(kind, Exception):
            try:
                enter("FAILED", error_type=kind.__name__)
            except Exception:
                LOG.exception("%s of %s failed, which could not be filed", service, month)

    with ExitStack() as leaving:
        leaving.push(on_error)
        enter("STARTED")
        result = work()
        enter("SUCCESS", result)
    return result
