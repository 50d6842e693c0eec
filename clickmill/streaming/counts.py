"""What streams received, could not key, and left out as too late."""

from collections import defaultdict
from collections.abc import Callable

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from clickmill.operators.quality import DELIVERED

COUNTS = ("received", "rejected", "late_groups")


def counts_of(progress) -> dict[str, int]:
    """The counts of one micro-batch.

    Late clicks of a watermarked stream are counted as Spark reports them: those of one task, product
    and hour as one group.
    """
    observed = progress.observedMetrics.get(DELIVERED)
    late = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
    received, rejected = (0, 0) if observed is None else (observed["received"], observed["rejected"])
    return dict(zip(COUNTS, (received, rejected, late)))


def delivered(query: StreamingQuery) -> dict[str, int]:
    """The counts of a query's recent micro-batches, of which Spark keeps the last hundred."""
    found = [counts_of(progress) for progress in query.recentProgress]
    return {name: sum(counts[name] for counts in found) for name in COUNTS}


class DeliveryListener(StreamingQueryListener):
    """Adds up the counts of every stream of a session, by the name of its query, or its id.

    Add it with spark.streams.addListener. `report`, if given, is called with the name, the
    micro-batch's number and its counts, to pass them on to a monitor or a log.
    """

    def __init__(self, report: Callable[[str, int, dict[str, int]], None] | None = None):
        self.report = report
        self.totals = defaultdict(lambda: dict.fromkeys(COUNTS, 0))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        name, counts = progress.name or str(progress.id), counts_of(progress)
        for kind in COUNTS:
            self.totals[name][kind] += counts[kind]
        if self.report is not None:
            self.report(name, progress.batchId, counts)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
