"""Spark data source for a REST service of historical exchange rates.

One request per month start. ``parallel`` (4) input partitions take turns, so that the service as a whole sees
a request every ``pause`` seconds (0) at most, and a failed request is repeated up to ``retries`` (2) times; a
lost task simply asks again. The service address is an option with a ``{date}`` placeholder:

    spark.dataSource.register(FxHistory)
    spark.read.format("fx_history").options(url=..., first="2012-01-01", last="2013-01-01").load()

Read as a stream, only months after the last one that the checkpoint has seen are asked for, and those named by
``again`` in a ``round`` that it has not seen. A month that fails to the end then gives a row without payload.
"""

import time
from datetime import date
from urllib.request import urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


def month_starts(first: date, last: date) -> list[date]:
    """Month starts from first to last, both included."""
    start, end = first.year * 12 + first.month - 1, last.year * 12 + last.month - 1
    return [date(m // 12, m % 12 + 1, 1) for m in range(start, end + 1)]


class Months(InputPartition):
    """Months that one task asks for: its turn among ``turns`` is ``turn``."""

    def __init__(self, days: list[str], turn: int, turns: int):
        super().__init__(days)
        self.days, self.turn, self.turns = days, turn, turns


def dealt(days: list[str], parallel: int) -> list[Months]:
    turns = min(parallel, len(days))
    return [Months(days[i::turns], i, turns) for i in range(turns)]


class FxHistory(DataSource):
    @classmethod
    def name(cls):
        return "fx_history"

    def schema(self):
        return "request_date STRING, payload STRING"

    def reader(self, schema):
        return FxHistoryReader(self.options)

    def streamReader(self, schema):
        return FxHistoryStream(self.options)


class Service:
    """The requests, at the service's pace."""

    def __init__(self, options):
        self.url = options["url"]
        self.timeout = float(options.get("timeout", "30"))
        self.parallel = int(options.get("parallel", "4"))
        self.pause = float(options.get("pause", "0"))
        self.retries = int(options.get("retries", "2"))
        self.months = month_starts(
            date.fromisoformat(options["first"]), date.fromisoformat(options["last"])
        )

    def answers(self, partition, lenient=False):
        """``(day, payload)`` of a partition's months; a lenient one gives None where a request fails to the end."""
        began = time.monotonic()
        for at, day in enumerate(partition.days):
            due = began + self.pause * (partition.turn + at * partition.turns)
            time.sleep(max(0.0, due - time.monotonic()))
            try:
                yield day, self._ask(day)
            except OSError:
                if not lenient:
                    raise
                yield day, None

    def _ask(self, day):
        for attempt in range(self.retries + 1):
            try:
                with urlopen(self.url.replace("{date}", day), timeout=self.timeout) as answer:
                    return answer.read().decode("utf-8")
            except OSError:
                if attempt == self.retries:
                    raise
                time.sleep(self.pause)


class FxHistoryReader(DataSourceReader):
    def __init__(self, options):
        self.service = Service(options)

    def partitions(self):
        return dealt([m.isoformat() for m in self.service.months], self.service.parallel)

    def read(self, partition):
        yield from self.service.answers(partition)


class FxHistoryStream(DataSourceStreamReader):
    """Offsets name the last month asked for, and the round of months asked for again."""

    def __init__(self, options):
        self.service = Service(options)
        self.again = [d for d in options.get("again", "").split(",") if d]
        self.round = options.get("round", "")

    def initialOffset(self):
        return {"upto": "", "again": [], "round": ""}

    def latestOffset(self):
        upto = self.service.months[-1].isoformat() if self.service.months else ""
        return {"upto": upto, "again": self.again, "round": self.round}

    def partitions(self, start, end):
        fresh = [m.isoformat() for m in self.service.months if start["upto"] < m.isoformat() <= end["upto"]]
        again = [d for d in end["again"] if d not in fresh] if end["round"] != start["round"] else []
        return dealt(sorted(again) + fresh, self.service.parallel)

    def read(self, partition):
        yield from self.service.answers(partition, lenient=True)
