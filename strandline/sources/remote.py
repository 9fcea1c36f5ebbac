"""Remote literature services as Spark data sources. There is no network where this is tested, so the transport is a plain
callable that can be replaced; rate limit and retry live in the reader, which runs in one task because the limit is global."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Requests per second (citations without and with a key, full-text search, full texts), retries, page sizes.
RATES = {"citations": 2.5, "citations_key": 9.0, "search": 5.0, "fulltext": 4.0}
RETRY_STATUS = (429, 500, 502, 503, 504)
TRIES = 5
HISTORY_PAGE, ID_PAGE, ENRICH_PAGE = 500, 200, 100

Transport = Callable[[str, dict], tuple[int, str]]


class RateLimiter:
    def __init__(self, per_second: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap, self.clock, self.sleep, self.last = 1.0 / per_second, clock, sleep, float("-inf")

    def wait(self) -> None:
        if (rest := self.last + self.gap - self.clock()) > 0:
            self.sleep(rest)
        self.last = self.clock()


def fetch(transport: Transport, url: str, params: dict, limiter: RateLimiter, tries: int = TRIES, sleep: Callable[[float], None] = time.sleep) -> str:
    """The body of a request, tried again with doubling pauses on overload; raises after the last try or on other errors."""
    for attempt in range(tries):
        limiter.wait()
        status, body = transport(url, params)
        if status == 200:
            return body
        if status not in RETRY_STATUS or attempt + 1 == tries:
            raise RuntimeError(f"{url}: status {status}")
        sleep(2.0**attempt)
    raise RuntimeError(url)


def cursor_pages(transport: Transport, url: str, query: str, limiter: RateLimiter, max_pages: int | None = None) -> Iterator[dict]:
    """Pages of a cursor search until the cursor repeats or the pages run out; `transport` answers JSON text."""
    import json

    cursor, n = "*", 0
    while max_pages is None or n < max_pages:
        page = json.loads(fetch(transport, url, {"query": query, "cursorMark": cursor}, limiter))
        yield page
        n += 1
        nxt = page.get("nextCursorMark")
        if not nxt or nxt == cursor:
            return
        cursor = nxt


def transport_of(name: str) -> Transport:
    """`module:function` as a callable, so that readers in other processes can find it."""
    import importlib

    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def hit_count(transport: Transport, url: str, term: str, limiter: RateLimiter) -> int:
    """How many citations a query has; nothing is fetched."""
    import json

    return int(json.loads(fetch(transport, url, {"term": term, "rettype": "count"}, limiter))["count"])


def open_history(transport: Transport, url: str, term: str, limiter: RateLimiter, low: str | None = None, high: str | None = None) -> tuple[str, str, int]:
    """(environment, query key, number of hits) of a search that is kept at the server; entry dates between `low` and `high`,
    where only one is given the other is 1900 or 3000."""
    import json

    params = {"term": term, "usehistory": "y"}
    if low or high:
        params |= {"datetype": "edat", "mindate": low or "1900", "maxdate": high or "3000"}
    r = json.loads(fetch(transport, url, params, limiter))
    return r["webenv"], r["querykey"], int(r["count"])


class _Part(InputPartition):
    def __init__(self, value):  # noqa: ANN001
        super().__init__(value)


class _Reader(DataSourceReader):
    """Common to the citation sources: `url`, `transport` and the rate. The limit is global, so `tasks` of them share it evenly."""

    def __init__(self, options: dict):
        self.url = options.get("url", "")
        self.transport = options.get("transport", "")
        self.tasks = max(1, int(options.get("tasks", "1")))
        self.rate = float(options.get("rate") or RATES["citations_key" if options.get("key") else "citations"])

    def limiter(self) -> RateLimiter:
        return RateLimiter(self.rate / self.tasks)

    def dealt(self, values: list) -> list[InputPartition]:
        return [_Part(values[i :: self.tasks]) for i in range(min(self.tasks, max(len(values), 1)))]


class _IdReader(_Reader):
    def __init__(self, options: dict):
        super().__init__(options)
        ids = [x for x in options.get("ids", "").split(",") if x]
        self.pages = [ids[at : at + ID_PAGE] for at in range(0, len(ids), ID_PAGE)]

    def partitions(self) -> list[InputPartition]:
        return self.dealt(self.pages)

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        transport, limiter = transport_of(self.transport), self.limiter()
        for page in partition.value:
            yield ",".join(page), fetch(transport, self.url, {"id": ",".join(page)}, limiter)


class CitationSource(DataSource):
    """`spark.read.format("citations").option("ids", "1,2").option("transport", "module:function")` → (source, xml)."""

    @classmethod
    def name(cls) -> str:
        return "citations"

    def schema(self) -> str:
        return "source string, xml string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _IdReader(self.options)


class _HistoryReader(_Reader):
    """The search is made once, while partitions are planned; each partition fetches its own pages by offset."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.term, self.low, self.high = options.get("term", ""), options.get("mindate"), options.get("maxdate")

    def partitions(self) -> list[InputPartition]:
        env, key, n = open_history(transport_of(self.transport), self.url, self.term, RateLimiter(self.rate), self.low, self.high)
        return self.dealt([(env, key, start) for start in range(0, n, HISTORY_PAGE)])

    def read(self, partition: InputPartition) -> Iterator[tuple[int, str]]:
        transport, limiter = transport_of(self.transport), self.limiter()
        for env, key, start in partition.value:
            yield start, fetch(transport, self.url, {"webenv": env, "query_key": key, "retstart": start, "retmax": HISTORY_PAGE}, limiter)


class HistorySource(DataSource):
    """`format("citation_history")` with `term`, optional `mindate`/`maxdate`, `transport`, `tasks` → (start, xml), a row per page."""

    @classmethod
    def name(cls) -> str:
        return "citation_history"

    def schema(self) -> str:
        return "start int, xml string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _HistoryReader(self.options)


class _CursorReader(_Reader):
    def __init__(self, options: dict):
        super().__init__(options)
        self.query, self.pages = options.get("query", ""), options.get("max_pages")
        self.rate = float(options.get("rate") or RATES["search"])

    def partitions(self) -> list[InputPartition]:
        return [_Part(self.query)]  # a cursor is sequential

    def read(self, partition: InputPartition) -> Iterator[tuple[int, str]]:
        import json

        pages = cursor_pages(transport_of(self.transport), self.url, partition.value, self.limiter(), int(self.pages) if self.pages else None)
        for n, page in enumerate(pages):
            yield from ((n, json.dumps(r)) for r in page.get("results", []))


class CursorSource(DataSource):
    """`format("cursor_search")` with `query`, `transport`, optional `max_pages` → (page, result JSON)."""

    @classmethod
    def name(cls) -> str:
        return "cursor_search"

    def schema(self) -> str:
        return "page int, result string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _CursorReader(self.options)


def register(spark) -> None:  # noqa: ANN001
    for source in (CitationSource, HistorySource, CursorSource):
        spark.dataSource.register(source)


ENRICHED = "pmid string, pmcid string, is_open_access int, license string, in_epmc int, has_suppl int"


def enrichment_lookup(ids: DataFrame, transport: str, url: str = "", tasks: int = 1, rate: float = RATES["search"]) -> DataFrame:
    """Facts of papers in batches of 100 identifiers: `ids(pmid)` → `ENRICHED`, one row per paper the service knows; a flag is 1
    only for `Y`. `tasks` readers share the rate."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        call, limiter = transport_of(transport), RateLimiter(rate / tasks)
        for pdf in it:
            out, known = [], pdf["pmid"].tolist()
            for at in range(0, len(known), ENRICH_PAGE):
                query = " OR ".join(f"EXT_ID:{i}" for i in known[at : at + ENRICH_PAGE])
                for r in json.loads(fetch(call, url, {"query": query, "pageSize": ENRICH_PAGE}, limiter))["results"]:
                    yes = lambda k, r=r: int(r.get(k) == "Y")
                    out.append((r["pmid"], r.get("pmcid"), yes("isOpenAccess"), r.get("license"), yes("inEPMC"), yes("hasSuppl")))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in ENRICHED.split(", ")]).astype({"is_open_access": "int32", "in_epmc": "int32", "has_suppl": "int32"})

    return ids.where("pmid is not null").select("pmid").distinct().repartition(tasks).mapInPandas(run, ENRICHED)


def fetch_ids(ids: DataFrame, transport: str, url: str = "", tasks: int = 1, rate: float = RATES["citations"]) -> DataFrame:
    """Citations by identifier, 200 per request and without a second try: `ids(pmid)` → (source, n_ids, xml, error)."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call, limiter = transport_of(transport), RateLimiter(rate / tasks)
        for pdf in it:
            out, known = [], pdf["pmid"].tolist()
            for at in range(0, len(known), ID_PAGE):
                page = known[at : at + ID_PAGE]
                try:
                    out.append((",".join(page), len(page), fetch(call, url, {"id": ",".join(page)}, limiter, tries=1), None))
                except RuntimeError as e:
                    out.append((",".join(page), len(page), None, str(e)))
            yield pd.DataFrame(out, columns=["source", "n_ids", "xml", "error"]).astype({"n_ids": "int32"})

    return ids.where("pmid is not null").select("pmid").distinct().repartition(tasks).mapInPandas(run, "source string, n_ids int, xml string, error string")
