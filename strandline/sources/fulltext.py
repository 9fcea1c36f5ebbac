"""Full texts tier by tier: what to ask for each document, what an answer is, and where it would be stored.

A tier is tried only for documents that have none of the tiers before it; every attempt leaves a row. The transport is a callable
(url, parameters) → (status, body bytes, content type), found by name in the workers.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..operators.catalogue import FULLTEXT_TIERS, publisher
from ..session import materialise
from .remote import RATES, RateLimiter, transport_of

ATTEMPT = "pmid string, tier string, ok boolean, name string, status string, supplement_files int, body binary"
Answer = tuple[bool, str | None, str, int, bytes | None]


def kind_of(body: bytes, content_type: str | None) -> str:
    """pdf by its first bytes, xml or html by the declared type."""
    if body[:4] == b"%PDF" or "pdf" in (content_type or ""):
        return "pdf"
    return "xml" if "xml" in (content_type or "") else "html"


def supplement_files(body: bytes) -> int:
    """How many files a supplement archive holds; 0 where the answer is no archive."""
    if body[:2] != b"PK":
        return 0
    try:
        return len(zipfile.ZipFile(io.BytesIO(body)).namelist())
    except zipfile.BadZipFile:
        return 0


class Fetcher:
    """The four tiers over one transport. Each method answers (ok, stored name, status, supplement files, body)."""

    def __init__(self, transport: Callable, limiter: RateLimiter):
        self.transport, self.limiter = transport, limiter

    def ask(self, url: str, **params: str) -> tuple[int, bytes, str]:
        self.limiter.wait()
        status, body, content_type = self.transport(url, params)
        return status, body or b"", content_type or ""

    def epmc(self, doc: dict) -> Answer:
        if not doc["pmcid"]:
            return False, None, "no pmcid", 0, None
        status, body, _ = self.ask("fulltext", id=doc["pmcid"])
        if status != 200:
            return False, None, f"http {status}", 0, None
        extra = self.ask("supplements", id=doc["pmcid"]) if doc.get("has_suppl") else (0, b"", "")
        return True, "epmc.xml", "ok", supplement_files(extra[1]) if extra[0] == 200 else 0, body

    def pmc(self, doc: dict) -> Answer:
        if not doc["pmcid"]:
            return False, None, "no pmcid", 0, None
        status, body, _ = self.ask("archive", id=doc["pmcid"].removeprefix("PMC"))
        if status != 200:
            return False, None, f"http {status}", 0, None
        return (True, "epmc.xml", "ok", 0, body) if b"<body" in body else (False, None, "no body", 0, None)

    def unpaywall(self, doc: dict) -> Answer:
        if not doc["doi"]:
            return False, None, "no doi", 0, None
        status, body, _ = self.ask("location", doi=doc["doi"])
        place = body.decode("utf-8", "replace").strip() if status == 200 else ""
        if not place:
            return False, None, "no open location" if status == 200 else f"http {status}", 0, None
        status, body, kind = self.ask(place)
        return (True, f"unpaywall.{kind_of(body, kind)}", "ok", 0, body) if status == 200 and body else (False, None, f"http {status}", 0, None)

    def publisher(self, doc: dict) -> Answer:
        house = doc["publisher"]
        if not house:
            return False, None, "no publisher interface", 0, None
        status, body, _ = self.ask(house, doi=doc["doi"])
        return (True, f"{house}.{'pdf' if house == 'wiley' else 'xml'}", "ok", 0, body) if status == 200 and body else (False, None, f"http {status}", 0, None)


def attempt(documents: DataFrame, tier: str, transport: str, tasks: int = 1, rate: float = RATES["fulltext"]) -> DataFrame:
    """One tier for `documents(pmid, pmcid, doi, has_suppl)` → `ATTEMPT`; a failing document costs its own row only."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = getattr(Fetcher(transport_of(transport), RateLimiter(rate / tasks)), tier)
        for pdf in it:
            out = []
            for doc in pdf.astype(object).where(pdf.notna(), None).to_dict("records"):
                try:
                    ok, name, status, files, body = ask(doc)
                except Exception as e:  # noqa: BLE001 - a transport may raise anything
                    ok, name, status, files, body = False, None, f"{type(e).__name__}: {e}"[:200], 0, None
                out.append((doc["pmid"], tier, ok, name, status, files, body))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in ATTEMPT.split(", ")]).astype({"supplement_files": "int32"})

    x = documents.select("pmid", "pmcid", "doi", "has_suppl", publisher(F.col("doi")).alias("publisher"))
    return x.repartition(tasks, "pmid").mapInPandas(run, ATTEMPT)


def fetch_tiers(documents: DataFrame, transport: str, tiers: tuple[str, ...] = FULLTEXT_TIERS, tasks: int = 1, rate: float = RATES["fulltext"]) -> DataFrame:
    """All attempts, tier after tier; each tier is written before the next one looks at what is still missing."""
    out, rest = None, documents
    for tier in tiers:
        got = materialise(attempt(rest, tier, transport, tasks, rate), f"tier-{tier}")
        rest = rest.join(got.where("ok").select("pmid"), "pmid", "left_anti")
        out = got if out is None else out.unionByName(got)
    return out


def statistics(attempts: DataFrame) -> DataFrame:
    """(tier, tried, ok, statuses): what a fetching run did."""
    return attempts.groupBy("tier").agg(F.count("*").alias("tried"), F.count_if("ok").alias("ok"), F.array_sort(F.collect_set("status")).alias("statuses"))
