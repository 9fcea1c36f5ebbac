"""A literature service that answers from rules instead of a network, for tests and for the registered queries.

Citations: 1,234 hits for any term (entry window given: 100 per year of it); pages hold their offset. Cursor searches: three pages of
four results. Enrichment: an id that ends in 0 is unknown, even ones are open. Full texts: by the last digit of the identifier.
"""

from __future__ import annotations

import io
import json
import zipfile


def citations(url: str, params: dict) -> tuple[int, str]:
    if params.get("rettype") == "count":
        return 200, json.dumps({"count": 1234})
    if "usehistory" in params:
        years = int(params["maxdate"][:4]) - int(params["mindate"][:4]) if "mindate" in params else None
        return 200, json.dumps({"webenv": "env", "querykey": "1", "count": 1234 if years is None else 100 * years})
    if "retstart" in params:
        return 200, f"<set start='{params['retstart']}' size='{params['retmax']}'/>"
    return 200, f"<set ids='{params['id'].count(',') + 1}'/>"


def search(url: str, params: dict) -> tuple[int, str]:
    if "cursorMark" in params:
        at = {"*": 0, "a": 1, "b": 2}[params["cursorMark"]]
        return 200, json.dumps({"results": [{"id": f"{at}-{i}"} for i in range(4)], "nextCursorMark": ["a", "b", "b"][at]})
    ids = [x.removeprefix("EXT_ID:") for x in params["query"].split(" OR ")]
    return 200, json.dumps({"results": [{"pmid": i, "pmcid": f"PMC{i}" if i[-1] in "2468" else None, "isOpenAccess": "Y" if i[-1] in "2468" else "N", "license": "cc by" if i[-1] in "24" else None, "inEPMC": "Y", "hasSuppl": "Y" if i[-1] == "2" else "N"} for i in ids if i[-1] != "0"]})


def _archive() -> bytes:
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("a.txt", "a")
        z.writestr("b.txt", "b")
    return b.getvalue()


def texts(url: str, params: dict) -> tuple[int, bytes, str]:
    last = (params.get("id") or params.get("doi") or url)[-1]
    if url == "fulltext":
        return (200, b"<article/>", "text/xml") if last in "0123" else (404, b"", "")
    if url == "supplements":
        return 200, _archive() if last in "01" else b"none", "application/zip"
    if url == "archive":
        return (200, b"<article><body/></article>" if last in "45" else b"<article/>", "text/xml") if last != "9" else (500, b"", "")
    if url == "location":
        return 200, f"place-{last}".encode() if last in "0246" else b"", "text/plain"
    if url.startswith("place"):
        return 200, b"%PDF-1" if last in "02" else b"<html/>", "text/html"
    return (200, b"<article/>", "text/xml") if last in "123" else (403, b"", "")
