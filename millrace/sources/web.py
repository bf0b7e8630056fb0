"""Documents behind links: kinds of links, redirects, and a fetcher that is given from outside."""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator, Mapping
from types import MappingProxyType
from urllib.parse import parse_qs, urljoin, urlparse

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A fetcher gives (status, content type, location, bytes) of a URL, without following redirects.
Fetch = Callable[[str], tuple[int, str, str | None, bytes]]
META = re.compile(rb"<meta[^>]+http-equiv=[\"']?refresh[^>]+url=([^\"'>\s]+)", re.IGNORECASE)
#: A script that goes elsewhere: an assignment to the location, a call that sets it, or a window that it opens.
SCRIPT = re.compile(rb"(?:\blocation(?:\.href)?\s*=\s*|\blocation\.(?:replace|assign)\(\s*|\bwindow\.open\(\s*)[\"']([^\"']+)[\"']")


def direct(url: str) -> str:
    """A link to a shared file as a link to its bytes; other links as they are."""
    parts = urlparse(url)
    host = (parts.hostname or "").lower()
    if host in ("drive.google.com", "docs.google.com"):
        found = re.search(r"/d/([A-Za-z0-9_-]+)", parts.path)
        name = found[1] if found else parse_qs(parts.query).get("id", [""])[0]
        if name and "/spreadsheets/" in parts.path:
            return f"https://docs.google.com/spreadsheets/d/{name}/export?format=xlsx"
        if name and "/document/" in parts.path:
            return f"https://docs.google.com/document/d/{name}/export?format=docx"
        return f"https://drive.google.com/uc?export=download&id={name}" if name else url
    if host.endswith(("1drv.ms", "onedrive.live.com", "sharepoint.com")) and "download=1" not in parts.query:
        return url + ("&" if parts.query else "?") + "download=1"
    return url


def next_page(url: str, data: bytes, links: Mapping[str, str]) -> str | None:
    """Where a page of HTML leads, from anywhere in it: what its host's pattern of ``links`` finds, its refresh, its script."""
    host = (urlparse(url).hostname or "").lower()
    own = next((re.search(p.encode(), data) for h, p in links.items() if host == h or host.endswith(f".{h}")), None)
    found = own or META.search(data) or SCRIPT.search(data)
    return urljoin(url, html.unescape(found[1].decode("utf-8", "replace"))) if found else None


def follow(url: str, fetch: Fetch, hops: int = 8, links: Mapping[str, str] = MappingProxyType({})) -> tuple[str, str, bytes]:
    """(last URL, content type, bytes) behind a link, over at most ``hops`` redirects: by status, by a
    page's refresh or by a script that goes elsewhere. ``links``: by host, such as one of people's profiles, a pattern of HTML whose
    first group is the link to the document. A page that leads to itself is the last."""
    url = direct(url)
    for _ in range(hops + 1):
        status, kind, location, data = fetch(url)
        if 300 <= status < 400 and location:
            url = urljoin(url, location)
            continue
        if status >= 400:
            raise ValueError(f"HTTP {status}")
        to = next_page(url, data, links) if "html" in kind.lower() else None
        if to is None or to == url:
            return url, kind, data
        url = direct(to)
    raise ValueError(f"more than {hops} redirects")


def fetched(df: DataFrame, fetch: Fetch, column: str = "url", hops: int = 8, links: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` with final_url, content_type, content and fetch_error of each link; one call after another in a task."""

    links = dict(links or {})

    def one(url):
        try:
            return (*follow(url, fetch, hops, links), None) if isinstance(url, str) else (None, None, None, "no url")
        except Exception as error:  # noqa: BLE001  the row says what went wrong
            return None, None, None, str(error)[:200]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            yield pd.DataFrame([one(x) for x in series], columns=["final_url", "content_type", "content", "fetch_error"])

    got = F.pandas_udf(run, "final_url string, content_type string, content binary, fetch_error string")
    return df.withColumn("_w", got(F.col(column))).select(*df.columns, "_w.*")
