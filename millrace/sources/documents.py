"""Mails and documents: MIME trees, bytes to text, the first source that works."""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import quality_reason
from ..storage import bounded


def walk(part: dict) -> tuple[str, str, list[tuple[str, str, str, int]]]:
    """(plain text, html, attachments) of a MIME part and those below it."""
    plain, html, files = "", "", []
    body, kind = part.get("body") or {}, part.get("mimeType") or ""
    if part.get("filename"):
        files.append((part["filename"], body.get("data") or "", kind, int(body.get("size") or 0)))
    elif body.get("data") and kind in ("text/plain", "text/html"):
        data = body["data"] + "=" * (-len(body["data"]) % 4)
        text = base64.urlsafe_b64decode(data).decode("utf-8", "replace")
        plain, html = (text, "") if kind == "text/plain" else ("", text)
    for child in part.get("parts") or []:
        p, h, f = walk(child)
        plain, html, files = plain or p, html or h, files + f
    return plain, html, files


def parse_messages(df: DataFrame, column: str = "raw") -> DataFrame:
    """``df`` with plain, html and attachments of raw messages in JSON; a broken one has nulls."""

    def one(raw: str | None):
        try:
            return walk(json.loads(raw)["payload"])
        except (TypeError, KeyError, ValueError, AttributeError):
            return None, None, None

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            yield pd.DataFrame([one(x) for x in series], columns=["plain", "html", "attachments"])

    parse = F.pandas_udf(run, "plain string, html string, attachments array<struct<filename:string,data:string,mime_type:string,size:bigint>>")
    return df.withColumn("_m", parse(F.col(column))).select(*df.columns, "_m.*")


def plain_text(data: bytes) -> str:
    for encoding in ("utf-8", "cp932"):
        try:
            return data.decode(encoding)
        except UnicodeDecodeError:
            continue
    return data.decode("utf-8", "replace")


#: Parsers by the first bytes of a file. Further formats are registered by the caller.
MAGIC: dict[bytes, str] = {b"%PDF": "pdf", b"PK\x03\x04": "zip", b"\xd0\xcf\x11\xe0": "ole"}
#: Kinds by the end of a file's name, where the first bytes tell nothing.
ENDINGS: dict[str, str] = {"html": "html", "htm": "html", "pdf": "pdf", "docx": "zip", "xlsx": "zip", "xlsm": "zip", "doc": "ole", "xls": "ole"}
Parser = Callable[[bytes], str]


def to_text(df: DataFrame, parsers: Mapping[str, Parser] | None = None, column: str = "content", name: str | None = None) -> DataFrame:
    """``df`` with text and error from a binary column: by its first bytes, else by the end of the file's ``name`` (a column)
    if there is a parser for it, else as plain text."""
    known = dict(parsers or {})

    def one(data: bytes | None, title: str | None = None) -> tuple[str | None, str | None]:
        if data is None:
            return None, "empty"
        named = ENDINGS.get(title.rsplit(".", 1)[-1].lower()) if title and "." in title else None
        kind = next((k for m, k in MAGIC.items() if data.startswith(m)), named if named in known else "plain")
        parser = plain_text if kind == "plain" else known.get(kind)
        if not parser:
            return None, f"no parser for {kind}"
        try:
            return parser(bytes(data)), None
        except Exception as error:  # noqa: BLE001  parsers are foreign code; the row says what went wrong
            return None, str(error)[:200]

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for contents, titles in batches:
            yield pd.DataFrame([one(x, t) for x, t in zip(contents, titles, strict=True)], columns=["text", "error"])

    title = F.lit(None).cast("string") if name is None else F.col(name)
    return bounded(df).withColumn("_t", F.pandas_udf(run, "text string, error string")(F.col(column), title)).select(*df.columns, "_t.*")


def first_success(candidates: DataFrame, key: str, priority: str, text: str = "text") -> DataFrame:
    """Of each key's candidates the first usable text (success), else a failure with up to ten reasons."""
    judged = candidates.withColumn("_why", quality_reason(F.col(text)))
    best = F.min_by(F.struct(F.col(text).alias("text"), F.col(priority).alias("priority")), F.when(F.col("_why").isNull(), F.col(priority)))
    reasons = F.slice(F.transform(F.array_sort(F.collect_list(F.when(F.col("_why").isNotNull(), F.struct(F.col(priority), F.col("_why"))))), lambda x: x["_why"]), 1, 10)
    found = judged.groupBy(key).agg(F.max(F.col("_why").isNull()).alias("success"), best.alias("_b"), reasons.alias("reasons"))
    return found.select(key, "success", F.when(F.col("success"), F.col("_b.text")).alias("text"), "reasons")


class MailSource(DataSource):
    """Mails of a paginated API; options: path (of the default client's folder: pages.jsonl has id lists
    as JSON lines, and each mail is a JSON file), max (no more than so many mails, the first ones; all
    without it). A subclass may give another ``client``."""

    @classmethod
    def name(cls) -> str:
        return "mails"

    def schema(self) -> str:
        return "message_id string, raw string"

    def client(self) -> tuple[Callable[[], list[list[str]]], Callable[[str], str | None]]:
        path = self.options["path"]

        def pages() -> list[list[str]]:
            with open(f"{path}/pages.jsonl", encoding="utf-8") as file:
                return [json.loads(x) for x in file if x.strip()]

        def fetch(name: str) -> str | None:
            try:
                with open(f"{path}/{name}.json", encoding="utf-8") as file:
                    return file.read()
            except OSError:
                return None  # a message that can't be fetched is left out

        return pages, fetch

    def reader(self, schema) -> DataSourceReader:
        pages, fetch = self.client()
        most = int(self.options["max"]) if "max" in self.options else None
        return _MailReader(pages, fetch, most)


class _MailReader(DataSourceReader):
    def __init__(self, pages, fetch, most: int | None):
        self.pages, self.fetch, self.most = pages, fetch, most

    def partitions(self) -> list[InputPartition]:
        pages, out = self.pages(), []
        left = sum(map(len, pages)) if self.most is None else self.most
        for page in pages:
            if left > 0:
                out.append(InputPartition(page[:left]))
                left -= len(page)
        return out or [InputPartition([])]

    def read(self, partition: InputPartition):
        for name in partition.value:
            if (raw := self.fetch(name)) is not None:
                yield name, raw
