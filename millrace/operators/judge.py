"""Judging a pair's requirements through a pluggable judge; offline by keyword evidence."""

from __future__ import annotations

import json
import queue
import threading
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import bounded, sliced, written

Judge = Callable[[list[str], str], list[dict]]
SKILL = "struct<skill:string,match:boolean,note:string>"


def keyword_judge(skills: list[str], text: str) -> list[dict]:
    """A skill is met if it, or all its longer tokens, occur in the text."""
    low, out = text.lower(), []
    for skill in skills:
        tokens = [t for t in skill.lower().split() if len(t) > 1]
        met = skill.lower() in low or bool(tokens) and all(t in low for t in tokens)
        out.append({"skill": skill, "match": met, "note": "found in the text" if met else "not in the text"})
    return out


def problem(answer: object, skills: list[str], most: int = 30) -> str | None:
    """Why an answer is not valid: an error code, or null."""
    if not isinstance(answer, list) or len(answer) != len(skills) or any(not isinstance(x, dict) or set(x) != {"skill", "match", "note"} for x in answer):
        return "llm_parse_error"
    for x, skill in zip(answer, skills, strict=True):
        if x["skill"] != skill or not isinstance(x["match"], bool) or not isinstance(x["note"], str) or not 1 <= len(x["note"].strip()) <= most:
            return "invalid_output_schema"
    return None


class Refused(Exception):
    """A call that must not be tried again: the request is wrong, or there is no permission."""


class Patient:
    """A judge that waits ``spacing`` seconds between calls of a process, gives up on a call after ``timeout``
    seconds, and tries each up to ``tries`` times, ``wait`` seconds apart; Refused is not tried again. A whole job's calls
    are spaced by ``Store``, which knows how many tasks there are."""

    def __init__(self, call: Judge, spacing: float = 0.5, tries: int = 3, wait: float = 5.0, timeout: float = 60.0):
        self.call, self.spacing, self.tries, self.wait, self.timeout, self.last = call, spacing, tries, wait, timeout, 0.0

    def _within(self, skills: list[str], text: str) -> list[dict]:
        told: queue.Queue = queue.Queue()

        def run() -> None:
            try:
                told.put((True, self.call(skills, text)))
            except Exception as cause:  # noqa: BLE001  handed on to the caller
                told.put((False, cause))

        threading.Thread(target=run, daemon=True).start()  # a call that never ends must not keep the worker
        try:
            good, value = told.get(timeout=self.timeout)
        except queue.Empty:
            raise TimeoutError(f"no answer within {self.timeout} s") from None
        if not good:
            raise value
        return value

    def __call__(self, skills: list[str], text: str) -> list[dict]:
        for left in range(self.tries - 1, -1, -1):
            time.sleep(max(0.0, self.last + self.spacing - time.monotonic()))
            self.last = time.monotonic()
            try:
                return self._within(skills, text)
            except Refused:
                raise
            except Exception:
                if not left:
                    raise
                time.sleep(self.wait)
        raise ValueError("no tries")


class Store:
    """Answers by the digest of their request, below ``path``, a folder that all executors share, by a path that
    pyarrow's file systems know. A task writes each answer as it comes, before the next call, and looks there first: a task
    that fails, or an executor that is lost, asks nothing again but the call it was in. ``rate`` calls a second are
    shared out among ``tasks`` tasks. Calls that failed are told, but not kept."""

    ANSWER = "digest string, answer string, error string, cause string"

    def __init__(self, spark, path: str, tasks: int = 8, rate: float | None = None):
        self.spark, self.path, self.tasks, self.rate = spark, path.rstrip("/"), tasks, rate

    def known(self) -> DataFrame:
        """Kept answers: those of earlier jobs, one a digest."""
        try:
            return self.spark.read.schema(self.ANSWER).parquet(f"{self.path}/answers").dropDuplicates(["digest"])
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.ANSWER)

    def asked(self, requests: DataFrame, one: Callable[[str], tuple[object | None, str | None, str | None]]) -> DataFrame:
        """``requests`` (digest, request) with answer (JSON), error and cause. ``one`` gets a request and gives an
        answer, an error and its cause; equal requests are one."""
        distinct = requests.groupBy("digest").agg(F.first("request").alias("request"))
        known = written(self.known(), "answers")
        missing = distinct.join(known.select("digest"), "digest", "left_anti").repartition(self.tasks, "digest")
        pending, spacing = f"{self.path}/pending", self.tasks / self.rate if self.rate else 0.0

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from pyarrow import fs

            files, root = fs.FileSystem.from_uri(pending) if "://" in pending else (fs.LocalFileSystem(), pending)
            files.create_dir(root, recursive=True)
            last = 0.0
            for batch in batches:
                out = []
                for digest, request in zip(batch["digest"], batch["request"], strict=True):
                    place = f"{root}/{digest}"
                    if files.get_file_info(place).type == fs.FileType.File:
                        with files.open_input_stream(place) as file:
                            out.append((digest, *json.loads(file.read())))
                        continue
                    time.sleep(max(0.0, last + spacing - time.monotonic()))
                    last = time.monotonic()
                    answer, error, cause = one(request)
                    row = (None if answer is None else json.dumps(answer, ensure_ascii=False), error, cause)
                    part = f"{place}.{uuid.uuid4().hex}"  # moved when whole, so that no half answer is read
                    with files.open_output_stream(part) as file:
                        file.write(json.dumps(row).encode())
                    files.move(part, place)
                    out.append((digest, *row))
                yield pd.DataFrame(out, columns=["digest", "answer", "error", "cause"])

        new = written(missing.mapInPandas(run, self.ANSWER), "asked")
        new.filter(~F.coalesce(F.col("error") == "llm_call_error", F.lit(False))).write.mode("append").parquet(f"{self.path}/answers")
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(pending)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        return requests.join(known.unionByName(new), "digest", "left")


#: Skills, and thousands of characters of texts, that a worker has answers of at once.
ANSWERS = 5_000


def _weight(skills, text) -> int:
    """An answer is some hundred bytes a skill, a text one for a character at least."""
    return (0 if skills is None else len(skills)) + (len(text) // 1000 if isinstance(text, str) else 0) + 1


def _judgement(judge: Judge) -> Callable[[list[str] | None, str | None], tuple[list[dict] | None, str | None, str | None]]:
    """Results, error and cause of skills and a sheet."""

    def one(wanted: list[str] | None, sheet: str | None) -> tuple[list[dict] | None, str | None, str | None]:
        if wanted is None or not len(wanted):
            return None, "missing_project_required_skills", None
        if not isinstance(sheet, str) or not sheet.strip():
            return None, "missing_resource_skillsheet", None
        try:
            answer = judge(list(wanted), sheet)
        except Exception as cause:  # noqa: BLE001  a call may fail in any way; the row says so
            return None, "llm_call_error", f"{type(cause).__name__}: {cause}"[:200]
        error = problem(answer, list(wanted))
        return (None, error, None) if error else (answer, None, None)

    return one


def judged(pairs: DataFrame, judge: Judge = keyword_judge, *, skills: str = "required_skills", text: str = "skillsheet", store: Store | None = None) -> DataFrame:
    """``pairs`` with results (structs of skill, match, note) or an error: missing skills, a missing
    sheet, a failed call (its message is the cause), an answer that isn't valid. With a ``store`` each distinct request is
    asked once, whatever fails or runs again; without one there is a call per row, in the row's task."""
    one = _judgement(judge)
    if store is not None:
        request = F.to_json(F.struct(F.col(skills).alias("skills"), F.col(text).alias("text")), {"ignoreNullFields": "false"})
        keyed = pairs.withColumn("_request", request).withColumn("_digest", F.sha2(F.concat(F.lit("judge "), "_request"), 256))
        ask = lambda request: one(*map(json.loads(request).get, ("skills", "text")))
        told = store.asked(keyed.select(F.col("_digest").alias("digest"), F.col("_request").alias("request")).distinct(), ask)
        told = told.select(F.col("digest").alias("_digest"), F.from_json("answer", f"array<{SKILL}>").alias("results"), "error", "cause")
        return keyed.join(told, "_digest", "left").select(*pairs.columns, "results", "error", "cause")

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for wanted, sheets in sliced(batches, _weight, ANSWERS):
            yield pd.DataFrame([one(w, s) for w, s in zip(wanted, sheets, strict=True)], columns=["results", "error", "cause"])

    call = F.pandas_udf(run, f"results array<{SKILL}>, error string, cause string")
    return bounded(pairs).withColumn("_j", call(F.col(skills), F.col(text))).select(*pairs.columns, "_j.*")


def override_soft(results: Column, is_soft: Callable[[Column], Column], note: str = "soft skill") -> Column:
    """Soft skills count as met."""
    return F.transform(results, lambda r: F.when(is_soft(r["skill"]), F.struct(r["skill"].alias("skill"), F.lit(True).alias("match"), F.lit(note).alias("note"))).otherwise(r))


def recheck_status(checks: Column) -> Column:
    """not_confirmed if any is, else human_review if any is, else confirmed (also without any)."""
    has = lambda v: F.exists(checks, lambda c: c["recheck_match"] == v)
    return F.when(has("not_confirmed"), "not_confirmed").when(has("human_review"), "human_review").otherwise("confirmed")


STATUSES = ("confirmed", "human_review", "not_confirmed")
CHECK = "struct<skill:string,recheck_match:string,note:string>"


def recheck(pairs: DataFrame, call: Judge, *, results: str = "results", text: str = "skillsheet", store: Store | None = None) -> DataFrame:
    """``pairs`` with checks (structs of skill, recheck_match, note), recheck_status and recheck_error.
    ``call`` gets the skills that were met; a call that fails, or an answer that isn't valid, leaves all
    of them to a human. There is always a row. ``store``: as for ``judged``."""

    def one(skills: list[str], sheet: str | None) -> tuple[list[dict], str | None]:
        review = lambda why: ([{"skill": s, "recheck_match": "human_review", "note": why} for s in skills], why)
        if not skills:
            return [], None
        try:
            answer = call(skills, sheet if isinstance(sheet, str) else "")
        except Exception:  # noqa: BLE001  as above
            return review("llm_call_error")
        good = isinstance(answer, list) and [x.get("skill") if isinstance(x, dict) else None for x in answer] == skills and all(x.get("recheck_match") in STATUSES and isinstance(x.get("note"), str) for x in answer)
        return (answer, None) if good else review("invalid_output_schema")

    met = F.transform(F.filter(F.coalesce(F.col(results), F.array().cast(f"array<{SKILL}>")), lambda r: F.coalesce(r["match"], F.lit(False))), lambda r: r["skill"])
    if store is not None:
        request = F.to_json(F.struct(met.alias("skills"), F.col(text).alias("text")), {"ignoreNullFields": "false"})
        keyed = pairs.withColumn("_request", request).withColumn("_digest", F.sha2(F.concat(F.lit("recheck "), "_request"), 256))
        ask = lambda request: (*one(*map(json.loads(request).get, ("skills", "text"))), None)
        told = store.asked(keyed.select(F.col("_digest").alias("digest"), F.col("_request").alias("request")).distinct(), ask)
        told = told.select(F.col("digest").alias("_digest"), F.from_json("answer", f"array<{CHECK}>").alias("checks"), F.col("error").alias("recheck_error"))
        found = keyed.join(told, "_digest", "left").select(*pairs.columns, "checks", "recheck_error")
    else:

        def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            for skills, sheets in sliced(batches, _weight, ANSWERS):
                yield pd.DataFrame([one(list(k), s) for k, s in zip(skills, sheets, strict=True)], columns=["checks", "recheck_error"])

        asked = F.pandas_udf(run, f"checks array<{CHECK}>, recheck_error string")(met, F.col(text))
        found = bounded(pairs).withColumn("_c", asked).select(*pairs.columns, "_c.*")
    return found.withColumn("recheck_status", recheck_status(F.col("checks")))


def overridden(results: Column, checks: Column) -> Column:
    """Results whose skill a valid check did not confirm count as not met."""
    denied = F.transform(F.filter(checks, lambda c: c["recheck_match"] == "not_confirmed"), lambda c: c["skill"])
    return F.transform(results, lambda r: F.when(F.array_contains(denied, r["skill"]), F.struct(r["skill"].alias("skill"), F.lit(False).alias("match"), F.lit("not confirmed").alias("note"))).otherwise(r))


def assisted(df: DataFrame, asked: Column, call: Callable[[str], tuple[str, float]], labels: tuple[str, ...], *, text: str = "text", label: str = "label", confidence: str = "confidence", most: int = 1500) -> DataFrame:
    """``df`` with label and confidence of ``call`` where ``asked`` is true (such as ambiguous rows) and
    its answer is one of ``labels``; the confidence is cut to 0 to 1. It gets ``most`` characters."""

    def one(ask, value) -> tuple[str | None, float | None]:
        if not ask:
            return None, None
        try:
            name, sure = call((value if isinstance(value, str) else "")[:most])
            return (name, min(1.0, max(0.0, float(sure)))) if name in labels else (None, None)
        except Exception:  # noqa: BLE001  without an answer the rules' label stays
            return None, None

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for asks, texts in batches:
            yield pd.DataFrame([one(a, t) for a, t in zip(asks, texts, strict=True)], columns=["label", "confidence"])

    answer = F.pandas_udf(run, "label string, confidence double")(asked, F.col(text))
    filled = {label: F.coalesce(F.col("_l.label"), F.col(label)), confidence: F.when(F.col("_l.label").isNotNull(), F.col("_l.confidence")).otherwise(F.col(confidence))}
    return df.withColumn("_l", answer).withColumns(filled).drop("_l")


def items_by_call(df: DataFrame, indicator: str, call: Callable[[str], list[str]], *, text: str = "text", items: str = "required_skills", most: int = 3000) -> DataFrame:
    """``df`` with the items that ``call`` finds in the first ``most`` characters, where the rules found
    none and the text has the ``indicator`` (a pattern)."""

    def one(ask, value) -> list[str] | None:
        try:
            return [str(x) for x in call(value[:most])] if ask else None
        except Exception:  # noqa: BLE001  as above
            return None

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for asks, texts in batches:
            yield pd.Series([one(a, t) for a, t in zip(asks, texts, strict=True)])

    asked = F.coalesce(((F.size(items) == 0) | F.col(items).isNull()) & F.col(text).rlike(indicator), F.lit(False))
    return df.withColumn("_i", F.pandas_udf(run, "array<string>")(asked, F.col(text))).withColumn(items, F.coalesce("_i", items)).drop("_i")
