"""Text and records for people: displays, notes, drafts."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_nonempty, mail_address


def block(title: str, fields: Mapping[str, Column]) -> Column:
    """A title and a line for each field; null is a hyphen."""
    lines = [F.concat(F.lit(f"{k}: "), F.coalesce(v.cast("string"), F.lit("-"))) for k, v in fields.items()]
    return F.concat_ws("\n", F.lit(f"[{title}]"), *lines)


def notes(conditions: Sequence[tuple[str, Column]]) -> Column:
    """The notes whose condition holds, sorted and distinct."""
    found = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in conditions])
    return F.array_sort(F.array_distinct(F.array_compact(found)))


def recipients(*options: Column) -> Column:
    """Addresses of the first option that has any; comma separated, distinct, in order."""
    parts = F.filter(F.transform(F.split(first_nonempty(*options), ","), mail_address), lambda a: F.contains(a, F.lit("@")))
    return F.array_join(F.array_distinct(parts), ",")


def sequence_name(seq: Column, prefix: str = "_pair_", width: int = 4) -> Column:
    return F.concat(F.lit(prefix), F.lpad(seq.cast("string"), width, "0"))


def drafts(pairs: DataFrame, modes: Mapping[str, tuple[Column, Column, Column]]) -> DataFrame:
    """A row per pair and mode: mode, to, subject, body. ``modes``: (to, subject, body) of each."""
    rows = F.array(*[F.struct(F.lit(m).alias("mode"), to.alias("to"), subject.alias("draft_subject"), body.alias("body")) for m, (to, subject, body) in modes.items()])
    return pairs.withColumn("_d", F.explode(rows)).select(*pairs.columns, "_d.*")


def affiliation(vendor_flow: Column, employment: Column) -> Column:
    """Who employs a supply: from its tens (own or other) and ones (companies between)."""
    depth = F.pmod(vendor_flow, F.lit(10))
    who = F.when(vendor_flow.between(10, 19), "own").when(vendor_flow >= 20, "partner")
    between = F.when(depth == 0, "").otherwise(F.concat(F.lit("+"), depth.cast("string")))
    return F.concat(who, between, F.coalesce(F.concat(F.lit("/"), employment), F.lit("")))


#: Words of derived labels, which a user may replace.
LABELS = {"own": "弊社", "away": "社先", "employee": "社員", "freelance": "個人事業主", "foreign_ok": "外国籍可", "foreign_no": "外国籍不可", "japanese": "日本国籍想定", "parallel": "並行提案中"}


def _derived(*options: tuple[str, Column]) -> Column:
    """(label, source) of the first option that isn't null; null and "unavailable" without any."""
    return F.struct(F.coalesce(*[v for _, v in options]).alias("label"), F.coalesce(*[F.when(v.isNotNull(), F.lit(n)) for n, v in options], F.lit("unavailable")).alias("source"))


def affiliation_label(vendor_flow: Column, employment: Column, words: Mapping[str, str] = LABELS) -> Column:
    """(label, source): whose a supply is, by its flow's tens, how many companies away (at least one for others), and
    whether it works for itself; null without a flow."""
    kind = F.when(employment == "freelance", words["freelance"]).otherwise(words["employee"])
    away = F.concat((F.pmod(vendor_flow, F.lit(10)) + 1).cast("string"), F.lit(words["away"]))
    return _derived(("flow", F.concat(F.when(vendor_flow < 20, words["own"]).otherwise(away), kind)))


def foreign_label(ok: Column, raw: Column, words: Mapping[str, str] = LABELS) -> Column:
    """(label, source) of what a demand says of foreigners: its own words, else what was made of them."""
    return _derived(("raw", F.nullif(F.trim(raw), F.lit(""))), ("value", F.when(ok, words["foreign_ok"]).when(~ok, words["foreign_no"])))


def nationality_label(nationality: Column, raw: Column, words: Mapping[str, str] = LABELS) -> Column:
    return _derived(("raw", F.nullif(F.trim(raw), F.lit(""))), ("value", F.when(nationality == "japanese", words["japanese"]).otherwise(nationality)))


def parallel_label(*texts: Column, words: Mapping[str, str] = LABELS) -> Column:
    """(label, source) of what the first text that says so says of proposals elsewhere; else the usual words, as a default."""
    said = [F.nullif(F.trim(F.regexp_extract(F.coalesce(t, F.lit("")), "並\\s*行(?:状況|営業)?\\s*[】\\]]?\\s*:\\s*([^\\n]{1,30})", 1)), F.lit("")) for t in texts]
    return _derived(("text", F.coalesce(*said)), ("default", F.lit(words["parallel"])))


def pair_id(run: Column, demand: Column, supply: Column) -> Column:
    return F.concat_ws("_", run, demand, supply)


def proposal(run: Column, fields: Mapping[str, Column], results: Column, most: int = 8) -> Column:
    """A record of a pair: its id, fields, the skills that are met and those that are not, ``most`` of each at most."""
    met = lambda flag: F.slice(F.transform(F.filter(results, lambda r: F.coalesce(r["match"], F.lit(False)) == flag), lambda r: r["skill"]), 1, most)
    return F.struct(pair_id(run, fields["demand_id"], fields["supply_id"]).alias("proposal_id"), *[c.alias(k) for k, c in fields.items()], met(True).alias("met"), met(False).alias("open"))


def pair_text(demand: Mapping[str, Column], supply: Mapping[str, Column], results: Column, total: Column) -> Column:
    """A pair for people: both sides, each skill with its mark and note, and the score."""
    lines = F.transform(results, lambda r: F.concat(F.when(r["match"], "○ ").otherwise("× "), r["skill"], F.lit(" - "), r["note"]))
    skills = F.concat_ws("\n", F.lit("[skills]"), F.array_join(F.coalesce(lines, F.array().cast("array<string>")), "\n"))
    return F.concat_ws("\n\n", block("demand", demand), block("supply", supply), skills, F.concat(F.lit("score: "), F.format_number(F.coalesce(total, F.lit(0.0)), 2)))


def write_texts(df: DataFrame, path: str, by: str, name: Column, text: Column) -> None:
    """A text for each row in a folder for each value of ``by``, one file a task, each text behind its name."""
    rows = df.select(by, F.concat_ws("\n", F.concat(F.lit("# "), name), text, F.lit("")).alias("value"))
    rows.write.mode("overwrite").partitionBy(by).text(path)


def archive(texts: DataFrame, name: str, text: str, publish: Callable[[str, bytes], None], target: str, most: int = 100_000_000) -> int:
    """A deflated zip of the texts (of few rows, such as the top bands: up to ``most`` characters, else
    an error) handed to ``publish``; how many texts it has. It is a step of the driver, behind a job."""
    size = texts.agg(F.sum(F.length(text))).first()[0] or 0
    if size > most:
        raise ValueError(f"{size} characters are too many for one archive")
    rows, buffer = texts.select(name, text).sort(name).collect(), io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as file:
        for row in rows:
            file.writestr(f"{row[0]}.txt", row[1] or "")
    publish(target, buffer.getvalue())
    return len(rows)
