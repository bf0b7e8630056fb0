"""One round of matching, from mails to drafts, with what earlier rounds knew.

matched pairs -> keywords in sheet or mail (without noise) -> results restored from the cache, or judged -> rates, bands ->
recheck of the top bands -> numbers in bands -> notes, proposals, drafts; then history and cache advance together."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import fields, history, judge, pairs, rows, scores
from ..storage import written
from . import matching, outreach

KEYS = ["demand_id", "supply_id"]
LOOSE = ["demand_subject", "supply_subject"]
CACHED = [*KEYS, *LOOSE, "results", "optional_results"]


@dataclass(frozen=True)
class Round:
    """How pairs are judged. ``noise``: (term, reason, condition on the columns demand_body and skillsheet): a keyword that
    counts only where the condition holds; ``unconditional`` ones never count."""

    keywords: Sequence[str] = ()
    noise: Sequence[tuple[str, str, Column]] = ()
    unconditional: Sequence[str] = ()
    call: judge.Judge = judge.keyword_judge
    recheck: judge.Judge | None = None
    top: Sequence[str] = ("match_100", "match_80_99")
    sender: str = "us"
    store: judge.Store | None = field(default=None)


def evidenced(found: DataFrame, demand: DataFrame, supply: DataFrame, config: matching.Config, how: Round) -> DataFrame:
    """Pairs with evidence: the pairs whose required keywords (and strong phases) stand in the supply's text, less noise.
    Texts are scanned once each, not once a pair."""
    if not how.keywords:
        return found.withColumn("hits", F.array().cast("array<string>"))
    terms = [*how.keywords, *config.strong_phases]
    hits = pairs.keyword_hits(supply.select("supply_id", "skillsheet"), "supply_id", "skillsheet", terms)
    wanted = demand.select("demand_id", "demand_body", fields.keyword_spans(F.col("required_skills"), how.keywords).alias("_required"))
    joined = found.join(wanted, "demand_id").join(hits, "supply_id").join(supply.select("supply_id", "skillsheet"), "supply_id")
    strong = F.filter(F.coalesce("p_phases", F.array().cast("array<string>")), lambda p: p.isin(*config.strong_phases)) if config.strong_phases else F.array().cast("array<string>")
    none = F.array().cast("array<string>")
    met = joined.withColumn("_c", pairs.containment(F.col("_required"), strong, F.col("hits"), none)).filter("_c.matched OR size(_required) = 0")
    kept = met.withColumn("_n", pairs.without_noise(F.col("_c.hits"), how.noise, how.unconditional)).filter("size(_n.kept) > 0 OR size(_required) = 0")
    return kept.select(*found.columns, F.col("_n.kept").alias("hits"))


def results_of(wanted: DataFrame, cache: DataFrame | None, how: Round) -> tuple[DataFrame, DataFrame]:
    """(pairs with results, errors): from the cache by pair, else by subjects, each cached row once; the others are judged."""
    keyed = wanted.withColumn("_pair", F.concat_ws("\u0001", *KEYS))
    new = keyed
    restored = None
    if cache is not None:
        known = cache.withColumn("_cached", F.concat_ws("\u0001", *KEYS))
        found = written(history.restore(keyed.select("_pair", *KEYS, *LOOSE), known.select("_cached", *KEYS, *LOOSE), KEYS, LOOSE, "_pair", "_cached").select("_pair", "_cached", "tier").filter("tier IS NOT NULL"), "restored")
        restored = keyed.join(found, "_pair").join(known.select("_cached", "results", "optional_results"), "_cached").drop("_cached")
        new = keyed.join(found.select("_pair"), "_pair", "left_anti")
    asked = judge.judged(new, how.call, store=how.store)
    asked = written(asked, "judged")
    optional = judge.judged(asked.select("_pair", "optional_skills", "skillsheet"), how.call, skills="optional_skills", store=how.store).select("_pair", F.col("results").alias("optional_results"))
    told = asked.join(optional, "_pair").withColumn("tier", F.lit("judged"))
    good, bad = rows.split(told, F.col("error").isNull())
    good = good.drop("error", "cause")
    merged = good if restored is None else good.unionByName(restored.select(good.columns))
    return merged.drop("_pair"), bad.select(*KEYS, "error", "cause")


def rated(found: DataFrame) -> DataFrame:
    banded = found.withColumns({"rate": scores.match_rate(F.col("results")), "optional_rate": scores.match_rate(F.col("optional_results"))})
    return banded.withColumns({"total": scores.total(F.col("rate"), F.col("optional_rate")), "band": scores.band(F.col("rate"))})


def rechecked(found: DataFrame, how: Round) -> DataFrame:
    """The top bands' results rechecked, with recheck_status; skills that are not confirmed count as not met, and the rates follow."""
    if how.recheck is None:
        return found.withColumn("recheck_status", F.lit(None).cast("string"))
    top, rest = rows.split(found, F.col("band").isin(*how.top))
    checked = judge.recheck(top, how.recheck, store=how.store)
    checked = checked.withColumn("results", judge.overridden(F.col("results"), F.col("checks")))
    again = rated(checked.drop("rate", "optional_rate", "total", "band")).select(*found.columns, "recheck_status")
    return again.unionByName(rest.withColumn("recheck_status", F.lit(None).cast("string")))


def run(mails: DataFrame, config: matching.Config, how: Round, state: history.RunState, name: str) -> dict[str, DataFrame]:
    """prepared (ranked pairs with notes and proposals), drafts and errors of a round; history and cache are committed."""
    parts = rows.route(matching.typed(matching.cleaned(mails, config), config), "mail_type", ["project", "resource", "ambiguous"], "unknown")
    bodies = parts["project"].select(F.col("message_id").alias("demand_id"), F.col("body").alias("demand_body"))
    demand = written(matching.demands(parts["project"], config).join(bodies, "demand_id"), "demand")
    supply = written(matching.supplies(parts["resource"], config), "supply")
    found = written(matching.matched(demand.drop("demand_body"), supply, config), "matched")
    wanted = evidenced(found, demand, supply, config, how).join(supply.select("supply_id", "skillsheet"), "supply_id").join(demand.select("demand_id", "demand_body"), "demand_id")
    wanted = written(wanted, "wanted")
    merged, errors = results_of(wanted, state.read("cache"), how)
    merged, errors = written(merged, "merged"), written(errors, "errors")
    fields.consistent(merged, wanted, errors)
    ranked = rows.numbered(rechecked(rated(merged), how), ["band"], [F.desc("total"), F.desc("rate"), F.col("demand_id"), F.col("supply_id")])
    out = written(outreach.prepared(ranked, name), "prepared")
    state.commit(wanted.select(*KEYS), merged.select(*CACHED), errors)
    return {"prepared": out, "drafts": outreach.drafted(out, how.sender), "errors": errors}
