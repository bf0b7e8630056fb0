"""From mails to ranked pairs: one lazy plan of the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import dedupe_key, join_cjk, mail_address, nfkc
from ..operators import annotate, classify, fields, judge, packs, pairs, places, rows, scores, sections
from ..storage import bounded


@dataclass(frozen=True)
class Config:
    skills: Mapping[str, Sequence[str]]
    phases: Mapping[str, Sequence[str]]
    regions: Mapping[str, Sequence[str]]
    excluded: Sequence[tuple[str, str | None]] = ()
    words: classify.Words = field(default_factory=classify.Words)
    own_domain: str = "own.example"
    margin: int = 120_000
    unwanted_skills: Sequence[str] = ()
    strong_phases: Sequence[str] = ("要件定義", "基本設計", "詳細設計")


def cleaned(mails: DataFrame, config: Config) -> DataFrame:
    """The newest mail of each sender and subject (of equally new ones that with the smallest id), without excluded ones, its body in NFKC."""
    keyed = bounded(mails).withColumns({"_from": mail_address(F.col("from")), "_subject": dedupe_key(nfkc(F.col("subject")))})
    kept = rows.keep_latest(keyed, ["_from", "_subject"], "date", "message_id")
    kept = rows.split(kept, ~rows.excluded(F.col("_from"), F.col("_subject"), config.excluded))[0]
    return kept.select("message_id", "subject", F.col("_from").alias("sender"), "reply_to", join_cjk(nfkc(F.coalesce("body_text", F.lit("")))).alias("body"))


def typed(mails: DataFrame, config: Config) -> DataFrame:
    return mails.withColumn("mail_type", classify.mail_type(F.col("subject"), F.col("body"), config.words)["label"])


def demands(mails: DataFrame, config: Config) -> DataFrame:
    """One row per demand with all attributes."""
    body = F.col("body")
    df = sections.sectioned(annotate.annotated(mails, config.skills, text="body"), text="body")
    needed = F.array_join("required_skills", "\n")
    return df.select(
        F.col("message_id").alias("demand_id"), F.col("sender").alias("demand_from"), F.col("subject").alias("demand_subject"), "required_skills", "optional_skills",
        packs.project_price(body, F.col("subject"))["value"].alias("p_price"), packs.age_limit(body)["value"].alias("p_age"), packs.remote(body)["value"].alias("p_remote"),
        packs.foreign_ok(body)["value"].alias("p_foreign"), packs.freelance_ok(body)["value"].alias("p_freelance"), packs.workload(body).alias("p_work"),
        packs.flow_level(body).alias("p_level"), F.col("terms").alias("p_skills"), annotate.primary(F.col("terms"), needed).alias("p_primary"),
        annotate.first_of_groups(body, config.phases).alias("p_phases"), places.work_region(body, config.regions).alias("p_region"),
        packs.contract(body)["value"].alias("p_contract"),
    )


def supplies(mails: DataFrame, config: Config) -> DataFrame:
    """One row per supply with all attributes."""
    body = F.col("body")
    df = annotate.annotated(mails, config.skills, text="body")
    return df.select(
        F.col("message_id").alias("supply_id"), F.col("sender").alias("supply_from"), F.col("subject").alias("supply_subject"), F.col("body").alias("skillsheet"),
        packs.resource_price(body, F.col("subject"))["value"].alias("r_price"), packs.own_age(body)["value"].alias("r_age"), packs.own_remote(body)["value"].alias("r_remote"),
        packs.nationality(body)["value"].alias("r_nationality"), packs.employment(body)["value"].alias("r_employment"), packs.own_workload(body).alias("r_work"),
        packs.vendor_flow(body, F.col("sender"), config.own_domain).alias("r_flow"), F.col("terms").alias("r_skills"),
        annotate.first_of_groups(body, config.phases).alias("r_phases"), F.nullif(places.home_region(body, config.regions), F.lit("unknown")).alias("r_region"),
        fields.station(body).alias("r_station"),
    )


def stages(config: Config) -> list:
    c = F.col
    return [
        ("budget", pairs.budget(c("p_price"), c("r_price"), config.margin)),
        ("age", pairs.age(c("p_age"), c("r_age"))),
        ("remote", pairs.compatible(c("p_remote"), c("r_remote"), pairs.REMOTE)),
        ("foreign", pairs.allowed(c("p_foreign"), c("r_nationality"), "japanese")),
        ("freelance", pairs.allowed(c("p_freelance"), c("r_employment"), "employee")),
        ("workload", pairs.overlap(c("p_work.min"), c("p_work.max"), c("r_work.min"), c("r_work.max"))),
        ("vendor", pairs.tier(c("p_level"), c("r_flow"), pairs.TIERS)),
        ("skills", pairs.skills(c("p_skills"), c("r_skills"), c("p_primary"), config.unwanted_skills)),
        ("phases", pairs.phases(c("p_phases"), c("r_phases"), config.strong_phases)),
        ("location", pairs.location(c("p_region"), c("r_region"), c("p_remote"))),
        ("contract", pairs.contract(c("p_contract"))),
    ]


def matched(demand: DataFrame, supply: DataFrame, config: Config, audit: bool = False) -> DataFrame:
    """Pairs that pass all stages, found through shared skills; with ``audit`` all pairs and the first
    stage that failed. Texts stay out of the product and are joined to what is left."""
    slim = supply.drop("skillsheet")
    if audit:
        return pairs.cascade(pairs.product(demand, slim), stages(config), True)
    wanted = pairs.effective(F.col("p_skills"), F.col("p_primary"), config.unwanted_skills)
    met = pairs.sharing(demand, slim, ("demand_id", wanted), ("supply_id", pairs.effective(F.col("r_skills"), None, config.unwanted_skills)))
    both = met.select(F.col("left").alias("demand_id"), F.col("right").alias("supply_id")).join(demand, "demand_id").join(slim, "supply_id")
    return pairs.cascade(both, stages(config))


def ranked(found: DataFrame, supply: DataFrame, call: judge.Judge = judge.keyword_judge) -> DataFrame:
    """Judged pairs with the rates of their required and optional skills, their sum, the band of the
    first and the number in the band, by the sum and then the first; rows that can't be judged have an error and the rate 0."""
    asked = found.join(supply.select("supply_id", "skillsheet"), "supply_id")
    results = judge.judged(asked, call)
    optional = judge.judged(results.select(*results.columns).withColumnsRenamed({"results": "_r", "error": "_e", "cause": "_c"}), call, skills="optional_skills")
    results = optional.withColumn("optional_rate", scores.match_rate(F.col("results"))).drop("results", "error", "cause").withColumnsRenamed({"_r": "results", "_e": "error", "_c": "cause"})
    results = results.drop("skillsheet").withColumn("rate", scores.match_rate(F.col("results")))
    banded = results.withColumns({"total": scores.total(F.col("rate"), F.col("optional_rate")), "band": scores.band(F.col("rate"))})
    return rows.numbered(banded, ["band"], [F.desc("total"), F.desc("rate"), F.col("demand_id"), F.col("supply_id")])


def match(mails: DataFrame, config: Config) -> DataFrame:
    """The attribute tables are persisted: without that, Catalyst would copy the extractors' expressions
    into every predicate that uses them."""
    parts = rows.route(typed(cleaned(mails, config), config), "mail_type", ["project", "resource", "ambiguous"], "unknown")
    demand, supply = demands(parts["project"], config).persist(), supplies(parts["resource"], config).persist()
    return ranked(matched(demand, supply, config), supply)
