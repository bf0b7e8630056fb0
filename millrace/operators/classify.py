"""Which side a mail is on: labels that settle it, weighted words damped by context, and the subject.

How much a word counts is data: a ``Damping`` names words, the context in which it holds, a factor and a
cap, and the first that holds for a word counts. Who wins is a table of conditions, read from the top."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import count_of, join_cjk, mask_noise
from .rules import let
from .scores import classify, distinct_labels, tiers

#: What a subject, an attached sheet and a word on working on site add to a side's context.
SUBJECT, ATTACHED, ON_SITE = 2.0, 1.5, 1.0
#: Contexts that are strong, and shares of the other side's score that make a side a near winner.
STRONG_SUPPLY, STRONG_DEMAND, CLOSE, NEAR = 3.5, 3.0, 0.6, 0.8
JOB = "案件"


@dataclass(frozen=True)
class Damping:
    """``words`` count ``factor`` times, ``cap`` at most, where the context of ``side`` is above ``above`` or, without
    a side, where the text matches ``pattern``; without either, anywhere."""

    words: tuple[str, ...]
    factor: float = 1.0
    cap: int | None = None
    side: str | None = None
    above: float = 0.0
    pattern: str | None = None


TERMS, STEPS = ("商流", "面談", "精算", "契約"), ("要件定義", "基本設計", "詳細設計", "テスト")
#: Factors, caps and thresholds. A supply's mail names the job it looks for, the terms it wants and the steps it has done.
DAMPINGS = (
    Damping((JOB,), 0.01, 1, side="supply"), Damping((JOB,), 0.1, 3, pattern="(?:合う|見合う|希望する|次の)\\s*案件|案件[^\\n]{0,6}(?:探|ございま)"),
    Damping((JOB,), 1.2, side="demand"), Damping((JOB,), 1.0, 5), Damping(TERMS, 0.2, side="supply", above=2.99), Damping(STEPS, 0.3, side="supply", above=3.49),
)


@dataclass(frozen=True)
class Words:
    """``supply`` and ``demand``: words and weights. Contexts: (score, pattern) in order, the first counts."""

    supply: Mapping[str, float] = field(default_factory=lambda: {"氏名": 1.0, "要員": 1.0, "経歴": 1.0, "所属": 0.5, "稼働": 0.5, "最寄": 0.5})
    demand: Mapping[str, float] = field(default_factory=lambda: {JOB: 1.0, "必須": 1.0, "募集": 0.5, "歓迎": 0.5, **dict.fromkeys(TERMS, 0.5), **dict.fromkeys(STEPS, 0.3)})
    supply_context: Sequence[tuple[float, str]] = (
        (5.0, "(?:要員|人材|エンジニア|技術者)[^\\n]{0,6}(?:ご紹介|ご提案|ご案内|提案)"), (3.5, "(?:案件|お仕事|参画先)を(?:お)?探|(?:合う|見合う)案件"), (3.0, "(?:スキルシート|経歴書)[^\\n]{0,8}(?:添付|送付)"),
    )
    demand_context: Sequence[tuple[float, str]] = ((3.0, "案件[^\\n]{0,6}(?:ご紹介|ご案内)|(?:要員|人材|エンジニア|技術者)を?[^\\n]{0,6}(?:募集|探して)"),)
    supply_subject: str = "要員|人材|技術者|個人"
    demand_subject: str = "案件|募集"
    supply_labels: Sequence[str] = tuple(f"(?:{x})\\s*[:】]" for x in ("氏名|名前", "年齢", "所属", "最寄り?駅?", "稼働(?:開始)?", "国籍", "性別"))
    demand_labels: Sequence[str] = tuple(f"(?:{x})\\s*[:】]" for x in ("案件名?", "(?:作業|業務)内容", "必須(?:スキル)?", "勤務地|場所", "面談(?:回数)?", "募集(?:人数)?"))
    dampings: Sequence[Damping] = DAMPINGS


def contexts(subject: Column, body: Column, words: Words, attached: Column) -> tuple[Column, Column]:
    """How strongly the texts speak of a supply, and of a demand."""
    adds = lambda condition, value: F.when(condition, value).otherwise(0.0)
    wanted, offered = body.rlike("常駐\\s*(?:必須|案件)"), body.rlike("常駐\\s*(?:検討)?可")
    supply = tiers(body, words.supply_context) + adds(subject.rlike(words.supply_subject), SUBJECT) + adds(attached, ATTACHED) + adds(offered & ~wanted, ON_SITE)
    return supply, tiers(body, words.demand_context) + adds(subject.rlike(words.demand_subject), SUBJECT) + adds(wanted, ON_SITE)


def word_scores(text: Column, weights: Mapping[str, float], dampings: Sequence[Damping], context: Mapping[str, Column]) -> Column:
    """The sum of counts times weights, each word damped by the first rule that holds for it."""

    def points(word: str, weight: float) -> Column:
        n = count_of(text, word).cast("double")
        cases = []
        for d in (d for d in dampings if word in d.words):
            holds = context[d.side] > d.above if d.side else text.rlike(d.pattern) if d.pattern else F.lit(True)
            cases.append(F.when(holds, (n if d.cap is None else F.least(n, F.lit(float(d.cap)))) * d.factor))
        return F.coalesce(*cases, n) * float(weight)

    return reduce(lambda a, b: a + b, [points(k, v) for k, v in weights.items()], F.lit(0.0))


def mail_type(subject: Column, body: Column, words: Words = Words(), attached: Column | None = None) -> Column:
    """(label, confidence): "resource", "project", "ambiguous" or "unknown". Texts are expected in NFKC;
    nulls count as empty."""
    texts = F.struct(F.coalesce(subject, F.lit("")).alias("subject"), join_cjk(F.coalesce(body, F.lit(""))).alias("body"))
    on = F.lit(False) if attached is None else F.coalesce(attached, F.lit(False))

    def measured(t: Column) -> Column:
        supply, demand = contexts(t["subject"], t["body"], words, on)
        return F.struct(
            supply.alias("supply"), demand.alias("demand"), mask_noise(F.concat(t["subject"], F.lit("\n"), t["body"])).alias("text"),
            t["subject"].rlike(words.supply_subject).alias("of_supply"), t["subject"].rlike(words.demand_subject).alias("of_demand"),
            F.regexp_count(t["body"], F.lit("氏名\\s*[:】]")).alias("names"), distinct_labels(t["body"], words.supply_labels).alias("supply_labels"), distinct_labels(t["body"], words.demand_labels).alias("demand_labels"),
        )

    def scored(m: Column) -> Column:
        context = {"supply": m["supply"], "demand": m["demand"]}
        own = word_scores(m["text"], words.supply, (), context) + m["supply"]
        other = word_scores(m["text"], words.demand, words.dampings, context) + m["demand"]
        return F.struct(m.alias("m"), own.alias("own"), other.alias("other"))

    def decided(s: Column) -> Column:
        m, own, other = s["m"], s["own"], s["other"]
        # the side that leads, or has a good share of the other's score, needs less if its context or the subject speaks for it
        strong = {
            "resource": ((m["supply"] >= STRONG_SUPPLY) | m["of_supply"]) & (own >= other * CLOSE), "project": ((m["demand"] >= STRONG_DEMAND) | m["of_demand"]) & (other >= own * CLOSE),
        }
        by_score = classify({"resource": own, "project": other}, strong=strong)
        nothing = own + other <= 0
        table = (
            (m["names"] >= 3, "resource", 0.9), (m["supply_labels"] >= 4, "resource", 0.85), ((m["demand_labels"] >= 3) & (m["supply"] < STRONG_SUPPLY), "project", 0.9),
            (nothing & m["of_supply"], "resource", 0.5), (nothing & m["of_demand"], "project", 0.5), (nothing, "unknown", 0.0),
            ((m["supply"] >= STRONG_SUPPLY) & m["of_supply"] & (own >= other * NEAR), "resource", None),
        )
        sure = by_score["confidence"]
        rows = [F.when(c, F.struct(F.lit(label).alias("label"), (sure if value is None else F.lit(value)).alias("confidence"))) for c, label, value in table]
        return F.coalesce(*rows, by_score)

    return let(let(let(texts, measured), scored), decided)
