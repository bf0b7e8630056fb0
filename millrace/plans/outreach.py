"""What people get of a pair: notes on what to look at, a proposal, and a draft for each side.

Notes and drafts are tables: a note is a code and a condition, a draft a list of headings with their fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import price_plan
from ..functions.text import quote
from ..operators import fields, render

#: Fields of a side that its mail may speak of without their being found: (field, what speaks of it).
SPOKEN = {
    "demand": {"start": "開始|時期|参画", "interviews": "面談|打ち?合わ?せ", "settlement": "精\\s*算", "foreign": "外国籍|国\\s*籍"},
    "supply": {"station": "最寄", "available": "稼働|参画可能", "parallel": "並\\s*行"},
}
ASKED, COPIED = "(?:返信|宛先|ご?連絡先|To)[^\\n]{0,20}(?:まで|へ|:|に)", "(?m)^[^\\n]*\\b(?:Cc|CC)\\b"


def conditions(sides: Mapping[str, Mapping[str, Column]], affiliation: Column, agreement: Column) -> list[tuple[str, Column]]:
    """(code, condition) of everything that a person should look at. A side has id, subject, body, asked (the addresses that
    its text asks to answer to), copied, and the fields of ``SPOKEN``; ``agreement``: false where the fields of work differ."""
    out = [("no_affiliation", affiliation.isNull()), ("fields_of_work_differ", ~agreement)]
    blank = lambda c: c.isNull() | (F.trim(c) == "")
    for name, side in sides.items():
        out += [(f"{name}_without_{k}", blank(side[k])) for k in ("id", "subject", "body")]
        out += [
            (f"{name}_asks_for_an_address_that_is_not_found", side["body"].rlike(ASKED) & (F.size(side["asked"]) == 0)), (f"{name}_asks_for_several_addresses", F.size(side["asked"]) > 1),
            (f"{name}_asks_for_a_copy_that_is_not_found", side["body"].rlike(COPIED) & (F.size(side["copied"]) == 0)),
        ]
        out += [(f"{name}_{k}_is_not_found", side[k].isNull() & side["body"].rlike(pattern)) for k, pattern in SPOKEN[name].items()]
    return out


def asked_addresses(text: Column) -> Column:
    """Addresses behind a word that asks to answer there, each once."""
    found = F.regexp_extract_all(text, F.lit(f"{ASKED}[^\\n]{{0,20}}?([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}})"), F.lit(1))
    return F.array_distinct(F.transform(found, F.lower))


def copied_addresses(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit("(?m)^[^\\n]*\\b(?:Cc|CC)\\b[^\\n]*?([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,})"), F.lit(1))
    return F.array_distinct(F.transform(found, F.lower))


def skill_lines(results: Column, head: str) -> Column:
    """A heading, and a line with a mark for each skill; a hyphen for none."""
    mark = lambda r: F.when(r["match"].isNull(), "[?] ").when(r["match"], "[o] ").otherwise("[x] ")
    lines = F.transform(F.coalesce(results, F.array().cast("array<struct<skill:string,match:boolean,note:string>>")), lambda r: F.concat(F.lit("- "), mark(r), r["skill"]))
    return F.concat(F.lit(f"[{head}]\n"), F.when(F.size(lines) > 0, F.array_join(lines, "\n")).otherwise("-"))


def body(opening: Sequence[str], sections: Sequence[Column], quoted: Column, closing: str = "Best regards") -> Column:
    """A draft's text: opening lines, sections with a blank line between, a closing, and the mail it answers."""
    return F.concat_ws("\n\n", F.lit("\n".join(opening)), *sections, F.lit(closing), F.concat(F.lit("----- quoted -----\n"), quote(quoted)))


def prepared(pairs: DataFrame, run: str) -> DataFrame:
    """``pairs`` (of ranked pairs with the columns of both sides, demand_body and skillsheet) with affiliation, notes,
    needs_review, plan (of the price) and proposal."""
    c = F.col
    affiliation = render.affiliation(c("r_flow"), c("r_employment"))
    sides = {
        "demand": {"id": c("demand_id"), "subject": c("demand_subject"), "body": c("demand_body"), "start": fields.start_date(c("demand_body")), "interviews": fields.interviews(c("demand_body")), "settlement": fields.settlement(c("demand_body")), "foreign": c("p_foreign")},
        "supply": {"id": c("supply_id"), "subject": c("supply_subject"), "body": c("skillsheet"), "station": c("r_station"), "available": fields.start_date(c("skillsheet")), "parallel": fields.parallel(c("skillsheet"))},
    }
    sides = {k: {**v, "asked": asked_addresses(v["body"]), "copied": copied_addresses(v["body"])} for k, v in sides.items()}
    agreement = F.coalesce(F.arrays_overlap("p_skills", "r_skills"), F.lit(False))
    named = pairs.withColumn("affiliation", affiliation).withColumn("notes", render.notes(conditions(sides, affiliation, agreement)))
    named = named.withColumns({"needs_review": F.size("notes") > 0, "plan": price_plan(c("p_price"), c("r_price"))})
    shown = {"demand_id": c("demand_id"), "supply_id": c("supply_id"), "band": c("band"), "seq": c("seq"), "affiliation": c("affiliation")}
    return named.withColumn("proposal", render.proposal(F.lit(run), shown, c("results")))


def drafted(prepared: DataFrame, sender: str) -> DataFrame:
    """Two rows a pair: a draft to the demand's side that offers the supply, and one to the supply's side that offers the job."""
    c = F.col
    shown = fields.display
    skills = [skill_lines(c("results"), "required skills"), skill_lines(c("optional_results"), "optional skills")]
    offer = render.block("supply", {
        "affiliation": shown(c("affiliation")), "age": F.nullif("r_age", F.lit(1)), "station": shown(c("r_station")), "available": shown(fields.start_date(c("skillsheet"))),
        "price": shown(c("plan.for_demand"), "price"), "parallel": shown(fields.parallel(c("skillsheet"))), "skills": shown(c("r_skills"), "list"),
    })
    job = render.block("job", {
        "subject": shown(c("demand_subject")), "start": shown(fields.start_date(c("demand_body"))), "region": shown(c("p_region")), "remote": shown(c("p_remote")), "price": shown(c("plan.for_supply"), "price"),
        "interviews": c("interviews") if "interviews" in prepared.columns else fields.interviews(c("demand_body")), "settlement": shown(fields.settlement(c("demand_body"))), "foreign": shown(c("p_foreign"), "flag"),
        "required": shown(c("required_skills"), "list"), "optional": shown(c("optional_skills"), "list"),
    })
    to = lambda text, address: render.recipients(F.array_join(asked_addresses(c(text)), ","), c(address))
    modes = {
        "to_demand": (to("demand_body", "demand_from"), F.concat(F.lit("Re: "), c("demand_subject")), body([f"This is {sender}.", "We would like to propose the following for your job."], [*skills, offer], c("demand_body"))),
        "to_supply": (to("skillsheet", "supply_from"), F.concat(F.lit("Re: "), c("supply_subject")), body([f"This is {sender}.", "Would the following job be of interest? Please correct our view of the skills."], [*skills, job], c("skillsheet"))),
    }
    return render.drafts(prepared, modes)
