"""Cleaners of single fields, and who sent a mail; patterns expect NFKC text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_nonempty, mail_address
from .annotate import label_value
from .rows import split


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    hit = F.regexp_extract(text, pattern, group)
    return F.when(hit != "", hit)


def start_date(text: Column) -> Column:
    return F.coalesce(_found(text, "即日|即時|随時"), _found(text, "(?:[0-9]{4}年)?[0-9]{1,2}月(?:[0-9]{1,2}日|上旬|中旬|下旬|初旬|末)?"), _found(text, "[0-9]{1,2}/[0-9]{1,2}"))


def settlement(text: Column) -> Column:
    """Hours between which the price holds."""
    return _found(text, "[0-9]{3}\\s*(?:h|H|時間)?\\s*[~〜-]\\s*[0-9]{3}\\s*(?:h|H|時間)?")


def interviews(text: Column) -> Column:
    return F.regexp_extract(text, "(?:面談|打合せ)[^0-9]{0,6}([0-9])回", 1).try_cast("int")


def parallel(text: Column) -> Column:
    return F.when(text.rlike("並行(?:営業)?\\s*[::]?\\s*(?:なし|無し|0)"), "none").when(text.rlike("並行"), "some")


def station(text: Column) -> Column:
    raw = label_value(text, "最寄り?駅?|最寄")
    return F.when(raw.isNotNull(), F.regexp_replace(F.regexp_replace(raw, "^.*線\\s*", ""), "(?:駅.*|[((].*)$", ""))


def company(text: Column, header: Column) -> Column:
    """The last line with a company's name among the last ten lines, else the header's display name."""
    lines = F.reverse(F.slice(F.split(text, "\n", -1), -10, 10))
    lines = F.when(F.size(F.split(text, "\n", -1)) >= 10, lines).otherwise(F.reverse(F.split(text, "\n", -1)))
    named = F.filter(lines, lambda x: x.rlike("株式会社|有限会社|合同会社|Inc\\.|Co\\., ?Ltd"))
    shown = F.trim(F.regexp_replace(header, "<[^>]*>|\"", ""))
    return F.coalesce(F.when(F.size(named) > 0, F.trim(F.get(named, F.lit(0)))), F.when(~F.contains(shown, F.lit("@")) & (shown != ""), shown))


def reply_target(text: Column, reply_to: Column, sender: Column) -> Column:
    """(address, ambiguous): an address that the text asks to answer to, else the header's."""
    asked = F.transform(F.regexp_extract_all(text, F.lit("(?:返信|宛先|To)[^\\n]{0,20}?([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,})"), F.lit(1)), F.lower)
    asked = F.array_distinct(asked)
    return F.struct(F.coalesce(F.get(asked, F.lit(0)), mail_address(first_nonempty(reply_to, sender))).alias("address"), (F.size(asked) > 1).alias("ambiguous"))


ADDRESS = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"


def correspondents(text: Column, reply_to: Column, cc: Column) -> Column:
    """(to, cc, signal, ambiguous, source): addresses on lines that name To or Cc, or ask for an answer to one; where the text
    names none, the headers' (reply_to: text, cc: array). A line that names them without an address, or several addresses to
    answer to, make it ambiguous."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    naming = lambda pattern: F.filter(lines, lambda x: x.rlike(pattern))
    to_lines = naming("(?i)\\b(?:mail\\s*)?to\\s*(?::|を)|(?:返信|ご連絡|宛先)[^\\n]{0,20}(?:まで|へ|に|宛|:)")
    cc_lines = naming("(?i)\\bcc\\s*(?::|を|に)")
    of = lambda found: F.array_distinct(F.flatten(F.transform(found, lambda x: F.transform(F.regexp_extract_all(x, F.lit(ADDRESS), F.lit(0)), F.lower))))
    bare = lambda found: F.exists(found, lambda x: ~x.rlike(ADDRESS))
    header = F.transform(F.regexp_extract_all(F.coalesce(reply_to, F.lit("")), F.lit(ADDRESS), F.lit(0)), F.lower)
    said = (F.size(of(to_lines)) > 0) | (F.size(of(cc_lines)) > 0)
    return F.struct(
        F.when(F.size(of(to_lines)) > 0, of(to_lines)).otherwise(header).alias("to"), F.when(F.size(of(cc_lines)) > 0, of(cc_lines)).otherwise(F.coalesce(cc, F.array().cast("array<string>"))).alias("cc"),
        (F.size(F.concat(to_lines, cc_lines)) > 0).alias("signal"), (bare(to_lines) | bare(cc_lines) | (F.size(of(to_lines)) > 1)).alias("ambiguous"), F.when(said, "text").otherwise("header").alias("source"),
    )


def normalised(records: DataFrame, rest: Sequence[str] = ()) -> DataFrame:
    """Records of judged pairs in one layout: demand_id, supply_id, required_skills, optional_skills, the columns ``rest``, and
    errors (what is missing). They may come flat, or with project_info and resource_info as structs; of both, the
    struct's field counts."""

    def either(name: str, inner: str, struct: str) -> Column:
        own = [F.col(name)] if name in records.columns else []
        held = struct in records.columns and inner in records.schema[struct].dataType.fieldNames()
        return F.coalesce(*([F.col(f"{struct}.{inner}")] if held else []), *own, F.lit(None))

    kinds = {"demand_id": "string", "supply_id": "string", "required_skills": "array<string>", "optional_skills": "array<string>"}
    places = {"demand_id": ("message_id", "project_info"), "supply_id": ("message_id", "resource_info"), "required_skills": ("required_skills", "project_info"), "optional_skills": ("optional_skills", "project_info")}
    values = {k: either(k, *places[k]).cast(kind) for k, kind in kinds.items()}
    lacks = lambda k: (values[k].isNull() | (values[k] == "")) if kinds[k] == "string" else values[k].isNull()
    errors = F.array_compact(F.array(*[F.when(lacks(k), F.lit(f"no {k}")) for k in kinds]))
    filled = [F.coalesce(v, F.lit("") if kinds[k] == "string" else F.array().cast(kinds[k])).alias(k) for k, v in values.items()]
    return records.select(*filled, *rest, errors.alias("errors"))


def keyword_spans(sentences: Column, terms: Sequence[str]) -> Column:
    """Terms of a dictionary in an array of sentences, in the order of their places, each once. Longer terms take
    their place first, so a term inside of a longer one is met only where it stands alone; ASCII terms need a border."""
    known = sorted({t for t in terms if t}, key=lambda t: (-len(t), t))
    if not known:
        return F.array().cast("array<string>")
    form = {t.lower(): t for t in reversed(known)}
    plain = lambda t: "\\Q" + t + "\\E"
    one = lambda t: f"(?<![A-Za-z0-9.-]){plain(t)}(?![A-Za-z0-9-])" if t.isascii() else plain(t)
    joined = F.array_join(F.coalesce(sentences, F.array().cast("array<string>")), "\n")
    hits = F.regexp_extract_all(joined, F.lit("(?iu)" + "|".join(map(one, known))), F.lit(0))
    names = F.create_map(*[F.lit(x) for pair in form.items() for x in pair])
    return F.array_distinct(F.transform(hits, lambda h: F.coalesce(F.try_element_at(names, F.lower(h)), h)))


def keywords(sentences: Column, terms: Sequence[str], noise: str = "$^", generic: Sequence[str] = (), phases: Sequence[str] = (), extra: str | None = None) -> Column:
    """Terms of a dictionary, then phases, in the sentences that aren't noise (by spans: see ``keyword_spans``), what
    the pattern ``extra`` finds, and "N years" tokens; if all terms are generic, those tokens come first."""
    clean = F.filter(F.coalesce(sentences, F.array().cast("array<string>")), lambda s: ~s.rlike(noise))
    hits = keyword_spans(clean, terms)
    joined = F.array_join(clean, "\n")
    years = F.regexp_extract_all(joined, F.lit("[0-9]{1,2}年(?:以上)?"), F.lit(0))
    more = [keyword_spans(clean, phases)] if phases else []
    more += [F.regexp_extract_all(joined, F.lit(extra), F.lit(0))] if extra else []
    only_generic = F.forall(hits, lambda h: h.isin(*generic) if generic else F.lit(False))
    found = F.array_distinct(F.concat(hits, *more))
    return F.when(only_generic, F.array_union(years, found)).otherwise(F.array_union(found, years))


def valid(df: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, the others with the names of the checks that failed)."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()]))
    good, bad = split(df.withColumn("failed", failed), F.size("failed") == 0)
    return good.drop("failed"), bad


def consistent(merged: DataFrame, expected: DataFrame, errors: DataFrame, first: int = 10) -> dict:
    """Counts and the first errors of a merge; an empty merge, or a gap without errors, raises. One job counts all three;
    with ``rows.Tally`` on their writes, ``gate`` needs none."""
    marked = lambda df, name: df.select(F.lit(name).alias("of"))
    counts = {r["of"]: r["count"] for r in marked(merged, "merged").union(marked(expected, "expected")).union(marked(errors, "errors")).groupBy("of").count().collect()}
    return gate(*(counts.get(k, 0) for k in ("merged", "expected", "errors"))) | {"first": [r.asDict() for r in errors.limit(first).collect()]}


def gate(merged: int, expected: int, errors: int) -> dict:
    """The counts of a merge, if they fit together."""
    if expected and not merged:
        raise ValueError("nothing was merged")
    if merged != expected and not errors:
        raise ValueError(f"{expected - merged} rows are missing and there is no error")
    return {"merged": merged, "expected": expected, "errors": errors}


def display(value: Column, kind: str = "text", none: str = "-") -> Column:
    """A field for people: blanks and a label's rest stripped; prices in units of ten thousand, flags and lists in words."""
    if kind == "price":
        shown = F.concat(F.format_string("%d", F.floor(value / 10_000)), F.lit("万円"))
    elif kind == "flag":
        shown = F.when(value, "可").otherwise("不可")
        shown = F.when(value.isNotNull(), shown)
    elif kind == "list":
        shown = F.array_join(F.slice(value, 1, 10), "、")
    else:
        shown = F.trim(F.regexp_replace(value.cast("string"), "^[\\s:】\\]・-]+|[\\s、。]+$", ""))
    return F.coalesce(F.when(shown != "", shown), F.lit(none))


def note_block(text: Column, label: str, header: str = "^\\s*[【\\[■◆●]") -> Column:
    """The lines behind a label's line, up to a blank one or another header; null without any."""
    lines = F.split(text, "\n", -1)
    at = F.array_position(F.transform(lines, lambda x: x.rlike(label)), True)
    rest = F.when(at > 0, F.slice(lines, (at + 1).cast("int"), F.greatest(F.size(lines) - at, F.lit(0)).cast("int")))
    stop = F.array_position(F.transform(rest, lambda x: (F.trim(x) == "") | x.rlike(header)), True)
    body = F.trim(F.array_join(F.when(stop > 0, F.slice(rest, F.lit(1), (stop - 1).cast("int"))).otherwise(rest), "\n"))
    return F.when(body != "", body)
