"""What staffing mails in Japanese say of a demand or a supply; texts are expected in NFKC. Each
extractor takes a text column and gives (value, source, raw), the source "extracted" or "default".

Two small grammars stand behind them: quantities (``amounts``), and stances: a topic, then within some
characters of its line a word that is for it, against it, or makes it the only one. What is said of what is a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.numbers import digit
from ..functions.text import synonyms
from . import amounts
from .prices import project_price, resource_price
from .rules import Rule, first_match, let, windows_of

__all__ = ["age_limit", "contract", "employment", "flow_level", "foreign_ok", "freelance_ok", "nationality", "own_age", "own_remote", "own_workload", "project_price", "remote", "resource_price", "vendor_flow", "workload"]

# stances --------------------------------------------------------------------------------------------

AGAINST = "不\\s*可|NG|×|なし|無し|断り|遠慮|できません|ません|対象外|不採用|禁止"
FOR = "(?<!不)(?<!不\\s)可|OK|○|歓迎|不問|相談|問いません|問わず|検討|問題な"
ONLY = "のみ|限定|必須|に限|だけ"


@dataclass(frozen=True)
class Stance:
    """Within ``gap`` characters behind ``topic``, on its line, stands one of ``words``: then ``value``."""

    topic: str
    words: str
    value: str | bool
    gap: int = 10

    def rule(self) -> Rule:
        return Rule(f"(?:{self.topic})[^\\n。]{{0,{self.gap}}}?(?:{self.words})", self.value)


def stance(text: Column, table: Sequence[Stance], default: str | bool, kind: str = "string") -> Column:
    """The first of the table that the text takes."""
    return first_match(text, [s.rule() for s in table], default, kind)


FOREIGNER, JAPANESE = "外\\s*国\\s*(?:籍|人)", "日\\s*本\\s*(?:国\\s*籍|籍|人)"
FOREIGN = (
    Stance(FOREIGNER, AGAINST, False, 20), Stance(JAPANESE, ONLY + "|募集|希望", False, 12), Stance("国\\s*籍\\s*(?:要?件)?\\s*[】\\]]?\\s*:", "日本", False, 2),
    Stance("永住(?:権|資格)|在留資格|ビザ|就労資格", "必須|必要|" + AGAINST, False, 10), Stance(f"{FOREIGNER}|国\\s*籍", FOR, True, 10),
)
SELF_EMPLOYED, STAFF = "個人\\s*事業\\s*主|フリーランス|フリー(?!\\w)|個人(?!情報)", "正?社員|プロパー"
FREELANCE = (Stance(SELF_EMPLOYED, AGAINST, False, 8), Stance(STAFF, ONLY + "|まで", False, 4), Stance(SELF_EMPLOYED, FOR + "|まで", True, 8), Stance("雇用\\s*形態", "不問", True, 6))


def foreign_ok(text: Column) -> Column:
    return stance(text, FOREIGN, True, "boolean")


def freelance_ok(text: Column) -> Column:
    return stance(text, FREELANCE, True, "boolean")


#: Countries that engineers' profiles name, by their usual short names.
COUNTRIES = "中国|韓国|台湾|香港|ベトナム|インド|ネパール|バングラデシュ|スリランカ|ミャンマー|インドネシア|マレーシア|フィリピン|タイ|モンゴル|ウズベキスタン|ロシア|アメリカ|カナダ|ブラジル|イギリス|フランス"
FIELD_OF = "国\\s*籍\\s*[】\\])]?\\s*[::]?\\s*"
NATIONALITY = (
    Rule(FOREIGNER, "foreign"), Rule(f"国\\s*籍\\s*(?:[】\\])]\\s*:?|:)\\s*(?:日本|JPN?\\b)", "japanese"), Rule(f"{FIELD_OF}(?:{COUNTRIES})", "foreign"),
    Rule(f"(?:{COUNTRIES})\\s*(?:籍|国籍|人(?!気|材)|出身|生まれ)", "foreign"), Rule(JAPANESE, "japanese"),
    Rule(f"(?m)^[^\\n]*(?:氏\\s*名|名\\s*前)[^\\n]*\\(\\s*(?:{COUNTRIES})", "foreign"), Rule("日本語[^\\n]{0,12}(?:JLPT\\s*)?N[1-5](?![0-9])", "foreign"),
)
EMPLOYMENT = (
    Rule(f"(?:所\\s*属|雇用\\s*形態|契約\\s*形態)[^\\n]{{0,8}}(?:{SELF_EMPLOYED})", "freelance"), Rule(f"(?:所\\s*属|雇用\\s*形態)[^\\n]{{0,8}}(?:{STAFF})|(?:弊|自|当)社\\s*(?:の\\s*)?(?:{STAFF})|BP\\s*(?:の\\s*)?(?:{STAFF})", "employee"),
    Rule(f"(?:{SELF_EMPLOYED})\\s*(?:様|の方|です|として)|個人\\s*事業\\s*主|フリーランス", "freelance"),
)


def nationality(text: Column) -> Column:
    """A field counts with a known country only, so that "nationality: any" says nothing."""
    return first_match(text, NATIONALITY, "japanese")


def employment(text: Column) -> Column:
    return first_match(text, EMPLOYMENT, "employee")


# ways of work ---------------------------------------------------------------------------------------

HOME, OFFICE = "リモ(?:ート)?(?:ワーク|勤務)?|在宅(?:勤務|ワーク)?|テレワーク", "出社|常駐|オンサイト|出勤"
#: Degrees before a topic, and what may stand behind it.
WHOLLY, MOSTLY, PARTLY = "フル|完全|全日程?|毎日|常時|100\\s*%", "基本的?に?|原則|ほぼ", "一部|部分的?に?|時々|適宜|現在|月\\s*[1-9一二三四]\\s*[日回]"
ALONE, MIXED = "のみ|100\\s*%|だけ|必須|前提", "(?<!不)(?:可|あり|有り?|併用|相談|対応|中心|メイン|主体|希望|歓迎|見込)"
PHRASE = (
    f"(?:({WHOLLY})|({MOSTLY})|({PARTLY})|({amounts.WEEK}))?\\s*(?:の|は|で|に|:)?\\s*(?:({HOME})|({OFFICE}))\\s*(?:は|も|が|での?|頻度)?\\s*:?\\s*(?:({AGAINST})|({ALONE})|({MIXED})|週\\s*([1-7一二三四五六七]))?"
)
#: Where the groups of the phrase are; those of the week are three more behind its days.
WHOLLY_AT, MOSTLY_AT, PARTLY_AT, DAYS_AT, HOME_AT, OFFICE_AT, AGAINST_AT, ALONE_AT, MIXED_AT, BEHIND_AT = 1, 2, 3, 5, 9, 10, 11, 12, 13, 14
#: What a phrase says, in the order in which it is believed; a phrase that says none of these is passed over.
WAYS = ("onsite", "fullremote", "hybrid")


def _phrases(text: Column) -> Column:
    """(way, i, raw, days) of the phrases about where work is done; way is the place in WAYS."""

    def read(raw: Column, i: Column) -> Column:
        has = lambda g: F.regexp_extract(raw, f"^{PHRASE}", g) != ""
        days = F.coalesce(digit(F.regexp_extract(raw, f"^{PHRASE}", DAYS_AT)), digit(F.regexp_extract(raw, f"^{PHRASE}", BEHIND_AT)))
        way = (
            F.when(has(HOME_AT) & has(AGAINST_AT), 0).when(has(OFFICE_AT) & (has(WHOLLY_AT) | has(ALONE_AT) | (has(MOSTLY_AT) & ~has(MIXED_AT))), 0)
            .when(has(HOME_AT) & (has(WHOLLY_AT) | has(ALONE_AT) | (days >= 5)), 1)
            .when(days.isNotNull() & ~(has(OFFICE_AT) & (days >= 5)), 2).when(has(PARTLY_AT) | (has(HOME_AT) & (has(MOSTLY_AT) | has(MIXED_AT))), 2)
        )
        return F.struct(way.alias("way"), i.alias("i"), raw.alias("raw"), F.when(has(HOME_AT), days).alias("days"))

    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(PHRASE), F.lit(0)), read), lambda p: p["way"].isNotNull())


#: Home named without a degree: in a field or brackets of the place of work, beside the office, or as a hybrid.
NAMED = f"ハイブリッ[ドト]|(?:場所|勤務地|勤務形態|働き方)[^\\n]*(?:\\n[ \\t]*)?(?:{HOME})|(?:{OFFICE})[^\\n]*(?:{HOME})|(?:{HOME})[^\\n]*(?:{OFFICE})"


def remote(text: Column) -> Column:
    """(value, source, raw, days) of a demand: the days of a week, where they are named."""

    def told(best: Column) -> Column:
        value = F.get(F.array(*map(F.lit, WAYS)), best["way"])
        named = F.struct(F.lit("hybrid").alias("value"), F.lit("extracted").alias("source"), F.regexp_extract(text, NAMED, 0).alias("raw"), F.lit(None).cast("int").alias("days"))
        none = F.struct(F.lit("onsite").alias("value"), F.lit("default").alias("source"), F.lit(None).cast("string").alias("raw"), F.lit(None).cast("int").alias("days"))
        found = F.struct(value.alias("value"), F.lit("extracted").alias("source"), best["raw"].alias("raw"), best["days"].alias("days"))
        return F.when(best.isNotNull(), found).when(text.rlike(NAMED), named).otherwise(none)

    return let(F.array_min(_phrases(text)), told)


def own_remote(text: Column) -> Column:
    """(value, source, raw) of a supply: wholly from home anywhere wins over partly; what rules it out says
    nothing, as supplies don't. From windows around the words, or a text of up to 300 characters as a whole."""
    parts = F.when(F.length(text) <= 300, F.array(text)).otherwise(windows_of(text, f"{HOME}|{OFFICE}|勤務", 30, 120))

    def told(found: Column) -> Column:
        best = F.array_min(F.filter(found, lambda p: p["way"] > 0))
        value = F.get(F.array(*map(F.lit, WAYS)), best["way"])
        return F.struct(F.coalesce(value, F.lit("onsite")).alias("value"), F.when(best.isNull(), "default").otherwise("extracted").alias("source"), best["raw"].alias("raw"))

    return let(_phrases(F.array_join(parts, "\n")), told)


# flow and contract ----------------------------------------------------------------------------------

STEPS = "([1-3一二三])\\s*社\\s*(?:先|下)?[^\\n、。]{0,8}?(?:まで|のみ|限)"
OWN = "(?:貴|自)\\s*社|直\\s*(?:接|雇用|契約)"
FREE = "制限\\s*(?:は)?\\s*(?:なし|無し|ありません|ございません)|なし|無し|不問"


def _level(text: Column) -> Column:
    """How far from the sender's own staff a supply may come: one more than the steps that are named."""
    steps = F.array_max(F.transform(F.regexp_extract_all(text, F.lit(STEPS), F.lit(1)), digit))
    free = text.rlike(f"商流[^\\n]{{0,8}}?(?:{FREE})")
    return F.when(free, 0).otherwise(F.coalesce(F.when(steps.isNotNull(), F.least(steps + 1, F.lit(3))), F.when(text.rlike(f"(?:{OWN})[^\\n、。]{{0,10}}?(?:まで|のみ|限定|に限)"), 1)))


def flow_level(text: Column) -> Column:
    """The highest level of the lines about the flow, else of the text as one line; 0 for none."""

    def of(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike("^[\\W_]*商流"))
        return F.coalesce(F.array_max(F.transform(lines, _level)), let(F.regexp_replace(t, "\\s+", " "), _level), F.lit(0))

    return let(synonyms(text), of)


def vendor_flow(text: Column, sender: Column, own_domain: str) -> Column:
    """Tens: 1 for the own domain, 2 for others; ones: how many companies stand between (2 at most)."""
    named = F.array_max(F.transform(F.regexp_extract_all(text, F.lit("([1-2一二])\\s*(?:社\\s*(?:先|下)|次\\s*請)"), F.lit(1)), digit))
    partner = F.when(text.rlike("(?:^|[^A-Za-z])BP(?![A-Za-z])|協力\\s*(?:会社|企業)|パートナー"), 1)
    return F.when(F.endswith(F.lower(sender), F.lit("@" + own_domain.lower())), 10).otherwise(20) + F.coalesce(named, partner, F.lit(0))


#: A permit to dispatch is no contract of dispatch.
PERMIT = "許可|認可|届出|職業紹介|事業\\s*(?:者)?\\s*番号"
CONTRACT = (
    Rule("派遣[^\\n]{0,12}準委任|準委任[^\\n]{0,12}派遣", "quasi_mandate"), Rule("契約[^\\n]{0,8}派遣|派遣\\s*(?:契約|のみ|社員|での?|に\\s*な)|\\(\\s*派遣\\s*\\)", "dispatch"), Rule("準\\s*委任", "quasi_mandate"),
)


def contract(text: Column) -> Column:
    """The first rule that any line but those on permits matches, in the order of the rules."""
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda x: ~x.rlike(PERMIT)), "\n")
    return let(kept, lambda t: first_match(t, CONTRACT, "outsourcing"))


# ages -----------------------------------------------------------------------------------------------

AGE_LABEL = "年\\s*[齢令]|年\\s*代"
#: On the label's line; 100 stands for no limit.
UNLIMITED, NO_LIMIT = f"(?:{AGE_LABEL})[^\\n]{{0,12}}?(?:不問|(?:制限|条件|特に|は|[::】])\\s*(?:なし|無し|な[いく])|確認中|未定)", 100
UP_TO, BELOW, FROM = "^(?:まで|迄|以下|以内|希望|尚?可|が?望ましい)$", "^未満$", "^(?:以上|から|超|より上)$"


def _last(span: Column, early: int, late: int, else_: int) -> Column:
    """The last age of a quantity; of a decade with what its part adds."""
    two = span["second"].isNotNull()
    n, unit, part = F.when(two, span["second"]).otherwise(span["first"]), F.when(two, span["second_unit"]).otherwise(span["unit"]), F.when(two, span["second_part"]).otherwise(span["part"])
    more = F.when(part.isin("前半"), early).when(part.isin("半ば", "中盤"), early if else_ == late else else_).when(part == "後半", late).otherwise(else_)
    return (n + F.when(unit.rlike("代$"), more).otherwise(0)).cast("int")


def _limit(span: Column, labelled: bool) -> Column:
    """The highest age that a quantity allows, as (value, raw), null if it is no age or says nothing."""
    age = amounts.is_unit(span, "[歳才代]$")
    last, first = _last(span, 4, 9, 9), span["first"].cast("int")
    bound = F.greatest(last, first)
    open_end = (span["mark"] != "") & span["second"].isNull()
    plain = span["second"].isNull() & ~amounts.is_unit(span, "代$") if labelled else F.lit(False)
    value = (
        F.when(span["refused"] != "", first - 1).when(span["limit"].rlike(BELOW), first - 1).when(span["second"].isNotNull(), bound)
        .when(open_end | span["limit"].rlike(FROM), NO_LIMIT).when(span["limit"].rlike(UP_TO) | (span["about"] != "") | (span["before"] != ""), last).when(plain, first)
    )
    return F.when(age & value.isNotNull(), F.struct(value.alias("value"), F.lit("extracted").alias("source"), span["raw"].alias("raw")))


def age_limit(text: Column) -> Column:
    """From windows behind the words for age, where a bare age is the limit, else from any line that names one."""
    first = lambda found: F.get(F.filter(found, lambda x: x.isNotNull()), F.lit(0))
    of = lambda part, labelled: first(F.transform(amounts.spans(part), lambda s: _limit(s, labelled)))
    free = F.when(text.rlike(UNLIMITED), F.struct(F.lit(NO_LIMIT).alias("value"), F.lit("extracted").alias("source"), F.regexp_extract(text, UNLIMITED, 0).alias("raw")))
    near = let(windows_of(text, AGE_LABEL, 5, 80), lambda w: first(F.transform(w, lambda x: of(x, True))))
    none = F.struct(F.lit(NO_LIMIT).alias("value"), F.lit("default").alias("source"), F.lit(None).cast("string").alias("raw"))
    return F.coalesce(free, near, of(text, False), none)


#: Ages without a unit: behind the label, or in brackets behind a name.
BARE_AGE = "(?:年\\s*[齢令]\\s*[】\\])]*\\s*:?\\s*|\\(\\s*)([1-9][0-9])(?=\\s*(?:[/)、,\\s]|$))"


def own_age(text: Column) -> Column:
    """The first age of 18 to 75 around the words for age or name; 1 if there is none."""

    def of(window: Column) -> Column:
        bare = F.transform(F.regexp_extract_all(window, F.lit(BARE_AGE), F.lit(1)), lambda x: F.struct(x.try_cast("int").alias("value"), F.lit("extracted").alias("source"), x.alias("raw")))
        named = F.transform(F.filter(amounts.spans(window), lambda s: amounts.is_unit(s, "[歳才代]$")), lambda s: F.struct(_last(s, 3, 7, 5).alias("value"), F.lit("extracted").alias("source"), s["raw"].alias("raw")))
        return F.get(F.filter(F.concat(bare, named), lambda x: x["value"].between(18, 75)), F.lit(0))

    near = windows_of(text, "年\\s*[齢令]|[歳才]|[2-7]0\\s*代|氏\\s*名|名\\s*前", 30, 60)
    none = F.struct(F.lit(1).alias("value"), F.lit("default").alias("source"), F.lit(None).cast("string").alias("raw"))
    return F.coalesce(let(near, lambda w: F.get(F.filter(F.transform(w, of), lambda x: x.isNotNull()), F.lit(0))), none)


# workloads ------------------------------------------------------------------------------------------

LOAD, FULL_TIME, SIDE = "稼\\s*働", "フル\\s*(?:タイム|稼働|コミット)|常\\s*勤", "[副複]\\s*業"
HOURS = "[0-9]{2,3}\\s*[hH]?\\s*[〜~-]\\s*[0-9]{2,3}\\s*(?:[hH]|時間)|精\\s*算[^\\n]{0,6}[0-9]{2,3}\\s*[hH]?\\s*[〜~-]\\s*[0-9]{2,3}"


def _load(low: Column, high: Column, source: str = "extracted") -> Column:
    a, b = low.cast("int"), high.cast("int")
    return F.when(a.between(1, 100) & b.between(1, 100), F.struct(F.least(a, b).alias("min"), F.greatest(a, b).alias("max"), F.lit(source).alias("source")))


def _percent(text: Column) -> Column:
    """Of the first range in percent; else of the first percentage beside the word for workload."""
    first = lambda found, read: F.get(F.filter(F.transform(found, read), lambda x: x.isNotNull()), F.lit(0))
    two = lambda s: F.when(s["second"].isNotNull() & (s["second_unit"] == "%"), _load(s["first"], s["second"]))
    one = lambda s: F.when(s["second"].isNull() & (s["unit"] == "%"), _load(s["first"], s["first"]))
    beside = [let(windows_of(text, LOAD, before, behind), lambda w: first(w, lambda x: first(amounts.spans(x), one))) for before, behind in ((0, 16), (6, 0))]
    return F.coalesce(let(amounts.spans(text), lambda s: first(s, two)), *beside)


def _whole(source: str) -> Column:
    return _load(F.lit(100), F.lit(100), source)


def workload(text: Column) -> Column:
    """(min, max, source) in percent of a demand; days of a week below five say nothing about it."""
    whole = text.rlike(f"{HOURS}|{FULL_TIME}|週\\s*[5五]\\s*[日回]?\\s*(?:{LOAD}|勤務)")
    return F.coalesce(_percent(text), F.when(whole, _whole("extracted")), _whole("default"))


def own_workload(text: Column) -> Column:
    """The same of a supply; a day of a week is 20 %, a side job 20 to 80 %. Days at home or in the office are none."""

    def of(week: Column) -> Column:
        day = lambda n: n * 20
        low = F.when(week["limit"].isin("まで", "以下", "以内"), 1).otherwise(week["first"])
        high = F.when(week["second"].isNotNull(), week["second"]).when(week["limit"].isin("以上", "から"), 5).otherwise(week["first"])
        return F.when(~week["topic"], _load(day(low), day(F.least(high, F.lit(5)))))

    weeks = F.get(F.filter(F.transform(amounts.weeks(text, f"{HOME}|{OFFICE}"), of), lambda x: x.isNotNull()), F.lit(0))
    side = F.when(text.rlike(f"{SIDE}[^\\n]{{0,4}}(?:{FOR}|希望|前提|として|で)"), _load(F.lit(20), F.lit(80)))
    return F.coalesce(_percent(text), weeks, side, F.when(text.rlike(FULL_TIME), _whole("extracted")), _whole("default"))
