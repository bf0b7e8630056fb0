"""A grammar of quantities in running text: "40万〜50万円/月", "45歳くらいまで", "30代前半", "80%以上".

``spans`` reads every quantity of a text into one structure; what a price, an age limit or a workload
makes of it is said by rules over these structures, not by patterns over the text. Texts are expected in NFKC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.numbers import digit

MARK = "[〜~-]"
NUMBER = "[0-9][0-9,]*(?:\\.[0-9]+)?"
#: Units by what they measure. A scale may stand before the unit of money, and "years" before that of decades.
UNIT = "(?:[万千]?円|[万千](?!人)|%|[歳才]?\\s*代|[歳才]|時間|[hH](?![a-zA-Z])|日|名|回|社|ヶ?月|年)"
PERIODS = {"hour": "時間?|[hH]", "day": "人?日", "month": "人?月"}
LEADS = {"hour": "時間?(?:給|単価|額)", "day": "日(?:給|当|額|単価)", "month": "月(?:給|額|単価)"}
PART = "前半|半ば|中盤|後半"
ABOUT = "程度|前後|[くぐ]らい|位"
LIMIT = "まで|迄|以下|以内|未満|以上|超|から|より上|が?望ましい|希望|尚?可"
REFUSED = "NG|不可|お断り|対象外"

#: (name, pattern) of the parts of a quantity in their order; a second one follows a mark.
PARTS = (
    ("lead", f"(?:({'|'.join(LEADS.values())})\\s*:?\\s*約?\\s*)?"),
    ("before", f"(?:({MARK})\\s*)?"),
    ("first", f"({NUMBER})"),
    ("unit", f"(?:\\s*({UNIT}))?"),
    ("part", f"(?:\\s*({PART}))?"),
    ("mark", f"(?:\\s*({MARK}|から)"),
    ("second", f"(?:\\s*({NUMBER})"),
    ("second_unit", f"(?:\\s*({UNIT}))?"),
    ("second_part", f"(?:\\s*({PART}))?)?)?"),
    ("per", f"(?:\\s*/\\s*({'|'.join(PERIODS.values())}))?"),
    ("about", f"(?:\\s*の?\\s*({ABOUT}))?"),
    ("limit", f"(?:\\s*の?(?:方)?\\s*({LIMIT}))?"),
    ("refused", f"(?:\\s*の?(?:方)?\\s*は?\\s*(?:原則\\s*)?({REFUSED}))?"),
)
SPAN = "".join(p for _, p in PARTS)


def spans(text: Column) -> Column:
    """All quantities: raw and the parts as texts, "" for what isn't there, with the numbers as decimals."""

    def read(raw: Column) -> Column:
        part = {name: F.regexp_extract(raw, f"^{SPAN}", i + 1) for i, (name, _) in enumerate(PARTS)}
        number = {k: F.regexp_replace(part[k], ",", "").try_cast("decimal(18,4)") for k in ("first", "second")}
        return F.struct(raw.alias("raw"), *[(number.get(k, v)).alias(k) for k, v in part.items()], F.contains(part["first"], F.lit(",")).alias("grouped"))

    return F.transform(F.regexp_extract_all(text, F.lit(SPAN), F.lit(0)), read)


def period(span: Column) -> Column:
    """hour, day or month, if the quantity says by what it is counted."""
    return F.coalesce(
        *[F.when(span["per"].rlike(f"^(?:{PERIODS[k]})$") | span["lead"].rlike(f"^(?:{LEADS[k]})$"), F.lit(k)) for k in PERIODS], F.lit(None).cast("string")
    )


def is_unit(span: Column, pattern: str) -> Column:
    """Whether the last unit that is named matches."""
    return F.when(span["second_unit"] != "", span["second_unit"].rlike(pattern)).otherwise(span["unit"].rlike(pattern))


#: Days of a week: "週3〜4日", "週二日以上", and what they are days of.
WEEK = f"週\\s*([1-7一二三四五六七])\\s*[日回]?\\s*(?:{MARK}\\s*([1-7一二三四五六七]))?\\s*[日回]?\\s*(?:({MARK})|の?(?:{ABOUT})?\\s*(まで|以下|以内|以上|から)?)"


def weeks(text: Column, topic: str) -> Column:
    """All such phrases: first and second number, limit, and whether the ``topic`` follows."""
    whole = f"{WEEK}\\s*(?:の|は|で|だけ)?\\s*({topic})?"
    get = lambda raw, g: F.regexp_extract(raw, f"^{whole}", g)
    read = lambda raw: F.struct(
        raw.alias("raw"), digit(get(raw, 1)).alias("first"), digit(get(raw, 2)).alias("second"), F.when(get(raw, 3) != "", "以上").otherwise(get(raw, 4)).alias("limit"), (get(raw, 5) != "").alias("topic")
    )
    return F.transform(F.regexp_extract_all(text, F.lit(whole), F.lit(0)), read)
