"""Column functions on text; all but ``nfkc`` run in the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..storage import sliced


#: Characters that a worker has the normal form of at once.
SLICE = 1 << 20


def nfkc(text: Column) -> Column:
    """Unicode compatibility form; null stays null. Of large texts the table goes through ``storage.bounded`` first."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in sliced(batches, lambda x: len(x) if isinstance(x, str) else 1, SLICE):
            yield pd.Series([unicodedata.normalize("NFKC", x) if isinstance(x, str) else None for x in series], dtype=object)

    return pandas_udf(run, "string")(text)


def collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "[\\s\\u3000]+", " "))


def dedupe_key(text: Column) -> Column:
    """Lower case, blanks collapsed, one leading reply or forward mark dropped; null counts as empty.
    Texts not in NFKC go through ``nfkc`` first."""
    bare = F.regexp_replace(collapsed(F.coalesce(text, F.lit(""))), "(?i)^(?:re|fwd?)\\s*[::]\\s*", "")
    return F.lower(collapsed(bare))


def mail_address(header: Column) -> Column:
    """What stands between < and >, else the whole, trimmed and in lower case."""
    inner = F.regexp_extract(header, "<([^<>]*)>", 1)
    return F.lower(F.trim(F.when(inner != "", inner).otherwise(header)))


def html_to_text(html: Column) -> Column:
    """Scripts and styles dropped, line breaks and paragraph ends as newlines, tags stripped, two blank lines at most."""
    text = F.regexp_replace(html, "(?is)<script[^>]*>.*?</script>", "")
    text = F.regexp_replace(text, "(?is)<style[^>]*>.*?</style>", "")
    text = F.regexp_replace(text, "(?i)<br\\s*/?>|</p>", "\n")
    text = F.regexp_replace(text, "<[^>]+>", "")
    return F.regexp_replace(F.btrim(text, F.lit(" \n\t\r")), "\n{3,}", "\n\n")


#: The named entities of HTML that markup itself needs, and the blank.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def document_to_text(html: Column) -> Column:
    """As html_to_text, but every block ends a line, comments and noscript go, entities are
    resolved and blanks collapse in each line."""
    text = F.regexp_replace(html, "(?is)<(script|style|noscript)[^>]*>.*?</\\1>|<!--.*?-->", "")
    text = F.regexp_replace(text, "(?i)<br\\s*/?>|</(?:p|div|li|tr|h[1-6]|table|section|article|ul|ol)>", "\n")
    text = F.regexp_replace(text, "<[^>]+>", " ")
    text = reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ENTITIES.items(), text)
    text = F.regexp_replace(F.regexp_replace(text, "[ \\t\\u00A0]+", " "), " ?\n ?", "\n")
    return squeeze(F.btrim(text, F.lit(" \n\t\r")), 1)


CJK = "[\\u3040-\\u30FF\\u3400-\\u9FFF\\uFF66-\\uFF9F]"


def join_cjk(text: Column) -> Column:
    """Without blanks between two CJK characters."""
    return F.regexp_replace(text, f"(?<={CJK})[ \\t\\u3000]+(?={CJK})", "")


#: Words that mean the same, and the one that stands for them.
SYNONYMS = {"御社": "貴社", "迄": "まで", "元請け": "元請"}


def synonyms(text: Column, words: Mapping[str, str] = SYNONYMS, flat: bool = False) -> Column:
    """Synonyms folded and blanks collapsed in each line, or over all lines if ``flat``."""
    folded = reduce(lambda t, w: F.replace(t, F.lit(w[0]), F.lit(w[1])), words.items(), text)
    if flat:
        return F.trim(F.regexp_replace(folded, "\\s+", " "))
    return F.regexp_replace(F.regexp_replace(folded, "[ \\t]+", " "), "(?m)^ | $", "")


def squeeze(text: Column, most: int = 2) -> Column:
    """At most ``most`` blank lines together."""
    return F.regexp_replace(text, f"\\n{{{most + 2},}}", "\n" * (most + 1))


EMAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"
IPV4 = "\\b[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\b"
URL = "https?://[^\\s<>\"']+"
PHONE = "\\b0[0-9]{1,4}-[0-9]{1,4}-[0-9]{3,4}\\b"
POSTCODE = "\\b[0-9]{3}-[0-9]{4}\\b"
DOMAIN = "\\b(?:[a-z0-9-]+\\.)+(?:com|net|org|jp|io|info|biz)\\b"


def mask_noise(text: Column) -> Column:
    """URLs, domains, postal codes and phone numbers as blanks, before scores are counted."""
    return F.regexp_replace(text, f"{URL}|(?i:{DOMAIN})|{PHONE}|{POSTCODE}", " ")


def heading_key(text: Column) -> Column:
    """A label without decoration, variation selectors and inner blanks."""
    bare = F.regexp_replace(text, "[\\uFE00-\\uFE0F\\s\\u3000]", "")
    return F.regexp_replace(bare, "^[【\\[《〈<■□◆◇●○・*#※▼▽]+|[】\\]》〉>::]+$", "")


def truncate_at_line(text: Column, most: int, suffix: str = "", back: float = 0.8) -> Column:
    """The first ``most`` characters, back to the last newline if it stands beyond ``back`` of them."""
    head = F.substring(text, 1, most)
    last = F.length(head) - F.instr(F.reverse(head), "\n")  # characters before the last newline
    cut = F.when((F.instr(head, "\n") > 0) & (last > F.lit(most * back)), F.substr(head, F.lit(1), last)).otherwise(head)
    return F.when(F.length(text) <= most, text).otherwise(F.concat(cut, F.lit(suffix)))


def summary(items: Column, most: int = 8, length: int = 240, separator: str = " / ", mark: str = "…") -> Column:
    """The first ``most`` items, joined and cut to ``length`` characters."""
    joined = F.array_join(F.slice(items, 1, most), separator)
    return F.when(F.length(joined) > length, F.concat(F.rtrim(F.substring(joined, 1, length)), F.lit(mark))).otherwise(joined)


def quote(text: Column, most: int = 1600, mark: str = "…") -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit(mark))).otherwise(text)


def strip_modifiers(skill: Column, modifiers: Sequence[str], technical: str = "[A-Za-z0-9+#]") -> Column:
    """A technical skill up to its first modifier (patterns); others as they are."""
    cut = F.trim(F.regexp_replace(skill, f"(?:{'|'.join(modifiers)}).*$", ""))
    return F.when(skill.rlike(technical) & (cut != ""), cut).otherwise(skill)


def is_soft_skill(skill: Column, soft: Sequence[str], technical: Sequence[str] = ()) -> Column:
    """Has a soft word, and neither an alphanumeric token nor a technical word."""
    has = lambda words: reduce(lambda a, b: a | b, [F.contains(skill, F.lit(w)) for w in words], F.lit(False))
    return has(soft) & ~skill.rlike("[A-Za-z0-9]{2,}") & ~has(technical)


def first_nonempty(*values: Column) -> Column:
    """The first that has more than blanks, as it is."""
    return F.coalesce(*[F.when(F.trim(v) != "", v) for v in values])


def with_source(*options: tuple[str, Column]) -> Column:
    """(value, source): the first value that isn't null, with its name; source "none" without any."""
    value = F.coalesce(*[v for _, v in options])
    source = F.coalesce(*[F.when(v.isNotNull(), F.lit(n)) for n, v in options], F.lit("none"))
    return F.struct(value.alias("value"), source.alias("source"))


def distinct_ignoring_case(items: Column) -> Column:
    """Items in order, without those that equal an earlier one but for case."""
    low = F.transform(items, F.lower)
    return F.filter(items, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)


def redact(text: Column) -> Column:
    """E-mail addresses, IPv4 addresses, URLs and phone numbers masked. Each pattern runs only over
    texts that have what all its matches have: an @, "://", digits around a dot or a hyphen."""
    masks = (("[EMAIL]", EMAIL, F.contains(text, F.lit("@"))), ("[URL]", URL, F.contains(text, F.lit("://"))), ("[IP]", IPV4, text.rlike("[0-9]\\.[0-9]")), ("[PHONE]", PHONE, text.rlike("0[0-9]{1,4}-[0-9]")))
    return reduce(lambda t, m: F.when(m[2], F.regexp_replace(t, m[1], m[0])).otherwise(t), masks, text)


#: Names by which people are met in chats: a service, then its id.
CHAT = "(?i)\\b((?:LINE|Skype|Slack|Teams|Chatwork|Discord)\\s*(?:ID)?\\s*[:=]\\s*)[@A-Za-z0-9._-]{3,}"
#: Lines that are noise at the edges of a text only: greetings, rules, names of the writer.
EDGE = "^[\\s*=_~━─-]*$|^(?:お世話に|いつも|よろしく|宜しく|(?:dear|hello|hi)[ ,]|best |kind |regards|sincerely)"


def masked(text: Column, domains: Sequence[str] = ()) -> Column:
    """``domains`` (own names and hosts) masked first, then what ``redact`` masks, then ids of chats."""
    own = reduce(lambda t, d: F.regexp_replace(t, "(?i)(?<![A-Za-z0-9])\\Q" + d + "\\E(?![A-Za-z0-9])", "[DOMAIN]"), sorted(domains, key=lambda d: (-len(d), d)), text)
    return F.regexp_replace(redact(own), CHAT, "$1[CHAT]")


def sanitised(text: Column, noise: Sequence[tuple[str, str]], domains: Sequence[str] = (), edge: str = EDGE) -> Column:
    """(text, reasons): lines that match one of ``noise`` (reason, pattern) are dropped, the rest is masked, and
    lines that match ``edge`` go at both ends; if nothing is left, the masked original. Reasons are
    sorted, one each. Without rules no line is dropped."""
    lines = F.split(text, "\n", -1)
    reason = lambda line: F.coalesce(*[F.when(line.rlike(p), F.lit(r)) for r, p in noise], F.lit(None).cast("string"))
    left = F.filter(lines, lambda x: reason(x).isNull())
    places = F.filter(F.transform(left, lambda x, i: F.when(~x.rlike(f"(?i){edge}"), i)), lambda i: i.isNotNull())
    low, high = F.coalesce(F.array_min(places), F.lit(0)), F.coalesce(F.array_max(places), F.lit(-1))
    kept = F.btrim(masked(F.array_join(F.slice(left, low + 1, F.greatest(high - low + 1, F.lit(0))), "\n"), domains), F.lit(" \n\t\r"))
    why = F.array_sort(F.array_distinct(F.filter(F.transform(lines, reason), lambda x: x.isNotNull())))
    return F.struct(F.when(kept == "", masked(text, domains)).otherwise(kept).alias("text"), why.alias("reasons"))


def urls(text: Column) -> Column:
    """URLs in order, without punctuation at their ends."""
    found = F.regexp_extract_all(text, F.lit(URL), F.lit(0))
    return F.transform(found, lambda u: F.regexp_replace(u, "[.,;:!?)\\]}。、」]+$", ""))


def host(url: Column) -> Column:
    return F.regexp_extract(url, "^[a-z]+://([^/:?#]+)", 1)


def url_class(url: Column, classes: Sequence[tuple[str, str]]) -> Column:
    """The first class whose pattern the host matches, else "other"."""
    return F.coalesce(*[F.when(host(url).rlike(p), F.lit(c)) for c, p in classes], F.lit("other"))


def by_priority(found: Column, classes: Sequence[tuple[str, str]]) -> Column:
    """Distinct URLs in the order of their classes, then as found."""
    rank = F.array(*[F.lit(c) for c, _ in classes], F.lit("other"))
    keyed = F.transform(F.array_distinct(found), lambda u, i: F.struct(F.array_position(rank, url_class(u, classes)).alias("p"), i.alias("i"), u.alias("u")))
    return F.transform(F.array_sort(keyed), lambda x: x["u"])


def quality_reason(text: Column, least: int = 30) -> Column:
    """Why a text is not usable, null if it is."""
    bare = F.regexp_replace(text, "\\s", "")
    return (
        F.when(text.isNull() | (bare == ""), "empty")
        .when(looks_like_html(text), "html")
        .when(F.length(bare) < least, "short")
        .when(bare.rlike("^[0-9/\\-]+$"), "page_numbers")
        .when(~F.contains(F.btrim(text, F.lit(" \n\t\r")), F.lit("\n")) & (F.length(bare) < 2 * least), "title_only")
    )


def content_kind(data: Column, content_type: Column) -> Column:
    """What a response is: html (by its type or its first bytes), pdf, office (a zip), ole (old office), text, or binary (bytes below blank)."""
    head = F.lower(F.decode(F.substring(data, 1, 512), "ISO-8859-1"))
    return (
        F.when(data.isNull() | (F.octet_length(data) == 0), "empty")
        .when(F.contains(F.coalesce(F.lower(content_type), F.lit("")), F.lit("text/html")) | looks_like_html(head), "html")
        .when(F.startswith(F.hex(F.substring(data, 1, 4)), F.lit("25504446")), "pdf")
        .when(F.startswith(F.hex(F.substring(data, 1, 4)), F.lit("504B0304")), "office")
        .when(F.startswith(F.hex(F.substring(data, 1, 8)), F.lit("D0CF11E0A1B11AE1")), "ole")
        .when(head.rlike("[\\x00-\\x08\\x0E-\\x1A]"), "binary")
        .otherwise("text")
    )


def looks_like_html(text: Column) -> Column:
    return F.substring(F.lower(F.ltrim(text)), 1, 200).rlike("^(?:<!doctype html|<html|<head|<body)")


def failure_reason(scope: Column, kind: Column, error: Column) -> Column:
    """"scope[kind] message", with the message of the first cause that the error shows."""
    low = F.lower(error)
    message = (
        F.when(low.rlike("40[13]|forbidden|unauthor"), "needs permission")
        .when(low.rlike("404|not found"), "not found")
        .when(low.rlike("timed? ?out"), "timeout")
        .when(low.rlike("html"), "page instead of a document")
        .otherwise("failed")
    )
    return F.concat(scope, F.lit("["), kind, F.lit("] "), message)


def wildcard(text: Column, pattern: str) -> Column:
    """Equality, or the shell's rules if the pattern has an asterisk."""
    if "*" not in pattern:
        return text == pattern
    out, i = "", 0
    while i < len(pattern):
        c, end = pattern[i], pattern.find("]", i + 2)
        if c == "[" and end > 0:
            inner = pattern[i + 1 : end]
            out += "[" + ("^" + inner[1:] if inner[0] == "!" else inner).replace("\\", "\\\\") + "]"
            i = end
        else:
            out += {"*": ".*", "?": "."}.get(c, "\\Q" + c + "\\E")
        i += 1
    return text.rlike(f"(?s)^{out}$")


def count_of(text: Column, word: str) -> Column:
    """Occurrences of ``word`` that don't overlap."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(word), F.lit("")))) / F.lit(len(word))).cast("long")


def around(text: Column, pattern: str, before: int, after: int, most: int = 200) -> Column:
    """What stands around the first match, ``most`` characters at most; null without a match."""
    at = F.regexp_instr(text, F.lit(pattern))
    low = F.greatest(at - before, F.lit(1))
    width = F.least(F.length(F.regexp_substr(text, F.lit(pattern))) + (at - low) + after, F.lit(most))
    return F.when(at > 0, F.substr(text, low, width))


def flexible(label: str) -> str:
    """A pattern for a label whose characters may have blanks between them."""
    return "[ \\t\\u3000]*".join("\\Q" + c + "\\E" for c in label)


def without_urls_near(text: Column, phrase: str) -> Column:
    """Without lines with ``phrase`` and a URL on the next line, or on the next after a blank one."""
    return F.regexp_replace(text, f"(?m)^.*(?:{phrase}).*\\n(?:[ \\t]*\\n)?[ \\t]*{URL}[ \\t]*(?:\\n|$)", "")
