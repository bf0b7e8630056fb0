"""Surrogates for personal data, in DataFrame functions only.

Entities are found by one pattern (e-mail addresses, secrets after a keyword, access keys, IBANs,
card numbers, IPv4 and IPv6 addresses, phone numbers with a country's code or an area's, social
security numbers, names behind a title or that start with one of GIVEN). An entity is its type and
canonical form (lower case; digits only for numbers; all eight groups of an IPv6 address), so that
all spellings of one entity in all documents get one surrogate: coreference is kept. A name's given
and family name are entities of their own, so "Mr. John Smith", "Mr Smith" and "John Smith" stay one
person, and titles and middle initials stay as they are. A given name has the gender of GIVEN, else
of its title; without either, the one that it has elsewhere in the corpus, if that is only one.

A surrogate comes from a keyed hash of type, canonical form and attempt: digits for digits, letters
for letters, hex for hex; card numbers keep their first digit and Luhn remainder, octets of addresses
their width, access keys their prefix, countries of IBANs and phone numbers stay. Names are made of
syllables of their script, given names (and Cyrillic family names) with an ending of their gender.
Laid out over the original, a surrogate has its case and separators. Whoever has the key can find
the originals of short formats by trying all; it has no default.

Attempts are raised until no two entities of a type have one surrogate and no surrogate is an
entity of the corpus. From attempt GROW on a format gets more room, so that a full one has an
answer: names get syllables, e-mail addresses, secrets, phone and social security numbers get
characters, and octets lose their width. Card numbers, IBANs and access keys have 10**10 or more
surrogates of one form and keep it.

Not found: names without a title that start with another given name, and names in other scripts than
Latin and Cyrillic.

Nulls: a null text stays null and has no entities. Equal texts share one replacement. An empty
table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Tables, kept_row, text_key, written

# Titles by gender, and common given names that are no other words.
TITLES = {"male": ["Mr", "Herr", "Monsieur", "Señor", "Господин"], "female": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Госпожа"], "neutral": ["Dr", "Prof", "Doctor", "Professor"]}
GIVEN = {
    "male": (
        "Adam Albert Alexander Andreas Andrew Anthony Antonio Arthur Benjamin Bernd Carlos Charles Christopher Daniel David Dieter Edward Eric Fernando George Gerald Hans Heinrich Henry Jacques "
        "James Javier Jeffrey John Jonathan Jorge Joseph José Juan Jürgen Karl Kenneth Kevin Klaus Louis Luis Manuel Markus Martin Matthew Michael Miguel Nicholas Patrick Paul Pedro Peter Philippe "
        "Pierre Ralph Richard Robert Ronald Stefan Stephen Steven Thomas Timothy Walter William Wolfgang Александр Алексей Андрей Дмитрий Иван Михаил Николай Павел Сергей Владимир"
    ).split(),
    "female": (
        "Alice Amanda Amy Andrea Angela Anna Anne Barbara Betty Brigitte Carmen Carol Caroline Catherine Charlotte Christine Claudia Cynthia Deborah Diana Donna Dorothy Elena Elizabeth Emily Emma "
        "Françoise Gabriele Helen Ingrid Isabelle Jane Janet Jennifer Jessica Joan Julia Karen Katharina Kathleen Laura Linda Lisa Margaret María Maria Marie Martha Mary Melissa Michelle Monika "
        "Nancy Nicole Olivia Pamela Patricia Petra Rachel Rebecca Renate Ruth Sabine Sandra Sarah Sharon Sophie Stephanie Susan Susanne Teresa Ursula Анна Екатерина Елена Ирина Мария Наталья Ольга Татьяна"
    ).split(),
}

#: What stands before a secret: its keyword (which may be quoted or go on, as in secret_access_key), the sign and the quote.
KEYWORD = "(?i:password|passwd|pwd|secret|token|api[_-]?key)(?:[_-][A-Za-z0-9]{1,16}){0,3}\\\\?[\"']?[ \\t]{0,3}(?:=>|:=|[=:])[ \\t]{0,3}"
HEAD = f"{KEYWORD}(?:\\\\?[\"'])?"
#: The whole of a quoted value (of 4 characters or more) or of another one (of 8 or more, up to white space).
VALUES = [
    "\\\\\"(?=[^\"\\n]*?[\\p{L}\\p{N}])[^\"\\n]{4,}?(?=\\\\\")",
    "\"(?=(?:[^\"\\\\\\n]|\\\\.){4})(?=[^\"\\n]*[\\p{L}\\p{N}])[^\"\\\\\\n]*+(?:\\\\.[^\"\\\\\\n]*+)*+(?=\")",
    "'(?=(?:[^'\\\\\\n]|\\\\.){4})(?=[^'\\n]*[\\p{L}\\p{N}])[^'\\\\\\n]*+(?:\\\\.[^'\\\\\\n]*+)*+(?=')",
    "[\"']?(?=[^\\s\"'<>]{7,}[^\\s\"'<>.,;:!?)\\]}])(?=[^\\s\"'<>]*[\\p{L}\\p{N}])[^\\s\"'<>\\\\]*(?:\\\\(?![\"'])[^\\s\"'<>\\\\]*)*(?<![.,;:!?)\\]}])",
]
GROUP = "[0-9A-Fa-f]{1,4}"


def one_of(words: list[str]) -> str:
    """A pattern for any of some words that looks at the first letter first."""
    by: dict[str, list[str]] = {}
    for word in sorted(words, key=lambda w: (-len(w), w)):
        by.setdefault(word[0], []).append(word[1:])
    return f"(?=[{''.join(sorted(by))}])(?:{'|'.join(f'{c}(?:{"|".join(rest)})' for c, rest in sorted(by.items()))})"


#: A capitalised word, which may go on behind a hyphen or an apostrophe.
CAPITAL = "[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+(?:[-'’][A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)?"
CYRILLIC = "[А-ЯЁ][а-яё]+(?:-[А-ЯЁ][а-яё]+)?"
TITLE = f"(?:{one_of([t for group in TITLES.values() for t in group])}\\.? )"
NAME_HEAD = f"{TITLE}{{1,2}}(?:[A-ZА-ЯЁ]\\. )?"
GIVEN_HEAD = f"{one_of([g for group in GIVEN.values() for g in group])}(?: [A-ZА-ЯЁ]\\.)?"
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Pattern of each type, in order of precedence; none has groups that capture.
PATTERNS = {
    "email": "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)*\\.[A-Za-z]{2,}",
    "secret": f"(?=[pstaPSTA]){KEYWORD}(?:{'|'.join(VALUES)})",
    "access_key": "(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "iban": "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "phone": "(?<![0-9A-Za-z+])\\+[0-9]{1,3}[ .-]?(?:\\([0-9]{1,4}\\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])",
    "card": "(?<![0-9A-Za-z.-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "ipv4": f"(?<![0-9.]){OCTET}(?:\\.{OCTET}){{3}}(?!\\.?[0-9])",
    "ipv6": f"(?<![0-9A-Za-z:.])(?:(?:{GROUP}:){{7}}{GROUP}|(?=[0-9A-Fa-f:]*[0-9]|(?:[0-9A-Fa-f]*:){{3}})(?:{GROUP}(?::{GROUP}){{0,6}})?::(?:{GROUP}(?::{GROUP}){{0,6}})?)(?![0-9A-Za-z:]|\\.[0-9])",
    "ssn": "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": "(?<![0-9A-Za-z])\\([0-9]{2,5}\\)[ -]?[0-9]{1,4}[ .-][0-9]{3,4}(?![0-9])|(?<![0-9A-Za-z.+-])(?:(?:1[ .-])?[2-9][0-9]{2}[.-][0-9]{3}[.-][0-9]{4}|0[0-9]{1,4}-[0-9]{1,4}-[0-9]{3,4}|0[0-9]{1,4}\\.[0-9]{2,4}\\.[0-9]{3,4}|0[0-9](?:[ .-][0-9]{2}){4}|0[0-9]{2,4} [0-9]{3,4} [0-9]{3,4})(?![0-9A-Za-z-]|\\.[0-9])",
    "name": f"(?<![\\p{{L}}])(?:{NAME_HEAD}(?:{CAPITAL}|{CYRILLIC})(?: [A-ZА-ЯЁ]\\.)?(?: (?:{CAPITAL}|{CYRILLIC}))?|{GIVEN_HEAD} (?:{CAPITAL}|{CYRILLIC}))(?![\\p{{L}}])",
}
PATTERN = "|".join(PATTERNS.values())
#: What names are made of: syllables by script, endings of given names by gender and script, of family names by gender.
SYLLABLES = {"latin": ["bar", "den", "fal", "gor", "hel", "kin", "lam", "mor", "nor", "pel", "ras", "sten", "tor", "ven", "wal", "zim"], "cyrillic": ["бар", "ден", "вал", "гор", "дел", "кин", "лам", "мор", "нор", "пел", "рас", "сен", "тор", "вен", "зим", "лук"]}
ENDINGS = {
    ("male", "latin"): ["us", "an", "or", "ert"], ("female", "latin"): ["a", "ia", "ine", "ella"], ("neutral", "latin"): ["i", "y", "o", "el"],
    ("male", "cyrillic"): ["ий", "ан", "ор", "ей"], ("female", "cyrillic"): ["ия", "ана", "ина", "елла"], ("neutral", "cyrillic"): ["и", "о", "у", "е"],
}
FAMILY = {("male", "cyrillic"): "ов", ("female", "cyrillic"): "ова"}
#: Attempts after which the room of a format grows.
GROW = 4


def may_have(text: Column) -> Column:
    """Without a digit, an @, ::, a secret's keyword, a title or a given name, none of the patterns can match; these are cheap to look for."""
    low = F.lower(text)
    marks = [F.contains(low, F.lit(w)) for w in ("password", "passwd", "pwd", "secret", "token", "api")]
    marks.append(text.rlike(f"(?<![\\p{{L}}])(?:{NAME_HEAD}|{GIVEN_HEAD} )"))
    return reduce(lambda a, b: a | b, marks, text.rlike("[0-9@]|::"))


def kind_of(entity: Column) -> Column:
    """The first type whose pattern is all of the entity; a secret's ends before a quote, but nothing else starts like one."""
    return F.coalesce(*[F.when(entity.rlike(f"^{KEYWORD}" if k == "secret" else f"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items()])


def canonical(kind: Column, entity: Column) -> Column:
    numbers = kind.isin("phone", "card", "ssn", "local_phone")
    sides = F.transform(F.split(F.lower(entity), "::"), lambda s: F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, ":")))
    left, right = F.element_at(sides, 1), F.when(F.size(sides) > 1, F.element_at(sides, -1)).otherwise(F.array().cast("array<string>"))
    groups = F.concat(left, F.array_repeat(F.lit("0"), 8 - F.size(left) - F.size(right)), right)
    ipv6 = F.array_join(F.transform(groups, lambda g: F.regexp_replace(g, "^0+(?=.)", "")), ":")
    return (
        F.when(numbers, F.regexp_replace(entity, "[^0-9]", ""))
        .when(kind == "secret", F.regexp_replace(entity, f"^{HEAD}", ""))
        .when(kind == "ipv6", ipv6)
        .when(kind == "iban", F.replace(entity, F.lit(" ")))
        .when(kind == "email", F.lower(entity))
        .otherwise(entity)
    )


def number(seed: Column, i: Column | int, below: int) -> Column:
    """The i-th number below ``below`` of a seed."""
    i = F.lit(i) if isinstance(i, int) else i
    return F.pmod(F.conv(F.substring(F.sha2(F.concat_ws(":", seed, i.cast("string")), 256), 1, 12), 16, 10).cast("long"), F.lit(below))


def pick(alphabet: str, seed: Column, i: Column) -> Column:
    return F.substr(F.lit(alphabet), (number(seed, i, len(alphabet)) + 1).cast("int"), F.lit(1))


def disguised(text: Column, seed: Column, hexadecimal: Column) -> Column:
    """Each character replaced by one of its class; others stay."""

    def one(c: Column, i: Column) -> Column:
        hexed = hexadecimal & c.rlike("[0-9a-f]")
        return (
            F.when(hexed, pick("0123456789abcdef", seed, i))
            .when(c.rlike("[0-9]"), pick("0123456789", seed, i))
            .when(c.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz", seed, i))
            .when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", seed, i))
            .when(c.rlike("[\\p{L}\\p{N}]"), pick("abcdefghijklmnopqrstuvwxyz", seed, i))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits, its last digit counted as 0."""
    length = F.length(digits)

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.pmod(length - i, F.lit(2)) == 0
        return F.when(i == length - 1, 0).when(twice, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.transform(F.split(digits, ""), value), F.lit(0), lambda a, x: a + x)


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The canonical form of an entity's surrogate."""
    seed = F.sha2(F.concat_ws("\x00", F.lit(key), kind, canon, attempt.cast("string")), 256)
    no = F.lit(False)
    drawn = disguised(canon, seed, no)
    domain = F.regexp_extract(canon, "\\.[a-z]+$", 0)
    email = F.concat(disguised(F.substr(canon, F.lit(1), F.length(canon) - F.length(domain)), seed, no), domain)
    card = F.concat(F.substring(canon, 1, 1), F.substr(drawn, F.lit(2)))
    body = F.substr(card, F.lit(1), F.length(card) - 1)
    last = F.pmod(luhn(canon) + F.substr(canon, F.length(canon)).cast("int") - luhn(card), F.lit(10))
    octet = F.transform(
        F.split(canon, "\\."),
        lambda o, i: F.when(F.length(o) == 3, 100 + number(seed, i, 156)).when(F.length(o) == 2, 10 + number(seed, i, 90)).otherwise(1 + number(seed, i, 9)).cast("string"),
    )
    ipv6 = F.concat(F.lit("fd"), F.substring(seed, 1, 2), *[F.concat(F.lit(":"), F.regexp_replace(F.substring(seed, 3 + 4 * i, 4), "^0+(?=.)", "")) for i in range(7)])
    any_octet = F.transform(F.split(canon, "\\."), lambda o, i: number(seed, i, 256).cast("string"))
    octet = F.when(attempt < GROW, octet).otherwise(any_octet)
    more = F.substr(F.sha2(seed, 256), F.lit(1), F.least(F.floor(attempt / GROW), F.lit(64)).cast("int"))
    more_digits, more_letters = F.translate(more, "abcdef", "012345"), F.translate(more, "0123456789", "ghijklmnop")
    country = F.when(F.length(canon) > 10, F.length(canon) - 10).otherwise(F.lit(1))
    phone = F.concat(F.substr(canon, F.lit(1), country), F.substr(drawn, country + 1))
    gender, cyrillic = F.regexp_extract(canon, "^([a-z]+):", 1), canon.rlike("[А-яё]")
    given = family = F.lit(None).cast("string")
    for script, all_syllables in SYLLABLES.items():
        syllables = F.array(*map(F.lit, all_syllables))
        several = lambda n, syllables=syllables: F.array_join(F.transform(F.sequence(F.lit(1), n + F.floor(attempt / GROW).cast("int")), lambda i: F.element_at(syllables, (number(seed, i, 16) + 1).cast("int"))), "")
        for of in ("male", "female", "neutral"):
            here = (gender == of) & (cyrillic == F.lit(script == "cyrillic"))
            ending = F.element_at(F.array(*map(F.lit, ENDINGS[of, script])), (number(seed, 99, 4) + 1).cast("int"))
            given = F.when(here, F.initcap(F.concat(several(2), ending))).otherwise(given)
            family = F.when(here, F.initcap(F.concat(several(4), F.lit(FAMILY.get((of, script), ""))))).otherwise(family)
    name = F.concat(gender, F.lit(":"), F.when(kind == "given", given).otherwise(family))
    return (
        F.when(kind == "email", F.concat(more_letters, email))
        .when(kind == "card", F.concat(body, last.cast("string")))
        .when(kind == "ipv4", F.array_join(octet, "."))
        .when(kind == "ipv6", ipv6)
        .when(kind == "phone", F.concat(phone, more_digits))
        .when(kind.isin("local_phone", "ssn"), F.concat(drawn, more_digits))
        .when(kind == "secret", F.concat(disguised(canon, seed, canon.rlike("^[0-9a-f]+$")), more))
        .when(kind == "access_key", F.concat(F.substring(canon, 1, 4), F.substr(drawn, F.lit(5))))
        .when(kind == "iban", F.concat(F.substring(canon, 1, 2), F.substr(drawn, F.lit(3))))
        .when(kind.isin("given", "family"), name)
        .otherwise(drawn)
    )


def laid_out(kind: Column, entity: Column, drawn: Column) -> Column:
    """The surrogate in the place of an entity: with its separators, its case and what stands before a secret."""
    digits = F.transform(
        F.split(entity, ""),
        lambda c, i: F.when(c.rlike("[0-9A-Z]"), F.substr(drawn, F.length(F.regexp_replace(F.substr(entity, F.lit(1), i + 1), "[^0-9A-Z]", "")), F.lit(1))).otherwise(c),
    )
    rest = F.substr(drawn, F.length(F.regexp_replace(entity, "[^0-9A-Z]", "")) + 1)
    front = F.length(drawn) - F.length(entity)
    letters = F.transform(F.split(entity, ""), lambda c, i: F.when(c.rlike("[A-Z]"), F.upper(F.substr(drawn, front + i + 1, F.lit(1)))).otherwise(F.substr(drawn, front + i + 1, F.lit(1))))
    return (
        F.when(kind.isin("phone", "card", "ssn", "local_phone", "iban"), F.concat(F.array_join(digits, ""), rest))
        .when(kind == "email", F.concat(F.substr(drawn, F.lit(1), front), F.array_join(letters, "")))
        .when(kind == "secret", F.concat(F.regexp_extract(entity, f"^{HEAD}", 0), drawn))
        .when(kind.isin("given", "family"), F.regexp_replace(drawn, "^[a-z]+:", ""))
        .otherwise(drawn)
    )


def _struct(lead: Column, kind: Column | str, canon: Column, entity: Column, last: bool) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(lead.alias("lead"), kind.alias("kind"), canon.alias("canon"), entity.alias("entity"), F.lit(last).alias("last"))


def pieces(kind: Column, entity: Column) -> Column:
    """The entities of one match: itself, or of a name the given and the family name. Each has what
    stands before it in the match, and the last one is marked."""
    title = F.regexp_extract(entity, f"^{NAME_HEAD}", 0)
    own = F.substr(entity, F.length(title) + 1)
    family = F.element_at(F.split(own, " "), -1)
    given = F.when(own != family, F.element_at(F.split(own, " "), 1))
    middle = F.substr(own, F.length(given) + 1, F.length(own) - F.length(given) - F.length(family))
    titled = lambda g: title.rlike("(?:^| )(?:" + "|".join(TITLES[g]) + ")\\.? ")
    by_title = F.when(titled("female"), "female").when(titled("male"), "male")
    listed = F.when(given.isin(*GIVEN["female"]), "female").when(given.isin(*GIVEN["male"]), "male")
    gender = F.coalesce(listed, by_title, F.lit("neutral"))
    own_gender = F.when(family.rlike("[А-яё]"), F.coalesce(by_title, listed, F.lit("neutral"))).otherwise("neutral")
    last = _struct(F.coalesce(middle, title), "family", F.concat(own_gender, F.lit(":"), family), family, True)
    first = _struct(title, "given", F.concat(gender, F.lit(":"), given), given, False)
    whole = _struct(F.lit(""), kind, canonical(kind, entity), entity, True)
    return F.when(kind != "name", F.array(whole)).when(given.isNull(), F.array(last)).otherwise(F.array(first, last))


def entities(matched: DataFrame) -> DataFrame:
    """key (of the text), at and part (positions among the text's matches and in one), of (the match's
    type), lead, kind, canon, entity and last. ``matched``: key and found, once for each text."""
    rows = matched.select("key", F.posexplode("found").alias("at", "match"))
    rows = rows.withColumn("of", F.coalesce(kind_of(F.col("match")), F.lit("other")))
    rows = rows.select("key", "at", "of", F.posexplode(pieces(F.col("of"), F.col("match"))).alias("part", "p")).select("key", "at", "of", "part", "p.*")
    # a given name of no known gender has that of its other mentions, if they agree
    name = F.regexp_extract("canon", "^[a-z]+:(.*)$", 1)
    known = rows.filter((F.col("kind") == "given") & ~F.startswith("canon", F.lit("neutral:"))).select(name.alias("same"), F.col("canon").alias("gendered"))
    known = known.groupBy("same").agg(F.min("gendered").alias("gendered"), F.max("gendered").alias("other")).filter("gendered = other").drop("other")
    asked = F.when((F.col("kind") == "given") & F.startswith("canon", F.lit("neutral:")), name)
    rows = rows.withColumn("asked", asked)
    met = rows.filter("asked IS NOT NULL").join(known, F.col("asked") == F.col("same"), "left").withColumn("canon", F.coalesce("gendered", "canon")).drop("same", "gendered")
    return rows.filter("asked IS NULL").unionByName(met).drop("asked")


def assigned(found: DataFrame, key: str, tables: Tables, rounds: int = 64) -> DataFrame:
    """kind, canon and surrogate of each distinct entity, free of collisions."""
    drawn = lambda df: df.withColumn("surrogate", surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key))
    known = tables(found.select("kind", "canon").distinct().withColumn("attempt", F.lit(0)), "known")
    parts = known.count() // 2000 + 8  # drawing takes time, not bytes, so rows are dealt by their number
    state = tables(drawn(known.repartition(parts, "kind", "canon")), "surrogates")
    for _ in range(rounds):
        real = state.select(F.col("kind").alias("_kind"), F.col("canon").alias("_canon"))
        rank = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("attempt", "canon"))
        judged = state.withColumn("rank", rank).join(real, (F.col("kind") == F.col("_kind")) & (F.col("surrogate") == F.col("_canon")), "left")
        bad = (F.col("rank") > 1) | F.col("_canon").isNotNull()
        judged = tables(judged.select("kind", "canon", "attempt", "surrogate", bad.alias("bad")), "judged")
        if judged.filter("bad").isEmpty():
            return judged.select("kind", "canon", "surrogate")
        again = drawn(judged.filter("bad").select("kind", "canon", F.col("attempt") + 1).toDF("kind", "canon", "attempt").repartition(parts, "kind", "canon"))
        state = tables(judged.filter("NOT bad").drop("bad").unionByName(again), "surrogates")
    raise ValueError("some formats have fewer surrogates than entities")


def _marked(docs: DataFrame, text: str) -> DataFrame:
    """row (all columns but the text), content, key, found (the matches) and parts (what stands
    between them). The pattern runs once over each text that may have a match, and once more over
    those that have one; exploding an array of one row keeps Catalyst from repeating it."""
    none = F.array().cast("array<string>")
    rows = docs.select(kept_row(docs, text, "n_entities", "kinds"), F.col(text).alias("content"), F.unhex(text_key(F.col(text))).alias("key"))
    found = F.when(F.coalesce(may_have(F.col("content")), F.lit(False)), F.regexp_extract_all("content", F.lit(PATTERN), F.lit(0))).otherwise(none)
    rows = rows.select("row", "content", "key", F.explode(F.array(found)).alias("found"))
    return rows.withColumn("parts", F.when(F.size("found") > 0, F.split("content", PATTERN, -1)))


def pseudonymise(docs: DataFrame, *, key: str, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in its text, and n_entities (matches) and kinds (sorted, distinct)."""
    if not key:
        raise ValueError("a key is needed")
    marked = written(_marked(docs, text), "marked")
    with Tables(docs.sparkSession) as tables:
        found = tables(entities(marked.filter(F.size("found") > 0).groupBy("key").agg(F.first("found").alias("found"))), "entities")
        named = found.join(assigned(found, key, tables), ["kind", "canon"])
        named = named.withColumn("new", F.concat("lead", laid_out(F.col("kind"), F.col("entity"), F.col("surrogate"))))
        lists = named.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "part", "last", "new"))).alias("new"), F.array_sort(F.collect_set("of")).alias("kinds"))
        lists = written(lists, "replacements")
    after = F.transform(F.col("new"), lambda s: F.concat(s["new"], F.when(s["last"], F.get("parts", s["at"] + 1)).otherwise("")))
    replaced = F.concat(F.get("parts", F.lit(0)), F.array_join(after, ""))

    def rows(part: DataFrame, content: Column, kinds: Column) -> DataFrame:
        columns = [content.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in ("n_entities", "kinds")]
        return part.select(*columns, F.size("found").alias("n_entities"), kinds.alias("kinds"))

    none = rows(marked.filter(F.size("found") == 0), F.col("content"), F.array().cast("array<string>"))
    return none.unionByName(rows(marked.filter(F.size("found") > 0).join(lists, "key"), replaced, F.col("kinds")))
