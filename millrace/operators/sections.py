"""Required and optional skills of a demand's text: a table-driven scan of its lines.

Lines are classed by the first rule that matches; state and class look up what to do in ``MOVES``. Inside a
section a stack holds the list heads above a line ("one of the following: design"), by their indentation, and short items
below a head get its phrase. The rules, the words and the table are data; a pack may replace each."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import bounded

NONE, REQUIRED, OPTIONAL, DONE = "none", "required", "optional", "done"

#: Line classes in order of precedence: (class, pattern).
RULES = (
    ("required", r"^\W*(?:required|must|mandatory|必須)[^\n:]{0,20}?(?:skills?|conditions?|スキル|条件|要件)?\W*$|^\W*(?:required(?: skills?)?|must(?: have)?|必須(?:スキル|条件|要件)?)\W*:"),
    ("optional", r"^\W*(?:preferred|optional|nice to have|尚可|歓迎)[^\n:]{0,20}?(?:skills?|スキル|条件|要件)?\W*$|^\W*(?:preferred(?: skills?)?|nice to have|optional(?: skills?)?|(?:尚可|歓迎)(?:スキル|条件|要件)?)\W*:"),
    ("hard_stop", r"^\s*(?:[-=_*━─]{3,}|best regards|kind regards|sincerely|以上(?:です|、|$)|(?:何卒)?(?:宜|よろ)しくお願い)"),
    ("soft_stop", r"^\W*(?:location|period|rate|price|remarks?|interviews?|contract|settlement|勤務地|場所|期間|時期|単価|備考|面談|精算|商流|契約|募集|人数|年齢|国籍)[^\n:]{0,6}\W*(?::|$)|^\s*[【\[■◆][^】\]]{1,12}[】\]]?"),
    ("head", r"^\W*(?:(?:any|one|some) of the following|(?:以下|下記)の?(?:いずれか|うち))"),
    ("element", r"^\W*(?:technical elements?|tech stack|技術要素|使用技術)\s*:"),
    ("desirable", r"(?:尚(?:可|良)い?|歓迎|望ましい|あればよい|is a plus|preferred|desirable)\W*$"),
    ("skip", r"^\W*$|^\W*(?:※|\(注|note:)|(?:ご提案|ご連絡|ご返信|お願い(?:致|いた)?します)"),
)
#: What is no item wherever it stands: explanations, questions, fields.
REJECTED = r"(?:下さい|ください|お待ちして|ございます|となります|いかがでしょうか|thank you|please)\W*$|^\W*(?:例|e\.g\.)\W*:?$|https?://|@"
BULLET = re.compile(r"^\s*(?:[-*・•●○■□◆◇▪]|[0-9]{1,2}[.)]|[(][0-9]{1,2}[)])\s*(.+)$")
#: Words by which a line without a bullet is told to be an item.
TECHNICAL = r"[A-Za-z][A-Za-z0-9+#./-]+|経験|知識|開発|設計|構築|運用|保守|実装|試験|テスト|要件定義|プログラ|データ|サーバ|ネットワーク|スキル"
PERSONAL = r"コミュニケーション|協調|主体|積極|責任|勤怠|調整|報連相|顧客折衝"
#: Words of a résumé: a mail with several of them is a supply's, and has no demands.
RESUME = ("職務経歴", "自己PR", "学歴", "取得資格", "保有資格", "生年月日", "最終学歴", "経歴書", "志望動機", "curriculum vitae", "work history", "education history")

#: (state, class): (next state, what is done). A class that isn't listed for a state does nothing.
MOVES = {
    **{(s, c): (c, "inline") for s in (NONE, REQUIRED, OPTIONAL) for c in (REQUIRED, OPTIONAL)},
    (NONE, "desirable"): (NONE, "add_optional"),
    (NONE, "element"): (NONE, "add_element"),
    **{(s, "soft_stop"): (NONE, None) for s in (REQUIRED, OPTIONAL)},
    **{(s, "hard_stop"): (DONE, None) for s in (REQUIRED, OPTIONAL)},
    **{(s, "head"): (s, "push") for s in (REQUIRED, OPTIONAL)},
    **{(s, c): (s, "item") for s in (REQUIRED, OPTIONAL) for c in ("content", "desirable", "element")},
}


@dataclass(frozen=True)
class Sections:
    rules: Sequence[tuple[str, str]] = RULES
    moves: dict = field(default_factory=lambda: dict(MOVES))
    rejected: str = REJECTED
    technical: str = TECHNICAL
    personal: str = PERSONAL
    resume: Sequence[str] = RESUME
    resume_words: int = 3
    longest: int = 80

    def scanner(self) -> Scanner:
        return Scanner(self)


class Scanner:
    """Compiled ``Sections``; reads one text at a time."""

    def __init__(self, pack: Sections):
        self.pack = pack
        self.classes = [(k, re.compile(p, re.IGNORECASE)) for k, p in pack.rules]
        self.rejected, self.technical, self.personal = (re.compile(p, re.IGNORECASE) for p in (pack.rejected, pack.technical, pack.personal))

    def kind(self, line: str) -> str:
        return next((k for k, p in self.classes if p.search(line)), "content")

    def is_resume(self, text: str) -> bool:
        low = text.lower()
        return sum(w.lower() in low for w in self.pack.resume) >= self.pack.resume_words

    def item(self, line: str) -> str | None:
        """The item that a line of a section is: any bullet line, or a short one with a word that tells."""
        bullet = BULLET.match(line)
        said = (bullet[1] if bullet else line).strip()
        if not said or self.rejected.search(said):
            return None
        if bullet:
            return said
        short, indented = len(said) <= self.pack.longest, line[:1].isspace()
        listed = short and 1 <= len(re.findall("[,、/]", said)) <= 5 and not re.search("[。.]$", said)
        return said if short and (self.technical.search(said) or (indented and self.personal.search(said)) or listed) else None

    def scan(self, text: str | None) -> tuple[list[str], list[str]]:
        """(required, optional), each item once."""
        text = unicodedata.normalize("NFKC", html.unescape(text or ""))
        found: dict[str, list[str]] = {REQUIRED: [], OPTIONAL: []}
        if self.is_resume(text):
            return [], []
        state, heads = NONE, []
        for line in text.split("\n"):
            kind = self.kind(line)
            bullet = BULLET.match(line)
            if kind == "soft_stop" and bullet and state != NONE and not line.rstrip().endswith(":") and ":" not in line:
                kind = "content"  # a bullet that begins with a field's word
            state, action = self.pack.moves.get((state, kind), (state, None))
            if state == DONE:
                break
            indent = len(line) - len(line.lstrip())
            if action == "inline":
                heads = []
                for part in re.split("[・•]", line.split(":", 1)[1] if ":" in line else ""):
                    if part.strip() and not self.rejected.search(part):
                        found[state].append(part.strip())
            elif action == "add_optional":
                found[OPTIONAL] += [x for x in [self.item(line)] if x]
            elif action == "add_element":
                found[REQUIRED] += [x for x in [line.split(":", 1)[1].strip()] if x]
            elif action == "push":
                heads = [h for h in heads if h[0] < indent] + [(indent, line.split(":", 1)[1].strip() if ":" in line else "")]
            elif action == "item":
                said = self.item(line)
                if said:
                    heads = [h for h in heads if h[0] < indent or (h[0] == indent and bullet and not heads[-1][0] < indent and h[1] == "")]
                    phrase = next((p for _, p in reversed(heads) if p), "")
                    if phrase and phrase not in said and len(said) + len(phrase) < self.pack.longest:
                        said = f"{said} {phrase}"
                    found[state].append(said)
        return list(dict.fromkeys(found[REQUIRED])), list(dict.fromkeys(found[OPTIONAL]))


SCHEMA = "required_skills array<string>, optional_skills array<string>"


def scan(pack: Sections | None = None):
    """A column function: text to a struct of required_skills and optional_skills; also to register for SQL."""
    pack = pack or Sections()

    @F.pandas_udf(SCHEMA)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = pack.scanner()
        for series in batches:
            yield pd.DataFrame([scanner.scan(x if isinstance(x, str) else None) for x in series], columns=["required_skills", "optional_skills"])

    return run


def sectioned(df: DataFrame, *, text: str = "text", pack: Sections | None = None) -> DataFrame:
    """``df`` with required_skills and optional_skills; a null text has none."""
    return bounded(df).withColumn("_s", scan(pack)(F.col(text))).select(*df.columns, "_s.*")


# signatures -----------------------------------------------------------------------------------------

#: Lines of a signature: what only it has, what it may have, and rules between.
STRONG = "TEL|Tel|電話|FAX|携帯|〒|[A-Za-z0-9._-]+@[A-Za-z0-9-]+\\."
WEAK = "会社|社\\s*$|(?:部|課|室|グループ)\\s*$|担当|営業|住所|[都道府県].{1,6}[市区町村]|ビル|https?://|URL|免許|許可"
RULE = "^[\\s=_*━─~+-]{3,}$"


@dataclass(frozen=True)
class Signature:
    """How a signature is told: from its last ``strong`` line, ``least`` lines or more behind the last case header, it goes
    back over strong, ``weak``, blank and ruled lines, ``back`` lines at most. Nothing is cut where the part to be
    cut has a ``label`` with a colon, or where nothing would be left."""

    header: str = "案件"
    strong: str = STRONG
    weak: str = WEAK
    least: int = 5
    back: int = 20
    label: str = "単価|期間|勤務地|必須|作業内容"

    def trim(self, text: str) -> str:
        lines = text.split("\n")
        last = lambda pattern, below: next((i for i in range(below - 1, -1, -1) if re.search(pattern, lines[i])), -1)
        end, head = last(self.strong, len(lines)), last(self.header, len(lines))
        if end < 0 or end - head < self.least:
            return text
        soft, first = re.compile(f"{self.strong}|{self.weak}|{RULE}|^\\s*$"), end
        while first - 1 > head and end - first < self.back and soft.search(lines[first - 1]):
            first -= 1
        if first <= 0 or any(re.search(f"(?:{self.label})[^\n]{{0,6}}:", x) for x in lines[first:]):
            return text
        return "\n".join(lines[:first])


def trim_signature(text: Column, header: str = "案件", strong: str = STRONG, **more) -> Column:
    """The text without its signature; null stays null."""
    rule = Signature(header, strong, **more)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(rule.trim, na_action="ignore")

    return run(text)
