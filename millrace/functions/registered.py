"""What SQL can call: ``register`` makes functions of a session of the normal form, the dictionary and section scans, and a
table function that explodes a text into its labelled lines."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

LABEL = re.compile(r"^[\W_]*([^\s:【】\[\]■◆●・][^:【】\[\]■◆●]{0,30}?)\s*[】\]]?\s*:\s*(.*)$")


class LabelledLines:
    """(at, label, value) for each line of a text that isn't blank; a line without a label has that of the
    last one above it, as far as no blank line is between."""

    def eval(self, text: str | None) -> Iterator[tuple[int, str | None, str]]:
        label = None
        for at, line in enumerate((text or "").split("\n")):
            if not line.strip():
                label = None
                continue
            hit = LABEL.match(line)
            if hit:
                label = hit[1].strip()
                if not hit[2].strip():
                    continue
            yield at, label, (hit[2] if hit else line).strip()


def register(spark: SparkSession, dictionary: Mapping[str, Sequence[str]] | None = None, pack=None) -> None:
    """nfkc(text); terms(text): array of the dictionary's terms; skills(text): struct of required_skills and
    optional_skills; labelled_lines(text): rows of (at, label, value), for ``LATERAL``."""
    from ..operators import sections
    from ..operators.annotate import Terms

    plain = {k: list(v) for k, v in (dictionary or {}).items()}

    @F.pandas_udf("string")
    def nfkc(texts: pd.Series) -> pd.Series:
        return texts.str.normalize("NFKC")

    @F.pandas_udf("array<string>")
    def terms(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Terms(plain)
        for texts in batches:
            yield pd.Series([list(dict.fromkeys(t for _, _, t in known.annotate(x))) if isinstance(x, str) else [] for x in texts], dtype=object)

    spark.udf.register("nfkc", nfkc)
    spark.udf.register("terms", terms)
    spark.udf.register("skills", sections.scan(pack))
    spark.udtf.register("labelled_lines", F.udtf(LabelledLines, returnType="at int, label string, value string"))
