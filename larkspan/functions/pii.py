"""Detection and masking of personal data that a pattern can recognise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category to pattern, in masking order. Patterns avoid lookaround
# so that any regular-expression engine reads them the same way.
PATTERNS: dict[str, str] = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "IP_ADDRESS": r"\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b",
    "PHONE_NUMBER": r"\+[0-9]{1,2} \([0-9]{3}\) [0-9]{3}-[0-9]{4}",
    "PAYMENT_CARD_DATA": r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b",
    "NATIONAL_ID": r"\b(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{4} [0-9]{4} [0-9]{4})\b",
    "TAX_IDENTIFIER": r"\b[A-Z]{5}[0-9]{4}[A-Z]\b",
    "DATE_OF_BIRTH": r"\b[0-9]{1,2}[/-][0-9]{1,2}[/-](?:19|20)[0-9]{2}\b",
    "PASSPORT": r"\b[A-Z][0-9]{7,8}\b",
    "DRIVERS_LICENSE": r"\b[A-Z]{2}[0-9]{2} ?[0-9]{11}\b",
    "AGE": r"\b[0-9]{1,3}[ -]years?[ -]old\b",
    "ADDRESS": r"\b[0-9]{1,5} (?:[A-Z][a-z]+ ){1,3}(?:Street|Avenue|Road|Boulevard|Lane|Drive)\b",
    "GENDER": r"\b(?:male|female|non-binary)\b",
    "NAME": r"\b(?:Mr|Mrs|Ms|Dr)\.? [A-Z][a-z]+(?: [A-Z][a-z]+)?\b",
}
CATEGORIES = list(PATTERNS)


def validate(categories: list[str] | None) -> list[str]:
    """Requested categories in masking order; an unknown name is an error."""
    if categories is None:
        return CATEGORIES
    unknown = sorted(set(categories) - set(CATEGORIES))
    if unknown:
        raise ValueError(f"unsupported categories: {', '.join(unknown)}")
    return [c for c in CATEGORIES if c in categories]


def pattern(category: str) -> str:
    return PATTERNS[category]


def redact(text: Column, categories: list[str] | None = None) -> Column:
    """Each detected value replaced by `[CATEGORY]`."""
    out = text
    for c in validate(categories):
        out = F.regexp_replace(out, pattern(c), f"[{c}]")
    return out


def matches(text: Column, category: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern(category)), F.lit(0))


def detect(text: Column, categories: list[str] | None = None) -> Column:
    """array<struct<category, text, start, end>> with overlaps resolved.

    Offsets count characters from 0. Where two categories overlap, the longer
    value wins, then the category that comes first in masking order.
    """
    found = F.concat(*[_spans(text, c, i) for i, c in enumerate(validate(categories))])
    by_length = F.array_sort(
        F.transform(
            found,
            lambda s: F.struct(
                (-(s["end"] - s["start"])).alias("neg_len"), s["rank"].alias("rank"), s["start"].alias("start"),
                s["end"].alias("end"), s["category"].alias("category"), s["text"].alias("text"),
            ),
        )
    )
    empty = F.slice(by_length, 1, 0)
    kept = F.aggregate(
        by_length,
        empty,
        lambda acc, s: F.when(
            F.exists(acc, lambda a: (a["start"] < s["end"]) & (s["start"] < a["end"])), acc
        ).otherwise(F.concat(acc, F.array(s))),
    )
    spans = F.transform(
        kept,
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["category"].alias("category"), s["text"].alias("text")),
    )
    return F.array_sort(spans)


def _spans(text: Column, category: str, rank: int) -> Column:
    """Matches of one category with offsets: the k-th match starts after the
    k-th piece of the text around the matches."""
    hits = matches(text, category)
    pieces = F.split(text, pattern(category), -1)
    steps = F.filter(F.arrays_zip(pieces.alias("piece"), hits.alias("hit")), lambda s: s["hit"].isNotNull())
    start = F.struct(
        F.lit(0).alias("pos"), F.expr("cast(array() as array<struct<category:string,text:string,start:int,end:int,rank:int>>)").alias("out")
    )

    def step(acc, s):
        begin = acc["pos"] + F.length(s["piece"])
        end = begin + F.length(s["hit"])
        row = F.struct(
            F.lit(category).alias("category"), s["hit"].alias("text"), begin.alias("start"), end.alias("end"), F.lit(rank).alias("rank")
        )
        return F.struct(end.alias("pos"), F.concat(acc["out"], F.array(row)).alias("out"))

    return F.when(F.size(hits) > 0, F.aggregate(steps, start, step, lambda acc: acc["out"])).otherwise(start["out"])
