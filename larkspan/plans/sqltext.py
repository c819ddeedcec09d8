"""SQL fragments for the checks of the text jobs, built from the same fixed values."""

from __future__ import annotations

from larkspan import lexicons as lx
from larkspan.functions.pii import PATTERNS
from larkspan.functions.text import STOPWORDS, TOKEN_PATTERN


def in_list(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def toks(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{TOKEN_PATTERN}')"


def sents(text: str) -> str:
    return f"string_split(regexp_replace(trim({text}), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))"


def count_in(words: str, vocabulary) -> str:
    return f"len(list_filter({words}, lambda w: w IN {in_list(vocabulary)}))"


def weighted(words: str, weights: dict[str, float]) -> str:
    groups: dict[float, list[str]] = {}
    for w, s in weights.items():
        groups.setdefault(s, []).append(w)
    parts = [f"({s}::DOUBLE * {count_in(words, v)})" for s, v in sorted(groups.items())]
    return "(0.0::DOUBLE + " + " + ".join(parts) + ")" if parts else "0.0::DOUBLE"


def labels(words: str, topics) -> str:
    """list of {neg, label} sorted best first."""
    rows = ", ".join(f"{{'neg': -({weighted(words, w)}), 'label': '{n}'}}" for n, w in sorted(topics.items()))
    return f"list_sort(list_filter([{rows}], lambda r: r.neg < 0))"


def pos_neg(words: str, lexicon) -> tuple[str, str]:
    return (
        weighted(words, {w: s for w, s in lexicon.items() if s > 0}),
        weighted(words, {w: s for w, s in lexicon.items() if s < 0}),
    )


def sentiment(p: str, n: str) -> str:
    s = f"(({p} + {n}) / sqrt(({p} + {n}) * ({p} + {n}) + {lx.ALPHA}))"
    return (
        f"CASE WHEN {p} = 0 AND {n} = 0 THEN 'unknown' WHEN {p} > 0 AND {n} < 0 THEN 'mixed' "
        f"WHEN {s} >= {lx.LABEL_BOUND} THEN 'positive' WHEN {s} <= -{lx.LABEL_BOUND} THEN 'negative' ELSE 'neutral' END"
    )


def has(words: str, cues) -> str:
    return f"({count_in(words, cues)} > 0)"


def level(words: str, levels) -> str:
    cases = " ".join(f"WHEN {has(words, c)} THEN {n}" for n, c in sorted(levels.items(), reverse=True))
    return f"CAST(CASE {cases} ELSE 0 END AS INTEGER)"


def redact(text: str, categories=None) -> str:
    out = text
    for c in categories or list(PATTERNS):
        out = f"regexp_replace({out}, '{PATTERNS[c]}', '[{c}]', 'g')"
    return out


def claim_words(text: str) -> str:
    return f"list_filter({toks(text)}, lambda w: w NOT IN {in_list(STOPWORDS)})"


def covered(claim: str, evidence: str) -> str:
    return (
        f"len(list_filter({claim}, lambda w: len(list_filter({evidence}, lambda e: starts_with(e, left(w, 5)) "
        f"OR starts_with(w, left(e, 5)))) > 0)) / greatest(len({claim}), 1)"
    )


def numbers(text: str) -> str:
    return f"list_distinct(regexp_extract_all(replace({text}, ',', ''), '[0-9]+(?:\\.[0-9]+)?'))"
