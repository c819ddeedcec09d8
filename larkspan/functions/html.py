"""HTML to plain text or Markdown as chains of regular-expression columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (pattern, replacement) in the order they are applied.
DROP_BLOCKS = [
    (r"(?is)<script[^>]*>.*?</script>", " "),
    (r"(?is)<style[^>]*>.*?</style>", " "),
    (r"(?is)<nav[^>]*>.*?</nav>", " "),
    (r"(?s)<!--.*?-->", " "),
]
TO_MARKDOWN = [
    (r"(?i)<h1[^>]*>", "\n# "),
    (r"(?i)<h2[^>]*>", "\n## "),
    (r"(?i)<h3[^>]*>", "\n### "),
    (r"(?i)<h[456][^>]*>", "\n#### "),
    (r"(?i)<li[^>]*>", "\n- "),
    (r"(?i)<t[dh][^>]*>", " | "),
    (r"(?i)<tr[^>]*>", "\n"),
    (r"(?i)</?p[^>]*>", "\n"),
    (r"(?i)<br[^>]*>", "\n"),
    (r"(?i)</(h[1-6]|ul|ol|table|div|title)>", "\n"),
]
DROP_TAGS = [(r"(?s)<[^>]*>", " ")]
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
SQUEEZE_ALL = [(r"\s+", " ")]
SQUEEZE_LINES = [(r"[ \t]+", " "), (r" ?\n ?", "\n"), (r"\n\n+", "\n\n")]

TEXT_STEPS = DROP_BLOCKS + DROP_TAGS + ENTITIES + SQUEEZE_ALL
MARKDOWN_STEPS = DROP_BLOCKS + TO_MARKDOWN + DROP_TAGS + ENTITIES + SQUEEZE_LINES


def apply_steps(html: Column, steps: list[tuple[str, str]]) -> Column:
    out = html
    for pattern, replacement in steps:
        out = F.regexp_replace(out, pattern, replacement)
    return F.btrim(out, F.lit(" \n"))


def html_to_text(html: Column) -> Column:
    return apply_steps(html, TEXT_STEPS)


def html_to_markdown(html: Column) -> Column:
    return apply_steps(html, MARKDOWN_STEPS)


def steps_as_sql(column: str, steps: list[tuple[str, str]]) -> str:
    """The same chain in standard SQL, used to check the columns above."""
    out = column
    for pattern, replacement in steps:
        p, r = pattern.replace("'", "''"), replacement.replace("'", "''")
        out = f"regexp_replace({out}, '{p}', '{r}', 'g')"
    return f"trim({out}, chr(32) || chr(10))"
