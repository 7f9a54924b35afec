"""Text expressions: words, line elements, text of a web page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r"
BLANK_RUN = "[ \\t\\n\\r]+"

UNKNOWN_CATEGORY = "Unknown"
TITLE_MAX_CHARS = 80

# Markup that goes away as a whole, in this order; each match becomes a blank. Per
# kind: the text that ends it, the pattern, what takes its place. Elements are looked
# for once between two ``>``: of several openings there the first is the one that
# counts, and group 1 is what stands before it.
_ELEMENT = "(?s)(?<![^>])(?>([^>]*?)<{0})[^>]*+>.*?</{0}>"
PAGE_MARKUP = (
    ("</script>", _ELEMENT.format("script"), "$1 "),
    ("</style>", _ELEMENT.format("style"), "$1 "),
    ("-->", "(?s)<!--.*?-->", " "),
    (">", "<[^>]*>", " "),
)

# Character references; the ampersand comes last so that nothing is decoded twice.
PAGE_ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
)


def split_words(text: Column) -> Column:
    """Words of a text; the empty list for a text of blanks only."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, BLANK_RUN)
    )


def trim_line(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def element_category(line: Column) -> Column:
    """Category of one trimmed line."""
    return (
        F.when(line.rlike("^([-*]|[0-9]+[.]) "), F.lit("ListItem"))
        .when(
            (F.length(line) <= TITLE_MAX_CHARS) & ~line.endswith("."), F.lit("Title")
        )
        .otherwise(F.lit("NarrativeText"))
    )


def without_markup(text: Column, end: str, pattern: str, by: str) -> Column:
    """``text`` with ``by`` in place of each match of a pattern that closes with ``end``.

    Nothing can match beyond the last ``end``, so only the text before it is
    searched: an opening without an end never costs a scan of the rest.
    """

    def replaced(whole: Column) -> Column:
        tail = F.substring_index(whole, end, -1)
        head = F.left(whole, F.length(whole) - F.length(tail))
        return F.concat(F.regexp_replace(head, pattern, by), tail)

    return F.element_at(F.transform(F.array(text), replaced), 1)


def page_text(html: Column) -> Column:
    """Readable text of a web page, in time linear in its length."""
    text = html
    for end, pattern, by in PAGE_MARKUP:
        text = without_markup(text, end, pattern, by)
    for reference, character in PAGE_ENTITIES:
        text = F.replace(text, F.lit(reference), F.lit(character))
    return F.btrim(F.regexp_replace(text, BLANK_RUN, " "), F.lit(" "))
