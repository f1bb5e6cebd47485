"""Objects assigned in page scripts, by JVM regular expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the variable that holds the document's data.
APP_DATA = "window.__APP_DATA__"

# A match runs over everything up to the next script, or to the end of the page, and only the
# text of that script fills the group. Comments, raw text and tags are passed over whole, so that
# a script inside a comment, a title or an attribute is none. A quote counts only after "=".
# Possessive quantifiers never step back, which keeps the search linear and off the stack.
ATTRIBUTES = r"(?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+"
RAW = r"(?i:textarea|title|style)"
OPEN = r"(?i:script)(?=[\s/>])"
SCRIPT = (
    r"(?:[^<]++|<(?:"
    r"!--(?:[^-]++|-(?!->))*+"
    rf"|{RAW}(?=[\s/>]){ATTRIBUTES}(?:>(?:[^<]++|<(?!/{RAW}[\s/>]))*+)?+"
    rf"|(?!{OPEN})(?:/?[A-Za-z]{ATTRIBUTES}|[!?/][^>]*+)?+"
    r"))*+"
    rf"(?:<{OPEN}{ATTRIBUTES}(?:>((?:[^<]++|<(?!/(?i:script)[\s/>]))*+))?+|\z)"
)


def script_bodies(html: Column) -> Column:
    """Array of the text of all script elements, in page order."""
    return F.filter(F.regexp_extract_all(html, F.lit(SCRIPT), F.lit(1)), lambda body: body != "")


def first_capture(bodies: Column, marker: str, pattern: str) -> Column:
    """First text of group 1 of ``pattern`` in the bodies with ``marker``, NULL if there is none."""
    marked = F.filter(bodies, lambda body: F.contains(body, F.lit(marker)))
    hits = F.flatten(
        F.transform(marked, lambda body: F.regexp_extract_all(body, F.lit(pattern), F.lit(1)))
    )
    return F.get(F.filter(hits, lambda hit: hit != ""), F.lit(0))


def captured(html: Column, marker: str, pattern: str) -> Column:
    """``first_capture`` of a page's scripts; the page is only searched if it has the marker."""
    return F.when(F.contains(html, F.lit(marker)), first_capture(script_bodies(html), marker, pattern))


def assigned_object(html: Column, variable: str = APP_DATA) -> Column:
    """Text of the object assigned to ``variable``: from its brace to the last one on the line.

    Where no brace closes on the line, none does for a later assignment on it either, and the
    rest of the line is passed over. ``(?d)`` makes a line end at a line feed only; ``(?U)``
    counts all Unicode space as space.
    """
    name = "".join(c if c.isalnum() or c == "_" else "\\" + c for c in variable)
    return captured(html, variable, rf"(?dU){name}\s*+=\s*+(?:(\{{.*\}})|\{{.*+)")
