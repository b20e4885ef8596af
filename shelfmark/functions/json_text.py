"""Column helpers for the JSON projections the reports use (all JVM-side expressions).

Every helper takes and returns a ``Column``; none of them runs Python per row.  They
reproduce how the source database prints JSON values as text, which is what the
report columns contain:

* ``pg_array_text``: a JSON array of strings printed as ``["a", "b"]`` (comma *and*
  blank; JSON escapes kept), from which the reports strip brackets and quotes.
* ``path_array`` / ``path_first``: ``$.arr[*].member`` -- elements without the
  member are skipped, and "first" means the first element that has it.
* ``notes_of_type`` / ``note_text`` / ``first_note``: filtered note paths.
* ``full_name``: ``NULLIF(CONCAT(first, ' ', last), ' ')`` with CONCAT's NULL-as-''.
* ``price_text``: default ``0.00`` and exactly one leading ``$``.
* ``identifiers_lazy`` / ``identifiers_greedy``: the two forms of the
  ``' : ... $9.99'`` clean-up (see SURVEY N10/N11).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Item note type ids named by the reports.
PRICE_NOTE = "1fceb11c-7a89-49d6-8ef0-2a42c58556a2"
PO_NUMBER_NOTE = "5ec4ca65-aacc-4f16-aa9d-395efd89f850"
STAFF_NOTE = "86e6410d-4c8b-4853-8054-bd5e563e9760"
CIRCULATION_NOTE = "5366d4d4-8775-4cf4-a00f-77c82f0ca3bf"
PUBLIC_NOTE = "b6b35579-ee2b-4973-8e0d-ebc05bab0dab"
OWNERSHIP_NOTE = "34207e4e-5cd7-4eab-801b-b0326cd5c66a"
INVENTORY_DATE_NOTE = "e1f34ba3-6d37-462e-878c-17f922b13d93"
INVOICE_NOTE = "8f99bd3a-706c-45d2-89d8-8eca7fa1c03f"

# The regular expressions of the reports.
BRACKETS_QUOTES = r'[\[\]"]'
PRICE_QUALIFIER_LAZY = r" :.*?\$\d+\.\d{2}"
# Inside a top-level alternation the source database matches greedily.
BRACKETS_QUOTES_OR_QUALIFIER_GREEDY = r'\[|\]|"| :.*\$\d+\.\d{2}'
LC_CALL_NUMBER = r"^[A-Z]{1,3}\s*[0-9]"


def _empty_strings() -> Column:
    return F.array().cast("array<string>")


def pg_array_text(arr: Column) -> Column:
    """``["a", "b"]`` for an array of strings; NULL (missing path) prints as ``[]``.

    Each element is rendered by the JSON writer (so quotes, backslashes and control
    characters are escaped exactly as in JSON text) and the elements are joined by
    ``', '`` as the source database prints a jsonb array.
    """
    def one(x: Column) -> Column:
        js = F.to_json(F.array(x))  # ["..."]
        return js.substr(F.lit(2), F.length(js) - 2)

    return F.concat(F.lit("["), F.array_join(F.transform(F.coalesce(arr, _empty_strings()), one), ", "),
                    F.lit("]"))


def path_array(arr: Column, member: str) -> Column:
    """``$.arr[*].member``: the member of every element that has it, in array order."""
    return F.filter(F.transform(arr, lambda x: x.getField(member)), lambda v: v.isNotNull())


def path_first(arr: Column, member: str) -> Column:
    """``jsonb_path_query_first(doc, '$.arr[*].member')``: first element having the member."""
    return F.get(path_array(arr, member), 0)


def notes_of_type(notes: Column, type_id: str) -> Column:
    """``$.notes[*] ? (@.itemNoteTypeId == type_id).note`` as an array of texts."""
    matching = F.filter(notes, lambda n: (n.getField("itemNoteTypeId") == F.lit(type_id))
                        & n.getField("note").isNotNull())
    return F.transform(matching, lambda n: n.getField("note"))


def strip_brackets_quotes(text: Column) -> Column:
    return F.regexp_replace(text, BRACKETS_QUOTES, "")


def note_text(notes: Column, type_id: str) -> Column:
    """All notes of one type joined as the reports print them; NULL when there is none."""
    return F.nullif(strip_brackets_quotes(pg_array_text(notes_of_type(notes, type_id))), F.lit(""))


def first_note(notes: Column, type_id: str) -> Column:
    return F.get(notes_of_type(notes, type_id), 0)


def full_name(first: Column, last: Column) -> Column:
    """``NULLIF(CONCAT(first, ' ', last), ' ')``: ``'Jane '`` keeps its blank, both NULL -> NULL."""
    return F.nullif(F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit(""))), F.lit(" "))


def price_text(notes: Column) -> Column:
    """First price note, ``0.00`` when absent, with exactly one leading ``$``."""
    return F.regexp_replace(F.coalesce(first_note(notes, PRICE_NOTE), F.lit("0.00")), r"^\$*", r"\$")


def array_member_text(arr: Column, member: str) -> Column:
    """Bracket-and-quote-free text of ``$.arr[*].member`` ('' when there is none)."""
    return strip_brackets_quotes(pg_array_text(path_array(arr, member)))


def identifiers_lazy(identifiers: Column) -> Column:
    """Identifier values without `` : ... $9.99`` qualifiers (non-greedy), then no brackets."""
    text = pg_array_text(path_array(identifiers, "value"))
    return F.nullif(strip_brackets_quotes(F.regexp_replace(text, PRICE_QUALIFIER_LAZY, "")), F.lit(""))


def identifiers_greedy(identifiers: Column) -> Column:
    """Same clean-up in one alternation, where the qualifier part is matched greedily."""
    text = pg_array_text(path_array(identifiers, "value"))
    return F.nullif(F.regexp_replace(text, BRACKETS_QUOTES_OR_QUALIFIER_GREEDY, ""), F.lit(""))


def pub_date(doc: Column, source: str) -> Column:
    """Greatest of the two publication dates of an instance document.

    ``source`` is ``'dates'`` (date1/date2) or ``'publicationPeriod'`` (start/end); the
    reports disagree on which member holds the dates, so each passes its own.
    """
    if source == "dates":
        return F.greatest(doc.getField("dates").getField("date1"), doc.getField("dates").getField("date2"))
    if source == "publicationPeriod":
        period = doc.getField("publicationPeriod")
        return F.greatest(period.getField("start"), period.getField("end"))
    raise ValueError(f"unknown publication date source {source!r}")
