"""Rules on free-text notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .registry import Tables, base, row_rule


@base("notes")
def notes_base(t: Tables) -> DataFrame:
    notes = t["notes"].select(F.col("entry_id").alias("of"), "text")
    entries = t["entries"].select(F.col("id").alias("entry_id"), "title")
    return notes.join(entries, notes["of"] == entries["entry_id"], "left")


def note() -> Column:
    return F.col("text")


def _on_known_entry(start: str) -> Column:
    return note().startswith(start) & F.col("entry_id").isNotNull()


@row_rule("malformed_note_reference", "malformed reference to another entry in notes", "notes", note)
def _() -> Column:
    # n bracket pairs must be n references of three parts, for one, two and three of them.
    broken = note().rlike(r"[a-zA-Z]\}")
    for n in (1, 2, 3):
        broken |= note().like("%{%}" * n + "%") & ~note().like("%{%|%|%}" * n + "%")
    return broken


@row_rule("compilation_note", "** programs in compilation must be indexed properly", "notes", note)
def _() -> Column:
    return note().like("[%+%]")


@row_rule("alias_note", "** aliases must be indexed properly", "notes", note)
def _() -> Column:
    return note().startswith("aka. ") | note().startswith("a.k.a. ")


@row_rule("note_is_license", "** note probably conversible to license", "notes", note)
def _() -> Column:
    return _on_known_entry("Based")


@row_rule("note_is_compilation", "** note to be converted into compilation or relation", "notes", note)
def _() -> Column:
    return _on_known_entry("Came")


@row_rule("note_is_relation", "** note to be converted into relation", "notes", note)
def _() -> Column:
    return _on_known_entry("Almost")
