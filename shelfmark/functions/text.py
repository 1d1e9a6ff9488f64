"""Titles, names, issue labels and review texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters a search key drops.
_DROPPED = " -.,\"'/:!"
# A marker that is dropped whole.
_MARKER = "[sam]"
# Roman numerals and the digits that may stand for them.
NUMERALS = {"II": 2, "III": 3, "IV": 4, "V": 5, "VI": 6, "VII": 7, "VIII": 8}
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)


def text(column: Column | str) -> Column:
    """Explicit cast to string: numbers and texts must not mix implicitly."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("string")


def or_mark(column: Column | str, mark: str) -> Column:
    return F.coalesce(text(column), F.lit(mark))


def name_key(name: Column | str) -> Column:
    """Search key of a name: lower case without blanks, punctuation and brackets."""
    return F.translate(F.lower(name), _DROPPED + "[]", "")


def title_key(title: Column | str) -> Column:
    """Search key of a title: like a name, and without its platform marker."""
    bare = F.translate(F.lower(title), _DROPPED, "")
    return F.translate(F.replace(bare, F.lit(_MARKER), F.lit("")), "[]", "")


def title_variants(title: Column) -> Column:
    """The title and one copy per roman numeral that stands as a word, with that numeral as a digit.

    Whether a copy exists depends on the numeral as a word, but the copy then changes every
    occurrence after a blank, also at the start of a longer word.
    """
    copies = [
        F.when(
            title.rlike(f" {roman}[ ,:+]") | title.endswith(f" {roman}"),
            F.replace(title, F.lit(f" {roman}"), F.lit(f" {digit}")),
        )
        for roman, digit in NUMERALS.items()
    ]
    return F.filter(F.array(title, *copies), lambda t: t.isNotNull())


def month_name(month: Column | str) -> Column:
    month = F.col(month) if isinstance(month, str) else month
    names = F.array(*[F.lit(m) for m in MONTHS])
    return F.when(month.between(1, 12), F.element_at(names, month.cast("int")))


def issue_name(volume="volume", number="number", year="date_year", month="date_month", day="date_day",
               special="special", supplement="supplement") -> Column:
    """``v.V #N - Y/Mon/D special "…" supplement "…"`` with the parts that exist."""
    def part(column: str, *pieces: Column) -> Column:
        return F.when(F.col(column).isNotNull(), F.concat(*pieces)).otherwise(F.lit(""))

    of_day = part(day, F.lit("/"), text(day))
    of_month = part(month, F.lit("/"), F.left(month_name(month), F.lit(3)), of_day)
    return F.trim(F.concat(
        part(volume, F.lit("v."), text(volume)),
        part(number, F.lit(" #"), text(number)),
        part(year, F.lit(" - "), text(year), of_month),
        part(special, F.lit(' special "'), F.col(special), F.lit('"')),
        part(supplement, F.lit(' supplement "'), F.col(supplement), F.lit('"')),
    ))


def issue_reference(magazine, number, year, month, page) -> Column:
    """``magazine #nnn y/m page p`` with question marks for what is unknown."""
    return F.concat(
        F.col(magazine), F.lit(" #"), F.coalesce(F.lpad(text(number), 3, "0"), F.lit("?")), F.lit(" "),
        or_mark(year, "?"), F.lit("/"), or_mark(month, "?"), F.lit(" page "), text(page),
    )


def last_segment(path: Column | str) -> Column:
    return F.substring_index(path, "/", -1)


def clean_page(page: Column | str) -> Column:
    """Page before the first comma or dot, without its supplement mark; NULL when nothing is left."""
    bare = F.replace(F.replace(page, F.lit("(Supplement)"), F.lit("")), F.lit("."), F.lit(","))
    return F.nullif(F.trim(F.substring_index(bare, ",", 1)), F.lit(""))


def on_supplement(page: Column | str) -> Column:
    page = F.col(page) if isinstance(page, str) else page
    return F.coalesce(page.endswith("(Supplement)"), F.lit(False))


def clean_text(column: Column | str, breaks: str | None = None) -> Column:
    """Without carriage returns; ``breaks`` becomes four newlines; empty becomes NULL."""
    out = F.replace(column, F.lit("\r"), F.lit(""))
    if breaks:
        out = F.replace(out, F.lit(breaks), F.lit("\n" * 4))
    return F.nullif(out, F.lit(""))


def trim_newlines(column: Column | str, trailing: int) -> Column:
    """Drop one leading newline and up to ``trailing`` ones at the end."""
    return F.regexp_replace(F.regexp_replace(column, r"\A\n", ""), rf"\n{{1,{trailing}}}\z", "")


def score_label(score: Column | str, suffix: Column | str) -> Column:
    def bare(column):
        return F.coalesce(F.trim(column), F.lit(""))

    return F.nullif(F.concat(bare(score), bare(suffix)), F.lit(""))


def link_from_mask(mask: Column | str, values: dict[str, Column | str]) -> Column:
    """Fill a link mask such as ``/{y4}/{i3}/{p2}``.

    ``values`` maps mask letters to columns: ``i v y m d p e`` are numbers padded to at least the given
    width, ``M`` is a month number shown as a name cut to that many letters, ``s`` and ``u`` are texts
    preceded by ``#``. An unknown value leaves nothing.
    """
    mask = F.col(mask) if isinstance(mask, str) else mask
    columns = {k: F.col(v) if isinstance(v, str) else v for k, v in values.items()}

    def filled(token: Column) -> Column:
        letter = F.substring(token, 2, 1)
        width = F.regexp_extract(token, r"(\d+)", 1).cast("int")
        shown = F.lit("")
        for key, column in columns.items():
            if key in "su":
                value = F.concat(F.lit("#"), column)
            elif key == "M":
                value = F.left(month_name(column), width)
            else:
                plain = column.cast("string")
                value = F.lpad(plain, F.greatest(width, F.length(plain)), F.lit("0"))
            shown = F.when(letter == key, F.coalesce(value, F.lit(""))).otherwise(shown)
        return shown

    tokens = F.regexp_extract_all(mask, F.lit(rf"\{{[{''.join(columns)}]\d+\}}"), 0)
    return F.aggregate(tokens, mask, lambda acc, token: F.replace(acc, token, filled(token)))
