"""Each rule on a few hand-written rows: some fire, some stay silent, some hold NULL."""

from __future__ import annotations

import pytest
from handmade import Handmade, rows

from shelfmark.plans.rules import REGISTRY, run_checks, run_rule
from shelfmark.plans.rules.magazines import pending_reviews
from shelfmark.plans.rules.tags import series_gaps

E = rows("id title", (1, "One"), (2, "Two"), (3, "Three"))
GENRES = rows("id text", (1, "Arcade"), (20, "Book: Game"), (30, "Hardware: Joystick"), (40, "Utility: Editor"),
              (50, "Programming: Compiler"), (52, "Game Editor"), (53, "Game Editor Data"), (80, "Compilation"),
              (81, "Covertape"), (82, "Electronic Magazine"), (85, "Demo: Scene"), (111, "Pack"))
MACHINES = rows("id text", (5, "Timex 2068"), (6, "Spectrum"))
LABELS = rows("id name labeltype_id owner_id", (1, "Ann", "+", None), (2, "Axe", "-", 1), (3, "Corp", "C", None),
              (4, "Blank", None, None), (5, "Aye", "-", 1), (6, "Nick", "-", 3), (7, "Solo", "-", None))
MAGS = rows("id name link_mask archive_mask", (1, "Mag", "/x", None), (2, "Zine", None, None), (3, "Late", None, "/y"))
ISSUES = rows("id magazine_id number date_year date_month", (1, 1, 7, 1985, 3), (2, 2, None, None, None))
K53 = "CSSCGC Crap Games Contest 1996"
K54 = "CSSCGC Crap Games Competition 1996"


def gone(*links, **more):
    """Downloads of entry 1 with the given links."""
    return [dict(id=i, entry_id=1, file_link=link, **more) for i, link in enumerate(links, 1)]


def notes(*texts):
    return [dict(entry_id=1, text=t) for t in texts] + [dict(entry_id=9, text=t) for t in texts[:1]]


# rule: (tables, expected (entry_id, details, occurrences))
CASES: dict[str, tuple[dict, list[tuple]]] = {
    "author_seq_gap": (
        dict(entries=E, authors=rows("entry_id author_seq", (1, 1), (1, 3), (1, 3), (2, 2), (2, 1), (3, 1), (9, 5))),
        [(1, "2", 2)]),
    "entry_without_release": (dict(entries=E, releases=rows("entry_id", 1, 1, 2)), [(3, "0", 1)]),
    "release_seq_gap": (
        dict(entries=E, releases=rows("entry_id release_seq", (1, 0), (1, 2), (2, 1), (3, 0), (3, 1))),
        [(1, "1", 1), (2, "0", 1)]),
    "library_title_mismatch": (
        dict(entries=rows("id title library_title", (1, "Game X", "Game Y"), (2, "Game X", "Game X"), (3, "A+B game", "A+B gome"),
                          (4, "Some", "Other"), (5, "Game Z", None))),
        [(1, "Game Y", 1)]),
    "contents_seq_gap": (
        dict(entries=E, contents=rows("container_id media_seq media_side prog_seq", (1, 1, "A", 1), (1, 1, "A", 3), (1, 1, "B", 2),
                                      (1, 2, "A", 1), (1, 2, "A", 2))),
        [(1, "1-A-2", 1), (1, "1-B-1", 1)]),
    "series_seq_missing": (
        dict(entries=E, tags=rows("id name tagtype_id", (1, "S", "S"), (2, "T", "T")),
             members=rows("tag_id entry_id series_seq", (1, 1, None), (1, 2, 1), (2, 3, None), (1, 9, None))),
        [(1, "S (1)", 1), (9, "S (1)", 1)]),
    "series_seq_gap": (
        dict(entries=E, tags=rows("id name tagtype_id", (1, "S", "S"), (2, "T", "T")),
             members=rows("tag_id entry_id series_seq", (1, 1, 1), (1, 2, 3), (1, 9, 3), (2, 1, 5), (2, 2, None))),
        [(2, "S (1)", 1), (9, "S (1)", 1)]),
    "seq_in_non_series": (
        dict(entries=E, tags=rows("id name tagtype_id", (1, "S", "S"), (2, "T", "T")),
             members=rows("tag_id entry_id series_seq", (1, 1, 1), (2, 2, 4), (2, 3, None))),
        [(2, "T (2)", 1)]),
    "publisher_seq_gap": (
        dict(entries=E, publishers=rows("entry_id release_seq publisher_seq", (1, 0, 1), (1, 0, 2), (1, 1, 2), (2, 0, 3))),
        [(1, "1", 1), (2, "2", 1)]),
    "malformed_note_reference": (
        dict(entries=E, notes=notes("see {1}", "{1|a|b}", "{1|a|b} and {2}", "{1|a|b} {2|c|d} {3|e|5}", "{1|2|3}", "{1|2|3} {4|5|6}",
                                    "{1|2|3}\n{4|5|6}\n{7|8}", "none")),
        [(1, "see {1}", 1), (1, "{1|a|b}", 1), (1, "{1|a|b} and {2}", 1), (1, "{1|a|b} {2|c|d} {3|e|5}", 1),
         (1, "{1|2|3}\n{4|5|6}\n{7|8}", 1), (None, "see {1}", 1)]),
    "authored_with_non_tool": (
        dict(entries=rows("id title genretype_id", (1, "A", 1), (2, "B", 40), (3, "C", 50), (4, "D", None), (3032, "E", 1)), genretypes=GENRES,
             relations=rows("entry_id original_id relationtype_id", (9, 1, "a"), (9, 2, "a"), (9, 3, "a"), (9, 4, "a"), (9, 3032, "a"), (9, 1, "e"))),
        [(1, "Arcade", 1)]),
    "editor_not_utility": (
        dict(entries=rows("id title genretype_id", (1, "A", 1), (2, "B", 40), (3, "C", 50), (4, "D", None)), genretypes=GENRES,
             relations=rows("entry_id original_id relationtype_id", (1, 9, "e"), (2, 9, "e"), (3, 9, "e"), (4, 9, "e"), (1, 9, "a"))),
        [(1, "Arcade", 1), (3, "Programming: Compiler", 1)]),
    "label_index_unneeded": (
        dict(labels=rows("id name", (1, "Ann [1]"), (2, "Bob [2]"), (3, "Bobby"), (4, "Cy"), (5, "100% [1]"), (6, "100x"))),
        [(None, "Ann [1]", 1), (None, "100% [1]", 1)]),
    "title_index_unneeded": (
        dict(entries=rows("id title", (1, "Zap [1]"), (2, "Pow [1]"), (3, "Pow [2]"), (4, "Zip"), (5, " Gap [1]"), (6, "Gap"))),
        [(1, None, 1)]),
    "team_not_company": (
        dict(entries=E, labels=LABELS, authors=rows("entry_id author_seq label_id team_id", (1, 1, 1, 3), (1, 2, 1, 2), (2, 1, 1, 4), (3, 1, 1, None))),
        [(1, "Ann / Axe", 1), (2, "Ann / Blank", 1)]),
    "team_member_not_person": (
        dict(entries=E, labels=LABELS, authors=rows("entry_id author_seq label_id team_id", (1, 1, 1, 3), (2, 1, 3, 3), (3, 1, 4, 3))),
        [(2, "Corp / Corp", 1)]),
    "timex_id_range": (
        dict(entries=rows("id title machinetype_id", (1, "A", 5), (2, "B", 6), (4000000, "C", 5), (4999999, "D", 5), (5000000, "E", 5), (3, "F", None)),
             machinetypes=MACHINES), [(1, "Timex 2068", 1), (5000000, "Timex 2068", 1)]),
    "book_id_range": (
        dict(entries=rows("id title genretype_id", (1, "A", 20), (2000000, "B", 20), (3000000, "C", 20), (2, "D", 1), (3, "E", None)), genretypes=GENRES),
        [(1, "Book: Game", 1), (3000000, "Book: Game", 1)]),
    "hardware_id_range": (
        dict(entries=rows("id title genretype_id", (1, "A", 30), (1999999, "B", 30), (2, "C", 1)), genretypes=GENRES),
        [(1, "Hardware: Joystick", 1)]),
    "range_not_timex": (
        dict(entries=rows("id title machinetype_id", (4000001, "A", 5), (4000002, "B", 6), (4000003, "C", None), (4, "D", 6)), machinetypes=MACHINES),
        [(4000002, "Spectrum", 1), (4000003, None, 1)]),
    "range_not_book": (
        dict(entries=rows("id title genretype_id", (2000001, "A", 20), (2000002, "B", 1), (2000003, "C", None), (4, "D", 1)), genretypes=GENRES),
        [(2000002, "Arcade", 1), (2000003, None, 1)]),
    "range_not_hardware": (
        dict(entries=rows("id title genretype_id", (1000001, "A", 30), (1000002, "B", 1), (1000003, "C", None), (4, "D", 1)), genretypes=GENRES),
        [(1000002, "Arcade", 1), (1000003, None, 1)]),
    "unknown_extension": (
        dict(entries=E, extensions=rows("ext", ".tap", ".tar.gz"),
             downloads=gone("/a/x.tap", "/a/x.foo", "http://x.foo", "/a/x.zip", "/pub/sinclair/x.foo", "/a/x_SourceCode.tar.bz2", "/a/x.tar.gz", "/a/tap",
                            "SourceCode.tar.bz2", "/a/x.foo")),
        [(1, "/a/x.foo", 1), (1, "/a/x.foo", 1), (1, "/a/tap", 1), (1, "SourceCode.tar.bz2", 1)]),
    "people_license_owned": (
        dict(labels=LABELS, licenses=rows("id name licensetype_id", (1, "Folk", "-"), (2, "Film", "F")), licensors=rows("license_id label_id", (1, 1), (2, 1))),
        [(None, "Folk / Ann", 1)]),
    "nickname_owner_not_person": (dict(labels=LABELS), [(None, "Nick / Corp", 1)]),
    "bad_archive_link": (
        dict(entries=E, downloads=gone("https://archive.org/download/x", "https://archive.org/details/x", "http://x")),
        [(1, "https://archive.org/details/x", 1)]),
    "source_code_filetype": (
        dict(entries=E, downloads=gone("/x_SourceCode.zip", filetype_id=1) + gone("/y_SourceCode.zip", filetype_id=32) + gone("/z", filetype_id=1)),
        [(1, "/x_SourceCode.zip", 1)]),
    "zx81_border": (
        dict(entries=rows("id title machinetype_id", (1, "A", 20), (2, "B", 6)),
             downloads=[dict(entry_id=1, file_link="a", filetype_id=1, scr_border=0), dict(entry_id=1, file_link="b", filetype_id=1, scr_border=7),
                        dict(entry_id=1, file_link="c", filetype_id=4, scr_border=0), dict(entry_id=1, file_link="d", filetype_id=2, scr_border=0, machinetype_id=6),
                        dict(entry_id=2, file_link="e", filetype_id=3, scr_border=0, machinetype_id=24), dict(entry_id=1, file_link="f", filetype_id=1)]),
        [(1, "a", 1), (2, "e", 1)]),
    "zx81_loading_screen": (
        dict(entries=rows("id title machinetype_id", (1, "A", 18), (31929, "B", 18)),
             downloads=[dict(entry_id=1, file_link="a", filetype_id=1), dict(entry_id=31929, file_link="b", filetype_id=1), dict(entry_id=1, file_link="c", filetype_id=2)]),
        [(1, "a", 1)]),
    "loading_screen_name": (
        dict(entries=rows("id title", (30407, "A"), (30408, "B")),
             downloads=[dict(entry_id=30408, file_link="/zxdb/a.scr", filetype_id=1), dict(entry_id=30408, file_link="/zxdb/a-load-1.scr", filetype_id=1),
                        dict(entry_id=30407, file_link="/zxdb/b.scr", filetype_id=1), dict(entry_id=30408, file_link="/pub/a.scr", filetype_id=1)]),
        [(30408, "/zxdb/a.scr", 1)]),
    "running_screen_name": (
        dict(entries=rows("id title", (30000, "A"), (30001, "B"), (37752, "C")),
             downloads=[dict(entry_id=i, file_link=f, filetype_id=2) for i, f in
                        ((30001, "/zxdb/a.scr"), (30001, "/zxdb/a-run-1.scr"), (30000, "/zxdb/b.scr"), (37752, "/zxdb/c.scr"))]),
        [(30001, "/zxdb/a.scr", 1)]),
    "opening_screen_name": (
        dict(entries=E, downloads=gone("/zxdb/a-x.scr", "/zxdb/a-open-1.scr", "/zxdb/a.scr", "/pub/a-x.scr", filetype_id=3)),
        [(1, "/zxdb/a-x.scr", 1)]),
    "duplicate_issue_number": (
        dict(magazines=MAGS, issues=rows("id magazine_id number volume special supplement", (1, 1, 5, None, None, None), (2, 1, 5, -1, "", None),
                                         (3, 1, 5, None, None, ""), (4, 1, 5, 2, None, None), (5, 2, 5, None, None, None), (6, 1, None, None, None, None),
                                         (7, 1, None, None, None, None))),
        [(None, "Mag #5", 3)]),
    "duplicate_issue_date": (
        dict(magazines=MAGS, issues=rows("id magazine_id number date_year date_month date_day", (1, 1, None, 1984, 5, None), (2, 1, None, 1984, 5, None),
                                         (3, 1, 9, 1984, 5, None), (4, 1, None, 1984, None, None), (5, 1, None, 1984, None, None), (6, 1, None, 1984, 5, 1))),
        [(None, "Mag 1984/5", 1), (None, None, 1)]),
    "supplement_mismatch": (
        dict(magazines=MAGS, issues=rows("id magazine_id number date_year special parent_id", (1, 1, 5, 1984, None, None), (2, 1, 5, 1984, "", 1), (3, 1, 6, 1984, None, 1),
                                         (4, 1, 1234, 1984, None, 1), (5, 1, 5, 1984, None, 2), (6, 1, None, 1984, None, 99), (7, 1, None, 1984, None, 1))),
        [(None, "Mag #006 supplement", 1), (None, "Mag #123 supplement", 1), (None, "Mag #005 supplement", 1), (None, "Mag #? supplement", 1)]),
    "unidentified_interview": (
        dict(magazines=MAGS, issues=ISSUES, magrefs=rows("id issue_id page entry_id label_id topic_id", (1, 1, 9, None, None, None), (2, 2, 4, None, None, None),
                                                         (3, 1, 9, 1, None, None), (4, 1, 9, None, 1, None), (5, 1, 9, None, None, 1))),
        [(None, "Mag #007 1985/3 page 9", 1), (None, "Zine #? ?/? page 4", 1)]),
    "award_magazine_mismatch": (
        dict(entries=E, magazines=MAGS, issues=ISSUES, awards=rows("id magazine_id", (1, 1), (2, 2)),
             magrefs=rows("id issue_id page entry_id award_id", (1, 1, 9, 1, 2), (2, 1, 9, 1, 1), (3, 1, 9, None, 2), (4, 1, 9, 1, None))),
        [(1, "Mag #007 1985/3 page 9", 1), (None, "Mag #007 1985/3 page 9", 1)]),
    "link_host_mismatch": (
        dict(hosts=rows("id link", (1, "https://a/")), magreflinks=rows("magref_id link host_id", (5, "https://a/x", 1), (6, "https://b/x", 1))),
        [(None, "6 - https://b/x", 1)]),
    "wrong_directory": (
        dict(entries=E, downloads=gone("/zxdb/sinclair/entries/0000001/x.tap", "/zxdb/sinclair/entries/0000002/x.tap", "/zxdb/x")),
        [(1, "/zxdb/sinclair/entries/0000002/x.tap", 1)]),
    "empty_tag": (
        dict(tagtypes=rows("id text", ("S", "Series")), tags=rows("id name tagtype_id", (1, "A", "S"), (2, "B", "S")), members=rows("tag_id entry_id", (1, 1))),
        [(None, "Series: B (2)", 1)]),
    "single_title_series": (
        dict(entries=E, tagtypes=rows("id text", ("S", "Series"), ("U", "Set"), ("T", "Theme")), tags=rows("id name tagtype_id", (1, "A", "S"), (2, "B", "U"), (3, "C", "T"), (4, "D", "S")),
             members=rows("tag_id entry_id", (1, 1), (1, 1), (2, 1), (2, 2), (3, 1), (4, 9))),
        [(1, "Series: A (1)", 2)]),
    "empty_license": (
        dict(licenses=rows("id name", (1, "A"), (2, "B")), relatedlicenses=rows("entry_id license_id", (1, 1))), [(None, "License: B (2)", 1)]),
    "container_genre": (
        dict(genretypes=GENRES, entries=rows("id title genretype_id", (1, "A", 1), (2, "B", 80), (3, "C", None), (4, "D", 1), (5, "E", 1)),
             contents=rows("container_id prog_seq entry_id", (1, 1, 2), (2, 1, 1), (3, 1, None), (4, 1, 4), (4, 2, 5))),
        [(1, "Arcade", 1), (3, None, 1)]),
    "issue_title_unlinked": (
        dict(genretypes=GENRES, entries=rows("id title genretype_id issue_id", (1, "Mag issue 5", 81, None), (2, "Mag issue 6", 81, 7), (3, "Tissue x", 1, None))),
        [(1, "Covertape", 1)]),
    "compilation_note": (dict(entries=E, notes=notes("[a + b]", "[a]", "x [a + b]", "[a\n+ b]")), [(1, "[a + b]", 1), (None, "[a + b]", 1), (1, "[a\n+ b]", 1)]),
    "alias_note": (dict(entries=E, notes=notes("aka. X", "a.k.a. Y", "also aka. Z")), [(1, "aka. X", 1), (None, "aka. X", 1), (1, "a.k.a. Y", 1)]),
    "deprecated_with_data": (
        dict(entries=rows("id title availabletype_id", (1, "A", "*"), (2, "B", "*"), (3, "C", "*"), (4, "D", "A"), (5, "E", "*"), (6, "F", None)),
             relations=rows("entry_id original_id relationtype_id", (1, 9, "*"), (2, 3, "p")), webrefs=rows("entry_id link", (4, "x"), (6, "y")),
             contents=rows("container_id entry_id", (9, None))),
        [(2, None, 1), (3, None, 1)]),
    "unmarked_demo": (
        dict(genretypes=GENRES, entries=rows("id title genretype_id", (1, "A", 1), (2, "B", 85), (3, "C", None)),
             downloads=[dict(entry_id=e, file_link=f, filetype_id=t, is_demo=d) for e, f, t, d in
                        ((1, "/x(Demo).tap", 8, 0), (1, "/y(demo).tap", 8, 1), (1, "/z(demo).tap", 12, 0), (2, "/w(demo).tap", 9, 0), (3, "/v(demo).tap", 11, 0))]),
        [(1, "/x(Demo).tap", 1)]),
    "suspect_release_seq": (
        dict(entries=rows("id title", (1999999, "Z"), (2000000, "A"), (2000113, "B"), (3000000, "C"), (3000001, "D")),
             downloads=[dict(entry_id=e, file_link="/x(2).tap", release_seq=s) for e, s in ((1999999, 0), (2000000, 0), (2000113, 0), (3000000, 0), (3000001, 0), (2000000, 1))]),
        [(2000000, "/x(2).tap", 1), (3000000, "/x(2).tap", 1)]),
    "duplicate_tags": (
        dict(tags=rows("id name", (1, "A"), (2, "B"), (3, "C"), (4, "D"), (5, "E"), (6, "F"), (7, "G")),
             members=rows("tag_id entry_id", (1, 1), (1, 2), (2, 2), (2, 1), (3, 1), (4, 1), (4, 2), (7, 1), (7, 1))),
        [(None, "A (1) x B (2)", 1), (None, "A (1) x D (4)", 2)]),
    "release_order": (
        dict(entries=E, releases=rows("entry_id release_seq release_year", (1, 0, 1986), (1, 1, 1987), (1, 2, 1985), (2, 0, 1984), (2, 1, 1984), (3, 0, None), (3, 1, 1980))),
        [(1, "#1 (1987) and #2 (1985)", 2)]),
    "library_title_article": (dict(entries=rows("id title library_title", (1, "The A", "The A"), (2, "B", "Theme"), (3, "C", None))), [(1, "The A", 1)]),
    "contest_title_not_compiled": (
        dict(entries=[*E, dict(id=8, title=K54)], tags=rows("id name", (1, K53), (2, "CSSCGC Crap Games Contest 1997")), members=rows("tag_id entry_id", (1, 1), (1, 2), (1, 8), (2, 3)),
             contents=rows("container_id prog_seq entry_id", (8, 1, 1), (8, 2, None))),
        [(2, K53, 1)]),
    "compiled_title_not_in_contest": (
        dict(entries=[*E, dict(id=8, title=K54), dict(id=9, title="CSSCGC Crap Games Competition 1999")], tags=rows("id name", (1, K53)), members=rows("tag_id entry_id", (1, 1)),
             contents=rows("container_id prog_seq entry_id", (8, 1, 1), (8, 2, 2), (8, 3, None), (9, 1, 3))),
        [(2, K54, 1), (3, "CSSCGC Crap Games Competition 1999", 1)]),
    "archived_non_historical": (dict(entries=E, scraps=rows("id entry_id file_link", (1, 1, "/zxdb/x"), (2, 1, "/pub/x"), (3, None, "/zxdb/y"), (4, 1, None))), [(1, "/zxdb/x", 1), (None, "/zxdb/y", 1)]),
    "archived_in_use": (
        dict(scraps=rows("id file_link", (1, "/a"), (2, "/a"), (3, "/b"), (4, None)), downloads=gone("/a", "/a", "/a", "/c")), [(None, "/a", 6)]),
    "magazine_entry_genre": (
        dict(genretypes=GENRES, issues=rows("id magazine_id", (1, 1), (2, 323)), entries=rows("id title genretype_id issue_id", (1, "A", 1, 1), (2, "B", 81, 1), (3, "C", None, 1), (4, "DigiTape 1", 1, 1),
                                                                                              (5, "E", 1, 2), (6, "F", 1, None))),
        [(1, "Arcade", 1), (3, None, 1)]),
    "paper_and_electronic": (
        dict(magazines=MAGS, issues=ISSUES, entries=rows("id title genretype_id issue_id", (1, "A", 82, 1), (2, "B", 82, 2), (3, "C", 81, 1))), [(None, "Mag", 1)]),
    "author_credited_twice": (
        dict(entries=[*E, dict(id=4448, title="X")], labels=LABELS,
             authors=rows("entry_id author_seq label_id", (1, 1, 1), (1, 2, 2), (1, 3, 5), (2, 1, 2), (2, 2, 6), (3, 1, 7), (3, 2, 7), (4448, 1, 1), (4448, 2, 2))),
        [(1, "Ann / Axe", 1), (1, "Ann / Aye", 1), (1, "Aye / Axe", 1)]),
    "redundant_alias": (
        dict(entries=E, aliases=rows("entry_id release_seq title", (1, 0, "One"), (2, 0, "2"), (3, 1, "Three"))), [(1, None, 1)]),
    "never_released_playable": (
        dict(entries=rows("id title availabletype_id", (1, "A", "N"), (2, "B", "A"), (3, "C", None)),
             downloads=[dict(entry_id=e, file_link=f, filetype_id=t, is_demo=d) for e, f, t, d in ((1, "a", 8, 0), (1, "b", 9, 0), (1, "c", 10, 1), (2, "d", 8, 0), (3, "e", 11, 0))]),
        [(1, "a", 1)]),
    "duplicate_filename": (
        dict(downloads=gone("/zxdb/sinclair/entries/1/a.tap.zip", "/zxdb/sinclair/entries/2/a.tap.zip", "/zxdb/sinclair/entries/2/b.tzx.zip", "/zxdb/x/a.tap.zip")),
        [(None, "/zxdb/sinclair/entries/.../a.tap.zip", 1)]),
    "deprecated_without_original": (
        dict(entries=rows("id title availabletype_id", (1, "A", "*"), (2, "B", "*"), (3, "C", "A")), relations=rows("entry_id original_id relationtype_id", (1, 9, "*"), (2, 9, "p"))), [(2, None, 1)]),
    "deprecated_as_original": (
        dict(entries=rows("id title availabletype_id", (1, "A", "*"), (2, "B", "*"), (3, "C", "A")), relations=rows("entry_id original_id relationtype_id", (9, 1, "p"), (9, 3, "*"))), [(1, None, 1)]),
    "duplicate_not_deprecated": (
        dict(entries=rows("id title availabletype_id", (1, "A", "*"), (2, "B", None), (3, "C", "A")), relations=rows("entry_id original_id relationtype_id", (1, 9, "*"), (2, 9, "*"), (3, 9, "*"), (3, 9, "p"))),
        [(2, None, 1), (3, None, 1)]),
    "magazine_without_issues": (dict(magazines=MAGS, issues=rows("id magazine_id", (1, 1))), [(None, "Late (3)", 1)]),
    "note_is_license": (dict(entries=E, notes=notes("Based on X", "Not Based")), [(1, "Based on X", 1)]),
    "multiple_origins": (
        dict(entries=E, relationtypes=rows("id text", ("p", "Port"), ("u", "Update"), ("a", "With")),
             relations=rows("entry_id original_id relationtype_id", (1, 5, "p"), (1, 6, "p"), (1, 7, "p"), (1, 7, "u"), (2, 5, "a"), (2, 6, "a"), (3, 5, "u"), (3, 5, "u"))),
        [(1, "Port", 3)]),
    "missing_contents": (
        dict(genretypes=GENRES, entries=rows("id title genretype_id", (1, "A", 80), (2, "B", 111), (3, "C", 82), (4, "D", 81), (5, "E", None), (6, "F", 112)), contents=rows("container_id", 1)),
        [(2, "Pack", 1), (4, "Covertape", 1)]),
    "itch_link_in_downloads": (dict(entries=E, downloads=gone("https://a.itch.io/x", filetype_id=0) + gone("https://a.itch.io/y", filetype_id=1)), [(1, "https://a.itch.io/x", 1)]),
    "redundant_contents_alias": (dict(entries=E, contents=rows("container_id prog_seq entry_id alias", (9, 1, 1, "One"), (9, 2, 2, "Deux"), (9, 3, 3, None))), [(1, "9", 1)]),
    "misclassified_editor": (
        dict(genretypes=GENRES, entries=rows("id title genretype_id", (1, "A", 52), (2, "B", 52), (3, "C", 53)), relations=rows("entry_id original_id relationtype_id", (1, 9, "e"), (2, 9, "a"), (3, 9, "e"))),
        [(1, "Game Editor", 1)]),
    "editor_without_game": (
        dict(genretypes=GENRES, entries=rows("id title genretype_id", (1, "A", 53), (2, "B", 53), (3, "C", 52)), relations=rows("entry_id original_id relationtype_id", (1, 9, "e"), (2, 9, "a"))),
        [(2, "Game Editor Data", 1)]),
    "web_link_mismatch": (
        dict(entries=E, websites=rows("id link", (1, "https://a/"), (10, "https://en.wikipedia.org/wiki/"), (16, "https://v/"), (31, "https://itch.io/"), (36, "https://w/")),
             webrefs=rows("entry_id link website_id", (1, "https://a/1", 1), (1, "https://b/1", 1), (1, "https://cs.wikipedia.org/wiki/X", 10), (1, "https://cs.wikipedia.org/X", 10),
                          (1, "https://youtu.be/1", 16), (1, "https://www.youtube.com/1", 16), (1, "https://youtu.be/1", 36), (1, "https://www.youtube.com/2", 36), (1, "https://me.itch.io/g", 31), (1, "https://youtu.be/3", 1))),
        [(1, "https://b/1", 1), (1, "https://cs.wikipedia.org/X", 1), (1, "https://www.youtube.com/2", 1), (1, "https://youtu.be/3", 1)]),
    "page_before_cover": (
        dict(entries=E, magazines=MAGS, referencetypes=rows("id text", (2, "Preview")), issues=rows("id magazine_id cover_page", (1, 1, 3), (2, 1, None)),
             magrefs=rows("id issue_id page entry_id referencetype_id", (1, 1, 2, 1, 2), (2, 1, 3, 1, 2), (3, 2, 0, 1, 2), (4, 1, 1, None, 2))),
        [(1, "Preview: Mag (issue-id 1)", 1), (None, "Preview: Mag (issue-id 1)", 1)]),
    "tape_date_conflict": (
        dict(entries=rows("id title genretype_id issue_id", (1, "A", 1, 1), (2, "B", 81, 1), (3, "C", 1, 1), (4, "D", None, 1), (5, "E", 1, 1)), issues=ISSUES,
             releases=rows("entry_id release_seq release_year release_month", (1, 0, 1984, None), (2, 0, 1984, None), (3, 0, 1985, 3), (4, 0, 1984, None), (5, 0, 1984, 1), (5, 1, 1985, 3)),
             contents=rows("container_id entry_id is_original", (9, 5, 1), (9, None, 0))),
        [(1, "1984/-/- vs 1985/3/-", 1)]),
    "multiple_originals": (
        dict(entries=E, issues=ISSUES, contents=rows("container_id prog_seq entry_id is_original", (8, 1, 1, 1), (8, 2, 1, 1), (9, 1, 1, 1), (8, 3, 2, 1), (9, 2, 2, 0), (8, 4, None, 1), (9, 4, None, 1)),
             magrefs=rows("id issue_id entry_id is_original", (1, 1, 1, 1), (2, 1, 1, 1), (3, 2, 3, 1)), booktypeins=rows("entry_id book_id is_original", (1, 5, 1), (3, 5, 1))),
        [(1, "4 original publications", 1), (3, "2 original publications", 1)]),
    "original_date_conflict": (
        dict(entries=E, releases=rows("entry_id release_seq release_year", (1, 0, 1984), (2, 0, None), (3, 0, 1984)), booktypeins=rows("entry_id book_id is_original", (1, 9, 1), (2, 9, 1), (3, 9, 0))), [(1, None, 1)]),
    "original_publisher_conflict": (
        dict(entries=E, publishers=rows("entry_id release_seq publisher_seq", (1, 0, 1), (1, 0, 2), (2, 1, 1), (3, 0, 1)), magrefs=rows("id issue_id entry_id is_original", (1, 1, 1, 1), (2, 1, 2, 1), (3, 1, None, 1))), [(1, None, 1)]),
    "original_price_conflict": (
        dict(entries=E, releases=rows("entry_id release_seq currency_id", (1, 0, "GBP"), (2, 0, None), (3, 1, "GBP")), contents=rows("container_id prog_seq entry_id is_original", (9, 1, 1, 1), (9, 2, 2, 1), (9, 3, 3, 1))), [(1, None, 1)]),
    "note_is_compilation": (dict(entries=E, notes=notes("Came with X", "X Came")), [(1, "Came with X", 1)]),
    "note_is_relation": (dict(entries=E, notes=notes("Almost X", "X Almost")), [(1, "Almost X", 1)]),
    "unidentified_file": (
        dict(files=rows("id file_link label_id", (1, "/pub/sinclair/games-info/x", None), (2, "/pub/sinclair/games-info/x", 1), (3, "/pub/sinclair/docs/x", None), (4, "/pub/sinclair/slt/x", None))),
        [(None, "/pub/sinclair/games-info/x", 1), (None, "/pub/sinclair/slt/x", 1)]),
}


def test_every_rule_has_a_case():
    assert set(CASES) == set(REGISTRY)
    assert len(REGISTRY) == 83 and sum(r.advisory for r in REGISTRY.values()) == 22


@pytest.mark.parametrize("name", list(CASES))
def test_rule(spark, name):
    tables, expected = CASES[name]
    found = [tuple(r) for r in run_rule(Handmade(spark, **tables), name).select("entry_id", "details", "occurrences").collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("name", [n for n, r in REGISTRY.items() if r.base])
def test_one_pass_agrees_with_single_runs(spark, name):
    tables = Handmade(spark, **CASES[name][0])
    together = run_checks(tables, [r.name for r in REGISTRY.values() if r.base == REGISTRY[name].base])
    assert together.where(f"rule = '{name}'").exceptAll(run_rule(tables, name)).count() == 0
    assert run_rule(tables, name).exceptAll(together).count() == 0


def test_null_awareness_silences_a_tag_or_a_whole_rule(spark):
    tags, members = CASES["series_seq_gap"][0]["tags"], CASES["series_seq_gap"][0]["members"]
    tables = Handmade(spark, entries=E, tags=tags, members=members)
    assert series_gaps(tables).count() == 2
    assert series_gaps(tables, null_aware=False).count() == 3
    conflict = CASES["tape_date_conflict"][0] | {"magrefs": rows("id issue_id entry_id is_original", (1, 1, None, 1))}
    assert run_rule(Handmade(spark, **conflict), "tape_date_conflict").count() == 0


def test_advisory_rules_are_left_out_by_default(spark):
    tables = Handmade(spark, entries=E, notes=notes("Based on {1}"))
    names = ["note_is_license", "malformed_note_reference"]
    assert {r.rule for r in run_checks(tables, names).collect()} == set(names)
    from shelfmark.plans.rules.registry import choose
    assert len(choose(None, False)) == 61 and len(choose(None, True)) == 83


def test_pending_reviews(spark):
    tables = Handmade(
        spark, entries=rows("id title machinetype_id", (1, "A", None), (2, "B", 11), (3, "C", 10)), magazines=[*MAGS, dict(id=51, name="Odd")],
        issues=rows("id magazine_id number volume date_year", (1, 1, 7, None, 1985), (2, 2, 1, None, None), (3, 51, 1, 2, None), (4, 51, 2, 1, None), (5, 51, 3, None, None)),
        magrefs=rows("id issue_id page entry_id referencetype_id review_id", (1, 1, 5, 1, 10, None), (2, 1, 6, 2, 10, None), (3, 1, 7, 3, 10, None), (4, 1, 8, 1, 10, 99),
                     (5, 2, 5, 1, 10, None), (6, 1, 9, 1, 2, None), (7, 1, 10, 1, 10, None), (8, 3, 1, 1, 10, None), (9, 4, 1, 1, 10, None), (10, 4, 2, 1, 10, 98), (11, 5, 1, 1, 10, None)),
        magreffeats=rows("magref_id feature_id", (7, 6455), (1, 5)),
    )
    found = sorted((r.entry_id, r.details) for r in pending_reviews(tables).collect())
    assert found == [(1, "Mag #007 1985/? page 5"), (1, "Odd #002 ?/? page 1"), (3, "Mag #007 1985/? page 7")]
