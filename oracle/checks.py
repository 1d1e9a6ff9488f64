"""One DuckDB query per consistency rule: entry, title, details and, where not 1, occurrences."""

from __future__ import annotations

from shelfmark.plans.rules import REGISTRY

from . import over_catalogue

REF = (
    "m.name || ' #' || coalesce(case when i.number is null then null else lpad(cast(i.number as varchar), 3, '0') end, '?')"
    " || ' ' || coalesce(cast(i.date_year as varchar), '?') || '/' || coalesce(cast(i.date_month as varchar), '?')"
    " || ' page ' || cast(r.page as varchar)"
)
ENTRY = (
    "(select n.*, g.text as genre, k.text as machine from cat_entries n left join cat_genretypes g on g.id = n.genretype_id"
    " left join cat_machinetypes k on k.id = n.machinetype_id)"
)
DOWN = (
    "(select d.*, n.title, n.availabletype_id, n.machinetype_id as own_machine, g.text as genre from cat_downloads d"
    " join cat_entries n on n.id = d.entry_id left join cat_genretypes g on g.id = n.genretype_id)"
)
NOTE = "(select n.text, x.id as entry_id, x.title from cat_notes n left join cat_entries x on x.id = n.entry_id)"


def _entries(where: str, details: str) -> str:
    return f"select id as entry_id, title, {details} as details, 1 as occurrences from {ENTRY} where {where}"


def _downloads(where: str) -> str:
    return f"select entry_id, title, file_link as details, 1 as occurrences from {DOWN} where {where}"


def _notes(where: str) -> str:
    return f"select entry_id, title, text as details, 1 as occurrences from {NOTE} where {where}"


def _gap(table: str, parent: str, seq: str, start: int, entry: str, details: str) -> str:
    keys = ", ".join(f"c.{p}" for p in parent.split())
    same = " and ".join(f"p.{k} = c.{k}" for k in parent.split())
    return (
        f"select e.id as entry_id, e.title, {details} as details, count(*) as occurrences from cat_{table} c"
        f" join cat_entries e on e.id = c.{entry} where c.{seq} > {start}"
        f" and not exists (select 1 from cat_{table} p where {same} and p.{seq} = c.{seq} - 1)"
        f" group by e.id, e.title, {keys}, c.{seq}"
    )


def _original(table: str) -> str:
    return f"select entry_id from cat_{table} where is_original = 1"


ORIGINALS = " union ".join(_original(t) for t in ("contents", "booktypeins", "magrefs"))


def _team(where: str) -> str:
    return (
        "select e.id as entry_id, e.title, b.name || ' / ' || t.name as details, 1 as occurrences from cat_authors a"
        " join cat_entries e on e.id = a.entry_id join cat_labels b on b.id = a.label_id"
        f" join cat_labels t on t.id = a.team_id where {where}"
    )


def _members(where: str) -> str:
    return (
        "select m.entry_id, e.title, g.name || ' (' || g.id || ')' as details, 1 as occurrences from cat_members m"
        f" join cat_tags g on g.id = m.tag_id left join cat_entries e on e.id = m.entry_id where {where}"
    )


def _index(table: str, name: str, out: str) -> str:
    stem = f"trim(split_part({name}, '[', 1))"
    return (
        f"select {out}, 1 as occurrences from (select *, {stem} as stem from cat_{table} where {name} like '% [%]') s"
        f" where not exists (select 1 from cat_{table} o where o.id <> s.id and starts_with(o.{name}, s.stem))"
    )


BODIES: dict[str, str] = {
    "author_seq_gap": _gap("authors", "entry_id", "author_seq", 1, "entry_id", "cast(c.author_seq - 1 as varchar)"),
    "entry_without_release": "select e.id as entry_id, e.title, '0' as details, 1 as occurrences from cat_entries e anti join cat_releases r on r.entry_id = e.id",
    "release_seq_gap": _gap("releases", "entry_id", "release_seq", 0, "entry_id", "cast(c.release_seq - 1 as varchar)"),
    "library_title_mismatch": _entries("title <> library_title and left(title, 4) = left(library_title, 4) and position('+' in title) = 0", "library_title"),
    "contents_seq_gap": _gap("contents", "container_id media_seq media_side", "prog_seq", 1, "container_id", "c.media_seq || '-' || c.media_side || '-' || (c.prog_seq - 1)"),
    "series_seq_missing": _members("m.series_seq is null and g.tagtype_id = 'S'"),
    "series_seq_gap": _members("m.series_seq > 1 and not exists (select 1 from cat_members p where p.tag_id = m.tag_id and (p.series_seq = m.series_seq - 1 or p.series_seq is null))"),
    "seq_in_non_series": _members("m.series_seq is not null and g.tagtype_id <> 'S'"),
    "publisher_seq_gap": _gap("publishers", "entry_id release_seq", "publisher_seq", 1, "entry_id", "cast(c.publisher_seq - 1 as varchar)"),
    "malformed_note_reference": _notes(
        "regexp_matches(text, '[a-zA-Z][}]') or (regexp_matches(text, '(?s)[{].*[}]') and not regexp_matches(text, '(?s)[{].*[|].*[|].*[}]'))"
        " or (regexp_matches(text, '(?s)([{].*[}].*){2}') and not regexp_matches(text, '(?s)([{].*[|].*[|].*[}].*){2}'))"
        " or (regexp_matches(text, '(?s)([{].*[}].*){3}') and not regexp_matches(text, '(?s)([{].*[|].*[|].*[}].*){3}'))"
    ),
    "authored_with_non_tool": f"select e.id as entry_id, e.title, e.genre as details, 1 as occurrences from cat_relations r join {ENTRY} e on e.id = r.original_id where r.relationtype_id = 'a' and not regexp_matches(e.genre, '^(Utility|Programming):') and e.id <> 3032",
    "editor_not_utility": f"select e.id as entry_id, e.title, e.genre as details, 1 as occurrences from cat_relations r join {ENTRY} e on e.id = r.entry_id where r.relationtype_id = 'e' and not starts_with(e.genre, 'Utility:')",
    "label_index_unneeded": _index("labels", "name", "null as entry_id, null as title, name as details"),
    "title_index_unneeded": _index("entries", "title", "id as entry_id, title, null as details"),
    "team_not_company": _team("coalesce(t.labeltype_id, '+') in ('+', '-')"),
    "team_member_not_person": _team("b.labeltype_id is not null and b.labeltype_id <> '+' and b.labeltype_id <> '-'"),
    "timex_id_range": _entries("starts_with(machine, 'Timex') and (id < 4000000 or id > 4999999)", "machine"),
    "book_id_range": _entries("starts_with(genre, 'Book') and (id < 2000000 or id > 2999999)", "genre"),
    "hardware_id_range": _entries("starts_with(genre, 'Hardware') and (id < 1000000 or id > 1999999)", "genre"),
    "range_not_timex": _entries("id // 1000000 = 4 and not starts_with(coalesce(machine, ''), 'Timex')", "machine"),
    "range_not_book": _entries("id // 1000000 = 2 and not starts_with(coalesce(genre, ''), 'Book')", "genre"),
    "range_not_hardware": _entries("id // 1000000 = 1 and not starts_with(coalesce(genre, ''), 'Hardware')", "genre"),
    "unknown_extension": _downloads("not exists (select 1 from cat_extensions x where ends_with(file_link, x.ext)) and not starts_with(file_link, 'http') and not ends_with(file_link, '.zip') and not starts_with(file_link, '/pub/sinclair/') and not regexp_matches(file_link, '(?s).SourceCode[.]tar[.]bz2$')"),
    "people_license_owned": "select null as entry_id, null as title, s.name || ' / ' || b.name as details, 1 as occurrences from cat_licenses s join cat_licensors o on o.license_id = s.id join cat_labels b on b.id = o.label_id where s.licensetype_id = '-'",
    "nickname_owner_not_person": "select null as entry_id, null as title, b.name || ' / ' || o.name as details, 1 as occurrences from cat_labels b join cat_labels o on o.id = b.owner_id where b.labeltype_id = '-' and o.labeltype_id <> '+'",
    "bad_archive_link": _downloads("contains(file_link, '/archive.org/') and not starts_with(file_link, 'https://archive.org/download/')"),
    "source_code_filetype": _downloads("contains(file_link, 'SourceCode') and filetype_id <> 32 and filetype_id <> 71"),
    "zx81_border": _downloads("coalesce(machinetype_id, own_machine) between 18 and 24 and filetype_id between 1 and 3 and scr_border <> 7"),
    "zx81_loading_screen": _downloads("coalesce(machinetype_id, own_machine) between 18 and 24 and filetype_id = 1 and entry_id <> 31929"),
    "loading_screen_name": _downloads("filetype_id = 1 and starts_with(file_link, '/zxdb/') and not contains(file_link, '-load-') and entry_id > 30407"),
    "running_screen_name": _downloads("filetype_id = 2 and starts_with(file_link, '/zxdb/') and not contains(file_link, '-run-') and entry_id > 30000 and entry_id <> 37752"),
    "opening_screen_name": _downloads("filetype_id = 3 and starts_with(file_link, '/zxdb/') and contains(file_link, '-') and not contains(file_link, '-open-')"),
    "duplicate_issue_number": """
        select null as entry_id, null as title, m.name || ' #' || i.number as details, n * (n - 1) // 2 as occurrences
        from (select magazine_id, number, coalesce(volume, -1), coalesce(special, ''), coalesce(supplement, ''), count(*) as n
              from cat_issues where number is not null group by all having count(*) > 1) i
        join cat_magazines m on m.id = i.magazine_id""",
    "duplicate_issue_date": """
        select null as entry_id, null as title, m.name || ' ' || i.y || '/' || i.mo as details, n * (n - 1) // 2 as occurrences
        from (select magazine_id, volume, special, supplement, date_year as y, date_month as mo, date_day, count(*) as n
              from cat_issues where number is null group by all having count(*) > 1) i
        join cat_magazines m on m.id = i.magazine_id""",
    "supplement_mismatch": """
        select null as entry_id, null as title, m.name || ' #' || coalesce(case when c.number is not null then lpad(cast(c.number as varchar), 3, '0') end, '?') || ' supplement' as details, 1 as occurrences
        from cat_issues c join cat_issues p on p.id = c.parent_id join cat_magazines m on m.id = c.magazine_id
        where p.parent_id is not null or coalesce(c.special, '') <> coalesce(p.special, '')
          or (c.magazine_id, c.date_year, c.date_month, c.date_day, c.volume, c.number)
             is distinct from (p.magazine_id, p.date_year, p.date_month, p.date_day, p.volume, p.number)""",
    "unidentified_interview": f"select null as entry_id, null as title, {REF} as details, 1 as occurrences from cat_magrefs r join cat_issues i on i.id = r.issue_id join cat_magazines m on m.id = i.magazine_id where coalesce(r.entry_id, r.label_id, r.topic_id) is null",
    "award_magazine_mismatch": f"select e.id as entry_id, e.title, {REF} as details, 1 as occurrences from cat_magrefs r join cat_awards a on a.id = r.award_id join cat_issues i on i.id = r.issue_id and i.magazine_id <> a.magazine_id join cat_magazines m on m.id = i.magazine_id left join cat_entries e on e.id = r.entry_id",
    "link_host_mismatch": "select null as entry_id, null as title, k.magref_id || ' - ' || k.link as details, 1 as occurrences from cat_magreflinks k join cat_hosts h on h.id = k.host_id and not starts_with(k.link, h.link)",
    "wrong_directory": _downloads("starts_with(file_link, '/zxdb/sinclair/entries') and not contains(file_link, lpad(cast(entry_id as varchar), 7, '0'))"),
    "empty_tag": "select null as entry_id, null as title, t.text || ': ' || g.name || ' (' || g.id || ')' as details, 1 as occurrences from cat_tags g join cat_tagtypes t on t.id = g.tagtype_id anti join cat_members m on m.tag_id = g.id",
    "single_title_series": """
        select e.id as entry_id, e.title, t.text || ': ' || g.name || ' (' || g.id || ')' as details, m.n as occurrences
        from (select tag_id, any_value(entry_id) as entry_id, count(*) as n from cat_members group by tag_id having count(distinct entry_id) = 1) m
        join cat_tags g on g.id = m.tag_id and g.tagtype_id in ('S', 'U') join cat_tagtypes t on t.id = g.tagtype_id
        join cat_entries e on e.id = m.entry_id""",
    "empty_license": "select null as entry_id, null as title, 'License: ' || name || ' (' || id || ')' as details, 1 as occurrences from cat_licenses l where not exists (select 1 from cat_relatedlicenses r where r.license_id = l.id)",
    "container_genre": _entries("exists (select 1 from cat_contents c where c.container_id = id) and not exists (select 1 from cat_contents c where c.container_id = c.entry_id and c.container_id = id) and coalesce(genretype_id, 0) < 80", "genre"),
    "issue_title_unlinked": _entries("contains(title, ' issue ') and issue_id is null", "genre"),
    "compilation_note": _notes("regexp_full_match(text, '(?s)\\[.*[+].*\\]')"),
    "alias_note": _notes("starts_with(text, 'aka. ') or starts_with(text, 'a.k.a. ')"),
    "deprecated_with_data": """
        select id as entry_id, title, null as details, 1 as occurrences from cat_entries
        where availabletype_id = '*' and id in (
          select entry_id from cat_aliases union select entry_id from cat_authors union select entry_id from cat_booktypeins
          union select book_id from cat_booktypeins union select entry_id from cat_contents where entry_id is not null
          union select container_id from cat_contents union select entry_id from cat_magrefs where entry_id is not null
          union select entry_id from cat_members union select entry_id from cat_ports union select entry_id from cat_publishers
          union select entry_id from cat_relatedlicenses union select entry_id from cat_relations where relationtype_id <> '*'
          union select original_id from cat_relations union select entry_id from cat_remakes union select entry_id from cat_webrefs)""",
    "unmarked_demo": _downloads("contains(lower(file_link), '(demo') and not contains(genre, 'Demo') and is_demo = 0 and filetype_id between 8 and 11"),
    "suspect_release_seq": _downloads("entry_id >= 2000000 and entry_id <= 3000000 and entry_id <> 2000113 and contains(file_link, ')') and release_seq = 0"),
    "duplicate_tags": """
        select null as entry_id, null as title, f.name || ' (' || f.id || ') x ' || s.name || ' (' || s.id || ')' as details, s.place - 1 as occurrences
        from (select id, name, first_value(id) over w as first_id, row_number() over w as place
              from (select g.id, g.name, string_agg(cast(m.entry_id as varchar), ',' order by m.entry_id) as k
                    from cat_tags g join cat_members m on m.tag_id = g.id group by g.id, g.name)
              window w as (partition by k order by id)) s
        join cat_tags f on f.id = s.first_id where s.place > 1""",
    "release_order": """
        select e.id as entry_id, e.title, '#' || cast(arg_max(a.release_seq, (a.release_year, -a.release_seq)) as varchar) || ' (' || max(a.release_year) || ') and #' || b.release_seq || ' (' || b.release_year || ')' as details, count(*) as occurrences
        from cat_releases a join cat_releases b on b.entry_id = a.entry_id and a.release_seq < b.release_seq and a.release_year > b.release_year
        join cat_entries e on e.id = a.entry_id group by e.id, e.title, b.release_seq, b.release_year""",
    "library_title_article": _entries("starts_with(library_title, 'The ')", "library_title"),
    "contest_title_not_compiled": """
        select e.id as entry_id, e.title, g.name as details, count(*) as occurrences from cat_tags g
        join cat_entries k on k.title = 'CSSCGC Crap Games Competition' || right(g.name, 5)
        join cat_members m on m.tag_id = g.id join cat_entries e on e.id = m.entry_id
        where starts_with(g.name, 'CSSCGC Crap Games Contest') and k.id <> e.id
          and not exists (select 1 from cat_contents c where c.container_id = k.id and c.entry_id = e.id)
        group by e.id, e.title, g.id, g.name""",
    "compiled_title_not_in_contest": """
        select e.id as entry_id, e.title, k.title as details, count(*) as occurrences from cat_entries k
        join cat_contents c on c.container_id = k.id join cat_entries e on e.id = c.entry_id
        left join cat_tags g on g.name = 'CSSCGC Crap Games Contest' || right(k.title, 5)
        where starts_with(k.title, 'CSSCGC Crap Games Competition')
          and not exists (select 1 from cat_members m where m.tag_id = g.id and m.entry_id = e.id)
        group by e.id, e.title, k.title""",
    "archived_non_historical": "select e.id as entry_id, e.title, s.file_link as details, 1 as occurrences from cat_scraps s left join cat_entries e on e.id = s.entry_id where starts_with(s.file_link, '/zxdb/')",
    "archived_in_use": "select null as entry_id, null as title, d.file_link as details, count(*) as occurrences from cat_scraps s join cat_downloads d using (file_link) group by d.file_link",
    "magazine_entry_genre": _entries("exists (select 1 from cat_issues i where i.id = issue_id and i.magazine_id <> 323) and not starts_with(title, 'DigiTape') and coalesce(genretype_id, 0) not in (81, 82)", "genre"),
    "paper_and_electronic": "select null as entry_id, null as title, m.name as details, 1 as occurrences from cat_magazines m where coalesce(m.link_mask, m.archive_mask) is not null and exists (select 1 from cat_issues i join cat_entries e on e.issue_id = i.id and e.genretype_id = 82 where i.magazine_id = m.id)",
    "author_credited_twice": """
        select entry_id, title, details, occurrences from (
          with credit as (select a.entry_id, e.title, b.id, b.name, b.labeltype_id, b.owner_id from cat_authors a
                          join cat_labels b on b.id = a.label_id join cat_entries e on e.id = a.entry_id where a.entry_id not in (4448, 15020)),
          sibling as (select x.*, first_value(name) over (partition by entry_id, owner_id order by id) as first_name,
                        count(*) over (partition by entry_id, owner_id order by id range between unbounded preceding and 1 preceding) as earlier
                      from credit x where labeltype_id = '-' and owner_id is not null)
          select s.entry_id, s.title, s.name || ' / ' || s.first_name as details, sum(s.earlier) as occurrences
          from sibling s where s.earlier > 0 and s.id <> s.owner_id group by s.entry_id, s.title, s.name, s.first_name, s.id
          union all
          select o.entry_id, o.title, o.name || ' / ' || c.name, count(*) from credit c join credit o on o.entry_id = c.entry_id and o.id = c.owner_id
          group by o.entry_id, o.title, o.id, o.name, c.id, c.name)""",
    "redundant_alias": "select e.id as entry_id, e.title, null as details, 1 as occurrences from cat_entries e join cat_aliases a on a.entry_id = e.id and a.title = e.title and a.release_seq = 0",
    "never_released_playable": _downloads("availabletype_id = 'N' and filetype_id in (8, 10, 11) and is_demo = 0"),
    "duplicate_filename": "select null as entry_id, null as title, '/zxdb/sinclair/entries/.../' || regexp_extract(file_link, '[^/]*$') as details, 1 as occurrences from cat_downloads where regexp_matches(file_link, '(?s)^/zxdb/sinclair/entries/.*[.]t(ap|zx)[.]zip$') group by details having count(*) > 1",
    "deprecated_without_original": _entries("availabletype_id = '*' and not exists (select 1 from cat_relations r where r.entry_id = id and r.relationtype_id = '*')", "null"),
    "deprecated_as_original": _entries("availabletype_id = '*' and exists (select 1 from cat_relations r where r.original_id = id)", "null"),
    "duplicate_not_deprecated": _entries("availabletype_id is distinct from '*' and exists (select 1 from cat_relations r where r.entry_id = id and r.relationtype_id = '*')", "null"),
    "magazine_without_issues": "select null as entry_id, null as title, m.name || ' (' || m.id || ')' as details, 1 as occurrences from cat_magazines m where coalesce(link_mask, archive_mask) is not null and not exists (select 1 from cat_issues i where i.magazine_id = m.id)",
    "note_is_license": _notes("starts_with(text, 'Based') and entry_id is not null"),
    "multiple_origins": "select e.id as entry_id, e.title, t.text as details, count(*) as occurrences from cat_relations a join cat_relations b on b.entry_id = a.entry_id and b.relationtype_id = a.relationtype_id and b.original_id > a.original_id join cat_relationtypes t on t.id = a.relationtype_id join cat_entries e on e.id = a.entry_id where a.relationtype_id in ('p', 'u') group by e.id, e.title, t.text",
    "missing_contents": _entries("genre is not null and (genretype_id = 80 or genretype_id = 81 or genretype_id >= 110) and not exists (select 1 from cat_contents c where c.container_id = id)", "genre"),
    "itch_link_in_downloads": _downloads("filetype_id = 0 and contains(file_link, 'itch.io')"),
    "redundant_contents_alias": "select e.id as entry_id, e.title, cast(c.container_id as varchar) as details, 1 as occurrences from cat_contents c join cat_entries e on e.id = c.entry_id and e.title = c.alias",
    "misclassified_editor": _entries("genretype_id = 52 and exists (select 1 from cat_relations r where r.entry_id = id and r.relationtype_id = 'e')", "genre"),
    "editor_without_game": _entries("genretype_id = 53 and not exists (select 1 from cat_relations r where r.entry_id = id and r.relationtype_id = 'e')", "genre"),
    "web_link_mismatch": """
        select e.id as entry_id, e.title, r.link as details, 1 as occurrences from cat_webrefs r
        join cat_entries e on e.id = r.entry_id join cat_websites w on w.id = r.website_id
        where not starts_with(r.link, w.link) and not case
          when r.website_id = 10 then regexp_matches(r.link, '^https://.*[.]wikipedia[.]org/wiki/')
          when r.website_id in (16, 19) then regexp_matches(r.link, '^https://(youtu[.]be|www[.]youtube[.]com)/')
          when r.website_id in (36, 37) then starts_with(r.link, 'https://youtu.be/')
          when r.website_id = 31 then regexp_matches(r.link, '^https://.*[.]itch[.]io/') else false end""",
    "page_before_cover": "select e.id as entry_id, e.title, t.text || ': ' || m.name || ' (issue-id ' || i.id || ')' as details, 1 as occurrences from cat_magrefs r join cat_issues i on i.id = r.issue_id and r.page < i.cover_page join cat_magazines m on m.id = i.magazine_id join cat_referencetypes t on t.id = r.referencetype_id left join cat_entries e on e.id = r.entry_id",
    "tape_date_conflict": f"""
        select e.id as entry_id, e.title, coalesce(cast(r.release_year as varchar), '-') || '/' || coalesce(cast(r.release_month as varchar), '-') || '/' || coalesce(cast(r.release_day as varchar), '-') || ' vs ' || coalesce(cast(i.date_year as varchar), '-') || '/' || coalesce(cast(i.date_month as varchar), '-') || '/' || coalesce(cast(i.date_day as varchar), '-') as details, 1 as occurrences
        from cat_entries e join cat_releases r on r.entry_id = e.id and r.release_seq = 0 join cat_issues i on i.id = e.issue_id
        where e.genretype_id <> 81 and (r.release_year, r.release_month, r.release_day) is distinct from (i.date_year, i.date_month, i.date_day)
          and e.id not in ({_original('contents')}) and e.id not in ({_original('booktypeins')}) and e.id not in ({_original('magrefs')})""",
    "multiple_originals": """
        select e.id as entry_id, e.title, (c.n + m.n + b.n) || ' original publications' as details, 1 as occurrences from cat_entries e,
          lateral (select count(distinct container_id) as n from cat_contents x where x.entry_id = e.id and x.is_original = 1) c,
          lateral (select count(distinct i.magazine_id) as n from cat_magrefs x join cat_issues i on i.id = x.issue_id where x.entry_id = e.id and x.is_original = 1) m,
          lateral (select count(distinct book_id) as n from cat_booktypeins x where x.entry_id = e.id and x.is_original = 1) b
        where c.n + m.n + b.n > 1""",
    "original_date_conflict": f"select e.id as entry_id, e.title, null as details, 1 as occurrences from cat_entries e join cat_releases r on r.entry_id = e.id and r.release_seq = 0 and r.release_year is not null where e.id in (select entry_id from ({ORIGINALS}) where entry_id is not null)",
    "original_publisher_conflict": f"select e.id as entry_id, e.title, null as details, 1 as occurrences from cat_entries e where exists (select 1 from cat_publishers p where p.entry_id = e.id and p.release_seq = 0) and e.id in (select entry_id from ({ORIGINALS}) where entry_id is not null)",
    "original_price_conflict": f"select e.id as entry_id, e.title, null as details, 1 as occurrences from cat_entries e join cat_releases r on r.entry_id = e.id and r.release_seq = 0 and r.currency_id is not null where e.id in (select entry_id from ({ORIGINALS}) where entry_id is not null)",
    "note_is_compilation": _notes("starts_with(text, 'Came') and entry_id is not null"),
    "note_is_relation": _notes("starts_with(text, 'Almost') and entry_id is not null"),
    "unidentified_file": "select null as entry_id, null as title, file_link as details, 1 as occurrences from cat_files where label_id is null and issue_id is null and tool_id is null and regexp_matches(file_link, '^/pub/sinclair/(books-pics/|games-|hardware-|slt/|technical-|zx81/)')",
}

PENDING = over_catalogue(f"""
    select cast(e.id as bigint) as entry_id, e.title, {REF} as details,
      'review from major magazine missing from integrated reviews' as todo
    from cat_magrefs r join cat_issues i on i.id = r.issue_id join cat_magazines m on m.id = i.magazine_id
    join cat_entries e on e.id = r.entry_id
    where r.referencetype_id = 10 and r.review_id is null and coalesce(e.machinetype_id, 0) <= 10
      and (i.magazine_id <> 51 or i.volume <> 2)
      and not exists (select 1 from cat_magreffeats f where f.magref_id = r.id and f.feature_id = 6455)
      and exists (select 1 from cat_magrefs d join cat_issues j on j.id = d.issue_id
                  where j.magazine_id = i.magazine_id and d.referencetype_id = 10 and d.review_id is not null)""")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def check_select(name: str) -> str:
    return (
        f"select '{name}' as rule, cast(entry_id as bigint) as entry_id, cast(title as varchar) as title,"
        f" cast(details as varchar) as details, {_quoted(REGISTRY[name].warning)} as warning,"
        f" cast(occurrences as bigint) as occurrences from ({BODIES[name]})"
    )


def check_sql(name: str) -> str:
    return over_catalogue(check_select(name))
