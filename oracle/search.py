"""DuckDB queries for the search indexes and lookups."""

from __future__ import annotations

from . import over_catalogue

_PEOPLE = "(labeltype_id is null or labeltype_id = '+' or labeltype_id = '-')"


def _key(text: str, marker: bool) -> str:
    bare = f"translate(lower({text}), ' -.,\"''/:!', '')"
    bare = f"replace({bare}, '[sam]', '')" if marker else bare
    return f"translate({bare}, '[]', '')"


def _variants() -> str:
    rows = ", ".join(f"(' {r}', ' {d}')" for d, r in enumerate(("II", "III", "IV", "V", "VI", "VII", "VIII"), 2))
    return (
        "select entry_id, replace(title, roman, digit) as title from named, (values " + rows + ") r(roman, digit)"
        " where regexp_matches(title, roman || '([ ,:+]|$)')"
    )


TITLES = f"""
    select distinct {_key('title', True)} as entry_title, cast(entry_id as bigint) as entry_id
    from (with named as (select id as entry_id, title from cat_entries union all select entry_id, title from cat_aliases)
          select * from named union all {_variants()}
          union all select entry_id, alias from cat_contents where alias is not null and entry_id is not null)"""
NAMES = f"select distinct {_key('name', False)} as label_name, cast(id as bigint) as label_id from cat_labels"


def _closure(seed: str) -> str:
    return f"""
    (with seed as (select distinct * from ({seed}) where entry_id is not null and label_id is not null),
     near as (
       select s.entry_id, unnest([s.label_id, b.from_id, b.owner_id]) as label_id from seed s left join cat_labels b on b.id = s.label_id
       union all select s.entry_id, b.id from seed s join cat_labels b on b.from_id = s.label_id and {_PEOPLE}
       union all select s.entry_id, b.id from seed s join cat_labels b on b.owner_id = s.label_id and {_PEOPLE})
     select distinct cast(label_id as bigint) as label_id, cast(entry_id as bigint) as entry_id from near where label_id is not null)"""


AUTHORS = "select * from " + _closure("""
       select entry_id, label_id from cat_authors union all select entry_id, team_id from cat_authors""").replace(
    "unnest([s.label_id, b.from_id, b.owner_id])",
    "unnest([s.label_id, (select p.id from cat_labels p where p.id = b.from_id), (select p.id from cat_labels p where p.id = b.owner_id)])",
)
PUBLISHERS = "select * from " + _closure("""
       select entry_id, label_id from cat_publishers
       union all select c.entry_id, p.label_id from cat_contents c join cat_publishers p on p.entry_id = c.container_id and p.release_seq = 0 where c.is_original = 1
       union all select container_id, label_id from cat_contents""")

_NAME = """
    trim(coalesce('v.' || volume, '') || coalesce(' #' || number, '')
      || coalesce(' - ' || date_year || coalesce('/' || left((['January','February','March','April','May','June','July','August',
         'September','October','November','December'])[date_month], 3) || coalesce('/' || date_day, ''), ''), '')
      || coalesce(' special "' || special || '"', '') || coalesce(' supplement "' || supplement || '"', ''))"""
ISSUE_NAMES = f"select cast(id as bigint) as issue_id, {_NAME} as name from cat_issues"

_ORIGINS = """
    (with held as (select e.id, e.genretype_id as genre, e.issue_id, r.release_year as y, r.release_month as m, r.release_day as d
                   from cat_entries e join cat_releases r on r.entry_id = e.id and r.release_seq = 0),
     found as (
       select 1 as place, e.id as entry_id, 'C' as kind, null as container_id, i.id as issue_id, i.date_year as y, i.date_month as m, i.date_day as d
       from cat_entries e join cat_issues i on i.id = e.issue_id where e.genretype_id = 81
       union all select 2, b.entry_id, 'B', h.id, null, h.y, h.m, h.d from cat_booktypeins b join held h on h.id = b.book_id where b.is_original = 1
       union all select 3, x.entry_id, 'M', null, i.id, i.date_year, i.date_month, i.date_day
       from (select entry_id, min(issue_id) as issue_id from cat_magrefs where is_original = 1 group by entry_id) x join cat_issues i on i.id = x.issue_id
       union all select 4, c.entry_id, 'T', h.id, i.id, i.date_year, i.date_month, i.date_day
       from cat_contents c join held h on h.id = c.container_id and h.genre = 81 join cat_issues i on i.id = h.issue_id where c.is_original = 1
       union all select 5, c.entry_id, case when h.genre = 80 or h.genre between 111 and 114 then 'A' when h.genre = 81 then 'T' when h.genre = 82 then 'E' else 'P' end,
         h.id, null, h.y, h.m, h.d from cat_contents c join held h on h.id = c.container_id where c.is_original = 1)
     select * from found where entry_id is not null
     qualify row_number() over (partition by entry_id order by place, container_id, issue_id) = 1)"""
_ORIGIN_COLUMNS = """
    cast(o.entry_id as bigint) as entry_id, o.kind as origintype_id, cast(o.container_id as bigint) as container_id,
    cast(o.issue_id as bigint) as issue_id, cast(o.y as int) as date_year, cast(o.m as int) as date_month, cast(o.d as int) as date_day"""
ORIGINS = f"select {_ORIGIN_COLUMNS} from {_ORIGINS} o"
PUBLICATIONS = f"""
    select {_ORIGIN_COLUMNS},
      coalesce(g.name, p.names, '?') || ' - ' || case o.kind when 'C' then 'covertape from magazine issue' when 'B' then 'type-in from book'
        when 'M' then 'type-in from magazine issue' when 'A' then 'within compilation' when 'T' then 'within covertape'
        when 'E' then 'within electronic magazine' else 'within program' end || ' '
        || coalesce('"' || e.title || '"', s.name, '?') as publication
    from {_ORIGINS} o left join cat_issues i on i.id = o.issue_id left join cat_magazines g on g.id = i.magazine_id
    left join ({ISSUE_NAMES}) s on s.issue_id = i.id left join cat_entries e on e.id = o.container_id
    left join (select p.entry_id, string_agg(b.name, ', ' order by p.publisher_seq, b.name) as names
               from cat_publishers p join cat_labels b on b.id = p.label_id where p.release_seq = 0 group by p.entry_id) p on p.entry_id = e.id"""


ORIGIN_PUBLISHERS = f"""
    select cast(p.entry_id as bigint) as container_id, cast(p.publisher_seq as int) as publisher_seq, b.name as label
    from cat_publishers p join cat_labels b on b.id = p.label_id
    where p.release_seq = 0 and p.entry_id in (select container_id from {_ORIGINS} o where container_id is not null)"""


def segments(key: str, place: str, text: str, size: int, source: str) -> str:
    """Ordered texts of each group, cut where a multiple of ``size`` bytes has gone before."""
    return f"""
        select {key}, cast(floor(gone / {size}) as bigint) as segment, string_agg({text}, ', ' order by {place}, {text}) as text
        from (select {key}, {place}, {text},
                     coalesce(sum(strlen({text}) + 2) over (partition by {key} order by {place} nulls first, {text}
                                                            rows between unbounded preceding and 1 preceding), 0) as gone
              from ({source})) group by 1, 2"""


LIST_BYTES = 256
PUBLISHER_LISTS = segments("container_id", "publisher_seq", "label", LIST_BYTES, ORIGIN_PUBLISHERS)
MEMBER_LISTS = segments(
    "tag_id", "entry_id", "member", LIST_BYTES,
    "select cast(tag_id as bigint) as tag_id, entry_id, cast(entry_id as varchar) as member from cat_members where entry_id is not null",
)
_SEEDS = {
    "author": "select label_id, entry_id from cat_authors union all select team_id, entry_id from cat_authors",
    "publisher": """select label_id, entry_id from cat_publishers
       union all select p.label_id, c.entry_id from cat_contents c join cat_publishers p on p.entry_id = c.container_id and p.release_seq = 0 where c.is_original = 1
       union all select label_id, container_id from cat_contents""",
}


def credits(by: str) -> str:
    return (
        "select distinct cast(label_id as bigint) as label_id, cast(entry_id as bigint) as entry_id"
        f" from ({_SEEDS[by]}) where label_id is not null and entry_id is not null"
    )


def relations(known: bool) -> str:
    def listed(column):
        return f" and {column} in (select id from cat_labels)" if known else ""

    return "select distinct cast(a as bigint) as label_id, cast(b as bigint) as related_id from (" + " union all ".join(
        f"select id as a, {c} as b from cat_labels where {c} is not null{listed(c)}"
        f" union all select {c}, id from cat_labels where {c} is not null and {_PEOPLE}{listed(c)}"
        for c in ("from_id", "owner_id")
    ) + ")"


def _has(column: str, word: str) -> str:
    return f"contains(strip_accents(lower({column})), '{word}')"


def entries_by_title(word: str) -> str:
    return f"select * from cat_entries where id in (select entry_id from ({TITLES}) where {_has('entry_title', word)})"


def labels_by_name(word: str) -> str:
    return f"select * from cat_labels where id in (select label_id from ({NAMES}) where {_has('label_name', word)})"


def entries_by_label(index: str, word: str) -> str:
    return (
        f"select * from cat_entries where id in (select x.entry_id from ({index}) x join ({NAMES}) n"
        f" on n.label_id = x.label_id where {_has('n.label_name', word)})"
    )


# A refreshed index holds what one built anew does.
_INDEXES = {
    "titles": TITLES, "names": NAMES, **{f"{by}_credits": credits(by) for by in _SEEDS}, "author_relations": relations(True),
    "publisher_relations": relations(False), "issue_names": ISSUE_NAMES, "origins": ORIGINS, "publisher_lists": PUBLISHER_LISTS,
}

SQL = {
    **{f"refreshed_{name}": over_catalogue(sql) for name, sql in _INDEXES.items()},
    "search_titles": over_catalogue(TITLES),
    "search_names": over_catalogue(NAMES),
    "search_authors": over_catalogue(AUTHORS),
    "search_publishers": over_catalogue(PUBLISHERS),
    **{f"search_{by}_credits": over_catalogue(credits(by)) for by in _SEEDS},
    "search_author_relations": over_catalogue(relations(True)),
    "search_publisher_relations": over_catalogue(relations(False)),
    "search_origin_publishers": over_catalogue(ORIGIN_PUBLISHERS),
    "search_publisher_lists": over_catalogue(PUBLISHER_LISTS),
    "tag_member_lists": over_catalogue(MEMBER_LISTS),
    "search_issue_names": over_catalogue(ISSUE_NAMES),
    "search_origins": over_catalogue(ORIGINS),
    "search_origin_publications": over_catalogue(PUBLICATIONS),
    "lookup_entries_by_title": over_catalogue(entries_by_title("widget3")),
    "lookup_labels_by_name": over_catalogue(labels_by_name("#00000012")),
    "grams_entries_by_title": over_catalogue(entries_by_title("widget3")),
    "grams_entries_by_short_word": over_catalogue(entries_by_title("8t")),
    "grams_labels_by_name": over_catalogue(labels_by_name("#00000012")),
    "lookup_entries_by_author": over_catalogue(entries_by_label(AUTHORS, "#00000001")),
    "lookup_entries_by_publisher": over_catalogue(entries_by_label(PUBLISHERS, "#00000001")),
}
