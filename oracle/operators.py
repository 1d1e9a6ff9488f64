"""DuckDB queries for operators over the plain test tables and for table-level jobs."""

from __future__ import annotations

from shelfmark.fixtures.derived import DEFINITIONS
from shelfmark.fixtures.files import DUMP_BATCH, DUMP_LAYOUTS
from shelfmark.schema import TABLES

from . import over_catalogue
from .checks import REGISTRY, check_select
from .search import TITLES

ROW_RULES = [r.name for r in REGISTRY.values() if r.base is not None]


def _broken(table: str, column: str, parent: str) -> str:
    return (
        f"select '{table}' as tab, '{column}' as col, cast(c.{column} as varchar) as value, count(*) as occurrences"
        f" from cat_{table} c where c.{column} is not null and not exists (select 1 from cat_{parent} p where p.{TABLES[parent].key[0]} = c.{column})"
        f" group by c.{column}"
    )


def _mask(parts: list[tuple[str, str]]) -> str:
    return " || ".join(f"'{text}' || coalesce({value}, '')" for text, value in parts)


def _padded(column: str, width: int) -> str:
    return f"lpad(cast({column} as varchar), greatest({width}, length(cast({column} as varchar)))::int, '0')"


_MONTH = (
    "left((['January','February','March','April','May','June','July','August','September','October','November',"
    "'December'])[i.date_month], 3)"
)
_LINK = _mask([("/", _padded("i.date_year", 4)), ("/", _padded("i.number", 3)), ("-", _padded("i.volume", 1)), ("/", _padded("r.page", 2))])
_ARCHIVE = _mask([("/", _MONTH), ("", _padded("i.date_year", 4)), ("", "'#' || i.special"), ("", "'#' || i.supplement")])

SQL = {
    "lineitem_sequence_gaps": """
        select c.l_orderkey, cast(c.l_linenumber as bigint) as l_linenumber, count(*) as occurrences from lineitem c
        where c.l_linenumber > 1 and not exists (select 1 from lineitem p where p.l_orderkey = c.l_orderkey and p.l_linenumber = c.l_linenumber - 1)
        group by c.l_orderkey, c.l_linenumber""",
    "orders_without_lineitem": "select o_orderkey, o_custkey from orders anti join lineitem on l_orderkey = o_orderkey",
    "orders_same_customer_date": """
        select a.o_custkey, cast(cast(a.o_orderdate as date) as varchar) as o_orderdate, count(*) as occurrences from orders a
        join orders b on b.o_custkey = a.o_custkey and cast(b.o_orderdate as date) = cast(a.o_orderdate as date) and a.o_orderkey < b.o_orderkey
        group by all""",
    "lineitem_ship_inversions": """
        with points as (select l_orderkey, cast(l_linenumber as bigint) as seq, cast(datediff('day', date '1970-01-01', cast(l_shipdate as date)) as bigint) as value from lineitem)
        select b.l_orderkey, b.seq, b.value, max(a.value) as first_value, -max((a.value, -a.seq))[2] as first_seq, count(*) as occurrences
        from points a join points b on b.l_orderkey = a.l_orderkey and a.seq < b.seq and a.value > b.value group by b.l_orderkey, b.seq, b.value""",
    "orders_same_return_flags": """
        with keyed as (select l_orderkey, string_agg(l_returnflag, ',' order by l_returnflag) as k from lineitem group by l_orderkey),
        ranked as (select o_orderkey as id, o_orderpriority as name, k, row_number() over (partition by k order by o_orderkey) as place,
                     first_value(o_orderkey) over (partition by k order by o_orderkey) as first_id from orders join keyed on l_orderkey = o_orderkey)
        select first_id, id, name, place - 1 as occurrences from ranked where place > 1""",
    "documents_canonical": "select doc_id, min(doc_id) over (partition by text) as first_id from documents",
    "events_numbered": """
        select event_id, user_id, cast(place as int) as seq
        from (select event_id, user_id, row_number() over (partition by user_id order by event_id) as place from events)""",
    "conversations_last_turn": "select conv_id, turn, role from conversations qualify turn = max(turn) over (partition by conv_id)",
    "documents_without_label": "select doc_id, lang from documents where doc_id not in (select doc_id from labels)",
    "labels_without_document": "select doc_id, quality from labels where doc_id not in (select doc_id from documents)",
    "lineitem_repeated_keys": "select l_orderkey, l_linenumber, count(*) as occurrences from lineitem group by all having count(*) > 1",
    "parts_first_supplier": "select l_partkey, min(l_suppkey) as l_suppkey from lineitem group by l_partkey",
    "orders_numbered": """
        select o_orderkey, 1000 + row_number() over (order by left(md5(concat_ws('|', o_custkey, o_orderkey)), 4), o_custkey, o_orderkey) as id from orders""",
    "catalogue_broken_references": over_catalogue(" union all ".join(
        _broken(t, c, p) for t in DEFINITIONS for c, p in TABLES[t].references.items()
    )),
    "magazine_page_links": over_catalogue(f"""
        select r.id as magref_id, case when m.link_mask is not null then {_LINK} end as page_link,
          case when m.archive_mask is not null then {_ARCHIVE} end as archive_link
        from cat_magrefs r join cat_issues i on i.id = r.issue_id join cat_magazines m on m.id = i.magazine_id"""),
    "series_gaps_plain": over_catalogue("""
        select cast(m.entry_id as bigint) as entry_id, e.title, g.name || ' (' || g.id || ')' as details, cast(1 as bigint) as occurrences
        from cat_members m join cat_tags g on g.id = m.tag_id left join cat_entries e on e.id = m.entry_id
        where m.series_seq > 1 and not exists (select 1 from cat_members p where p.tag_id = m.tag_id and p.series_seq = m.series_seq - 1)"""),
    "findings_in_one_pass": over_catalogue(" union all ".join(check_select(n) for n in ROW_RULES)),
    "findings_per_rule": over_catalogue(
        "select rule, count(*) as findings, cast(sum(occurrences) as bigint) as occurrences from ("
        + " union all ".join(check_select(r.name) for r in REGISTRY.values()) + ") group by rule"
    ),
    "rebuild_titles": over_catalogue(TITLES),
    "refresh_titles": over_catalogue(TITLES),
    "export_batches": over_catalogue("select 'issues' as tab, count(*) as rows, true as in_batches from cat_issues union all select 'labels', count(*), true from cat_labels"),
    "dump_rejects": over_catalogue(" union all ".join(
        f"select if(v.problem = 'head not read', '', '{t}') as tab, v.problem, v.text, count(distinct floor({c} / {DUMP_BATCH})) as occurrences from cat_{t},"
        " (values ('not read to its end', chr(9) || '(1, \'\'no end', 0, 1), ('does not fit its columns', '(1)', 0, 1),"
        f" ('head not read', 'INSERT INTO `catalogue`.`{t}` SET `id` = 1;', 3, 3)) v(problem, text, low, high)"
        f" where floor({c} / {DUMP_BATCH}) % {DUMP_LAYOUTS} between v.low and v.high group by v.problem, v.text"
        for t, c in (("labels", "id"), ("notes", "entry_id"))
    )),
    "dump_labels": over_catalogue("select cast(id as int) as id, name, labeltype_id, cast(owner_id as int) as owner_id, cast(from_id as int) as from_id from cat_labels"),
    "dump_notes": over_catalogue("select cast(entry_id as int) as entry_id, text from cat_notes"),
}
