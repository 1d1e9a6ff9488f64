"""A catalogue computed from the given test tables by SQL that Spark and DuckDB both read.

Every definition scans its whole source table, so the catalogue grows with the data.
Defects are planted by shifting sequence numbers, redirecting keys or blanking values.
``{part}`` and the like stand for the source table; ``E(...)`` and ``TITLE`` are shorthand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..session import cut_lineage

SOURCES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Entry numbers fall into the four ranges the identifier rules look at.
_ENTRY = (
    "(case when ({0})%20=17 then 1000000+({0}) when ({0})%20=18 then 2000000+({0})"
    " when ({0})%20=19 then 4000000+({0}) else ({0}) end)"
)
_TITLE = (
    "(case when p_partkey%16=6 and p_partkey%5=1"
    " then 'CSSCGC Crap Games Competition '||cast(1996+p_partkey%25 as string)"
    " else p_name||case p_size%10 when 1 then ' II' when 2 then ' III: '||p_type when 3 then ' IV'"
    " when 4 then ' V, '||p_name when 5 then ' ['||cast(p_size as string)||']'"
    " when 6 then ' issue '||cast(p_size as string) when 7 then ', Vol. VIII Vikings'"
    " when 8 then ' no. '||cast(p_partkey as string)||' [48K]' else '' end end)"
)
_MONTH = (
    "(case month({0}) when 1 then 'January' when 2 then 'February' when 3 then 'March'"
    " when 4 then 'April' when 5 then 'May' when 6 then 'June' when 7 then 'July'"
    " when 8 then 'August' when 9 then 'September' when 10 then 'October'"
    " when 11 then 'November' else 'December' end)"
)
# A block of 16 parts has its containers at offsets 6 to 9 (proper ones) and 11 (a wrong one).
_CONTAINER = (
    "(l_partkey-l_partkey%16+case l_linenumber when 2 then 7 when 3 then 8 when 4 then case"
    " when l_partkey%144<16 then 6 else 9 end when 5 then 11 else 6 end)"
)

DEFINITIONS: dict[str, str] = {
    "entries": """
        select E(p_partkey+1) as id, TITLE as title,
          case when p_partkey%50=0 then 'The '||p_name when p_partkey%13=0 then p_name||' Alt'
               else TITLE end as library_title,
          case p_partkey%16 when 0 then 20 when 1 then 30 when 2 then 40 when 3 then 50 when 4 then 52
               when 5 then 53 when 6 then 80 when 7 then 81 when 8 then 82 when 9 then 111
               when 10 then null else 1 end as genretype_id,
          nullif(p_partkey%30,0) as machinetype_id,
          case when p_partkey%7=0 or p_partkey%16 in (7,8) then p_partkey+1 end as issue_id,
          case p_partkey%17 when 0 then '*' when 1 then 'N' when 2 then null else 'A' end as availabletype_id
        from {part}
        union all
        select id, title, title, genre, machine, cast(null as bigint), 'A' from (values
          (31929,'Exempt loading screen',1,19),(31930,'Same without exemption',1,19),(37752,'Exempt running screen',1,1),
          (37753,'Same without exemption 2',1,1),(2000113,'Exempt release',1,1),(2000114,'Same without exemption 3',1,1)
        ) t(id, title, genre, machine)""",
    "labels": """
        select c_custkey+1 as id,
          case when c_custkey%18=0 then left(c_name,12)||' [2]' when c_custkey%9=0 then c_name||' [2]'
               else c_name end as name,
          case c_custkey%4 when 0 then '+' when 1 then '-' when 2 then 'C' else null end as labeltype_id,
          case when c_custkey%40=1 then c_custkey+2 when c_custkey%4=1 then c_custkey-c_custkey%8+1
               end as owner_id,
          case when c_custkey%6=0 then cast(floor(c_custkey/2) as bigint)+1 end as from_id
        from {customer}
        union all
        select 900000001+n_nationkey, 'Lost '||n_name, '+', cast(null as bigint), 800000001+n_nationkey from {nation}""",
    "releases": """
        select case when l_partkey%29=0 then 9000000+l_partkey else E(l_partkey+1) end as entry_id,
          l_linenumber-1+case when l_partkey%7=0 and l_linenumber>4 then 1 else 0 end as release_seq,
          case when l_partkey%11=0 then null else cast(year(min(l_shipdate)) as int) end as release_year,
          cast(month(min(l_shipdate)) as int) as release_month,
          case when l_partkey%3=0 then cast(day(min(l_shipdate)) as int) end as release_day,
          case when l_partkey%5=0 then 'GBP' end as currency_id
        from {lineitem} group by l_partkey, l_linenumber""",
    "authors": """
        select E(l_partkey+1) as entry_id,
          l_linenumber+case when l_partkey%5=0 and l_linenumber>2 then 1 else 0 end as author_seq,
          min(l_suppkey)*10+l_linenumber+1 as label_id,
          case when l_linenumber%3=0 then max(l_suppkey)*10+l_partkey%10+1 end as team_id
        from {lineitem} group by l_partkey, l_linenumber""",
    "publishers": """
        select E(l_partkey+1) as entry_id, l_linenumber-1 as release_seq,
          case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end as publisher_seq,
          min(l_suppkey)*10+l_linenumber+1 as label_id
        from {lineitem} group by l_partkey, l_linenumber, l_returnflag
        union all
        select c_custkey-c_custkey+7, 0, cast(c_custkey+10 as int), c_custkey+1 from {customer}
        union all
        select E(n_nationkey+1), 0, cast(1000000+n_nationkey as int), 800000001+n_nationkey from {nation}""",
    "contents": """
        select E(CONTAINER+1) as container_id,
          case l_linenumber when 6 then 2 when 7 then 3 else 1 end as media_seq,
          l_linestatus as media_side,
          l_partkey%16+1+case when l_partkey%16>8 and l_partkey%3=0 then 1 else 0 end as prog_seq,
          case when l_partkey%23<>0 and l_partkey<>CONTAINER then E(l_partkey+1) end as entry_id,
          case when l_partkey%19=0 then min(l_suppkey)*10+1 end as label_id,
          case when l_partkey%21=0 then min(p_title) when l_partkey%7=0
               then 'Alias '||cast(min(l_orderkey) as string) end as alias,
          case when l_partkey%5=0 and l_partkey%23<>0 and l_partkey<>CONTAINER and l_linenumber<4
               then 1 else 0 end as is_original
        from {lineitem} join (select p_partkey, TITLE as p_title from {part}) p on p_partkey=l_partkey
        group by l_partkey, l_linenumber, l_linestatus""",
    "tags": """
        select s_suppkey+1 as id, 'Tag '||s_name as name,
          case s_suppkey%4 when 0 then 'S' when 1 then 'U' when 2 then 'T' else 'C' end as tagtype_id
        from {supplier}
        union all
        select 10000001+n_nationkey, case when n_nationkey<10 then 'Tag '||n_name
          else 'CSSCGC Crap Games Contest '||cast(1996+n_nationkey as string) end,
          case when n_nationkey<5 then 'T' when n_nationkey<10 then 'S' else 'C' end
        from {nation}""",
    "members": """
        select l_suppkey+1 as tag_id, E(l_linenumber+10*(l_suppkey%16)+1) as entry_id,
          case when l_suppkey%8=0 and l_linenumber=3 then null
               when l_suppkey%12=4 and l_linenumber>4 then l_linenumber+1
               when l_suppkey%4=0 or l_suppkey%12=1 then l_linenumber end as series_seq
        from {lineitem} group by l_suppkey, l_linenumber
        union all
        select 10000006+n_nationkey%5, E(n_nationkey%5+1), cast(floor(n_nationkey/5) as int)+1 from {nation}
        union all
        select 10000011+p_partkey%15, E(p_partkey+1), cast(null as int) from {part}""",
    "magazines": """
        select s_suppkey+1 as id, s_name as name,
          case when s_suppkey%2=0 then '/{{y4}}/{{i3}}-{{v1}}/{{p2}}' end as link_mask,
          case when s_suppkey%5=0 then '/{{M3}}{{y4}}{{s0}}{{u0}}' end as archive_mask
        from {supplier}
        union all
        select id, name, cast(null as string), cast(null as string) from (values
          (8000001,'ACE (Advanced Computer Entertainment)'),(8000002,'Sinclair User'),(8000003,'ZX Collection'),
          (8000004,'Popular Computing Weekly'),(8000005,'ZX Computing'),(8000006,'Which Micro? & Software Review')) t(id, name)""",
    "issues": """
        select o_orderkey+1 as id, cast(floor(o_custkey/16) as int)+1 as magazine_id,
          case when o_orderkey%10<>3 then nullif(cast(o_orderkey%400 as int),0) end as number,
          case when o_orderkey%9=0 then cast(o_orderkey%3+1 as int) end as volume,
          case when o_orderkey%50=0 then 'Annual' end as special,
          case when o_orderkey%60=0 then 'Extra' end as supplement,
          case when o_orderkey%31<>0 then cast(year(o_orderdate) as int) end as date_year,
          case when o_orderkey%11<>0 then cast(month(o_orderdate) as int) end as date_month,
          case when o_orderkey%4=0 then cast(day(o_orderdate) as int) end as date_day,
          case when o_orderkey%45=1 then o_orderkey end as parent_id,
          case when o_orderkey%5=0 then 3 end as cover_page
        from {orders}
        union all
        select id, magazine_id, number, cast(null as int), special, supplement, date_year, date_month, cast(null as int),
          parent_id, cast(null as int) from (values
          (7000001,8000002,cast(null as int),'Annual 1984',cast(null as string),1984,cast(null as int),cast(null as bigint)),
          (7000002,8000003,null,null,null,1984,12,null),(7000003,8000004,21,null,'Extra',1986,5,7000006),
          (7000004,8000005,null,null,null,1982,8,null),(7000005,8000002,null,null,'Top 50 Spectrum Software Classics',1983,1,7000001),
          (7000006,8000004,20,null,null,1986,5,null),(7000007,8000001,12,null,null,1988,9,null)
        ) t(id, magazine_id, number, special, supplement, date_year, date_month, parent_id)""",
    "magrefs": """
        select event_id+1 as id, cast(floor(event_id/2) as bigint)+1 as issue_id,
          cast(floor(value) as int)%100 as page,
          case when event_type<>'error' then E(user_id+1) end as entry_id,
          case when event_type='error' and event_id%2=0 then user_id+1 end as label_id,
          case when event_type='error' and event_id%3=0 then 1 end as topic_id,
          case when event_type='click' and event_id%4=0 then cast(floor(user_id/2) as bigint)+1 end as award_id,
          case event_type when 'click' then 10 when 'view' then 2 else 3 end as referencetype_id,
          case when event_type='purchase' and event_id%9=0 then 1 else 0 end as is_original,
          case when event_type='click' and event_id%2=0 then event_id+1 end as review_id,
          '' as score_group
        from {events}""",
    "downloads": """
        select page_id+1 as id, E(page_id+1) as entry_id,
          case page_id%8 when 0 then url
            when 1 then '/pub/sinclair/games/'||cast(page_id%20 as string)||'.dat'
            when 2 then '/zxdb/sinclair/entries/'||lpad(cast(E(page_id+1) as string),7,'0')||'/f'
                        ||cast(page_id%10 as string)||'.tap.zip'
            when 3 then '/zxdb/sinclair/entries/0000000/g-'||cast(page_id as string)||'.xyz'
            when 4 then 'https://archive.org/details/'||cast(page_id as string)||'.tap'
            when 5 then '/zxdb/x/SourceCode(demo)'||cast(page_id as string)||'.tar.bz2'
            when 6 then '/zxdb/x/a-load-'||cast(page_id as string)||'.scr'
            else 'https://dev.itch.io/'||cast(page_id as string) end as file_link,
          cast(case when page_id%16=7 then 0 else page_id%12 end as int) as filetype_id, nullif(page_id%26,0) as machinetype_id,
          page_id%8 as scr_border, case when page_id%5=0 then 1 else 0 end as is_demo,
          cast(floor(page_id/2) as int)%2 as release_seq, cast(length(html) as int) as file_size, md5(html) as file_md5
        from {pages}
        union all
        select id, entry_id, file_link, filetype_id, machinetype_id, 7, 0, 0, 1, md5(file_link) from (values
          (9000001,31929,'/zxdb/x/a-load-31929.scr',1,19),(9000002,31930,'/zxdb/x/a-load-31930.scr',1,19),
          (9000003,37752,'/zxdb/x/37752.scr',2,1),(9000004,37753,'/zxdb/x/37753.scr',2,1),
          (9000005,2000113,'/zxdb/x/(2000113).tap',8,1),(9000006,2000114,'/zxdb/x/(2000114).tap',8,1)
        ) t(id, entry_id, file_link, filetype_id, machinetype_id)""",
    "files": """
        select page_id+1 as id, case when page_id%4=0 then page_id+1 end as label_id,
          case when page_id%4=1 then page_id+1 end as issue_id, case when page_id%4=2 then 1 end as tool_id,
          case when page_id%10=9 then '/zxdb/sinclair/docs' else '/pub/sinclair/'||case when page_id%3=0
               then 'games-info' else 'docs' end end||'/'||cast(page_id as string)||'.txt' as file_link,
          cast(length(url) as int) as file_size, md5(url) as file_md5
        from {pages}""",
    "scraps": """
        select page_id+1 as id, E(page_id+1) as entry_id,
          case page_id%5 when 0 then null when 1 then '/pub/sinclair/games/'||cast(page_id%20 as string)||'.dat'
               else '/zxdb/old/'||cast(page_id as string)||'.tap' end as file_link,
          case page_id%3 when 0 then 'unavailable (distribution denied)' when 1 then null
               else 'obsolete' end as rationale,
          0 as file_size
        from {pages}""",
    "notes": """
        select E(doc_id+1) as entry_id,
          case doc_id%10 when 0 then '{{1|a|b}}' when 1 then 'see {{1|a}}' when 2 then 'Based on '||text
            when 3 then 'Came with '||text when 4 then 'Almost '||text when 5 then '[a + b]'
            when 6 then 'aka. '||text when 7 then '{{1|a|b}} and {{2|cx}}' else text end as text
        from {documents}""",
    "relations": """
        select distinct E(o_custkey+1) as entry_id, E(cast(floor(o_orderkey/8) as bigint)+1) as original_id,
          case o_orderkey%12 when 0 then 'a' when 1 then 'e' when 2 then 'p' when 3 then 'u' when 4 then '*'
               else 'i' end as relationtype_id
        from {orders}""",
    "aliases": """
        select E(p_partkey+1) as entry_id, p_partkey%2 as release_seq,
          case when p_partkey%9=0 then TITLE else p_brand||' VI' end as title from {part}""",
    "webrefs": """
        select E(page_id+1) as entry_id, url as link,
          case page_id%5 when 0 then 6 when 1 then 10 when 2 then 16 when 3 then 31 else 40 end as website_id,
          'en' as language_id
        from {pages}""",
    "booktypeins": """
        select E(o_custkey+1) as entry_id, E(cast(floor(o_custkey/20) as bigint)*20+18) as book_id,
          case when count(*)%4=0 then 1 else 0 end as is_original
        from {orders} group by o_custkey""",
    "reviews_src": """
        select doc_id as review_id, E(doc_id+1) as game_id, doc_id+1 as issue_code,
          case doc_id%6 when 0 then cast(doc_id%90 as string)||'(Supplement)'
            when 1 then cast(doc_id%90 as string)||'.'||cast(doc_id%7 as string) when 2 then ''
            else cast(doc_id%90 as string) end as review_page,
          case when doc_id%5=0 then chr(10)||text||chr(13)||chr(10)||chr(10)
               when doc_id%41=0 then '' else text end as review_text,
          case when doc_id%4=0 then 'x'||chr(172)||'y'||chr(10) end as review_comments,
          case when doc_id%7=0 then chr(10)||lang||chr(10)||chr(10)||chr(10)||chr(10) end as review_rating,
          source as reviewers,
          case when doc_id%10=0 then 999 when doc_id%3=0 then cast(doc_id%25+1 as int) end as award_id,
          cast(doc_id%25+1 as int) as mag_type
        from {documents}""",
    "scores_src": """
        select conv_id as review_id, turn+1 as header_order,
          case when turn=0 then 'Graphics' when turn=1 then 'Overall' when turn=2 then 'Overall (48K)'
               when turn=3 then 'Ace Rating' else role end as review_header,
          case when turn%4=3 then null else cast(length(text)%100 as string)||' ' end as review_score,
          case when turn%2=0 then '%' when conv_id%6=0 then 'K)' end as score_suffix,
          case when turn%3=0 then chr(10)||text||chr(13)||chr(10) end as score_text
        from {conversations}""",
    "compilations_src": """
        select conv_id*1000+turn as score_id, conv_id as review_id, E(conv_id+turn+1) as game_id,
          turn+1 as header_order, role as review_header, cast(length(text)%10 as string) as review_score,
          case when turn%2=0 then '/10' end as score_suffix
        from {conversations}""",
    "captions_src": """
        select event_id+1 as id, user_id as review_id, chr(10)||event_type||chr(13)||chr(10) as caption,
          case when event_type='error' then 1 else 0 end as is_banner
        from {events}""",
    "magazines_src": """
        select s_suppkey+1 as mag_id, case when s_suppkey%8=7 then 'Unknown '||s_name else lower(s_name) end
          as mag_name
        from {supplier}
        union all
        select * from (values (9000001,'Sinclair User Annual'),(9000002,'ZX Collection'),
          (9000003,'Popular Computing Weekly Supplement'),(9000004,'ZX Computing'),(9000005,'Sinclair User'),(9000006,'ACE'),
          (9000007,'Which Micro Software Review')) t(mag_id, mag_name)""",
    "issues_src": """
        select o_orderkey+1 as issue_code, cast(floor(o_custkey/16) as int)+1 as mag_id,
          case o_orderkey%5
            when 0 then 'Issue '||cast(o_orderkey%400 as string)||', '||MONTH(o_orderdate)||' '
                        ||cast(year(o_orderdate) as string)
            when 1 then 'Issue 0'||cast(o_orderkey%400 as string)||', '||MONTH(o_orderdate)||' '
                        ||cast(year(o_orderdate) as string)
            when 2 then 'Issue '||MONTH(o_orderdate)||' '||cast(year(o_orderdate) as string)
            when 3 then 'Issue '||cast((o_orderkey+1)%400 as string)||', Someday' else 'Annual' end as issue
        from {orders}
        union all
        select * from (values (9100001,9000001,'1984 Annual'),(9100002,9000002,'Issue December 1984'),
          (9100003,9000003,'Issue May 1986'),(9100004,9000004,'Issue September 1982'),
          (9100005,9000005,'Top 50 Spectrum Software Classics'),(9100006,9000006,'Issue 12, September 1988')) t(issue_code, mag_id, issue)""",
    "reviewers_src": "select user_id as reviewer_id, cast(user_id%120 as int)+1 as mag_id from {events} group by user_id",
    "awards_src": "select n_nationkey as award_id, n_nationkey*5+1 as mag_type from {nation}",
    "genretypes": """
        select * from (values (1,'Arcade'),(20,'Book: Reference'),(30,'Hardware: Joystick'),
          (40,'Utility: Editor'),(50,'Programming: Assembler'),(52,'Game Editor'),(53,'Game Editor Data'),
          (80,'Compilation'),(81,'Covertape'),(82,'Electronic Magazine'),(111,'Demo Compilation')) t(id, text)""",
    "machinetypes": """
        select n_nationkey+1 as id, case when n_nationkey in (7,8) then 'Timex '||cast(n_nationkey as string)
          else 'Machine '||cast(n_nationkey as string) end as text from {nation}""",
    "tagtypes": "select * from (values ('S','Series'),('U','Unsorted Group'),('T','Theme'),('C','Competition')) t(id, text)",
    "relationtypes": """
        select * from (values ('a','Authored with'),('e','Editor of'),('p','Port of'),('u','Updated from'),
          ('i','Inspired by'),('*','Duplicate of')) t(id, text)""",
    "referencetypes": "select * from (values (2,'Preview'),(3,'Advert'),(10,'Review')) t(id, text)",
    "extensions": "select * from (values ('.tap'),('.scr'),('.tzx'),('.html')) t(ext)",
    "websites": """
        select * from (values (6,'http://'),(10,'https://en.wiki.example/'),(16,'https://m.'),
          (31,'https://blog.'),(40,'https://')) t(id, link)""",
    "hosts": "select * from (values (1,'https://'),(2,'http://')) t(id, link)",
    "magreflinks": "select page_id+1 as magref_id, url as link, cast(page_id%2+1 as int) as host_id from {pages}",
    "awards": "select s_suppkey+1 as id, s_suppkey%24+1 as magazine_id from {supplier}",
    "licenses": """
        select r_regionkey+1 as id, r_name as name, case when r_regionkey%2=0 then '-' else 'B' end
          as licensetype_id from {region}""",
    "licensors": "select r_regionkey+1 as license_id, r_regionkey*3+1 as label_id from {region}",
    "relatedlicenses": "select E(p_partkey+1) as entry_id, cast(p_partkey%3+1 as int) as license_id from {part}",
    "features": """
        select n_nationkey*40+100 as id, 'Section '||n_name as name from {nation}
        union all select cast(s_suppkey as int)+100, lower(s_name) from {supplier}""",
    "magreffeats": """
        select event_id+1 as magref_id,
          cast(case when event_id%50=0 then 6455 else event_id%20*40+100 end as int) as feature_id
        from {events}""",
    "ports": "select E(s_suppkey+1) as entry_id from {supplier}",
    "remakes": "select E(n_nationkey+1) as entry_id from {nation}",
}


# Tables whose rows are groups of a source's rows, which each use of a definition exchanges anew.
GROUPED = ("releases", "authors", "publishers", "contents", "members", "relations", "booktypeins")


def _expand(sql: str) -> str:
    sql = sql.replace("TITLE", _TITLE).replace("CONTAINER", _CONTAINER)
    for mark, body in (("E", _ENTRY), ("MONTH", _MONTH)):
        while (hit := re.search(rf"\b{mark}\(", sql)) is not None:
            depth, at = 1, hit.end()
            while depth:
                depth += {"(": 1, ")": -1}.get(sql[at], 0)
                at += 1
            sql = sql[: hit.start()] + body.format(sql[hit.end() : at - 1]) + sql[at:]
    return re.sub(r"\s+", " ", sql).strip()


def spark_sql(name: str, sf_dir: str) -> str:
    return _expand(DEFINITIONS[name]).format(**{t: f"parquet.`{sf_dir}/{t}.parquet`" for t in SOURCES})


def oracle_cte(names: list[str]) -> str:
    """A ``with`` prefix that defines ``cat_<name>`` for each name."""
    tables = {t: t for t in SOURCES}
    return "with " + ",\n".join(f"cat_{n} as ({_expand(DEFINITIONS[n]).format(**tables)})" for n in names)


class DerivedCatalogue(Mapping[str, DataFrame]):
    """The derived tables of one data folder, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._stored: dict[str, DataFrame] = {}

    def with_grouped_stored(self) -> DerivedCatalogue:
        """The same catalogue for a job that reads its tables often: grouped ones are written, whole, and read from there."""
        stored = DerivedCatalogue(self._spark, self._dir)
        stored._stored = {name: cut_lineage(self[name], name) for name in GROUPED}
        return stored

    def __getitem__(self, name: str) -> DataFrame:
        if name not in DEFINITIONS:
            raise KeyError(name)
        if name in self._stored:
            return self._stored[name]
        return self._spark.sql(spark_sql(name, self._dir))

    def __iter__(self) -> Iterator[str]:
        return iter(DEFINITIONS)

    def __len__(self) -> int:
        return len(DEFINITIONS)
