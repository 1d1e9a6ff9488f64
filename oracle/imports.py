"""DuckDB queries for the import jobs: listings, map links and review integration."""

from __future__ import annotations

from shelfmark.fixtures.files import LISTING, MAP_LIST, MIRROR

from . import over_catalogue

_MAPS = f"""
    (with maps as ({MAP_LIST})
     select entry_id, link, cast(website_id as int) as website_id, language_id from cat_webrefs where website_id <> 6
     union all
     select distinct e.id, 'http://maps.speccy.cz/map.php?id=' || left(m.file_image, cast(strlen(m.file_image) - 4 as int)), 6, 'en'
     from maps m join cat_entries e on e.id = try_cast(m.entry as int))"""
_LISTED = f"(select try_cast(file_size as bigint) as file_size, file_link, file_md5 from ({LISTING}) qualify row_number() over (partition by file_link order by n) = 1)"
_MIRRORED = f"""
    (select try_cast(file_size as bigint) as file_size, '2017-06-01' as file_date, '12:00' as file_time, replace(file_link, 'World of Spectrum June 2017 Mirror/', '/pub/') as file_link
     from ({MIRROR}) qualify row_number() over (partition by file_link order by n) = 1)"""
_KNOWN = "(select file_link from cat_downloads union select file_link from cat_files union select file_link from cat_scraps where file_link is not null)"


def _missing(table: str, root: str, listing: str, extra: str = "") -> str:
    return f"select * from cat_{table} x where starts_with(file_link, '{root}') {extra} and not exists (select 1 from {listing} l where l.file_link = x.file_link)"


def _enriched(table: str, digest: bool) -> str:
    hit = "l.file_link is not null and starts_with(x.file_link, '/zxdb/')"
    change = f"cast(case when {hit} and l.file_size is not null then l.file_size else x.file_size end as bigint) as file_size"
    if digest:
        change += f", case when {hit} then l.file_md5 else x.file_md5 end as file_md5"
    return f"select x.* replace ({change}) from cat_{table} x left join {_LISTED} l on l.file_link = x.file_link"


_REVIEWS = """
    mag_map as (
      select s.mag_id, cast(min(m.id) as bigint) as magazine_id, count(distinct m.id) as candidates from cat_magazines_src s
      join cat_magazines m on lower(m.name) = lower(replace(replace(replace(s.mag_name, 'Which Micro Software Review', 'Which Micro? & Software Review'),
        'ACE', 'ACE (Advanced Computer Entertainment)'), 'Computer & Videogames', 'C&VG (Computer & Video Games)'))
      group by s.mag_id),
    theirs as (select s.*, m.magazine_id from cat_issues_src s join mag_map m using (mag_id)),
    ours as (
      select id, magazine_id, number, (['January','February','March','April','May','June','July','August','September','October',
        'November','December'])[date_month] || ' ' || date_year as dated from cat_issues where parent_id is null),
    choices as (
      select t.issue_code, o.id, case when t.issue = 'Issue ' || o.number || ', ' || o.dated then 2
          when t.issue = 'Issue 0' || o.number || ', ' || o.dated then 3 else 4 end as tier
      from theirs t join ours o on o.magazine_id = t.magazine_id
       and t.issue in ('Issue ' || o.number || ', ' || o.dated, 'Issue 0' || o.number || ', ' || o.dated, 'Issue ' || o.dated)
      union
      select t.issue_code, o.id, 5 from theirs t join ours o on o.magazine_id = t.magazine_id
       and o.number = try_cast(substr(split_part(t.issue, ',', 1), 7) as int) where t.issue like 'Issue %,%'
      union
      select s.issue_code, i.id, 1 from cat_issues_src s join cat_magazines_src m on m.mag_id = s.mag_id
      join cat_magazines g on g.id >= 8000001 join cat_issues i on i.magazine_id = g.id
      where (m.mag_name = 'Sinclair User Annual' and s.issue = '1984 Annual' and g.name = 'Sinclair User' and i.special = 'Annual 1984' and i.parent_id is null)
         or (m.mag_name = 'ZX Collection' and s.issue = 'Issue December 1984' and g.name = 'ZX Collection' and i.date_year = 1984 and i.parent_id is null)
         or (m.mag_name = 'Popular Computing Weekly Supplement' and s.issue = 'Issue May 1986' and g.name = 'Popular Computing Weekly' and i.number = 21 and i.parent_id is not null)
         or (m.mag_name = 'ZX Computing' and s.issue = 'Issue September 1982' and g.name = 'ZX Computing' and i.date_year = 1982 and i.date_month = 8 and i.parent_id is null)
         or (m.mag_name = 'Sinclair User' and s.issue = 'Top 50 Spectrum Software Classics' and g.name = 'Sinclair User' and i.supplement = 'Top 50 Spectrum Software Classics')),
    iss_map as (
      select issue_code, min(id) as issue_id, tier, count(*) as candidates from choices group by issue_code, tier
      qualify row_number() over (partition by issue_code order by tier) = 1),
    cleaned as (
      select s.review_id as id, cast(s.game_id as bigint) as entry_id, cast(i.issue_id as bigint) as issue_id,
        try_cast(nullif(trim(split_part(replace(replace(s.review_page, '(Supplement)', ''), '.', ','), ',', 1)), '') as int) as page,
        ends_with(s.review_page, '(Supplement)') as is_supplement, m.mag_name as mag_section,
        nullif(replace(s.review_text, chr(13), ''), '') as review_text,
        nullif(replace(replace(s.review_comments, chr(13), ''), chr(172), repeat(chr(10), 4)), '') as review_comments,
        nullif(replace(s.review_rating, chr(13), ''), '') as review_rating, nullif(s.reviewers, '') as reviewers,
        cast(nullif(s.award_id, 999) as int) as award_id
      from cat_reviews_src s left join iss_map i using (issue_code)
      left join cat_magazines_src m on m.mag_id = s.mag_type and m.mag_id >= 7 and m.mag_id <= 18),
    moved as (
      select c.* replace (case when c.is_supplement then (select min(i.id) from cat_issues i where i.parent_id = c.issue_id) else c.issue_id end as issue_id)
      from cleaned c),
    reviews as (
      select id, entry_id, issue_id, coalesce(page, 0) as page, mag_section, review_text, review_comments, review_rating, reviewers, award_id,
        min(id) over (partition by review_text, review_comments, review_rating, reviewers) as parent_id
      from moved where issue_id is not null),
    known as (select *, referencetype_id = 10 and entry_id is not null as counts from cat_magrefs),
    fresh as (select distinct r.entry_id, r.issue_id, r.page from reviews r
      anti join (select * from known where counts) k on k.entry_id = r.entry_id and k.issue_id = r.issue_id and k.page = r.page),
    refs as (
      select id, issue_id, page, entry_id, label_id, topic_id, award_id, referencetype_id, is_original, review_id, score_group from cat_magrefs
      union all
      select (select max(id) from cat_magrefs) + row_number() over (order by left(md5(concat_ws('|', entry_id, issue_id, page)), 4), entry_id, issue_id, page),
        issue_id, page, entry_id, null, null, null, 10, 0, null, '' from fresh),
    told as (select distinct on (entry_id, issue_id, page) entry_id, issue_id, page, parent_id, award_id, id from reviews order by entry_id, issue_id, page, id),
    main_refs as (
      select r.* replace (case when t.id is null then r.award_id else t.award_id end as award_id, case when t.id is null then r.review_id else t.parent_id end as review_id)
      from refs r left join told t on r.referencetype_id = 10 and t.entry_id = r.entry_id and t.issue_id = r.issue_id and t.page = r.page),
    located as (
      select v.*, (select min(r.id) from main_refs r where r.referencetype_id = 10 and r.entry_id = v.entry_id and r.issue_id = v.issue_id
                   and r.page = v.page and r.score_group = '') as magref_id from reviews v),
    inside as (select c.*, cast(c.game_id as bigint) as entry_id, v.issue_id, v.page, v.parent_id from cat_compilations_src c join reviews v on v.id = c.review_id),
    fresh2 as (select distinct c.entry_id, c.issue_id, c.page from inside c
      anti join (select * from main_refs where referencetype_id = 10) k on k.entry_id = c.entry_id and k.issue_id = c.issue_id and k.page = c.page),
    all_refs as (
      select * from main_refs union all
      select (select max(id) from main_refs) + row_number() over (order by left(md5(concat_ws('|', entry_id, issue_id, page)), 4), entry_id, issue_id, page),
        issue_id, page, entry_id, null, null, null, 10, 0, null, '' from fresh2),
    told2 as (select distinct on (entry_id, issue_id, page) entry_id, issue_id, page, parent_id from inside order by entry_id, issue_id, page, review_id, parent_id),
    final_refs as (
      select r.* replace (case when t.parent_id is null then r.review_id else t.parent_id end as review_id)
      from all_refs r left join told2 t on r.referencetype_id = 10 and r.score_group = '' and t.entry_id = r.entry_id and t.issue_id = r.issue_id and t.page = r.page),
    scores as (
      select l.magref_id, cast(s.header_order as int) as score_seq, s.review_header as category,
        nullif(coalesce(trim(s.review_score), '') || coalesce(trim(s.score_suffix), ''), '') as score,
        regexp_replace(regexp_replace(nullif(replace(s.score_text, chr(13), ''), ''), '^\\n', ''), '\\n$', '') as comments
      from cat_scores_src s join located l on l.id = s.review_id
      union all
      select f.id, cast(c.header_order as int), c.review_header, nullif(coalesce(trim(c.review_score), '') || coalesce(trim(c.score_suffix), ''), ''), null
      from inside c join final_refs f on f.referencetype_id = 10 and f.score_group = '' and f.entry_id = c.entry_id and f.issue_id = c.issue_id and f.page = c.page)
"""


def _reviews(select: str) -> str:
    prefix = over_catalogue(_REVIEWS + select)
    cut = prefix.index(_REVIEWS.lstrip("\n").split("\n")[0])
    return prefix[:cut].rstrip() + ",\n" + prefix[cut:]


SQL = {
    "import_map_links": over_catalogue(f"select * from {_MAPS}"),
    "sliced_map_links": over_catalogue(f"select * from {_MAPS}"),
    "manifest_listing": over_catalogue(f"select * from {_LISTED}"),
    "manifest_unknown_files": over_catalogue(f"select * from {_LISTED} l where file_link not in {_KNOWN}"),
    **{f"manifest_missing_{t}": over_catalogue(_missing(t, "/zxdb/", _LISTED)) for t in ("downloads", "files", "scraps")},
    **{f"manifest_enriched_{t}": over_catalogue(_enriched(t, t != "scraps")) for t in ("downloads", "files", "scraps")},
    "manifest_malformed_sizes": over_catalogue(f"select file_size, file_link from ({LISTING}) where try_cast(file_size as bigint) is null"),
    "mirror_malformed_sizes": over_catalogue(f"select file_size, file_link from ({MIRROR}) where try_cast(file_size as bigint) is null"),
    "mirror_listing": over_catalogue(f"select * from {_MIRRORED}"),
    **{f"mirror_missing_{t}": over_catalogue(_missing(t, "/pub/", _MIRRORED)) for t in ("downloads", "files")},
    "mirror_missing_scraps": over_catalogue(_missing("scraps", "/pub/", _MIRRORED,
        "and rationale not in ('unavailable (distribution denied)', 'broken link at www.worldofspectrum.org', 'missing file at archive.org mirror replaced by fixed version')")),
    "mirror_unknown_files": over_catalogue(f"select * from {_MIRRORED} l where file_link not in {_KNOWN} and not starts_with(file_link, '/pub/sinclair/magazines/') and not regexp_matches(file_link, '^/pub/sinclair/.*/$')"),
    "review_magazine_map": _reviews("select mag_id, magazine_id, 1 as tier, candidates from mag_map"),
    "review_issue_map": _reviews("select issue_code, issue_id, cast(tier as int) as tier, candidates from iss_map"),
    "review_unmapped_magazines": _reviews("select * from cat_magazines_src where mag_id not in (select mag_id from mag_map)"),
    "review_unmapped_magazine_issues": _reviews("select * from cat_issues_src where mag_id not in (select mag_id from mag_map)"),
    "review_unmapped_reviewers": _reviews("select * from cat_reviewers_src where mag_id not in (select mag_id from mag_map)"),
    "review_unmapped_awards": _reviews("select * from cat_awards_src where mag_type not in (select mag_id from mag_map)"),
    "review_unmapped_issues": _reviews("select * from cat_issues_src where issue_code not in (select issue_code from iss_map)"),
    "review_unmapped_reviews": _reviews("select * from cat_reviews_src where issue_code not in (select issue_code from iss_map)"),
    "review_ambiguous_issues": _reviews("select issue_code, issue_id, cast(tier as int) as tier, candidates from iss_map where candidates > 1"),
    "review_cleaned": _reviews("select * from cleaned"),
    "review_odd_supplements": _reviews("select c.id, c.issue_id, count(i.id) as children from cleaned c left join cat_issues i on i.parent_id = c.issue_id where c.is_supplement and c.issue_id is not null group by c.id, c.issue_id having count(i.id) <> 1"),
    "review_without_page": _reviews("select id, entry_id, issue_id from cleaned where page is null"),
    "review_canonical": _reviews("select id, entry_id, issue_id, page, parent_id from reviews"),
    "review_texts": _reviews("""select id,
        regexp_replace(regexp_replace(review_text, '^\\n', ''), '\\n{1,2}$', '') as review_text,
        regexp_replace(regexp_replace(review_comments, '^\\n', ''), '\\n$', '') as review_comments,
        regexp_replace(regexp_replace(review_rating, '^\\n', ''), '\\n{1,3}$', '') as review_rating, reviewers from reviews where id = parent_id"""),
    "review_magrefs": _reviews("select * from final_refs"),
    "review_feature_links": _reviews("""select distinct l.magref_id, cast(f.id as int) as feature_id from located l join cat_features f on f.name = l.mag_section and f.id between 100 and 800
        where not exists (select 1 from cat_magreffeats k where k.magref_id = l.magref_id and k.feature_id = f.id)"""),
    "review_unknown_sections": _reviews("select mag_section, count(*) as reviews from reviews r where mag_section is not null and not exists (select 1 from cat_features f where f.name = r.mag_section and f.id between 100 and 800) group by mag_section"),
    "review_scores": _reviews("""select magref_id, score_seq, category, score, comments, cast(score_seq = max(score_seq) over (partition by magref_id)
        and (score_seq = 1 or category in ('Ace Rating', 'ACE Rating', 'Verdict')
             or (starts_with(category, 'Overall') and not starts_with(category, 'Overall (') and coalesce(not ends_with(score, 'K)'), false)))  as int) as is_overall from scores"""),
    "review_captions": _reviews("""select magref_id, cast(place as int) as caption_seq,
        regexp_replace(regexp_replace(replace(caption, chr(13), ''), '^\\n', ''), '\\n$', '') as text, is_banner
        from (select l.magref_id, c.caption, c.is_banner, row_number() over (partition by l.magref_id order by c.id) as place from cat_captions_src c join located l on l.id = c.review_id)"""),
}
