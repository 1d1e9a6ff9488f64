"""Review integration on hand-written rows: every tier, variant and odd case."""

from __future__ import annotations

import pytest
from handmade import Handmade, rows

from shelfmark.fixtures.derived import DerivedCatalogue
from shelfmark.plans.imports import reviews as r
from shelfmark.sources.tables import check_keys

MAGAZINES = rows("id name", (1, "Crash"), (2, "Sinclair User"), (3, "ACE (Advanced Computer Entertainment)"), (4, "Popular Computing Weekly"), (5, "ZX Computing"), (6, "Section Mag"))
ISSUES = rows(
    "id magazine_id number date_year date_month special supplement parent_id",
    (10, 1, 5, 1984, 6, None, None, None), (11, 1, 6, 1984, 7, None, None, None), (12, 1, None, 1984, 8, None, None, None),
    (13, 1, 7, None, None, None, None, None), (14, 1, 7, None, None, None, None, None), (15, 1, 5, 1984, 6, None, "Extra", 10),
    (20, 2, None, None, None, "Annual 1984", None, None), (21, 2, None, None, None, None, "Top 50 Spectrum Software Classics", 20),
    (40, 4, 21, None, None, None, None, None), (41, 4, 21, None, None, None, "S", 40), (50, 5, None, 1982, 8, None, None, None),
    (971, 1, 90, None, None, None, None, None), (1007, 1, 91, None, None, None, None, None),
)
MAGAZINES_SRC = rows("mag_id mag_name", (1, "crash"), (2, "Sinclair User"), (3, "ACE"), (4, "Popular Computing Weekly"), (5, "ZX Computing"), (7, "Section"), (9, "Nowhere"),
                     (104, "Popular Computing Weekly Supplement"), (102, "Sinclair User Annual"))
ISSUES_SRC = rows(
    "issue_code mag_id issue", (1, 1, "Issue 5, June 1984"), (2, 1, "Issue 06, July 1984"), (3, 1, "Issue August 1984"), (4, 1, "Issue 07, Someday"),
    (5, 1, "Issue x, Someday"), (6, 9, "Issue 5, June 1984"), (7, 102, "1984 Annual"), (8, 104, "Issue May 1986"), (9, 5, "Issue September 1982"),
    (10, 2, "Top 50 Spectrum Software Classics"), (971, 1, "Issue 90, x"), (1007, 1, "Issue 91, x"),
)
REVIEWS = rows(
    "review_id game_id issue_code review_page review_text review_comments review_rating reviewers award_id mag_type",
    (1, 100, 1, "12.5", "\nSame\r\n\n\n", "a¬b\n", None, "", 999, 7), (2, 101, 1, "13", "\nSame\r\n\n\n", "a¬b\n", None, None, 3, 1),
    (3, 100, 1, "4(Supplement)", "Other", None, "\nR\n\n\n\n", "X", None, None), (4, 102, 2, "7(Supplement)", "No child", None, None, None, None, None),
    (5, 100, 5, "1", "Unmapped", None, None, None, None, None), (6, 103, 2, "", None, None, None, None, None, 7),
    (7, 6087, 971, "73", "Producer: Mr A", None, None, None, None, None), (8, 6087, 971, "73", "Producer: Cy", None, None, None, None, None),
    (9, 176, 1007, "116", "A48", None, None, None, None, None), (10, 176, 1007, "116", "A128", None, None, None, None, None),
)
SCORES = rows(
    "review_id header_order review_header review_score score_suffix score_text",
    (1, 1, "Graphics", " 9", "/10", "\nfine\r\n"), (1, 2, "Overall", "90", "%", None), (2, 1, "Overall (48K)", "5", None, ""), (3, 1, "Fun", "1", None, None), (3, 2, "Overall value", "5", "K)", None),
    (6, 1, "A", None, None, None), (6, 2, "Overall", None, None, None), (9, 1, "Overall", "92 ", None, None), (10, 1, "Overall", "94", None, None),
    (7, 1, "x", "1", None, None), (7, 2, "Verdict", None, None, None),
)
COMPILATIONS = rows(
    "score_id review_id game_id header_order review_header review_score score_suffix", (1, 1, 200, 1, "Fun", "7", "/10"), (2, 1, 200, 2, "Overall", "8", "/10"), (3, 2, 100, 1, "Fun", "1", None))
CAPTIONS = rows("id review_id caption is_banner", (5, 1, "\nFirst\r\n", 0), (4, 1, "Zero", 1), (9, 5, "lost", 0), (8, 2, "Other", 0))
MAGREFS = rows(
    "id issue_id page entry_id referencetype_id review_id award_id score_group", (1, 10, 12, 100, 10, None, 8, ""), (2, 10, 13, 101, 3, None, None, ""), (3, 99, 1, None, 10, None, None, ""),
    (4, 10, 13, 100, 10, 77, None, ""))
FEATURES = rows("id name", (100, "Section"), (900, "Section"))


@pytest.fixture(scope="module")
def job(spark):
    entries = rows("id title", *[(i, str(i)) for i in (100, 101, 102, 103, 176, 200, 6087)])
    t = Handmade(spark, entries=entries, magazines=MAGAZINES, issues=ISSUES, magrefs=MAGREFS, features=FEATURES, magreffeats=rows("magref_id feature_id", (50, 100)))
    s = Handmade(spark, magazines_src=MAGAZINES_SRC, issues_src=ISSUES_SRC, reviews_src=REVIEWS, scores_src=SCORES, compilations_src=COMPILATIONS, captions_src=CAPTIONS,
                 reviewers_src=rows("reviewer_id mag_id", (1, 1), (2, 9)), awards_src=rows("award_id mag_type", (1, 9)))
    return r.ReviewIntegration(t, s)


def test_magazines_map_by_alias(job):
    assert {x.mag_id: x.magazine_id for x in job.magazines.collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5}


def test_issues_map_by_tier(job):
    got = {x.issue_code: (x.issue_id, x.tier, x.candidates) for x in job.issues.collect()}
    assert got == {
        1: (10, 2, 1), 2: (11, 3, 1), 3: (12, 4, 1), 4: (13, 5, 2), 7: (20, 1, 1), 8: (41, 1, 1), 9: (50, 1, 1), 10: (21, 1, 1),
        971: (971, 5, 1), 1007: (1007, 5, 1)}


def test_reviews_are_cleaned_moved_grouped_and_told_apart(job):
    got = {x.id: x for x in job.reviews.collect()}
    assert sorted(got) == [1, 2, 3, 6, 7, 8, 9, 10]
    assert (got[1].page, got[1].review_text, got[1].review_comments, got[1].reviewers, got[1].award_id, got[1].mag_section) == (
        12, "\nSame\n\n\n", "a\n\n\n\nb\n", None, None, "Section")
    assert (got[3].issue_id, got[3].page) == (15, 4)
    assert (got[6].page, got[6].review_text) == (0, None)
    assert {i: got[i].parent_id for i in (1, 2, 3)} == {1: 1, 2: 1, 3: 3}
    assert {i: (got[i].variant, got[i].score_group) for i in got} == {
        1: (0, ""), 2: (0, ""), 3: (0, ""), 6: (0, ""), 7: (0, "Classic Adventure"), 8: (1, "Colossal Caves"), 9: (0, "48K"), 10: (1, "128K")}


def test_texts_are_stored_once_and_trimmed(job):
    got = {x.id: x for x in job.review_texts.collect()}
    assert sorted(got) == [1, 3, 6, 7, 8, 9, 10]
    assert (got[1].review_text, got[1].review_comments) == ("Same\n", "a\n\n\n\nb")
    assert got[3].review_rating == "R\n"


def test_references(job):
    refs = job.magrefs.collect()
    by_id = {x.id: x for x in refs}
    assert len(by_id) == len(refs)
    assert (by_id[1].review_id, by_id[1].award_id) == (1, None)
    assert (by_id[2].review_id, by_id[3].review_id) == (None, None)
    # A reference of a compilation's content takes over the review of the compilation.
    assert by_id[4].review_id == 1
    new = {(x.entry_id, x.issue_id, x.page, x.score_group): (x.review_id, x.award_id, x.referencetype_id) for x in refs if x.id > 4}
    assert new == {
        (101, 10, 13, ""): (1, 3, 10), (100, 15, 4, ""): (3, None, 10), (103, 11, 0, ""): (6, None, 10), (6087, 971, 73, "Classic Adventure"): (7, None, 10),
        (6087, 971, 73, "Colossal Caves"): (8, None, 10), (176, 1007, 116, "48K"): (9, None, 10), (176, 1007, 116, "128K"): (10, None, 10), (200, 10, 12, ""): (1, None, 10)}
    assert sorted(x.id for x in refs if x.id > 4) == list(range(5, 13))


def test_scores(job):
    ref = {x.id: x.magref_id for x in job.located.collect()}
    inside = {(x.entry_id, x.issue_id, x.page): x.id for x in job.magrefs.collect()}
    got = {(x.magref_id, x.score_seq): (x.category, x.score, x.comments, x.is_overall) for x in job.review_scores.collect()}
    assert got == {
        (ref[1], 1): ("Graphics", "9/10", "fine", 0), (ref[1], 2): ("Overall", "90%", None, 1), (ref[2], 1): ("Overall (48K)", "5", None, 1),
        (ref[3], 1): ("Fun", "1", None, 0), (ref[3], 2): ("Overall value", "5K)", None, 0), (ref[6], 1): ("A", None, None, 0), (ref[6], 2): ("Overall", None, None, 0),
        (ref[9], 1): ("Overall", "92", None, 1), (ref[10], 1): ("Overall", "94", None, 1), (ref[7], 1): ("x", "1", None, 0), (ref[7], 2): ("Verdict", None, None, 1),
        (inside[200, 10, 12], 1): ("Fun", "7/10", None, 0), (inside[200, 10, 12], 2): ("Overall", "8/10", None, 1), (4, 1): ("Fun", "1", None, 1)}


def test_captions_and_features(job):
    ref = {x.id: x.magref_id for x in job.located.collect()}
    got = sorted(tuple(x) for x in job.review_captions.collect())
    assert got == sorted([(ref[1], 1, "Zero", 1), (ref[1], 2, "First", 0), (ref[2], 1, "Other", 0)])
    assert {tuple(x) for x in job.feature_links.collect()} == {(ref[1], 100), (ref[6], 100)}
    assert check_keys(job.review_captions, ["magref_id", "caption_seq", "is_banner"]).count() == 0


def test_reports(job):
    counts = {name: df.count() for name, df in job.reports().items()}
    assert counts == {
        "unmapped_magazines": 4, "unmapped_magazine_issues": 3, "unmapped_reviewers": 1, "unmapped_awards": 1, "unmapped_issues": 2, "unmapped_reviews": 1,
        "ambiguous_issues": 1, "odd_supplements": 1, "reviews_without_page": 1, "unknown_sections": 0}


def test_a_report_makes_only_what_it_reads(job):
    own = r.ReviewIntegration(job.t, job.s)
    own.report("unmapped_magazine_issues").count()
    assert not {"issues", "placed", "reviews"} & set(vars(own))
    own.report("ambiguous_issues").count()
    own.report("odd_supplements").count()
    assert not {"placed", "reviews"} & set(vars(own))


def test_shared_frames_hold_no_texts(job):
    assert not set(r.CONTENT) & {*job.placed.columns, *job.located.columns}


def test_labels_of_issues_are_made_once(job, capsys):
    r.issue_map(job.t, job.s).explain("simple")
    assert capsys.readouterr().out.count("Generate posexplode") == 1


def test_repeated_reviews_keep_their_texts(spark, job):
    class Twice(dict):
        def __missing__(self, name):
            return job.s[name]

    once = r.ReviewIntegration(job.t, job.s).review_texts
    other = job.s["reviews_src"].where("review_id = 3").withColumn("review_text", r.F.lit("Another"))
    more = r.ReviewIntegration(job.t, Twice(reviews_src=job.s["reviews_src"].unionByName(other))).review_texts
    assert sorted(x.review_text for x in more.where("id = 3").collect()) == ["Another", "Other"]
    assert sorted(map(str, more.where("id <> 3").collect())) == sorted(map(str, once.where("id <> 3").collect()))


def test_rerun_gives_the_same_ids(spark, sf_dir):
    t = DerivedCatalogue(spark, sf_dir)
    first, second = r.ReviewIntegration(t, t), r.ReviewIntegration(t, t)
    assert first.magrefs.exceptAll(second.magrefs).count() == 0
    assert first.magrefs.count() == first.magrefs.select("id").distinct().count()
    assert first.review_texts.where("id is null").count() == 0


def test_store(job, spark, tmp_path):
    job.store(str(tmp_path))
    for name, df in job.outputs.items():
        assert spark.read.parquet(f"{tmp_path}/{name}").count() == df.count()
