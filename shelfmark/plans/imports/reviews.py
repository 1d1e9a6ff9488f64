"""Integration of an outside review collection: mapping, cleaning, deduplication, upserts.

``t`` holds the catalogue, ``s`` the tables of the outside collection (names ending in ``_src``).
Every step is a frame derived from the ones before; nothing is written until the outputs are.
Where the outside data allow several answers, the smallest id wins, so a rerun repeats the result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.text import (
    clean_page, clean_text, month_name, on_supplement, score_label, text, trim_newlines,
)
from ...operators.changes import insert_missing, match_choices, tiered_match, update_from
from ...operators.groups import canonical_ids, content_key, first_by
from ...operators.membership import absent, spread
from ...operators.sequences import assign_ids, assign_sequence, last_of_group
from ...session import cut_lineage
from ...sources.tables import constant_dim

Tables = Mapping[str, DataFrame]

REVIEW = 10  # Fixed value: the reference type of reviews.
REFERENCE_KEY = ["entry_id", "issue_id", "page"]
CONTENT = ("review_text", "review_comments", "review_rating", "reviewers")

# Names of magazines that differ between the two databases, replaced in this order.
MAGAZINE_ALIASES = (
    ("Which Micro Software Review", "Which Micro? & Software Review"),
    ("ACE", "ACE (Advanced Computer Entertainment)"),
    ("Computer & Videogames", "C&VG (Computer & Video Games)"),
)
# Issues mapped by hand. Outside magazine and issue, then magazine, whether the issue is a
# supplement, and the year, month, number, special and supplement to look for (None means any).
MANUAL_ISSUES = (
    ("Sinclair User Annual", "1984 Annual", "Sinclair User", False, None, None, None, "Annual 1984", None),
    ("ZX Collection", "Issue December 1984", "ZX Collection", False, 1984, None, None, None, None),
    ("Popular Computing Weekly Supplement", "Issue May 1986", "Popular Computing Weekly", True,
     None, None, 21, None, None),
    ("ZX Computing", "Issue September 1982", "ZX Computing", False, 1982, 8, None, None, None),
    ("Sinclair User", "Top 50 Spectrum Software Classics", "Sinclair User", None, None, None, None, None,
     "Top 50 Spectrum Software Classics"),
)
# Award number that means none; magazines whose types are section names; section features.
NO_AWARD = 999
SECTION_MAGAZINES = (7, 18)
SECTION_FEATURES = (100, 800)
# Two reviews on one page told apart by how they begin.
TEXT_VARIANTS = (
    (6087, 971, 73, "Producer: M", 0, "Classic Adventure"),
    (6087, 971, 73, "Producer: C", 1, "Colossal Caves"),
)
# Reviews on one page told apart by entry, issue, page and overall score.
SCORE_VARIANTS = (
    (176, 1007, 116, "94", 1, "128K"),
    (176, 1007, 116, "92", 0, "48K"),
    (4863, 1003, 22, "97", 1, "128K"),
    (4863, 1003, 22, "95", 0, "48K"),
    (2054, 1001, 18, "92", 1, "128K"),
    (2054, 1001, 18, "80", 0, "48K"),
    (4448, 94, 50, "85", 0, "Charles Wood"),
    (4448, 94, 50, "78", 1, "Garth Sumpter"),
    (5630, 94, 51, "35", 0, "Andrew Buchan"),
    (5630, 94, 51, "61", 1, "Garth Sumpter"),
    (5218, 94, 50, "65", 0, "Editor"),
    (5218, 94, 50, "73", 1, "Garth Sumpter"),
    (5061, 995, 24, "86", 0, "Pros"),
    (5061, 995, 24, "21", 1, "Cons"),
)
# Score categories that are an overall verdict by themselves.
VERDICTS = ("Ace Rating", "ACE Rating", "Verdict")


def aliased_magazine(name: Column | str) -> Column:
    """The catalogue's name of an outside magazine, in lower case; aliases apply inside words too."""
    for theirs, ours in MAGAZINE_ALIASES:
        name = F.replace(name, F.lit(theirs), F.lit(ours))
    return F.lower(name)


def magazine_map(t: Tables, s: Tables) -> DataFrame:
    """``(mag_id, magazine_id, tier, candidates)`` by aliased name."""
    theirs = s["magazines_src"].select("mag_id", aliased_magazine("mag_name").alias("key"))
    ours = t["magazines"].select(F.col("id").alias("magazine_id"), F.lower("name").alias("key"))
    return tiered_match([theirs.join(match_choices(ours, ["key"], "magazine_id"), "key")], "mag_id", "magazine_id")


def unmapped(df: DataFrame, column: str, mapped: DataFrame, key: str) -> DataFrame:
    """Report: outside rows whose key has no counterpart."""
    return absent(df, column, mapped, key)


def _manual_pairs(t: Tables, s: Tables) -> DataFrame:
    spark = t["issues"].sparkSession
    pairs = constant_dim(
        spark, MANUAL_ISSUES,
        "mag_name string, issue string, magazine string, w_child boolean, w_date_year int, w_date_month int,"
        " w_number int, w_special string, w_supplement string",
    )
    # Only rows that some pair can mean are exchanged.
    named = s["issues_src"].where(F.col("issue").isin(*[p[1] for p in MANUAL_ISSUES]))
    theirs = named.join(s["magazines_src"].select("mag_id", "mag_name"), "mag_id").join(pairs, ["mag_name", "issue"])
    child = F.col("parent_id").isNotNull()
    meant = reduce(Column.__or__, [
        reduce(Column.__and__, [
            F.coalesce(c == F.lit(wanted), F.lit(False))
            for c, wanted in zip((child, *map(F.col, ("date_year", "date_month", "number", "special", "supplement"))), p[3:])
            if wanted is not None
        ], F.lit(True)) for p in MANUAL_ISSUES
    ])
    ours = t["issues"].where(meant).join(
        t["magazines"].select(F.col("id").alias("magazine_id"), F.col("name").alias("magazine")), "magazine_id"
    ).withColumn("child", F.col("parent_id").isNotNull()).select(
        "magazine", F.col("id").alias("issue_id"), "child", "date_year", "date_month", "number", "special", "supplement"
    )
    fits = F.lit(True)
    for column in ("child", "date_year", "date_month", "number", "special", "supplement"):
        wanted = F.col(f"w_{column}")
        fits &= wanted.isNull() | F.coalesce(ours[column] == wanted, F.lit(False))
    found = theirs.join(ours, "magazine").where(fits).select("issue_code", "issue_id").distinct()
    return match_choices(found, ["issue_code"], "issue_id")


def issue_map(t: Tables, s: Tables, magazines: DataFrame | None = None) -> DataFrame:
    """``(issue_code, issue_id, tier, candidates)``: by hand, by three kinds of label, by number."""
    magazines = magazine_map(t, s) if magazines is None else magazines
    theirs = s["issues_src"].join(magazines.select("mag_id", "magazine_id"), "mag_id").select(
        "issue_code", "magazine_id", "issue",
        F.when(F.col("issue").like("Issue %,%"),
               F.substring(F.substring_index("issue", ",", 1), 7, 2**31 - 1).try_cast("int")).alias("number"),
    )
    main = t["issues"].where("parent_id is null").select(
        F.col("id").alias("issue_id"), F.col("magazine_id").cast("long").alias("magazine_id"), "number",
        F.concat(month_name("date_month"), F.lit(" "), text("date_year")).alias("dated"),
    )
    # One row per label and kind of label, so that one join serves the three label tiers.
    labels = main.where("dated is not null").select(
        "issue_id", "magazine_id", F.posexplode(F.array(
            F.concat(F.lit("Issue "), text("number"), F.lit(", "), F.col("dated")),
            F.concat(F.lit("Issue 0"), text("number"), F.lit(", "), F.col("dated")),
            F.concat(F.lit("Issue "), F.col("dated")),
        )).alias("kind", "issue")
    ).where("issue is not null")
    label_key, number_key = ["magazine_id", "issue"], ["magazine_id", "number"]
    by_label = theirs.where("issue like 'Issue %'").select("issue_code", *label_key).join(
        match_choices(labels, [*label_key, "kind"], "issue_id"), label_key
    )
    numbers = match_choices(main.where("number is not null").select("issue_id", *number_key), number_key, "issue_id")
    by_number = theirs.where("number is not null").select("issue_code", *number_key).join(numbers, number_key)
    # The labels' kinds are tiers 2 to 4, told by a column: the labels are made and joined once.
    return tiered_match(
        [_manual_pairs(t, s).withColumn("tier", F.lit(1)), by_label.withColumn("tier", F.col("kind") + 2),
         by_number.withColumn("tier", F.lit(5))], "issue_code", "issue_id", "tier",
    )


def cleaned_rows(s: Tables) -> DataFrame:
    """Outside reviews in the shape of the target, with the outside issue and section."""
    return s["reviews_src"].select(
        F.col("review_id").cast("long").alias("id"), F.col("game_id").cast("long").alias("entry_id"), "issue_code", "mag_type",
        clean_page("review_page").try_cast("int").alias("page"), on_supplement("review_page").alias("is_supplement"),
        clean_text("review_text").alias("review_text"),
        clean_text("review_comments", "¬").alias("review_comments"),
        clean_text("review_rating").alias("review_rating"),
        F.nullif("reviewers", F.lit("")).alias("reviewers"),
        F.when(F.col("award_id") != NO_AWARD, F.col("award_id")).cast("int").alias("award_id"),
    )


def mapped_reviews(rows: DataFrame, s: Tables, issues: DataFrame) -> DataFrame:
    """Cleaned rows with their issue, NULL where it could not be mapped, and their section."""
    # A dozen magazines by their fixed numbers.
    sections = F.broadcast(s["magazines_src"].where(F.col("mag_id").between(*SECTION_MAGAZINES)).select(
        F.col("mag_id").alias("mag_type"), F.col("mag_name").alias("mag_section")
    ))
    joined = rows.join(issues.select("issue_code", F.col("issue_id").cast("long").alias("issue_id")), "issue_code", "left")
    rest = [c for c in rows.columns if c not in ("id", "entry_id", "issue_code", "mag_type", "page", "is_supplement")]
    return joined.join(sections, "mag_type", "left").select(
        "id", "entry_id", "issue_id", "page", "is_supplement", "mag_section", *rest
    )


def cleaned_reviews(s: Tables, issues: DataFrame) -> DataFrame:
    """Reviews in the shape of the target; the issue is NULL where it could not be mapped."""
    return mapped_reviews(cleaned_rows(s), s, issues)


def _children(issues: DataFrame) -> DataFrame:
    """``(issue_id, child_id, children)``: the smallest child of an issue and how many it has."""
    children = issues.where("parent_id is not null").select(
        F.col("parent_id").cast("long").alias("issue_id"), F.col("id").cast("long").alias("child_id")
    )
    return match_choices(children, ["issue_id"], "child_id").withColumnRenamed("candidates", "children")


def redirected(reviews: DataFrame, issues: DataFrame) -> DataFrame:
    """Reviews from a supplement move to the child issue: the smallest one, or none."""
    children = _children(issues)
    return reviews.join(children, "issue_id", "left").withColumn(
        "issue_id", F.when(F.col("is_supplement"), F.col("child_id")).otherwise(F.col("issue_id"))
    ).select(*reviews.columns)


def redirect_reports(reviews: DataFrame, issues: DataFrame) -> DataFrame:
    """Supplement reviews whose issue has no child or more than one."""
    counted = reviews.where("is_supplement and issue_id is not null").join(_children(issues), "issue_id", "left").select(
        "id", "issue_id", F.coalesce("children", F.lit(0)).cast("long").alias("children")
    )
    return counted.where("children <> 1")


def with_variants(reviews: DataFrame, scores: DataFrame) -> DataFrame:
    """Add ``variant`` and ``score_group`` for reviews that share entry, issue and page; ``text_head`` is how a text begins."""
    spark = reviews.sparkSession
    starts = constant_dim(
        spark, TEXT_VARIANTS,
        "entry_id long, issue_id long, page int, start string, text_variant int, text_group string",
    )
    groups = constant_dim(
        spark, SCORE_VARIANTS,
        "entry_id long, issue_id long, page int, overall string, variant int, score_group string",
    )
    by_score = reviews.select("id", *REFERENCE_KEY).join(groups, REFERENCE_KEY).join(
        scores.where("review_header = 'Overall'").select(
            F.col("review_id").alias("id"), F.rtrim("review_score").alias("overall")
        ), ["id", "overall"],
    )
    chosen = first_by(by_score.select("id", "variant", "score_group"), ["id"], ["variant", "score_group"])
    begun = reviews.select("id", "text_head", *REFERENCE_KEY).join(starts, REFERENCE_KEY).where(
        F.col("text_head").startswith(F.col("start"))
    ).select("id", "text_variant", "text_group")
    return reviews.join(chosen, "id", "left").join(begun, "id", "left").select(
        *reviews.columns, F.coalesce("variant", "text_variant", F.lit(0)).alias("variant"),
        F.coalesce("score_group", "text_group", F.lit("")).alias("score_group"),
    )


def new_reference_rows(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Rows with some columns of ``magrefs``; the others take their defaults."""
    fixed = {"referencetype_id": F.lit(REVIEW), "is_original": F.lit(0), "score_group": F.lit("")}
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else fixed.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
        for f in target.schema.fields
    ])


def overall_scores(scores: DataFrame) -> DataFrame:
    """Set ``is_overall`` on the last score of a reference when it is a verdict."""
    named = F.col("category").isin(*VERDICTS)
    overall = F.col("category").like("Overall%") & ~F.col("category").like("Overall (%")
    verdict = (F.col("score_seq") == 1) | named | (overall & ~F.col("score").like("%K)"))
    marked = last_of_group(scores, "magref_id", "score_seq").where(verdict).select("magref_id", "score_seq").distinct()
    return scores.drop("is_overall").join(
        marked.withColumn("_overall", F.lit(1)), ["magref_id", "score_seq"], "left"
    ).withColumn("is_overall", F.coalesce("_overall", F.lit(0)).cast("int")).select(*scores.columns)


class ReviewIntegration:
    """The whole job. ``durable`` writes the few frames that many outputs share to the shared folder."""

    def __init__(self, t: Tables, s: Tables, durable: bool = True):
        self.t, self.s = t, s
        self._keep = cut_lineage if durable else (lambda df: df)

    @cached_property
    def magazines(self) -> DataFrame:
        return magazine_map(self.t, self.s)

    @cached_property
    def issues(self) -> DataFrame:
        return self._keep(issue_map(self.t, self.s, self.magazines))

    @cached_property
    def cleaned(self) -> DataFrame:
        return cleaned_reviews(self.s, self.issues)

    @cached_property
    def _rows(self) -> DataFrame:
        """Cleaned rows with the digest of their content, which stands for it until the texts are stored."""
        return cleaned_rows(self.s).withColumn("digest", content_key(CONTENT))

    @cached_property
    def placed(self) -> DataFrame:
        """Redirected and grouped reviews with a known issue, without their texts; an unknown page counts as 0."""
        head = F.left("review_text", F.lit(max(len(v[3]) for v in TEXT_VARIANTS))).alias("text_head")
        rows = self._rows.select("*", head).drop(*CONTENT)
        mapped = redirected(mapped_reviews(rows, self.s, self.issues), self.t["issues"]).drop("is_supplement")
        mapped = mapped.where("issue_id is not null").withColumn("page", F.coalesce("page", F.lit(0)))
        grouped = canonical_ids(mapped, CONTENT, "id", "parent_id", digest="digest")
        return self._keep(with_variants(grouped, self.s["scores_src"]).drop("text_head"))

    def _with_texts(self, placed: DataFrame) -> DataFrame:
        """Reviews with their texts, which are exchanged this once."""
        texts = self._rows.select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), *CONTENT).dropDuplicates(["_id", "_digest"])
        return placed.join(texts, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")))

    @cached_property
    def reviews(self) -> DataFrame:
        """Cleaned, redirected and grouped reviews with a known issue, whole; the job itself passes on :attr:`placed`."""
        return self._with_texts(self.placed).select(
            "id", "entry_id", "issue_id", "page", "mag_section", *CONTENT, "award_id", "parent_id", "variant", "score_group"
        )

    @cached_property
    def review_texts(self) -> DataFrame:
        """One row per canonical review, with outer newlines trimmed."""
        return self._with_texts(self.placed.where("id = parent_id").select("id", "digest")).select(
            "id",
            trim_newlines("review_text", 2).alias("review_text"),
            trim_newlines("review_comments", 1).alias("review_comments"),
            trim_newlines("review_rating", 3).alias("review_rating"),
            "reviewers",
        )

    def _typed(self, refs: DataFrame) -> DataFrame:
        return refs.where(F.col("referencetype_id") == REVIEW)

    @cached_property
    def _main_refs(self) -> DataFrame:
        """``magrefs`` with a reference for every review, variants included."""
        refs = self.t["magrefs"].withColumn("id", F.col("id").cast("long"))
        keyed = self.placed.select(*REFERENCE_KEY)
        first = insert_missing(refs, keyed, REFERENCE_KEY, present=self._typed(refs))
        refs = refs.unionByName(new_reference_rows(first, refs))
        # Asked before the update, which leaves ids alone and need not run twice for it.
        last_id = refs.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
        plain = self.placed.where("variant = 0").select(
            *REFERENCE_KEY, "id", F.col("score_group").alias("new_group"), "parent_id", "award_id",
            F.lit(REVIEW).alias("referencetype_id"),
        )
        source = first_by(plain, [*REFERENCE_KEY, "referencetype_id"], ["id"])
        refs = update_from(
            refs, source, [*REFERENCE_KEY, "referencetype_id"],
            {"score_group": "new_group", "review_id": "parent_id", "award_id": "award_id"},
        )
        others = self.placed.where("variant = 1").select(
            F.col("id").alias("review_key"), *REFERENCE_KEY, "score_group", F.col("parent_id").alias("review_id"), "award_id"
        )
        numbered = assign_ids(others, ["review_key"], last_id)
        return self._keep(refs.unionByName(new_reference_rows(numbered, refs)))

    @cached_property
    def located(self) -> DataFrame:
        """Reviews with the id of their reference."""
        key = [*REFERENCE_KEY, "score_group"]
        refs = self._typed(self._main_refs).where("entry_id is not null").groupBy(*key, spread(*key)).agg(
            F.min("id").alias("magref_id")
        )
        return self.placed.join(refs.drop("_spread"), key)

    @cached_property
    def feature_links(self) -> DataFrame:
        """New ``(magref_id, feature_id)`` rows for the sections reviews appeared in."""
        features = self.t["features"].where(F.col("id").between(*SECTION_FEATURES)).select(
            F.col("id").alias("feature_id"), F.col("name").alias("mag_section")
        )
        links = self.located.where("mag_section is not null").select("magref_id", "mag_section").join(
            features, "mag_section"
        ).select("magref_id", "feature_id").distinct()
        known = self.t["magreffeats"].select("magref_id", "feature_id")
        return links.join(known, ["magref_id", "feature_id"], "left_anti")

    @cached_property
    def unknown_sections(self) -> DataFrame:
        """Report: sections without a feature of that name."""
        features = self.t["features"].where(F.col("id").between(*SECTION_FEATURES))
        sections = self.placed.where("mag_section is not null").groupBy("mag_section").agg(
            F.count(F.lit(1)).alias("reviews")
        )
        return absent(sections, "mag_section", features, "name")

    @cached_property
    def _compilations(self) -> DataFrame:
        """Scores of the contents of reviewed compilations, placed like their review."""
        reviews = self.placed.select(
            F.col("id").alias("review_id"), "issue_id", "page", "parent_id"
        )
        return self.s["compilations_src"].withColumn("review_id", F.col("review_id").cast("long")).join(
            reviews, "review_id"
        ).withColumn("entry_id", F.col("game_id").cast("long"))

    @cached_property
    def magrefs(self) -> DataFrame:
        """New version of ``magrefs``: references of reviews and of the contents of compilations."""
        refs = self._main_refs
        first = insert_missing(refs, self._compilations, REFERENCE_KEY, present=self._typed(refs))
        refs = refs.unionByName(new_reference_rows(first, refs))
        source = first_by(
            self._compilations.select(
                *REFERENCE_KEY, "review_id", "parent_id", F.lit(REVIEW).alias("referencetype_id"),
                F.lit("").alias("score_group"),
            ),
            [*REFERENCE_KEY, "referencetype_id", "score_group"], ["review_id", "parent_id"],
        ).drop("review_id")
        return self._keep(update_from(
            refs, source, [*REFERENCE_KEY, "referencetype_id", "score_group"], {"review_id": "parent_id"}
        ))

    @cached_property
    def review_scores(self) -> DataFrame:
        """Scores of reviews and of compilation contents, with overall marks and trimmed comments."""
        own = self.s["scores_src"].join(
            self.located.select(F.col("id").alias("review_id"), "magref_id"), "review_id"
        ).withColumn("comments", trim_newlines(clean_text("score_text"), 1))
        refs = self._typed(self.magrefs).where("score_group = ''").select(F.col("id").alias("magref_id"), *REFERENCE_KEY)
        inside = self._compilations.join(refs, REFERENCE_KEY).withColumn("comments", F.lit(None).cast("string"))

        def shaped(df: DataFrame) -> DataFrame:
            return df.select(
                "magref_id", F.col("header_order").cast("int").alias("score_seq"),
                F.col("review_header").alias("category"), F.lit(0).alias("is_overall"),
                score_label("review_score", "score_suffix").alias("score"), "comments",
            )

        return overall_scores(shaped(own).unionByName(shaped(inside)))

    @cached_property
    def review_captions(self) -> DataFrame:
        """Picture captions numbered per reference by id; beyond the cap the number stays 0."""
        captions = self.s["captions_src"].withColumn("review_id", F.col("review_id").cast("long")).join(
            self.located.select(F.col("id").alias("review_id"), "magref_id"), "review_id"
        ).select("id", "magref_id", F.replace("caption", F.lit("\r"), F.lit("")).alias("text"), "is_banner")
        numbered = assign_sequence(captions, "magref_id", "id", "caption_seq")
        return numbered.select("magref_id", "caption_seq", trim_newlines("text", 1).alias("text"), "is_banner")

    @cached_property
    def outputs(self) -> dict[str, DataFrame]:
        return {
            "magrefs": self.magrefs,
            "magreffeats": self.t["magreffeats"].select("magref_id", "feature_id").unionByName(self.feature_links),
            "review_texts": self.review_texts,
            "review_scores": self.review_scores,
            "review_captions": self.review_captions,
        }

    @property
    def _reports(self) -> dict[str, Callable[[], DataFrame]]:
        return {
            "unmapped_magazines": lambda: unmapped(self.s["magazines_src"], "mag_id", self.magazines, "mag_id"),
            "unmapped_magazine_issues": lambda: unmapped(self.s["issues_src"], "mag_id", self.magazines, "mag_id"),
            "unmapped_reviewers": lambda: unmapped(self.s["reviewers_src"], "mag_id", self.magazines, "mag_id"),
            "unmapped_awards": lambda: unmapped(self.s["awards_src"], "mag_type", self.magazines, "mag_id"),
            "unmapped_issues": lambda: unmapped(self.s["issues_src"], "issue_code", self.issues, "issue_code"),
            "unmapped_reviews": lambda: unmapped(self.s["reviews_src"], "issue_code", self.issues, "issue_code"),
            "ambiguous_issues": lambda: self.issues.where("candidates > 1"),
            "odd_supplements": lambda: redirect_reports(self.cleaned, self.t["issues"]),
            "reviews_without_page": lambda: self.cleaned.where("page is null").select("id", "entry_id", "issue_id"),
            "unknown_sections": lambda: self.unknown_sections,
        }

    def report(self, name: str) -> DataFrame:
        """One report; of the shared frames it writes those that it reads, no others."""
        return self._reports[name]()

    def reports(self) -> dict[str, DataFrame]:
        """What a person should look at before the outputs replace the stored tables."""
        return {name: self.report(name) for name in self._reports}

    def store(self, folder: str) -> None:
        """Write all outputs; the caller swaps the folder in once this returns."""
        for name, df in self.outputs.items():
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
