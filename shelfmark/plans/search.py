"""Search index tables and the lookups over them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.text import issue_name, name_key, title_key, title_variants
from ..operators.closure import label_closure, label_edges, labels_reaching
from ..operators.groups import SEGMENT, first_source, segmented_text, whole_text
from ..operators.membership import among
from . import grams

Tables = Mapping[str, DataFrame]

# Kinds of first publication.
ORIGIN_KINDS = {
    "C": "covertape from magazine issue",
    "B": "type-in from book",
    "M": "type-in from magazine issue",
    "A": "within compilation",
    "T": "within covertape",
    "E": "within electronic magazine",
    "P": "within program",
}
# Genres of covertapes, electronic magazines and compilations.
COVERTAPE, ELECTRONIC, COMPILATIONS = 81, 82, (80, 111, 112, 113, 114)


def titles(t: Tables) -> DataFrame:
    """``(entry_title, entry_id)`` for titles, aliases, their numeral variants, and contents aliases."""
    own = t["entries"].select(F.col("id").alias("entry_id"), "title")
    named = own.unionByName(t["aliases"].select("entry_id", "title"))
    varied = named.select("entry_id", F.explode(title_variants(F.col("title"))).alias("title"))
    inside = t["contents"].where("alias is not null and entry_id is not null").select(
        "entry_id", F.col("alias").alias("title")
    )
    return varied.unionByName(inside).select(
        title_key("title").alias("entry_title"), F.col("entry_id").cast("long").alias("entry_id")
    ).distinct()


def names(t: Tables) -> DataFrame:
    return t["labels"].select(
        name_key("name").alias("label_name"), F.col("id").cast("long").alias("label_id")
    ).distinct()


def _author_seed(t: Tables) -> DataFrame:
    return t["authors"].select("entry_id", F.explode(F.array("label_id", "team_id")).alias("label_id"))


def _credits(seed: DataFrame) -> DataFrame:
    return seed.where("label_id is not null and entry_id is not null").select(
        F.col("label_id").cast("long").alias("label_id"), F.col("entry_id").cast("long").alias("entry_id")
    ).distinct()


def author_credits(t: Tables) -> DataFrame:
    """``(label_id, entry_id)`` of authors and teams themselves: with the relations a linear form of the author index."""
    return _credits(_author_seed(t))


def publisher_credits(t: Tables) -> DataFrame:
    """``(label_id, entry_id)`` of publishers themselves: with the relations a linear form of the publisher index."""
    return _credits(_publisher_seed(t))


def _relations(t: Tables, known_parents: bool) -> DataFrame:
    return label_edges(t["labels"], known_parents).select(
        F.col("label_id").cast("long").alias("label_id"), F.col("related_id").cast("long").alias("related_id")
    )


def author_relations(t: Tables) -> DataFrame:
    """``(label_id, related_id)``: an author's label also stands for the related one."""
    return _relations(t, known_parents=True)


def publisher_relations(t: Tables) -> DataFrame:
    return _relations(t, known_parents=False)


def authors(t: Tables) -> DataFrame:
    """``(label_id, entry_id)``: authors and teams, and the labels one step away from them."""
    return label_closure(_author_seed(t), t["labels"], known_parents=True)


def _publisher_seed(t: Tables) -> DataFrame:
    own = t["publishers"].select("label_id", "entry_id")
    first = t["publishers"].where("release_seq = 0").select("label_id", F.col("entry_id").alias("container_id")).distinct()
    original = t["contents"].where("is_original = 1 and entry_id is not null").select("container_id", "entry_id").distinct()
    inherited = first.join(original, "container_id").select("label_id", "entry_id")
    inside = t["contents"].where("label_id is not null").select("label_id", F.col("container_id").alias("entry_id"))
    return own.unionByName(inherited).unionByName(inside)


def publishers(t: Tables) -> DataFrame:
    """``(label_id, entry_id)``: publishers of the entry, of its original container and of its contents."""
    return label_closure(_publisher_seed(t), t["labels"], known_parents=False)


def issue_names(t: Tables) -> DataFrame:
    return t["issues"].select(F.col("id").cast("long").alias("issue_id"), issue_name().alias("name"))


def _origin(df: DataFrame, kind, container, issue, dates: str) -> DataFrame:
    def number(c):
        return (F.lit(None) if c is None else F.col(c)).cast("long")

    return df.select(
        F.col("entry_id").cast("long").alias("entry_id"),
        (F.lit(kind) if isinstance(kind, str) else kind).alias("origintype_id"),
        number(container).alias("container_id"), number(issue).alias("issue_id"),
        *[F.col(f"{dates}_{p}").cast("int").alias(f"date_{p}") for p in ("year", "month", "day")],
    )


def origins(t: Tables) -> DataFrame:
    """One first publication per entry; the first kind of source that knows the entry wins.

    Within one kind the smallest container, then the smallest issue, decides.
    """
    issues = t["issues"].select(F.col("id").alias("issue_id"), "date_year", "date_month", "date_day")
    holders = t["entries"].select(
        F.col("id").alias("container_id"), F.col("genretype_id").alias("genre"), F.col("issue_id")
    )
    first_releases = t["releases"].where("release_seq = 0").select(
        F.col("entry_id").alias("container_id"), "release_year", "release_month", "release_day"
    )
    tapes = t["entries"].where(F.col("genretype_id") == COVERTAPE).select(F.col("id").alias("entry_id"), "issue_id")
    books = t["booktypeins"].where("is_original = 1").select("entry_id", F.col("book_id").alias("container_id"))
    printed = t["magrefs"].where("is_original = 1 and entry_id is not null").groupBy("entry_id").agg(
        F.min("issue_id").alias("issue_id")
    )
    inside = t["contents"].where("is_original = 1 and entry_id is not null").select(
        "entry_id", "container_id"
    ).distinct().join(holders, "container_id").join(first_releases, "container_id")
    kind = (
        F.when(F.col("genre").isin(*COMPILATIONS), "A").when(F.col("genre") == COVERTAPE, "T")
        .when(F.col("genre") == ELECTRONIC, "E").otherwise("P")
    )
    sources = [
        _origin(tapes.join(issues, "issue_id"), "C", None, "issue_id", "date"),
        _origin(books.join(holders, "container_id").join(first_releases, "container_id"), "B", "container_id", None, "release"),
        _origin(printed.join(issues, "issue_id"), "M", None, "issue_id", "date"),
        _origin(inside.where(F.col("genre") == COVERTAPE).join(issues, "issue_id"), "T", "container_id", "issue_id", "date"),
        _origin(inside, kind, "container_id", None, "release"),
    ]
    return first_source(sources, "entry_id", ["container_id", "issue_id"])


def _first_publishers(t: Tables) -> DataFrame:
    """``(container_id, publisher_seq, label)``: who published the first release of an entry."""
    labels = t["labels"].select(F.col("id").alias("label_id"), F.col("name").alias("label"))
    first = t["publishers"].where("release_seq = 0").select(F.col("entry_id").alias("container_id"), "publisher_seq", "label_id")
    return first.join(labels, "label_id").select("container_id", "publisher_seq", "label")


def origin_publishers(t: Tables, found: DataFrame | None = None) -> DataFrame:
    """All publishers of the containers of first publications, a row each: ``(container_id, publisher_seq, label)``.

    A container may have any number of them; ordered by sequence and name they are its list. ``found`` are the
    origins where they are known.
    """
    return among(_first_publishers(t), "container_id", origins(t) if found is None else found, "container_id").select(
        F.col("container_id").cast("long").alias("container_id"), F.col("publisher_seq").cast("int").alias("publisher_seq"), "label"
    )


def publisher_lists(t: Tables, size: int = SEGMENT, found: DataFrame | None = None) -> DataFrame:
    """``(container_id, segment, text)``: the publishers of a container by sequence and name, in segments of ``size`` bytes."""
    return segmented_text(origin_publishers(t, found), ["container_id"], "publisher_seq", "label", size=size)


def origins_with_publication(t: Tables) -> DataFrame:
    """:func:`origins` and a line of text on the publication, which names all publishers of the container.

    The line is as long as the list; where only some entries are looked at, filter the result by them, or read
    :func:`publisher_lists`, which has each list once.
    """
    found = origins(t)
    kinds = F.create_map(*[F.lit(v) for pair in ORIGIN_KINDS.items() for v in pair])
    issues = t["issues"].select(
        F.col("id").alias("issue_id"), "magazine_id", issue_name().alias("issue_name")
    ).join(t["magazines"].select(F.col("id").alias("magazine_id"), F.col("name").alias("magazine")), "magazine_id", "left")
    holders = t["entries"].select(F.col("id").alias("container_id"), F.col("title").alias("container"))
    publishers_ = whole_text(segmented_text(_first_publishers(t), ["container_id"], "publisher_seq", "label"), ["container_id"], "publishers")
    where = F.coalesce(F.concat(F.lit('"'), F.col("container"), F.lit('"')),
                       F.when(F.col("magazine_id").isNotNull(), F.col("issue_name")).otherwise(F.lit("?")))
    text = F.concat(
        F.coalesce("magazine", "publishers", F.lit("?")), F.lit(" - "),
        F.element_at(kinds, F.col("origintype_id")), F.lit(" "), where,
    )
    return (
        found.join(issues, "issue_id", "left").join(holders, "container_id", "left")
        .join(publishers_, "container_id", "left").select(*found.columns, text.alias("publication"))
    )


# Stored tables. The author and publisher indexes are stored as credits and relations, whose sizes add up;
# their product would hold a row for each credit of each relative.
INDEXES = {
    "titles": titles, "names": names, "author_credits": author_credits, "publisher_credits": publisher_credits,
    "author_relations": author_relations, "publisher_relations": publisher_relations,
    "issue_names": issue_names, "origins": origins, "publisher_lists": publisher_lists,
}


# Indexes whose lookups read gram lists, and their columns.
GRAM_INDEXES = {"titles": ("entry_title", "entry_id"), "names": ("label_name", "label_id")}


def _holding(index: DataFrame, column: str, word: str, lists: str | None = None) -> DataFrame:
    """Rows of an index whose name holds a word, from the gram lists under ``lists`` where there are any."""
    found = grams.holding(index.sparkSession, lists, column, word) if lists else None
    if found is not None:
        return found
    return index.where(F.contains(F.collate(F.col(column), grams.LOOKUP_COLLATION), F.lit(word)))


def _lists(folder: str | None, name: str) -> str | None:
    return f"{folder}/{name}" if folder else None


def find_entries(t: Tables, word: str, by: str = "title", indexes: Tables | None = None, lists: str | None = None) -> DataFrame:
    """Entries by a part of a title, an author's or a publisher's name, sorted by title.

    ``indexes`` are stored index tables; without them the same is read from the tables themselves. Labels
    found are traced back to the credits, so no pairs of credits with relatives are built. ``lists`` is the folder of the
    gram lists of :data:`GRAM_INDEXES`: with it a lookup reads one list instead of a whole index.
    """
    if by == "title":
        hits = _holding(titles(t) if indexes is None else indexes["titles"], "entry_title", word, _lists(lists, "titles"))
    else:
        labels = _holding(names(t) if indexes is None else indexes["names"], "label_name", word, _lists(lists, "names"))
        if indexes is not None:
            credits, relations = indexes[f"{by}_credits"], indexes[f"{by}_relations"]
        else:
            credits = {"author": _author_seed, "publisher": _publisher_seed}[by](t)
            relations = label_edges(t["labels"], known_parents=by == "author")
        hits = among(credits, "label_id", labels_reaching(labels, relations), "label_id", unique=True)
    return among(t["entries"], "id", hits, "entry_id").orderBy("title", "id")


def find_labels(t: Tables, word: str, indexes: Tables | None = None, lists: str | None = None) -> DataFrame:
    """Labels by a part of their name, sorted by name; ``lists`` as in :func:`find_entries`."""
    index = indexes["names"] if indexes is not None else names(t)
    return among(t["labels"], "id", _holding(index, "label_name", word, _lists(lists, "names")), "label_id").orderBy("name", "id")


def refresh_titles(index: DataFrame, t: Tables, changed: DataFrame) -> DataFrame:
    """New version of a title index after the entries in ``changed(entry_id)`` were edited."""
    part = {
        "entries": among(t["entries"], "id", changed, "entry_id"),
        "aliases": among(t["aliases"], "entry_id", changed, "entry_id"),
        "contents": among(t["contents"], "entry_id", changed, "entry_id"),
    }
    kept = index.join(changed.select("entry_id").distinct(), "entry_id", "left_anti")
    return kept.select("entry_title", "entry_id").unionByName(titles(part))
