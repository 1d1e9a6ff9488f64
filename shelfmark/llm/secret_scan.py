"""Secrets in texts, told apart by how many repositories and owners share them.

Candidates are found by pattern in every text. Their hashes are counted over the whole corpus by
distinct repositories and owners: what many owners have is an example copied from some manual, what one
few have looks like a live credential. Three kinds of candidate are always spans. The fourth, a long mixed
run of characters without any key name, becomes a span unless it is an example. For this kind copies of one
text in several places count as their first owner's, so that they do not turn its secret into an example.

DataFrame functions only: no code runs in Python on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.membership import spread
from ..session import cut_lineage


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    value: int  # the group that holds the secret; it ends where the match ends
    least: int  # characters of that group
    hint: tuple[str, ...] = ()  # one of these characters or texts occurs in every match
    also: tuple[str, ...] = ()  # patterns the secret must contain
    base: bool = True


# Patterns and lengths of the contract, in its order.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = (
    Kind("assign", ASSIGN, 2, 6, (":", "=")),
    Kind("access", "AKIA[A-Z0-9]+", 0, 20, ("AKIA",)),
    # Runs below the least length are dropped in any case, so the pattern need not stop at them.
    Kind("hex", "[0-9a-f]{24,}", 0, 24),
    Kind("blob", "[A-Za-z0-9+/_-]{32,}", 0, 32, (), ("[0-9]", "[a-z]", "[A-Z]"), False),
)
# A candidate of this many owners is an example; a blob of this many holders is none of the spans.
EXAMPLE_OWNERS = 3
MARK = "[SECRET]"
# Texts are cut in blocks of 2 to the power of this many characters, so that no cut counts from the beginning.
BLOCK_BITS = 12
PART = "struct<rank:int,place:int,gap:bigint,size:bigint,sound:boolean,hash:bigint>"


def _parts(text: Column, rank: int, kind: Kind) -> Column:
    """Leftmost matches of one kind that do not overlap, each with its size and the gap before it."""
    pattern = F.lit(kind.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(kind.value))
    between = F.split(text, kind.pattern, -1)
    matches = F.zip_with(
        F.zip_with(found, values, lambda f, v: F.struct(F.length(f).alias("size"), v.alias("value"))),
        F.transform(F.slice(between, F.lit(1), F.size(found)), F.length),
        lambda m, gap: F.struct(gap.alias("gap"), m["size"].alias("size"), m["value"].alias("value")),
    )

    def part(match: Column, place: Column) -> Column:
        sound = F.length(match["value"]) >= kind.least
        for need in kind.also:
            sound = sound & F.rlike(match["value"], F.lit(need))
        return F.struct(
            F.lit(rank).alias("rank"), place.alias("place"), match["gap"].alias("gap"), match["size"].alias("size"),
            sound.alias("sound"), F.xxhash64(match["value"]).alias("hash"),
        ).cast(PART)

    # Most texts hold nothing: one cheap look keeps them from being cut to pieces.
    look = F.rlike(text, pattern)
    if kind.hint:
        hint = F.contains(text, F.lit(kind.hint[0]))
        for other in kind.hint[1:]:
            hint = hint | F.contains(text, F.lit(other))
        look = hint & look
    return F.when(look, F.transform(matches, part)).otherwise(F.array().cast(f"array<{PART}>"))


def candidate_parts(text: Column | str) -> Column:
    """All matches in a text as an array of parts, kind by kind; empty for null."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.concat(*[_parts(text, rank, kind) for rank, kind in enumerate(KINDS)])


def _spans(parts: DataFrame) -> DataFrame:
    """``(row, start, rank, end, base, hash)`` of exploded parts: running sums of gaps and sizes tell where they are.

    Blobs that overlap another span of their row are left out. All windows are of one row and share one exchange.
    """
    in_kind = Window.partitionBy("row", "rank").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    ends = parts.repartition("row").withColumn("end", F.sum(F.col("gap") + F.col("size")).over(in_kind))
    spans = ends.where("sound").select(
        "row", (F.col("end") - F.col("size")).alias("start"), "rank", "end",
        F.col("rank").isin([r for r, kind in enumerate(KINDS) if kind.base]).alias("base"), "hash",
    )
    forth = Window.partitionBy("row").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("rank")).rowsBetween(Window.unboundedPreceding, 0)
    covered = spans.withColumn("left", F.max(F.when(F.col("base"), F.col("end"))).over(forth)).withColumn(
        "right", F.min(F.when(F.col("base"), F.col("start"))).over(back)
    )
    overlaps = F.coalesce(F.col("left") > F.col("start"), F.lit(False)) | F.coalesce(F.col("right") < F.col("end"), F.lit(False))
    return covered.where(F.col("base") | ~overlaps).drop("left", "right")


def ownership(candidates: DataFrame) -> DataFrame:
    """``(hash, repositories, owners, holders)`` of rows ``(hash, repository, owner, text)``, the text as its hash.

    A repository is one of its owner. Holders are owners over distinct texts: each text counts for the first of its
    owners alone. Each step is a partial count, so a hash that a third of all documents hold shrinks to a row per
    task before any exchange. A null counts as one owner or repository.
    """
    pairs = candidates.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owners = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    texts = candidates.groupBy("hash", "text").agg(F.min(F.struct("owner")).alias("first"))
    holders = texts.select("hash", "first").distinct()
    number = lambda n: F.lit(n).cast("long")
    rows = owners.select("hash", "repositories", number(1).alias("owners"), number(0).alias("holders")).unionByName(
        holders.select("hash", number(0).alias("repositories"), number(0).alias("owners"), number(1).alias("holders"))
    )
    return rows.groupBy("hash", spread("hash")).agg(
        *[F.sum(c).alias(c) for c in ("repositories", "owners", "holders")]
    ).select("hash", "repositories", "owners", "holders")


def scan(docs: DataFrame, carry: list[str], text: str = "text", repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """``(doc, spans)`` for every row; ``doc`` is a struct of the columns to ``carry``.

    ``spans`` is sorted by start, then kind, with ``(start, rank, end, kind, base, hash, repositories,
    owners, holders, live, before)``, positions in code points, end exclusive; ``before`` is where the live spans so far
    end. Null, empty and blank texts have no spans. Repeated rows are scanned and returned as often as they come, and
    count once where repositories and owners are counted. Blobs that overlap another span of their text, or have as many
    holders as an example, are left out. The work is linear in the length of a text and its spans, but for their sorting.
    """
    found = docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("doc"), F.col(repository).alias("repository"),
        F.col(owner).alias("owner"), F.xxhash64(text).alias("text"), candidate_parts(text).alias("parts"),
    )
    # Written once: the numbers that bring the spans of a row together again must not change.
    found = cut_lineage(found.withColumn("row", F.monotonically_increasing_id()), "spans")
    each = found.where(F.size("parts") > 0).select("row", "repository", "owner", "text", F.explode("parts").alias("part"))
    counts = ownership(each.where("part.sound").select(F.col("part.hash").alias("hash"), "repository", "owner", "text"))
    kinds = F.array(*[F.lit(kind.name) for kind in KINDS])
    weight = F.when(F.col("base"), F.col("owners")).otherwise(F.col("holders"))
    judged = _spans(each.select("row", "part.*")).join(counts, "hash").withColumn("live", weight < EXAMPLE_OWNERS)
    earlier = Window.partitionBy("row").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.max(F.when(F.col("live"), F.col("end"))).over(earlier), F.lit(0))
    span = F.struct(
        "start", "rank", "end", kinds[F.col("rank")].alias("kind"), "base", "hash", "repositories", "owners", "holders", "live",
        "before",
    )
    lists = judged.where("base or live").repartition("row").withColumn("before", before).groupBy("row").agg(
        F.array_sort(F.collect_list(span)).alias("judged")
    )
    none = F.array().cast(lists.schema["judged"].dataType)
    empty = found.where(F.size("parts") == 0).select("doc", none.alias("spans"))
    full = found.where(F.size("parts") > 0).select("row", "doc").join(lists, "row", "left")
    return empty.unionByName(full.select("doc", F.coalesce("judged", none).alias("spans")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each live span, or run of overlapping ones, replaced by a mark; examples stay."""
    live = F.filter(spans, lambda s: s["live"])
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << BLOCK_BITS}}}"), F.lit(0))

    def piece(cut: Column, start: Column, end: Column) -> Column:
        first = F.shiftright(start, BLOCK_BITS)
        number = F.shiftright(end, BLOCK_BITS) - first + 1
        joined = F.array_join(F.slice(cut, (first + 1).cast("int"), number.cast("int")), "")
        return F.substring(joined, (start - F.shiftleft(first, BLOCK_BITS) + 1).cast("int"), (end - start).cast("int"))

    def without(cut: Column) -> Column:
        pieces = F.transform(live, lambda s: F.when(
            s["start"] >= s["before"], F.concat(piece(cut, s["before"], s["start"]), F.lit(MARK))
        ).otherwise(F.lit("")))
        rest = piece(cut, F.array_max(F.transform(live, lambda s: s["end"])), F.length(text).cast("long"))
        return F.array_join(F.concat(pieces, F.array(rest)), "")

    # The blocks are the one element of an array, so that they are cut once and not for each span.
    return F.when(F.size(live) > 0, F.transform(F.array(blocks), without)[0]).otherwise(text)


def without_secrets(docs: DataFrame, text: str = "text", repository: str = "doc_id", owner: str = "source",
                    n_chars: str = "n_chars") -> DataFrame:
    """The documents with their live secrets replaced by a mark; ``n_chars`` follows.

    Examples, which three owners or more have, stay in the texts, as do texts without live secrets.
    """
    scanned = scan(docs, docs.columns, text, repository, owner)
    clean = redacted(F.col(f"doc.{text}"), F.col("spans"))
    held = F.exists("spans", lambda s: s["live"])
    out = scanned.select("doc", "spans", clean.alias("clean"))
    columns = []
    for name in docs.columns:
        column = F.col("doc").getField(name)
        if name == text:
            column = F.col("clean")
        elif name == n_chars:
            column = F.when(held, F.length("clean")).otherwise(column).cast(docs.schema[name].dataType)
        columns.append(column.alias(name))
    return out.select(*columns)
