"""Tables out of SQL dump text, read in parallel however statements, heads and tuples lie over its lines.

What a line means depends on what is open where it begins: a quoted text, a head, a tuple. So each line is told by what
it does to the state before it, and states come from composing that over all lines before, split by split:

* a line's effect on "inside quotes or not" is one of four functions, two of which forget the state and one of which
  turns it around. The state at a line is what the last forgetting line left, turned by the number of turns since;
* a split's effect is a function of the same four, so the state at its start is the same sum over earlier splits,
  of which there is one row each;
* a quote that stays open at the end of a line is a raw newline in a text only if the next quote that closes one is
  followed by what can follow a value. Otherwise the text has no end, and reading goes on with the next line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..schema import TABLES
from ..session import cut_lineage
from .text_files import LINE_ORDER, read_lines, unescape

# Words that begin a statement; the name of a table, with or without its database; a head.
_BEGINS = r"""(?ix)^\s*(?: (?:INSERT|REPLACE|CREATE|DROP|ALTER|USE|SET|LOCK|UNLOCK|START|TRUNCATE|DELETE|UPDATE|DELIMITER|GRANT
    |REVOKE|CALL|ANALYZE|OPTIMIZE|FLUSH|SELECT|SHOW|RENAME|PREPARE|EXECUTE|DEALLOCATE|DECLARE) \s+ [^\s,)]
    | (?:INSERT|REPLACE)\s*$ | (?:COMMIT|ROLLBACK|BEGIN)\s*(?:;|$) | ON\s+DUPLICATE\b )"""
_NAME = r"""(?:`[^`]+`|"[^"]+"|\w+)"""
_HEAD = rf"""(?is)^\s*(?:INSERT|REPLACE)\s+(?:(?:LOW_PRIORITY|DELAYED|HIGH_PRIORITY|IGNORE)\s+)*(?:INTO\s+)?
    (?:{_NAME}\s*\.\s*)?((?!INTO\b){_NAME})\s*(?:\(([^)]*)\))?\s*VALUES?\b""".replace("\n    ", "")
_INSERTS = r"(?i)^\s*(?:INSERT|REPLACE)\b"
_VALUES = r"(?i)\bVALUES?\b"
# What lies before the first VALUES, and the rest of the line.
_AFTER_VALUES = r"(?is)^.*?\bVALUES?\b(.*)\z"
_BLOCK_COMMENT = r"/\*(?:[^*]++|\*(?!/))*+\*/"
_COMMENT = rf"^\s*(?:--(?:\s.*)?|\#.*|(?:{_BLOCK_COMMENT}[\s;]*+)*+(?:/\*(?:[^*]++|\*(?!/))*+)?)$"
_LEADING_COMMENTS = rf"^\s*+(?:{_BLOCK_COMMENT}\s*+)++"
# Where a line begins a tuple, or leads up to one.
_TUPLE_BEGINS = r"^\s*(?:,?\s*\(|;)"
# A quoted text with backslash escapes or doubled quotes. All loops are possessive, so long texts cost
# neither backtracking nor stack.
_QUOTED = r"'(?:[^'\\]++|\\[\s\S]|'')*+'"
_VALUE = rf"{_QUOTED}|[^,'\s][^,]*+"
_TUPLE = rf"\((?:{_QUOTED}|[^'()]++)*+\)"
# A line from a plain beginning up to a quoted text without end, and a line inside quotes up to their end.
_PLAIN = (
    r"^(?:[^'\"`#/\-]++|" + _QUOTED + r'|"(?:[^"\\]++|\\[\s\S]|"")*+"|`[^`]*+`|--(?=\s|\z)[\s\S]*+|\#[\s\S]*+|'
    + _BLOCK_COMMENT + r"|[^'])*+"
)
_INSIDE = r"^(?:[^'\\]++|\\[\s\S]|''|\\\z)*+"
_FOLLOWS_A_VALUE = r"^\s*(?:[,);]|\z)"

_SPLIT = ["_file", "_block"]
_BEFORE = (Window.unboundedPreceding, -1)


def _leaves_open(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, "").startswith("'")


def _told_lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Every line with what can be told from it alone, written once; states are then found on its narrow columns."""
    lines = read_lines(spark, path, encoding, raw=True)
    quoted = F.contains("value", F.lit("'"))
    rest = F.regexp_replace("value", _INSIDE, "")
    after = rest.substr(F.lit(2), F.length(rest))
    closes = quoted & (rest != "")
    plain = F.regexp_replace("value", _LEADING_COMMENTS, "")
    inserts = F.rlike(plain, F.lit(_INSERTS))
    # A head holds no quoted text, so its VALUES come before any.
    values = F.rlike(F.substring_index(plain, "'", 1), F.lit(_VALUES))
    head = inserts & values
    named = lambda group: F.when(head, F.regexp_extract(plain, _HEAD, group))
    return cut_lineage(lines.select(
        *LINE_ORDER, "value",
        F.rlike("value", F.lit(_COMMENT)).alias("comment"),
        (quoted & _leaves_open(F.col("value"))).alias("opens"),
        closes.alias("closes"), F.when(closes, F.rlike(after, F.lit(_FOLLOWS_A_VALUE))).alias("good"),
        (closes & _leaves_open(after)).alias("opens_again"),
        F.rlike(plain, F.lit(_BEGINS)).alias("begins"), inserts.alias("inserts"), values.alias("values"),
        F.rlike(plain, F.lit(_TUPLE_BEGINS)).alias("tuple_begins"), named(1).alias("table"), named(2).alias("names"),
    ), "dump-lines")


def _with_carried(rows: DataFrame, carried: DataFrame, *names: str) -> DataFrame:
    """Rows with columns of their split's row; a column that a split lacks is NULL."""
    return rows.join(carried.select(*_SPLIT, *names), _SPLIT, "left")


def _quote_states(lines: DataFrame) -> DataFrame:
    """Adds ``inside``, whether a line begins inside quotes, and ``open``, whether it ends there."""
    # Whether the next closing quote, in this split or a later one, is followed by what can follow a value.
    closing = lines.where("closes").groupBy(*_SPLIT).agg(F.min_by("good", "_pos").alias("_first"))
    splits = lines.select(*_SPLIT).distinct().join(closing, _SPLIT, "left")
    later = Window.partitionBy("_file").orderBy(F.col("_block").desc()).rowsBetween(*_BEFORE)
    splits = splits.withColumn("_later", F.last("_first", ignorenulls=True).over(later))
    backwards = Window.partitionBy(*_SPLIT).orderBy(F.col("_pos").desc()).rowsBetween(*_BEFORE)
    told = _with_carried(
        lines.withColumn("_next", F.last("good", ignorenulls=True).over(backwards)), splits, "_later"
    ).withColumn("_goes_on", F.coalesce("_next", "_later", F.lit(False)))
    told = told.withColumns({
        "_from_plain": F.col("opens") & F.col("_goes_on") & ~F.col("comment"),
        "_from_inside": F.when(F.col("closes"), F.col("opens_again") & F.col("_goes_on")).otherwise(True),
    }).drop("_next", "_later", "_goes_on")

    def scan(rows: DataFrame, partition: list[str], order: str, start: str | None) -> DataFrame:
        """Adds ``_state`` before each row: the last value that was set, turned by the turns since."""
        before = Window.partitionBy(*partition).orderBy(order).rowsBetween(*_BEFORE)
        turns = F.coalesce(F.sum((F.col("_from_plain") & ~F.col("_from_inside")).cast("long")).over(before), F.lit(0))
        rows = rows.withColumn("_turns", turns)
        sets = F.when(F.col("_from_plain") == F.col("_from_inside"), F.struct(F.col("_from_plain").alias("to"), "_turns"))
        last = F.last(sets, ignorenulls=True).over(before)
        rows = rows.withColumn("_set", last)
        odd = (F.col("_turns") - F.coalesce("_set._turns", F.lit(0))) % 2 == 1
        base = F.coalesce(F.col("_set.to"), F.col(start) if start else F.lit(False))
        return rows.withColumn("_state", base != odd)

    # A split as one line: what it makes of either state. Its last line's state, and what that line does, tell.
    local = scan(told, _SPLIT, "_pos", None).select(
        *_SPLIT, "_pos", (F.col("_set").isNotNull()).alias("_was_set"), "_state", "_from_plain", "_from_inside"
    )
    end = lambda state: F.when(state, F.col("_l._from_inside")).otherwise(F.col("_l._from_plain"))
    effects = local.groupBy(*_SPLIT).agg(F.max_by(F.struct("_was_set", "_state", "_from_plain", "_from_inside"), "_pos").alias("_l")).select(
        *_SPLIT, end(F.col("_l._state")).alias("_from_plain"),
        end(F.when(F.col("_l._was_set"), F.col("_l._state")).otherwise(~F.col("_l._state"))).alias("_from_inside"),
    )
    starts = scan(effects, ["_file"], "_block", None).select(*_SPLIT, F.col("_state").alias("_start"))
    found = scan(_with_carried(told, starts, "_start"), _SPLIT, "_pos", "_start")
    return found.withColumn("inside", F.col("_state")).withColumn(
        "open", F.when(F.col("inside"), F.col("_from_inside")).otherwise(F.col("_from_plain"))
    ).drop("_from_plain", "_from_inside", "_turns", "_set", "_state", "_start")


def _placed_lines(lines: DataFrame) -> DataFrame:
    """Lines that are no comments, each with its statement, whether it belongs to a head, and the piece it is part of.

    What is sorted by split are narrow rows; the texts join them at the end, dealt by line, and all of it is written once.
    """
    told = _quote_states(lines.drop("value")).where(F.col("inside") | ~F.col("comment"))
    plain = ~F.col("inside")
    begins = plain & F.col("begins")
    here = F.struct("_block", "_pos")
    events = {
        "statement": F.when(begins, F.struct(
            F.col("_block").alias("block"), F.col("_pos").alias("pos"), F.col("inserts").alias("inserts"),
            F.col("values").alias("whole"), "table", "names",
        )),
        # A head is open from an INSERT to its VALUES.
        "in_head": F.when(begins, F.col("inserts") & ~F.col("values")).when(plain & F.col("values"), F.lit(False)),
        "piece": F.when(plain & (F.col("begins") | F.col("values") | F.col("tuple_begins")), here),
    }
    told = told.withColumns({f"_{name}": event for name, event in events.items()})
    per_split = told.groupBy(*_SPLIT).agg(*[
        F.max_by(f"_{name}", F.when(F.col(f"_{name}").isNotNull(), F.col("_pos"))).alias(name) for name in events
    ])
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(*_BEFORE)
    carried = per_split.select(*_SPLIT, *[F.last(name, ignorenulls=True).over(earlier).alias(f"_{name}_before") for name in events])
    order = Window.partitionBy(*_SPLIT).orderBy("_pos")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    local = told.withColumns({
        "_s": F.last("_statement", ignorenulls=True).over(upto),
        "_h": F.last("_in_head", ignorenulls=True).over(order.rowsBetween(*_BEFORE)),
        "_p": F.last("_piece", ignorenulls=True).over(upto),
        "_next": F.lead(F.col("_piece").isNotNull()).over(order),
    })
    joined = _with_carried(local, carried, *[f"_{name}_before" for name in events])
    placed = joined.select(
        *LINE_ORDER, "inside", "open", begins.alias("begins"), (plain & F.col("values")).alias("values"),
        F.coalesce("_s", "_statement_before").alias("statement"), F.coalesce("_h", "_in_head_before", F.lit(False)).alias("in_head"),
        F.coalesce("_p", "_piece_before").alias("piece"),
        # The last line of a split cannot tell whether the next one goes on.
        (F.col("_piece").isNotNull() & F.coalesce("_next", F.lit(False))).alias("alone"),
    ).where("statement.inserts")
    return cut_lineage(placed.join(lines.select(*LINE_ORDER, "value"), LINE_ORDER), "dump-placed")


def _joined(lines: DataFrame, key: list[Column], *carry: str) -> DataFrame:
    """Lines of one head or piece as one text, raw newlines between them."""
    return lines.groupBy(*key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_block", "_pos", "text"))), lambda x: x["text"]), "\n").alias("text"),
        *[F.min(c).alias(c) for c in carry],
    )


def _data_lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Pieces of INSERT statements: table, columns, text, tuples, whether all of it was read, and whether it is a head."""
    placed = _placed_lines(_told_lines(spark, path, encoding))
    # A carriage return at the end of a line belongs to the text only inside quotes.
    bare = F.when(F.col("open"), F.col("value")).otherwise(F.regexp_replace("value", r"\r\z", ""))
    bare = F.when(F.col("inside"), bare).otherwise(F.regexp_replace(bare, _LEADING_COMMENTS, ""))
    placed = placed.withColumn("line", bare)
    of_head = (F.col("begins") & ~F.col("values")) | (F.col("in_head") & ~F.col("begins"))
    by_statement = [F.col("_file"), F.col("statement.block").alias("_sb"), F.col("statement.pos").alias("_sp")]
    heads = _joined(placed.where(~F.col("statement.whole") & of_head).withColumn("text", F.col("line")), by_statement)
    heads = heads.select(
        "_file", "_sb", "_sp", "text", F.regexp_extract("text", _HEAD, 1).alias("table"), F.regexp_extract("text", _HEAD, 2).alias("names")
    )
    data = placed.where(F.col("values") | (~F.col("in_head") & ~F.col("begins")))
    unread = F.col("begins") & (F.coalesce("statement.table", F.lit("")) == "")
    text = F.when(F.col("values") & ~unread, F.regexp_extract("line", _AFTER_VALUES, 1)).otherwise(F.col("line"))
    data = data.select(*LINE_ORDER, "statement", "piece", "alone", text.alias("text"))
    single = data.where("alone").select(*LINE_ORDER, "statement", "text")
    several = _joined(
        data.where("not alone"), [F.col("_file"), F.col("piece._block").alias("_pb"), F.col("piece._pos").alias("_pp")], "statement"
    ).select("_file", F.col("_pb").alias("_block"), F.col("_pp").alias("_pos"), "statement", "text")
    pieces = single.unionByName(several).where(~F.rlike("text", F.lit(r"^\s*\z")))
    known = pieces.where("statement.whole").select(*LINE_ORDER, "text", "statement.table", "statement.names")
    waiting = pieces.where("not statement.whole").select(
        *LINE_ORDER, "text", F.col("statement.block").alias("_sb"), F.col("statement.pos").alias("_sp")
    ).join(heads.drop("text"), ["_file", "_sb", "_sp"], "left").select(*LINE_ORDER, "text", "table", "names")
    lost_heads = heads.where("table = ''").select(
        "_file", F.col("_sb").alias("_block"), F.col("_sp").alias("_pos"), "text", "table", "names"
    )
    cut = known.unionByName(waiting).unionByName(lost_heads)
    bare_name = F.regexp_replace(F.coalesce("table", F.lit("")), r"[`\"]", "")
    names = F.when(F.coalesce("names", F.lit("")) != "", F.split(F.regexp_replace("names", r"[`\"\s]", ""), ","))
    declared = F.create_map(*[
        x for name, table in TABLES.items() for x in (F.lit(name), F.array(*[F.lit(f) for f in table.schema.fieldNames()]))
    ])
    left = F.regexp_replace("text", _TUPLE, "")
    return cut.withColumn("table", bare_name).select(
        "table", F.coalesce(names, F.try_element_at(declared, F.col("table"))).alias("columns"), "text",
        F.regexp_extract_all("text", F.lit(_TUPLE), F.lit(0)).alias("tuples"), F.rlike(left, F.lit(r"^[\s,;]*$")).alias("whole"), *LINE_ORDER,
    )


def _tokens(tuple_: Column) -> Column:
    body = tuple_.substr(F.lit(2), F.length(tuple_) - 2)
    return F.regexp_extract_all(body, F.lit(_VALUE), F.lit(0))


def _values(tuple_: Column) -> Column:
    return F.transform(_tokens(tuple_), _value)


def read_dump(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """``(table, columns, values)`` of every inserted tuple in the dump files under ``path``.

    Heads may name a database, and heads and tuples may go over several lines; texts may hold raw newlines. Without
    a list of columns the declared ones are meant. A piece of text that does not parse to its end gives no tuple at all,
    and tuples under a head that cannot be read, or that do not fit their columns, none either:
    :func:`read_rejects` has them.
    """
    lines = _data_lines(spark, path, encoding).where("whole and table <> ''")
    each = lines.select("table", "columns", F.posexplode("tuples").alias("_tuple", "t"), *LINE_ORDER)
    rows = each.select("table", "columns", _values(F.col("t")).alias("values"), *LINE_ORDER, "_tuple")
    return rows.where(F.size("columns") == F.size("values"))


def read_rejects(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """``(table, problem, text)`` of all text inside INSERT statements that gave no row; no table where its head is not read."""
    lines = _data_lines(spark, path, encoding)
    fits = lambda t: F.coalesce(F.size("columns") == F.size(_tokens(t)), F.lit(False))
    lost = (
        F.when(F.col("table") == "", F.array(F.struct(F.lit("head not read").alias("problem"), "text")))
        .when(~F.col("whole"), F.array(F.struct(F.lit("not read to its end").alias("problem"), "text")))
        .otherwise(F.transform(
            F.filter("tuples", lambda t: ~fits(t)),
            lambda t: F.struct(F.lit("does not fit its columns").alias("problem"), t.alias("text")),
        ))
    )
    return lines.select("table", F.inline(lost))


def _value(token: Column) -> Column:
    bare = F.btrim(token, F.lit(" \t\r\n"))
    inner = F.replace(bare.substr(F.lit(2), F.length(bare) - 2), F.lit("''"), F.lit("'"))
    # Quoted text is kept even where it reads like the unquoted NULL.
    text = F.when(inner == F.lit("\\N"), inner).otherwise(unescape(inner))
    return F.when(bare.startswith("'"), text).when(F.upper(bare) != "NULL", bare)


def dump_table(rows: DataFrame, name: str, source: str | None = None) -> DataFrame:
    """The declared columns of one table as texts, wherever the INSERT lists them."""
    def column(field: str) -> Column:
        at = F.array_position("columns", F.lit(field)).cast("int")
        return F.when(at > 0, F.get("values", at - 1)).alias(field)

    return rows.where(F.col("table") == (source or name)).select(
        *[column(f.name) for f in TABLES[name].schema.fields]
    )
