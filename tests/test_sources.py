from __future__ import annotations

import pytest
from handmade import Handmade, rows

from shelfmark.operators.changes import replace_slice, update_from
from shelfmark.plans.imports import listings, map_links
from shelfmark.plans.imports.reviews import magazine_map
from shelfmark.schema import TABLES
from shelfmark.session import shared_folder
from shelfmark.sources import dump, tables, text_files


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_delimited_fields_escapes_and_charset(spark, tmp_path):
    path = write(tmp_path / "a.txt", "č;b\\;c;\\N\r\n;x\\\\;z;extra\n\"q\"\n", "iso-8859-2")
    got = text_files.read_delimited(spark, path, ["a", "b", "c"], ";", "ISO-8859-2").orderBy(*text_files.LINE_ORDER)
    assert [(r.a, r.b, r.c) for r in got.collect()] == [("č", "b;c", None), ("", "x\\", "z"), ('"q"', None, None)]


def test_any_number_of_backslashes_and_lone_carriage_returns(spark, tmp_path):
    slashes = "\\" * 43
    path = write(tmp_path / "e.txt", f"a{slashes};b;c\n{slashes}\\;d\rd;e\nf\\\n;;\n")
    got = text_files.read_delimited(spark, path, ["a", "b", "c"]).orderBy(*text_files.LINE_ORDER)
    assert [(r.a, r.b, r.c) for r in got.collect()] == [
        ("a" + "\\" * 21 + ";b", "c", None), ("\\" * 22, "d\rd", "e"), ("f\\", None, None), ("", "", "")]


def test_line_order_and_edges_over_many_splits(spark, tmp_path):
    lines = [f"line {i}" for i in range(3000)]
    path = write(tmp_path / "long.txt", "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        read = text_files.read_lines(spark, path)
        assert read.rdd.getNumPartitions() > 5
        ordered = [r.value for r in read.orderBy(*text_files.LINE_ORDER).collect()]
        kept = [r.value for r in text_files.drop_edges(read, 3, 2).orderBy(*text_files.LINE_ORDER).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert ordered == lines
    assert kept == lines[3:-2]


def test_map_links_cut_by_bytes_and_replace_one_site(spark, tmp_path):
    def line(ident, image):
        return ";".join(["t", image, *[""] * 10, ident, "g", ""])

    text = "\n".join([line("1", "map.png"), line("1", "map.png"), line("2", "mapč.png"), line("", "x.png"), line("7", "y.png"), line("2x", "z.png")])
    maps = map_links.read_map_list(spark, write(tmp_path / "m.txt", text + "\n", "iso-8859-2"))
    t = Handmade(spark, entries=rows("id title", (1, "A"), (2, "B")), webrefs=rows("entry_id link website_id", (1, "old", 6), (1, "kept", 5), (2, "kept", 7)))
    got = sorted(tuple(r) for r in map_links.import_map_links(maps, t).collect())
    root = "http://maps.speccy.cz/map.php?id="
    assert got == [(1, root + "map", 6, "en"), (1, "kept", 5, None), (2, root + "mapč.", 6, "en"), (2, "kept", 7, None)]
    assert [r.id for r in map_links.unclean_ids(maps).collect()] == ["2x"]


def files(spark):
    return Handmade(
        spark, downloads=rows("id entry_id file_link file_size file_md5", (1, 1, "/zxdb/a", 1, "old"), (2, 1, "/zxdb/gone", 1, "old"), (3, 1, "/pub/a", 1, "old"), (4, 1, "/pub/gone", 1, "old")),
        files=rows("id file_link file_size", (1, "/zxdb/f", None), (2, "/pub/f", 4)),
        scraps=rows("id file_link rationale file_size", (1, None, "x", 0), (2, "/zxdb/s", None, 0), (3, "/pub/s1", "broken link at www.worldofspectrum.org", 0), (4, "/pub/s2", None, 0), (5, "/pub/s3", "other", 0)),
    )


def test_manifest(spark, tmp_path):
    md5 = "d" * 32
    lines = [f"{size}\t{link}\t{md5}  {link}" for size, link in ((10, "/zxdb/a"), (11, "/zxdb/a"), (12, "/zxdb/new č"), (13, "/zxdb/f"), (14, "/zxdb/s"), (15, "/pub/a"))]
    listing = listings.read_manifest(spark, write(tmp_path / "dir.txt", "\n".join(lines) + "\n", "iso-8859-2")).cache()
    t = files(spark)
    assert listing.where("file_link = '/zxdb/a'").first().file_size == 10
    assert [r.file_link for r in listings.unknown_files(listing, t).collect()] == ["/zxdb/new č"]
    assert [r.id for r in listings.missing_files(t["downloads"], listing).collect()] == [2]
    assert {r.id: (r.file_size, r.file_md5) for r in listings.enriched(t["downloads"], listing).collect()} == {
        1: (10, md5), 2: (1, "old"), 3: (1, "old"), 4: (1, "old")}
    assert {r.id: r.file_size for r in listings.enriched(t["scraps"], listing, digest=False).collect()} == {1: 0, 2: 14, 3: 0, 4: 0, 5: 0}


def test_mirror(spark, tmp_path):
    root = "World of Spectrum June 2017 Mirror/"

    def line(size, link):
        return f"{size:>11} 2017-06-01 12:00 {root}{link}\tignored"

    text = "\n".join(["h1", "h2", "h3", line(5, "a"), line(6, "f"), line(7, "a"), line("dir", "sinclair/x/"), line(8, "new"), line(9, "sinclair/magazines/m"), "f1", "f2"])
    listing = listings.read_mirror(spark, write(tmp_path / "mirror.txt", text + "\n", "iso-8859-2")).cache()
    t = files(spark)
    assert {r.file_link: r.file_size for r in listing.collect()} == {
        "/pub/a": 5, "/pub/f": 6, "/pub/sinclair/x/": None, "/pub/new": 8, "/pub/sinclair/magazines/m": 9}
    assert (listing.first().file_date, listing.first().file_time) == ("2017-06-01", "12:00")
    assert [r.id for r in listings.missing_files(t["downloads"], listing, "/pub/").collect()] == [4]
    assert [r.id for r in listings.missing_mirror_scraps(t["scraps"], listing).collect()] == [5]
    assert [r.file_link for r in listings.unknown_mirror_files(listing, t).collect()] == ["/pub/new"]


DUMP = r"""-- header
CREATE DATABASE IF NOT EXISTS `c`;
USE `c`;
CREATE TABLE IF NOT EXISTS `genretypes` (
  `id` int(11) NOT NULL,
  PRIMARY KEY (`id`)
) ENGINE=InnoDB;
INSERT INTO `genretypes` (`id`, `text`) VALUES
	(1, 'It\'s, (a) test; really'),
	(2, 'NULL'),
	(3, NULL),
	(x4, 'two\nlines \\ back'),
	(5, ''),
	(6, 'doubled '' quote');
CREATE TABLE `hosts` (
  `id` int(11)
);
INSERT INTO `hosts` (`link`, `id`) VALUES ('inline is no tuple line', 0);
INSERT INTO `hosts` (`link`, `id`) VALUES
	('a', 1),
	('b', 2);
"""


@pytest.mark.parametrize("split", ["64", "100000"])
def test_dump_to_typed_tables(spark, tmp_path, split):
    path = write(tmp_path / "d.sql", DUMP)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        read = dump.read_dump(spark, path)
        schema = TABLES["genretypes"].schema
        typed, rejects = tables.apply_schema(dump.dump_table(read, "genretypes"), schema, {"text": 20})
        got, bad = {r.id: r.text for r in typed.collect()}, {r.id: r.problems for r in rejects.collect()}
        hosts = {tuple(r) for r in dump.dump_table(read, "hosts").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {2: "NULL", 5: "", 6: "doubled ' quote"}
    assert bad == {"1": ["text: too long"], "3": ["text: missing"], "x4": ["id: not int"]}
    assert hosts == {("0", "inline is no tuple line"), ("1", "a"), ("2", "b")}


LAYOUTS = """-- a comment
INSERT INTO `genretypes` (`id`, `text`) VALUES (1,'one'),(2,'tw(o), ''2''');
INSERT IGNORE INTO genretypes VALUES (3, NULL), (4,'a;b'),
  (5,'five'),(6, 'six');
COMMIT;
(99, 'outside');
INSERT INTO `genretypes` (`id`, `text`)
VALUES
(7,'seven')
,(8,'no end
(9);
/* done */
"""


def test_dump_layouts_and_rejects(spark, tmp_path):
    path = write(tmp_path / "x.sql", LAYOUTS)
    read = dump.read_dump(spark, path)
    got = {(r.id, r.text) for r in dump.dump_table(read, "genretypes").collect()}
    assert got == {("1", "one"), ("2", "tw(o), '2'"), ("3", None), ("4", "a;b"), ("5", "five"), ("6", "six"), ("7", "seven")}
    rejects = {(r.problem, r.text) for r in dump.read_rejects(spark, path).collect()}
    assert rejects == {("not read to its end", ",(8,'no end"), ("does not fit its columns", "(9)")}


ANY_LAYOUT = """/* a comment
over it's lines */
/* here */ INSERT INTO `zx`.`genretypes`
  (`id`,
   `text`)
VALUES
  (1, 'one
line, it''s \\' (more)
INSERT INTO nothing'), (2, 'two'),
  (
    3,
    'three'
  ),
  (4, '
');
# it's a comment
INSERT INTO zx . genretypes (id, text) VALUES (5, 'a'), (6,
'b\r
c')
, (7, 'no end
, (8, 'eight'),
  (9, '-- no comment
# nor this');
-- it's over
INSERT INTO `genretypes` SET `id` = 10, `text` = 'ten';
INSERT INTO "zx"."genretypes" ("id", "text") SELECT 11, 'eleven'
  FROM `other`;
REPLACE `genretypes` VALUES (12, 'twelve'); (13, 'thirteen');
INSERT INTO (14, 'no table') VALUES (14, 'fourteen'),
(15, 'fifteen');
CREATE TABLE `x` (
  `id` int COMMENT 'it''s'
);
(16, 'sixteen');
INSERT INTO `genretypes` VALUES (17, 'seventeen')
ON DUPLICATE KEY UPDATE `text` = 'x';
"""


@pytest.mark.parametrize("split", ["40", "1000"])
def test_dump_in_any_layout(spark, tmp_path, split):
    """Rows plus rejects are what was planted, however the splits fall."""
    path = write(tmp_path / "y.sql", ANY_LAYOUT)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        read = dump.read_dump(spark, path)
        got = {(r.id, r.text) for r in dump.dump_table(read, "genretypes").collect()}
        rejects = {(r.table, r.problem, r.text) for r in dump.read_rejects(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {
        ("1", "one\nline, it's ' (more)\nINSERT INTO nothing"), ("2", "two"), ("3", "three"), ("4", "\n"), ("5", "a"), ("6", "b\r\nc"),
        ("8", "eight"), ("9", "-- no comment\n# nor this"), ("12", "twelve"), ("13", "thirteen"), ("17", "seventeen"),
    }
    assert rejects == {
        ("genretypes", "not read to its end", ", (7, 'no end"),
        ("", "head not read", "INSERT INTO `genretypes` SET `id` = 10, `text` = 'ten';"),
        ("", "head not read", "INSERT INTO \"zx\".\"genretypes\" (\"id\", \"text\") SELECT 11, 'eleven'\n  FROM `other`;"),
        ("", "head not read", "INSERT INTO (14, 'no table') VALUES (14, 'fourteen'),\n(15, 'fifteen');"),
    }


def test_dump_lexer_against_a_walk(spark, tmp_path):
    """Random rows with quotes, backslashes, newlines and comments in their texts, cut into splits of 1 KB."""
    import random

    rng = random.Random(7)
    pieces = ["a", "'", "\\", "\n", "--", "#", "(", ")", ",", ";", "/*", "*/", '"', "`", " ", "VALUES ", "INSERT INTO x ", "\t", "\r\n"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(30))) + "z") for i in range(400)]
    # A text that goes on with what can follow a value would be taken for the end of one without an end.
    literal = lambda t: "'" + "".join({"'": rng.choice(["''", "\\'"]), "\\": "\\\\"}.get(c, c) for c in t) + "'"
    text = "".join(
        rng.choice(["INSERT INTO `zx`.genretypes\n(id, text)\nVALUES\n", "INSERT INTO genretypes VALUES "])
        + rng.choice([", ", ",\n", "\n, "]).join(rng.choice(["({}, {})", "({},\n {}\n)"]).format(i, literal(t)) for i, t in rows[at:at + 5]) + ";\n"
        for at in range(0, len(rows), 5)
    )
    path = write(tmp_path / "w.sql", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        got = {int(r.id): r.text for r in dump.dump_table(dump.read_dump(spark, path), "genretypes").collect()}
        assert dump.read_rejects(spark, path).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == dict(rows)


def test_long_quoted_text_neither_backtracks_nor_overflows(spark, tmp_path):
    body = "ab\\'c, " * 200_000
    read = dump.read_dump(spark, write(tmp_path / "l.sql", f"INSERT INTO `notes` (`entry_id`, `text`) VALUES\n(1, '{body}');\n"))
    assert len(dump.dump_table(read, "notes").first().text) == 6 * 200_000


def test_keys_and_references(spark):
    t = Handmade(spark, authors=rows("entry_id author_seq label_id team_id", (1, 1, 5, None), (1, 1, 6, 9), (2, 1, 6, 9)), entries=rows("id title", (1, "A")), labels=rows("id name", (5, "x")))
    assert [tuple(r) for r in tables.check_keys(t["authors"], TABLES["authors"].key).collect()] == [(1, 1, 2)]
    assert sorted(tuple(r) for r in tables.check_references(t, "authors").collect()) == [
        ("entry_id", "2", 1), ("label_id", "6", 2), ("team_id", "9", 2)]


def test_export_and_rebuild(spark, tmp_path):
    df = spark.range(2500).selectExpr("id", "cast(id % 7 as string) as t")
    tables.export_tables({"x": df.coalesce(1)}, str(tmp_path), 1000)
    assert len(list((tmp_path / "x").glob("part-*"))) == 3
    tables.rebuild(df, str(tmp_path / "y"), ["t", "id"])
    assert spark.read.parquet(str(tmp_path / "y")).exceptAll(df).count() == 0


def test_second_database(spark, tmp_path):
    s = Handmade(spark, magazines_src=rows("mag_id mag_name", (1, "SPACE"), (2, "Unknown")))
    t = Handmade(spark, magazines=rows("id name", (7, "space"), (8, "SPACE (Advanced Computer Entertainment)")))
    spark.sql(f"create database if not exists outside location '{tmp_path}/outside'")
    s["magazines_src"].write.mode("overwrite").saveAsTable("outside.magazines_src")
    try:
        second = tables.DatabaseTables(spark, "outside")
        # The alias also applies inside a word.
        assert [(r.mag_id, r.magazine_id) for r in magazine_map(t, second).collect()] == [(1, 8)]
    finally:
        spark.sql("drop database outside cascade")


def test_replace_slice_leaves_other_slices(spark):
    t = spark.createDataFrame([(1, 6), (2, 5), (3, None)], "a int, s int")
    out = replace_slice(t, spark.createDataFrame([(9, 6)], "a long, s long"), "s", 6)
    assert sorted(out.collect(), key=repr) == sorted([(2, 5), (3, None), (9, 6)], key=repr)


def test_update_takes_null_from_the_source(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    out = update_from(t, spark.createDataFrame([(1, None), (3, "x")], "k int, n string"), ["k"], {"v": "n"})
    assert sorted(out.collect(), key=repr) == sorted([(1, None), (2, "b"), (None, "c")], key=repr)


def test_shared_folder_is_read_from_the_session(spark):
    assert shared_folder(spark)


def test_dump_states_are_found_without_the_texts(spark, tmp_path, monkeypatch):
    seen, found = [], dump._quote_states
    monkeypatch.setattr(dump, "_quote_states", lambda lines: seen.append(lines.columns) or found(lines))
    (tmp_path / "d.sql").write_text("INSERT INTO `labels` (`id`, `name`) VALUES\n(1,'a\nb'),\n(2,'c', 3),\n(4;\nINSERT INTO;\n")
    lost = sorted(tuple(r) for r in dump.read_rejects(spark, str(tmp_path)).collect())
    assert seen == [[c for c in seen[0] if c != "value"]]
    assert lost == [("", "head not read", "INSERT INTO;"), ("labels", "does not fit its columns", "(2,'c', 3)"), ("labels", "not read to its end", "(4;")]
    assert [list(r["values"]) for r in dump.read_dump(spark, str(tmp_path)).collect()] == [["1", "a\nb"]]
