"""The two public XML dumps: bibliography records and question-and-answer posts."""

import re
from functools import reduce
from html.entities import name2codepoint
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Marks of the wanted venues in a record's text.
VENUE_MARKS = ["/SIGMOD", "/sigmod", "/vldb", "/edbt", "/icde"]

RECORD_SCHEMA = (
    "_key string, author array<string>, title string, year string, "
    "url string, ee array<string>, journal string, booktitle string, crossref string"
)
POST_SCHEMA = "_Id string, _PostTypeId string, _Body string"

# Entities that every XML parser knows; they stay as they are.
PREDEFINED = ["amp", "lt", "gt", "quot", "apos"]

# characters of records that leave a task together
BATCH_CHARACTERS = 1 << 20

# What a scan can be inside of at the beginning of a file block, and what ends it.
ENDS = {"markup": None, "comment": "-->", "cdata": "]]>", "instruction": "?>"}
TAG = re.compile(r"""[^\s/>]+(?:[^>"']|"[^"]*"|'[^']*')*?(/?)>""")


def named_entities_decoded(text: Column) -> Column:
    """Named entities such as ``&ouml;`` as their characters, in text that is still XML.

    The dumps declare them in a DTD that the XML reader does not see. The five predefined ones
    stay, and an unknown name keeps its letters behind an escaped ampersand.
    """
    names = [name for name in sorted(name2codepoint) if name not in PREDEFINED]
    characters = F.create_map(
        *[F.lit(value) for name in names for value in (name, chr(name2codepoint[name]))]
    )

    def decoded(part: Column) -> Column:
        name = F.regexp_extract(part, "^([A-Za-z][A-Za-z0-9]*);", 1)
        rest = F.substr(part, F.length(name) + 2)
        return (
            F.when((name == "") | name.isin(PREDEFINED), F.concat(F.lit("&"), part))
            .when(F.map_contains_key(characters, name), F.concat(characters[name], rest))
            .otherwise(F.concat(F.lit("&amp;"), part))
        )

    parts = F.split(text, "&")
    later = F.transform(F.slice(parts, 2, F.size(parts)), decoded)
    whole = F.concat(parts[0], F.array_join(later, ""))
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)


class _Scan:
    """Depth of elements along the pieces of a file, each of which follows a ``<``."""

    def __init__(self, inside: str, depth: int):
        self.inside, self.depth = inside, depth

    def is_tag(self, piece: str) -> bool:
        """Take a piece; whether it is a tag, and not a comment or the like."""
        if self.inside != "markup":
            if ENDS[self.inside] in piece:
                self.inside = "markup"
            return False
        if piece.startswith(("!--", "![CDATA[", "?")):
            inside = {"!-": "comment", "![": "cdata"}.get(piece[:2], "instruction")
            if ENDS[inside] not in piece[3:]:
                self.inside = inside
            return False
        if piece.startswith("/"):
            self.depth -= 1
            return True
        if piece[:1] in ("", "!"):
            return False
        tag = TAG.match(piece)
        self.depth += not (tag and tag[1])
        return True


def _by_block(batches, names: list[str]):
    """(values, pieces) of each file block: the columns ``names``, and ``value`` of all rows.

    What precedes a file's first tag is left out.
    """
    rows = (
        row
        for batch in batches
        for row in zip(*(batch.column(name).to_pylist() for name in [*names, "value"]), strict=True)
    )
    for values, group in groupby(rows, key=lambda row: row[:-1]):
        if values[names.index("start")] == 0:
            next(group)
        yield values, (row[-1] for row in group)


def _block_changes(batches):
    """For each thing a block may begin inside of: what it ends inside of, and its depths.

    ``lowest`` is the lowest depth reached; depths are relative to the block's beginning.
    """
    for (path, start), pieces in _by_block(batches, ["path", "start"]):
        scans = {inside: _Scan(inside, 0) for inside in ENDS}
        lowest = dict.fromkeys(ENDS, 0)
        for piece in pieces:
            for inside, scan in scans.items():
                scan.is_tag(piece)
                lowest[inside] = min(lowest[inside], scan.depth)
        rows = [
            {"path": path, "start": start, "inside": inside, "after": scan.inside,
             "change": scan.depth, "lowest": lowest[inside]}
            for inside, scan in scans.items()
        ]
        yield pa.RecordBatch.from_pylist(rows)


def _block_beginnings(changes) -> list[tuple]:
    """(path, start, inside, depth, owner) of each block, from the changes of those before it.

    ``owner`` is the block where the record began that is open at the beginning of this one.
    """
    blocks = {}
    for row in changes:
        blocks.setdefault((row["path"], row["start"]), {})[row["inside"]] = row
    found, file = [], None
    for (path, start), ways in sorted(blocks.items()):
        if path != file:
            file, inside, depth, owner = path, "markup", 0, start
        found.append((path, start, inside, depth, owner))
        way = ways[inside]
        if depth < 2 or depth + way["lowest"] < 2:
            owner = start
        inside, depth = way["after"], depth + way["change"]
    return found


def _record_parts(batches):
    """(path, owner, number, start, part): the children of each file's root element.

    A record that lies within a block is one part, numbered from 1. A record that does not is one
    part in each of its blocks, with the block where it began as ``owner`` and number 0. Parts leave
    the task in batches of bounded size, so it holds no whole block.
    """
    names = ["path", "start", "inside", "depth", "owner"]
    columns = ["path", "owner", "number", "start", "part"]

    def batch(parts):
        return pa.RecordBatch.from_pylist([dict(zip(columns, row, strict=True)) for row in parts])

    for (path, start, inside, depth, owner), pieces in _by_block(batches, names):
        scan, number, parts, size = _Scan(inside, depth), 0, [], 0
        held = [] if depth > 1 else None
        for piece in pieces:
            before, tag = scan.depth, scan.is_tag(piece)
            if held is None and tag and before == 1 and not piece.startswith("/"):
                held, owner, number = [], start, number + 1
            if held is None:
                continue
            if tag and scan.depth == 1:
                end = piece.find(">") if piece.startswith("/") else TAG.match(piece).end() - 1
                held.append("<" + piece[: end + 1])
                parts.append((path, owner, number, start, "".join(held)))
                held, size = None, size + len(parts[-1][-1])
                if size >= BATCH_CHARACTERS:
                    yield batch(parts)
                    parts, size = [], 0
            else:
                held.append("<" + piece)
        if held is not None:
            parts.append((path, owner, 0, start, "".join(held)))
        if parts:
            yield batch(parts)


def record_elements(spark: SparkSession, path: str) -> DataFrame:
    """(position, element): the children of the root element of each file, as they are written.

    Files are split where tags begin, so that a file of any size is read in parallel, and read
    twice: first for how each block changes the depth, of which the driver keeps four rows a block, then
    for the elements. Comments, CDATA and processing instructions may hold anything.
    """
    pieces = spark.read.option("lineSep", "<").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )
    schema = "path string, start bigint, inside string, after string, change bigint, lowest bigint"
    changes = pieces.mapInArrow(_block_changes, schema).collect()
    begun = spark.createDataFrame(
        _block_beginnings(changes), "path string, start bigint, inside string, depth int, owner bigint"
    )
    # one row a block
    parts = (
        pieces.join(F.broadcast(begun), ["path", "start"])
        .select("path", "start", "inside", "depth", "owner", "value")
        .mapInArrow(_record_parts, "path string, owner bigint, number bigint, start bigint, part string")
    )
    ordered = F.array_sort(F.collect_list(F.struct("start", "part")))
    crossing = parts.where("number = 0").groupBy("path", "owner", "number").agg(ordered.alias("parts"))
    position = F.concat_ws(":", "path", "owner", "number").alias("position")
    return parts.where("number > 0").select(position, F.col("part").alias("element")).unionAll(
        crossing.select(position, F.array_join("parts.part", "").alias("element"))
    )


def read_records(
    spark: SparkSession, path: str, tags: list[str] | None = None, schema: str = RECORD_SCHEMA
) -> DataFrame:
    """Bibliography records with ``record_type``, ``text``, ``position`` and ``corrupt``.

    Every child of a file's root element is a record, whatever its name and attributes; ``tags``
    selects some. ``text`` is the text of all child elements, ``position`` names the record where it
    has no key. A record that is no XML has its writing in ``corrupt`` and nulls elsewhere.
    """
    found = record_elements(spark, path).select(
        "position",
        F.regexp_extract("element", r"^<([^\s/>]+)", 1).alias("record_type"),
        named_entities_decoded(F.col("element")).alias("element"),
    )
    if tags is not None:
        found = found.where(F.col("record_type").isin(tags))
    return found.select(
        F.from_xml("element", schema + ", _corrupt_record string").alias("record"),
        "record_type",
        F.regexp_replace("element", "(?s)<!--.*?-->|<[^>]*>", " ").alias("text"),
        "position",
    ).select("record.*", "record_type", "text", "position").withColumnRenamed("_corrupt_record", "corrupt")


def record_baskets(records: DataFrame) -> DataFrame:
    """(basket_id, item): the authors of each record; records without authors give no row.

    A record without key is named by its position.
    """
    return records.select(
        F.coalesce("_key", "position").alias("basket_id"), F.explode("author").alias("item")
    )


def mentions(text: Column, marks: list[str]) -> Column:
    """Whether the text contains any of the marks, case-sensitively."""
    return reduce(lambda found, mark: found | F.contains(text, F.lit(mark)), marks, F.lit(False))


def record_titles(records: DataFrame, marks: list[str] | None = None) -> DataFrame:
    """(title, year) of the records with a year that name a wanted venue in any child element."""
    return (
        records.where(mentions(F.col("text"), marks or VENUE_MARKS))
        .where(F.col("year").isNotNull() & (F.col("year") != ""))
        .select(
            F.regexp_replace("title", "<[^>]*>", "").alias("title"),
            F.col("year").try_cast("int").alias("year"),
        )
        .where("year IS NOT NULL")
    )


def read_xml_posts(spark: SparkSession, path: str) -> DataFrame:
    """(post_id, post_type, body) of ``<row Id PostTypeId Body .../>`` elements."""
    rows = spark.read.format("xml").option("rowTag", "row").schema(POST_SCHEMA).load(path)
    return rows.select(
        F.col("_Id").alias("post_id"),
        F.col("_PostTypeId").alias("post_type"),
        F.col("_Body").alias("body"),
    )


def write_records(records: DataFrame, path: str, tag: str) -> None:
    records.write.format("xml").option("rootTag", "dblp").option("rowTag", tag).save(path)


def write_xml_posts(posts: DataFrame, path: str) -> None:
    posts.select(
        F.col("post_id").alias("_Id"),
        F.col("post_type").alias("_PostTypeId"),
        F.col("body").alias("_Body"),
    ).write.format("xml").option("rootTag", "posts").option("rowTag", "row").save(path)
