"""Dropping lines that an earlier document holds, as bitmaps instead of text."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 10
SALTS = 32
LAST_ID = (1 << 63) - 1


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; texts without other letters take the fast way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def with_identity(docs: DataFrame) -> DataFrame:
    """Add ``doc_order`` (rows without doc_id come last) and ``text_key``, which tell rows apart.

    Rows that agree in both have the same id and text, and so the same lines.
    """
    return docs.withColumn(
        "doc_order", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID))
    ).withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))


def text_lines(text: Column) -> Column:
    """A text's lines; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_drop_bitmaps(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(doc_order, text_key, n_dropped, dropped): which lines of a document repeat earlier ones.

    ``dropped`` is a compressed bitmap: line ``i`` goes if bit ``i % 64`` of word ``i / 64`` is
    set, and words without a set bit are not listed. Documents that keep all lines have no row.

    A line's key is the line stripped and in lower case; keys below ``least_length`` code points
    are kept. A key's lines go in all documents but the one with the smallest id. Hashes of the
    keys are range-partitioned with a salt of the document, so that a frequent line spreads over
    ``SALTS`` ranges, and sorted by document and position; the first document of each range is
    read off the stream, and a second stream over these firsts finds the key's first of all.
    """
    identified = with_identity(docs.select("doc_id", "text"))
    lines = identified.select(
        "doc_order",
        "text_key",
        F.posexplode(text_lines(F.col("text"))).alias("pos", "line"),
    )
    key = ascii_lower(F.btrim("line", F.lit(SPACES)))
    hashed = lines.withColumn("key", key).where(F.char_length("key") >= least_length).select(
        F.xxhash64("key").alias("hash"),
        F.xxhash64(F.lit("second"), "key").alias("check"),
        F.pmod(F.xxhash64("doc_order"), F.lit(SALTS)).cast("int").alias("salt"),
        "doc_order",
        "text_key",
        "pos",
    )
    stream = ["hash", "check", "salt", "doc_order", "pos"]
    in_range = Window.partitionBy("hash", "check", "salt").orderBy("doc_order", "pos")
    in_range = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = (
        hashed.repartitionByRange("hash", "salt")
        .sortWithinPartitions(*stream)
        .withColumn("_first", F.first("doc_order").over(in_range))
    )
    over_salts = Window.partitionBy("hash", "check").orderBy("doc_order")
    over_salts = over_salts.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = ranged.where(F.col("doc_order") > F.col("_first"))
    firsts = (
        ranged.where(F.col("doc_order") == F.col("_first"))
        .withColumn("_first", F.first("doc_order").over(over_salts))
        .where(F.col("doc_order") > F.col("_first"))
    )
    place = ["doc_order", "text_key"]
    words = (
        later.select(*place, "pos")
        .unionByName(firsts.select(*place, "pos"))
        .withColumn("word", F.shiftright("pos", 6))
        .groupBy(*place, "word")
        .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    )
    return words.groupBy(*place).agg(
        F.sum(F.bit_count("bits")).cast("bigint").alias("n_dropped"),
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("dropped"),
    )


def kept_text(text: Column, dropped: Column) -> Column:
    """The lines of ``text`` that the bitmap keeps, joined again."""

    def stays(_, i):
        bits = F.coalesce(F.try_element_at(dropped, F.shiftright(i, 6)), F.lit(0).cast("bigint"))
        return F.getbit(bits, i % 64) == 0

    whole = F.coalesce(text, F.lit(""))
    return F.when(dropped.isNull(), whole).otherwise(
        F.array_join(F.filter(text_lines(text), stays), "\n")
    )


def dedup_lines(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) for every row of ``docs``; ``kept`` is the text left.

    A null text counts as empty. Rows with the same doc_id are one document, rows without one
    are one document after all others. Repeated rows each get a result; no rows give no rows.
    """
    bitmaps = line_drop_bitmaps(docs, least_length)
    return (
        with_identity(docs.select("doc_id", "text"))
        .join(bitmaps, ["doc_order", "text_key"], "left")
        .select(
            "doc_id",
            F.size(text_lines(F.col("text"))).cast("bigint").alias("n_lines"),
            F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
            kept_text(F.col("text"), F.col("dropped")).alias("kept"),
        )
    )
