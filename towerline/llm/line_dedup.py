"""Line deduplication with DataFrame functions only.

Lines are normalised (white space stripped at both ends, ASCII lower case); each
document's distinct keys of at least ``min_chars`` code points are exploded, hashed to 128
bits, and the distinct documents of each hash are counted.  A key found in ``min_docs``
documents or more loses its lines everywhere but in the document with the largest id.
What goes is gathered per document as hashes, so the lines themselves never leave their
row: they are filtered there and come out in their old order.

Cases: null or empty text is one empty line; a null id neither counts as a document nor
loses lines; rows that repeat an id count as one document and all lose, or all keep, a
line; other columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)


def key_hash(line: Column) -> Column:
    """128 bits of the key as text."""
    key = line_key(line)
    return F.concat_ws(":", F.hex(F.xxhash64(key)), F.hex(F.xxhash64(F.lit("line"), key)))


def _long_enough(line: Column, min_chars: int) -> Column:
    return F.char_length(F.btrim(line, F.lit(BLANK))) >= min_chars


def drop_common_lines(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5, stats: bool = False) -> DataFrame:
    """The documents with their text rewritten; with ``stats`` also n_lines and n_dropped
    (such columns of the input are replaced)."""
    names = [c for c in documents.columns if not (stats and c in ("n_lines", "n_dropped"))]
    rest = [F.col(f"`{c}`") for c in names if c != text_col] or [F.lit(0).alias("none")]
    packed = documents.select(F.struct(*rest).alias("row"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = F.split(F.col("text"), "\n", -1)
    keyed = (
        packed.filter("id is not null")
        .select("id", F.explode(F.array_distinct(F.filter(lines, lambda x: _long_enough(x, min_chars)))).alias("line"))
        .select("id", F.xxhash64(line_key(F.col("line"))).alias("a"), F.xxhash64(F.lit("line"), line_key(F.col("line"))).alias("b"))
        .distinct()
    )
    common = keyed.groupBy("a", "b").agg(F.count("*").alias("docs"), F.max("id").alias("stays")).filter(F.col("docs") >= min_docs)
    gone = (
        keyed.join(common.select("a", "b", "stays"), ["a", "b"])
        .filter(F.col("id") != F.col("stays"))
        .groupBy("id")
        .agg(F.collect_set(F.struct("a", "b")).alias("gone"))
    )
    pair = lambda x: F.struct(F.xxhash64(line_key(x)).alias("a"), F.xxhash64(F.lit("line"), line_key(x)).alias("b"))
    kept = F.when(F.col("gone").isNull(), lines).otherwise(
        F.filter(lines, lambda x: ~(_long_enough(x, min_chars) & F.array_contains(F.col("gone"), pair(x))))
    )
    out = packed.join(gone, "id", "left").select("row", lines.alias("lines"), kept.alias("kept"))
    counts = [F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped")] if stats else []
    text = F.array_join("kept", "\n").alias(text_col)
    return out.select(*[text if c == text_col else F.col(f"row.`{c}`") for c in names], *counts)
