"""Structure of measurement files: element order, nesting, required attributes.

A file is read as text, cut where a collection begins, and each collection becomes a string
with one letter for each tag in document order: an upper-case letter opens an element, the
lower-case one closes it.  As elements nest to a fixed depth, the rules are those of a
bottom-up tree automaton: a valid value, then a valid block, then a valid data section is
rewritten to one letter, and a collection is valid if its last rewriting is the whole of it.
What a step cannot rewrite names the rule that is broken.  All of it are expressions on one
row, so nothing is shuffled but the names of files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = "measCollecFile"
#: The elements of a measurement file and the letters that stand for them here.
LETTERS = {
    "measCollecFile": "C", "fileHeader": "H", "fileSender": "S", "measCollec": "M", "fileFooter": "F", "measData": "D", "managedElement": "E", "measInfo": "I", "job": "J",
    "granPeriod": "G", "repPeriod": "P", "measTypes": "L", "measType": "T", "measValue": "V", "measResults": "R", "r": "X", "suspect": "U",
}
FOREIGN = "Z"
#: Attributes that an element has to have.
REQUIRED = {"fileHeader": ("fileFormatVersion",), "granPeriod": ("duration", "endTime"), "measValue": ("measObjLdn",)}
DURATION = r"\sduration\s*=\s*[\"']PT[0-9]+S[\"']"
_TAG = r"<(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')++>"


def collections(spark: SparkSession, path: str) -> DataFrame:
    """-> file_name, body: the text of each collection after '<measCollecFile', and what
    stands before the first one (``body`` null).  Large plain files are split by Spark."""
    rows = spark.read.option("lineSep", f"<{ROOT}").text(path)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    begins = F.col("value").rlike(r"^\s*(?:[\w:.-]+\s*=\s*(?:\"[^\"]*+\"|'[^']*+')\s*)*+/?>")
    return rows.select(name.alias("file_name"), F.when(begins, F.col("value")).alias("body"))


def _has(tag: Column, attribute: str) -> Column:
    return tag.rlike(rf"\s{attribute}\s*=")


def symbols(body: Column) -> Column:
    """The tags of a collection as letters.  After an opening one: '-' if a required
    attribute is missing, '~' for a duration that is no count of seconds, and for measCollec
    '1' and '2' where begin and end time stand."""
    bare = F.regexp_replace(F.concat(F.lit(f"<{ROOT}"), body), r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>", "")
    known = F.create_map(*[F.lit(x) for pair in LETTERS.items() for x in pair])

    # the name is taken out of each tag once
    named = F.transform(F.regexp_extract_all(bare, F.lit(_TAG), F.lit(0)), lambda t: F.struct(t.alias("tag"), F.regexp_extract(t, r"^</?(?:[\w.-]+:)?([\w.-]+)", 1).alias("name")))

    def letter(x: Column) -> Column:
        tag, name = x["tag"], x["name"]
        marks = F.lit("")
        for element, attributes in REQUIRED.items():
            missing = F.lit(False)
            for a in attributes:
                missing = missing | ~_has(tag, a)
            mark = F.when(missing, "-").otherwise("")
            if element == "granPeriod":
                mark = F.concat(mark, F.when(_has(tag, "duration") & ~tag.rlike(DURATION), "~").otherwise(""))
            marks = F.when(name == element, mark).otherwise(marks)
        times = F.concat(F.when(_has(tag, "beginTime"), "1").otherwise(""), F.when(_has(tag, "endTime"), "2").otherwise(""))
        marks = F.when(name == "measCollec", times).otherwise(marks)
        letters = F.coalesce(F.element_at(known, name), F.lit(FOREIGN))
        opened = F.concat(letters, marks, F.when(F.endswith(tag, F.lit("/>")), F.lower(letters)).otherwise(""))
        return F.when(F.startswith(tag, F.lit("</")), F.lower(letters)).otherwise(opened)

    return F.array_join(F.transform(named, letter), "")


def _let(value: Column, then) -> Column:
    """then(value), with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def violations(text: Column) -> Column:
    """Array of the rules that a string of ``symbols`` breaks."""
    return _let(text, lambda t: _let(F.regexp_replace(t, r"[-~12]", ""), lambda plain: _broken(t, plain)))


def _broken(text: Column, plain: Column) -> Column:
    has = lambda s, x: F.contains(s, F.lit(x))
    named = lambda checks: F.array_compact(F.array(*[F.when(bad, name) for name, bad in checks]))
    around = lambda known: named([
        ("no fileHeader at the beginning", ~known.rlike("^CH")),
        ("fileHeader without fileFormatVersion", has(text, "H-")),
        ("fileHeader is not fileSender, measCollec", known.rlike("^CH") & ~known.rlike("^CHSsMmh")),
        ("fileHeader without beginTime", text.rlike("H[^h]*M2?m")),
        ("no fileFooter", ~has(known, "F")),
        ("fileFooter is not last", has(known, "F") & ~known.rlike("f[^A-Z]*$")),
        ("fileFooter is not measCollec", known.rlike("F(?!Mmf)")),
        ("fileFooter without endTime", text.rlike("F[^f]*M1?m")),
        ("granPeriod without duration or endTime", has(text, "G-")),
        ("duration is no number of seconds", text.rlike("G-?~")),
        ("measValue without measObjLdn", has(text, "V-")),
        ("foreign element", has(plain, FOREIGN)),
    ])

    def inside(known: Column) -> Column:
        """Valid values become one letter, then valid blocks, then valid data sections."""
        values = F.regexp_replace(F.regexp_replace(known, "VRr(?:Uu)?+v", "a"), "V(?:Xx)*+(?:Uu)?+v", "b")
        blocks = lambda x: F.regexp_replace(x, "I(?:Jj)?+Gg(?:Pp)?+(?:Lla*+|(?:Tt)*+b*+)i", "o")
        sections = lambda x: F.regexp_replace(x, "DEeo*+d", "q")
        return _let(values, lambda v: F.when(has(v, "V"), F.array(F.lit("measValue does not hold results of one form"))).otherwise(
            _let(blocks(v), lambda b: F.when(has(b, "I"), F.array(F.lit("measInfo is not granPeriod, types, values"))).otherwise(
                _let(sections(b), lambda d: F.when(has(d, "D"), F.array(F.lit("measData is not managedElement, measInfo"))).otherwise(whole(d)))))))

    def whole(data: Column) -> Column:
        """Header and footer are judged by themselves: what stands between is left."""
        middle = F.regexp_replace(F.regexp_replace(data, "F[^f]*+f", ""), "^CH[^h]*+h", "C")
        return F.when(middle.rlike("^Cq*+c$"), F.array().cast("array<string>")).otherwise(F.array(F.lit(ELSE)))

    def all_of(known: Column) -> Column:
        return _let(F.concat(around(known), inside(known)), lambda x: F.when(F.size(x) > 1, F.array_remove(x, ELSE)).otherwise(x))

    # what foreign elements hold is judged in their place
    return _let(F.regexp_replace(plain, "[Zz]", ""), all_of)


#: The rule for what no other one names.
ELSE = "element out of place or not closed"


def validate_structure(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, violation), one row for each rule that a collection breaks; a file without
    a collection breaks one rule of its own."""
    rows = collections(spark, path)
    broken = rows.filter("body is not null").select("file_name", F.explode(violations(symbols(F.col("body")))).alias("violation"))
    none = rows.groupBy("file_name").agg(F.bool_or(F.col("body").isNotNull()).alias("any")).filter("not any")
    return broken.unionByName(none.select("file_name", F.lit(f"no {ROOT}").alias("violation")))
