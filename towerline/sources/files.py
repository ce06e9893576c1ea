"""Readers of counter files, record files and the delivery ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import to_utc
from ..functions.names import managed_element
from ..schemas import COUNTERS_CSV, OMES_XML, PM_XML


def _seconds(iso_duration: Column) -> Column:
    """'PT900S' or 'PT15M' in seconds."""
    part = lambda unit: F.coalesce(F.regexp_extract(iso_duration, rf"(\d+){unit}", 1).try_cast("int"), F.lit(0))
    return part("S") + 60 * part("M") + 3600 * part("H")


def _number(text: Column) -> Column:
    """A counter value; NIL and blanks are null, never zero."""
    return F.when(F.upper(F.trim(text)).isin("NIL", ""), None).otherwise(F.trim(text)).try_cast("double")


def _file_name() -> Column:
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)


def raw_pm_xml(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", "measCollecFile").option("ignoreNamespace", True).option("columnNameOfCorruptRecord", "_corrupt_record").schema(PM_XML).load(path).withColumn("file_name", _file_name())


def pm_values(raw: DataFrame) -> DataFrame:
    """Nested measurement files to long rows; both the list form (types and results in two
    texts) and the positional form (numbered elements)."""
    # what a row needs of its block is taken out before the block is exploded, so that no row
    # carries the whole of it
    data = raw.select("file_name", F.col("fileHeader._dnPrefix").alias("prefix"), F.col("fileHeader.fileSender._localDn").alias("ems"), F.explode("measData").alias("d"))
    data = data.select("file_name", "prefix", "ems", F.col("d.managedElement._localDn").alias("element"), F.col("d.managedElement._swVersion").alias("version"), F.col("d.measInfo").alias("infos"))
    blocks = data.select("file_name", "prefix", "ems", "element", "version", F.explode("infos").alias("i"))
    blocks = blocks.select(
        "file_name", "prefix", "ems", "element", "version", F.col("i._measInfoId").alias("meas_group"), to_utc(F.col("i.granPeriod._endTime")).alias("end"), _seconds(F.col("i.granPeriod._duration")).alias("seconds"),
        F.split(F.trim("i.measTypes"), r"\s+").alias("names"), F.transform("i.measType", lambda t: F.struct(t["_p"].alias("p"), F.trim(t["_VALUE"]).alias("counter"))).alias("types"), F.col("i.measValue").alias("values"),
    )
    of_block = [c for c in blocks.columns if c != "values"]
    values = blocks.select(*of_block, F.explode("values").alias("v"))
    dn = F.concat_ws(",", F.nullif(F.col("prefix"), F.lit("")), F.nullif(F.col("element"), F.lit("")), F.nullif(F.col("v._measObjLdn"), F.lit("")))
    listed = F.arrays_zip(F.col("names").alias("counter"), F.split(F.trim("v.measResults"), r"\s+").alias("text"))
    numbered = F.transform("types", lambda t: F.struct(t["counter"].alias("counter"), F.get(F.filter(F.col("v.r"), lambda r: r["_p"] == t["p"]), F.lit(0))["_VALUE"].alias("text")))
    values = values.select("file_name", "ems", "element", "version", "meas_group", "end", "seconds", dn.alias("object_dn"), F.coalesce("v.suspect", F.lit(False)).alias("suspect"), F.when(F.col("names").isNotNull(), listed).otherwise(numbered).alias("found"))
    rows = values.select(*[c for c in values.columns if c != "found"], F.explode("found").alias("x"))
    return rows.select(
        "ems", F.col("element").alias("managed_element"), "object_dn", "meas_group", F.col("x.counter").alias("counter"), _number(F.col("x.text")).alias("value"), "suspect",
        (F.col("end") - F.make_dt_interval(secs=F.col("seconds"))).alias("period_start"), F.col("end").alias("period_end"), F.col("version").alias("dictionary_release"), "file_name",
    )


def read_pm_xml(spark: SparkSession, path: str) -> DataFrame:
    return pm_values(raw_pm_xml(spark, path))


def omes_values(raw: DataFrame) -> DataFrame:
    """Setups of the dialect whose counters are element names to long rows."""
    rows = raw.select("file_name", F.col("_startTime").alias("start"), F.col("_interval").alias("minutes"), F.explode("PMMOResult").alias("m"))
    dn = F.array_join(F.transform(F.flatten("m.MO.DN"), F.trim), "/")
    rows = rows.select("file_name", "start", "minutes", dn.alias("object_dn"), F.col("m.PMTarget").alias("t"))
    rows = rows.select("file_name", "start", "minutes", "object_dn", F.col("t")["_measurementType"].alias("meas_group"), "t")
    rows = rows.select("file_name", "start", "minutes", "object_dn", "meas_group", F.explode("t").alias("counter", "text")).filter(~F.startswith("counter", F.lit("_")))
    begin = to_utc(F.col("start"))
    return rows.select(managed_element(F.col("object_dn")).alias("managed_element"), "object_dn", "meas_group", "counter", _number(F.col("text")).alias("value"), F.lit(False).alias("suspect"), begin.alias("period_start"), (begin + F.make_dt_interval(mins=F.col("minutes"))).alias("period_end"), F.lit(None).cast("string").alias("dictionary_release"), "file_name")


def read_omes_xml(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.format("xml").option("rowTag", "PMSetup").option("ignoreNamespace", True).schema(OMES_XML).load(path)
    return omes_values(raw.withColumn("file_name", _file_name()))


#: File names of both dialects.
TYPE_A = r"^[AB](\d{8})\.(\d{4})([+-]\d{4})?-(?:(\d{8})\.)?(\d{4})([+-]\d{4})?_(?:(\w+)_)?(.+?)(?:_-_(\d+))?(?:\.xml)?(?:\.gz)?$"


OMES = r"^OMeS_([A-Za-z0-9-]+)_(\d{8}T\d{4})Z\.xml(?:\.gz)?$"


def omes_name(name: Column) -> Column:
    """struct<ems, start> of a name 'OMeS_EMS-01_20260105T0800Z.xml.gz'; null if it is none."""
    start = F.try_to_timestamp(F.concat(F.regexp_extract(name, OMES, 2), F.lit("+0000")), F.lit("yyyyMMdd'T'HHmmxx"))
    return F.when(start.isNotNull(), F.struct(F.regexp_extract(name, OMES, 1).alias("ems"), start.alias("start")))


def file_period(name: Column) -> Column:
    """struct<start, end> of a counter file name 'A20260105.0000+0700-0015+0700_unit.xml.gz'
    (end <= begin: the next day), or of the other dialect's, which tells no end; null if it
    is neither."""
    part = lambda i: F.regexp_extract(name, TYPE_A, i)
    zone = F.when(part(3) == "", "+0000").otherwise(part(3))
    at = lambda day, clock, z: F.try_to_timestamp(F.concat(day, clock, z), F.lit("yyyyMMddHHmmxx"))
    start = at(part(1), part(2), zone)
    end = at(F.when(part(4) == "", part(1)).otherwise(part(4)), part(5), F.when(part(6) == "", zone).otherwise(part(6)))
    known = F.when(start.isNotNull(), F.struct(start.alias("start"), F.when(end <= start, end + F.expr("interval 1 day")).otherwise(end).alias("end")))
    other = omes_name(name)
    return F.coalesce(known, F.when(other.isNotNull(), F.struct(other["start"].alias("start"), F.lit(None).cast("timestamp").alias("end"))))


def read_records(spark: SparkSession, path: str, *, strict: bool = True) -> DataFrame:
    """JSON lines as they are, with the kind out of the file name; strict: a malformed line
    fails the query, else it comes with valid = false."""
    rows = spark.read.text(path).select(F.col("value").alias("record"), _file_name().alias("file_name"))
    rows = rows.withColumn("kind", F.regexp_extract("file_name", r"^([A-Z]+)", 1)).withColumn("valid", F.try_parse_json("record").isNotNull())
    if not strict:
        return rows
    bad = F.raise_error(F.concat(F.lit("malformed record in "), F.col("file_name"))).cast("string")
    return rows.withColumn("record", F.when(F.col("valid"), F.col("record")).otherwise(bad)).drop("valid")


def file_ledger(spark: SparkSession, path: str, values: DataFrame | None = None) -> DataFrame:
    """Deliveries of a folder: name, hash, size, arrival, and rows loaded out of each."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), F.sha2("content", 256).alias("file_hash"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("arrival_time")
    )
    if values is None:
        return files.withColumn("loaded", F.lit(False)).withColumn("rows", F.lit(0).cast("long"))
    n = values.groupBy("file_name").agg(F.count("*").alias("rows"))
    return files.join(n, "file_name", "left").withColumn("loaded", F.col("rows").isNotNull()).withColumn("rows", F.coalesce("rows", F.lit(0)))


def read_counters_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=COUNTERS_CSV, enforceSchema=True)


def validate_pm_files(raw: DataFrame) -> DataFrame:
    """(file_name, violation) of nested measurement files, all of them, not the first.

    Results must match their types: as many in the list form, the same distinct positions in
    the positional form, and no result of one form under the other."""
    info = F.col("measData")
    places = lambda x: F.array_sort(F.transform(x, lambda r: r["_p"]))

    def unmatched(i: Column, v: Column) -> Column:
        listed = F.size(F.split(F.trim(i["measTypes"]), r"\s+")) != F.size(F.split(F.trim(v["measResults"]), r"\s+"))
        numbered = (places(i["measType"]) != places(v["r"])) | (F.size(F.array_distinct(places(i["measType"]))) != F.size(i["measType"]))
        return F.coalesce(F.when(i["measTypes"].isNotNull(), listed | v["r"].isNotNull()).otherwise(numbered | v["measResults"].isNotNull()), F.lit(True))

    bad_list = F.exists(info, lambda d: F.exists(d["measInfo"], lambda i: F.exists(i["measValue"], lambda v: unmatched(i, v))))
    bad_time = F.exists(info, lambda d: F.exists(d["measInfo"], lambda i: ~F.coalesce(i["granPeriod"]["_duration"].rlike(r"^PT(\d+[HMS])+$"), F.lit(False))))
    checks = F.array(
        F.when(F.col("_corrupt_record").isNotNull(), "malformed"), F.when(F.col("fileHeader._dnPrefix").isNull(), "no dnPrefix"), F.when(F.col("measData").isNull(), "no measData"),
        F.when(bad_list, "results do not match types"), F.when(bad_time, "bad granPeriod duration"),
    )
    return raw.select("file_name", F.explode(F.array_compact(checks)).alias("violation"))


def corpus_profile(files: DataFrame, values: DataFrame) -> DataFrame:
    """By kind of file: files, bytes, mean size, values, values for each byte."""
    kind = F.substring("file_name", 1, 1).alias("kind")
    f = files.groupBy(kind).agg(F.count("*").alias("files"), F.sum("size_bytes").alias("bytes"), F.avg("size_bytes").alias("mean_bytes"))
    v = values.groupBy(kind).agg(F.count("*").alias("values"), F.count_distinct("counter").alias("counters"))
    return f.join(v, "kind", "left").withColumn("values_per_kb", 1024 * F.col("values") / F.col("bytes"))


def layer_sizes(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """(layer, files, bytes, rows) of Parquet tables."""
    out = None
    for name, path in tables.items():
        per = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.max("_metadata.file_size").alias("b"), F.count("*").alias("n"))
        row = per.agg(F.count("*").alias("files"), F.sum("b").alias("bytes"), F.sum("n").alias("rows")).select(F.lit(name).alias("layer"), "*")
        out = row if out is None else out.unionByName(row)
    return out
