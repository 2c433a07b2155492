"""Match files: one multi-line JSON document per file, keyed by its file name.

A folder is first listed, by names, sizes and times alone; what is staged already is taken off the list, and only the
rest is read and parsed. A file that is no match document becomes a row that says why.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pavilion.sources.folders import FILE, contents, is_large, listing, scanned

DOCUMENT = "info string, innings string, broken string"


def file_key(file_name: Column) -> Column:
    """First run of digits in the name, negative for files with the wi_ prefix; null without digits."""
    named = r"^(wi_)?\D*(\d+)"
    number = F.regexp_extract(file_name, named, 2).try_cast("long")
    return F.when(F.regexp_extract(file_name, named, 1) != "", -number).otherwise(number)


def split_documents(texts: DataFrame) -> DataFrame:
    """(content, …) of whole documents to (info, innings, broken, …), the parts still as JSON text.

    broken is the content of what is no JSON object, and null for all others.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    document = F.from_json("content", DOCUMENT, options)
    parsed = texts.withColumn("document", document)
    # White space alone has no document at all.
    broken = F.coalesce(parsed["document.broken"], F.when(F.col("content").rlike(r"^\s*$"), F.col("content")))
    rest = [c for c in texts.columns if c != "content"]
    return parsed.select("document.info", "document.innings", broken.alias("broken"), *rest)


def stage(documents: DataFrame) -> DataFrame:
    """Staging rows from (info, innings, file_name, …), the nested values still as JSON text."""
    kept = [c for c in FILE if c in documents.columns]
    return documents.select(
        file_key(F.col("file_name")).alias("match_id"),
        F.col("info").alias("match_info"),
        F.col("innings").alias("match_innings"),
        *kept,
        F.current_timestamp().alias("last_update_ts"),
    )


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """file_name, file_bytes and file_time of the JSON files in a folder. No file is opened; files of no bytes are no rows."""
    if is_large(spark, folder):
        return listing(spark, folder)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder)
    name = F.substring_index("path", "/", -1)
    return listed.select(name.alias("file_name"), F.col("length").alias("file_bytes"), F.col("modificationTime").alias("file_time"))


def new_files(listed: DataFrame, *known: DataFrame) -> DataFrame:
    """The listed versions of files that none of the known tables has."""
    return reduce(lambda left, seen: left.join(seen.select(*FILE), FILE, "left_anti"), known, listed)


def read_files(spark: SparkSession, folder: str, new: DataFrame = None) -> DataFrame:
    """info, innings, broken and the file's name, size and time, a row a file; with new, of these files only.

    Files older than every new one are passed over unread, by a filter on their time that Spark applies to the listing.
    The contents of the others meet the names of the new ones before they are parsed. Of a large folder just the new ones are opened.
    """
    if is_large(spark, folder):
        files = listing(spark, folder)
        files = files if new is None else files.join(new.select(*FILE), FILE, "left_semi")
        return contents(spark, folder, files, split_documents)
    texts = scanned(spark, folder)
    if new is None:
        return split_documents(texts)
    oldest = new.agg(F.min("file_time")).first()[0]
    return split_documents(texts.filter(F.col("file_time") >= F.lit(oldest)).join(new.select(*FILE), FILE, "left_semi"))


def problem() -> Column:
    """Why a row of read_files cannot be staged; null if it can."""
    return (
        F.when(F.col("broken").isNotNull(), "not a JSON object")
        .when(F.col("info").isNull(), "no info")
        .when(F.col("innings").isNull(), "no innings")
        .when(file_key(F.col("file_name")).isNull(), "no number in the name")
    )


def problems(files: DataFrame) -> DataFrame:
    """The files that cannot be staged, and why; nothing is passed over in silence."""
    return files.withColumn("problem", problem()).filter("problem is not null").select(*FILE, "problem")


def read_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Staging rows of all match files in a folder. The files left out are those that problems(read_files(…)) names."""
    return stage(read_files(spark, folder).filter(problem().isNull()))
