"""Sources (S2-S9): every reader takes an explicit schema, adds an order
column where the reference relies on list order, and never collects."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.ordering import global_positions
from ..session import materialize

TRACE_STEP = "struct<candiate:array<string>,values:array<double>>"
#: Question -> key ("0", "1", ... or "correct") -> its JSON text, so that a record may have any steps.
TRACE_SCHEMA = "map<string,map<string,string>>"
TRACE_ROW = "array<struct<step:bigint,idx:bigint,candidate:string,value:double>>"


def with_seq(df: DataFrame) -> DataFrame:
    """Source order of a file scan: (file path, block start, row within the task).

    Comparable as a whole and free of any shuffle.  The row number of the task
    alone is not the source order, since Spark deals out large files first.
    """
    return df.withColumn("seq", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")))


def scan_pairs_json(spark: SparkSession, path: str, schema: StructType | str, multiline: bool = False) -> DataFrame:
    """JSON records (JSON lines by default; ``multiline=True`` reads a
    JSON array per file, which is one task per file)."""
    return with_seq(spark.read.schema(schema).option("multiLine", multiline).json(path))


#: What the CSV parser reports for an empty field without quotes.
ABSENT = "\0absent\0"


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, row, record): the text of every CSV record, quoted newlines included.

    Files are read as lines, so one file is split over many tasks.  Whether a line begins a
    record depends on the number of quotes before it in the file: each split counts its own,
    a prefix sum over the splits of a file (a row each) says how each begins, and a running
    count within the split (one task's input) does the rest.  Records of one line, nearly
    all, are done then; only the lines of longer ones meet in a second shuffle.  A record may
    reach over any number of splits.

    Quotes must be doubled inside quoted fields and absent from others, so that they come in
    pairs; after a field that is never closed, the rest of the file is one record.  Lines end
    in ``\\n`` or ``\\r\\n``; line ends inside a field stay as they are.  Blank records are left out.
    """
    raw = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    lines = with_seq(raw.withColumnRenamed("value", "line")).select(
        F.col("seq.file").alias("file"), F.col("seq.block").alias("block"), F.col("seq.row").alias("row"), "line",
        (quotes % 2).alias("odd"))
    splits = Window.partitionBy("file").orderBy("block")
    begins = lines.groupBy("file", "block").agg((F.sum("odd") % 2).alias("odd")).select(
        "file", "block", (F.coalesce(F.sum("odd").over(splits.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2).alias("open"))
    within = Window.partitionBy("file", "block").orderBy("row")
    before = F.coalesce(F.sum("odd").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = lines.join(begins, ["file", "block"]).withColumn("start", ((F.col("open") + before) % 2 == 0).cast("int"))
    # r: which of the split's records the line belongs to; 0: to one of an earlier split.
    held = materialize(held.withColumns({
        "r": F.sum("start").over(within.rowsBetween(Window.unboundedPreceding, 0)),
        "alone": (F.col("start") == 1) & (F.col("odd") == 0)}).select("file", "block", "row", "line", "start", "r", "alone"), "csv-lines")

    one = held.where("alone").select("file", "block", "row", F.col("line").alias("record"))
    # The last record of the latest split before this one that begins any.
    last = held.groupBy("file", "block").agg(F.max("r").alias("of")).withColumn(
        "from", F.last(F.when(F.col("of") > 0, F.struct("block", "of")), ignorenulls=True).over(
            splits.rowsBetween(Window.unboundedPreceding, -1))).select("file", "block", "from")
    parts = held.where("not alone")
    own = parts.where("r > 0").select("file", F.col("block").alias("b"), "r", "block", "row", "line")
    carried = parts.where("r = 0").join(last, ["file", "block"]).select(
        "file", F.col("from.block").alias("b"), F.col("from.of").alias("r"), "block", "row", "line")
    many = own.unionByName(carried).groupBy("file", "b", "r").agg(
        F.array_sort(F.collect_list(F.struct("block", "row", "line"))).alias("m"))
    many = many.select("file", F.col("b").alias("block"), F.get("m", 0)["row"].alias("row"),
                       F.array_join(F.transform("m", lambda x: x["line"]), "\n").alias("record"))
    every = one.unionByName(many).withColumn("record", F.regexp_replace("record", "\\r\\z", ""))
    return every.where(F.btrim("record") != "")


def scan_task_csv(spark: SparkSession, path: str, question: str = "Question", answer: str = "Answer") -> DataFrame:
    """S3: the question and answer columns, by name, of CSV files with a header (quoted fields may
    hold newlines).  One file is read by many tasks, see :func:`csv_records`.

    The first record of a file is its header; files with different headers, or without the
    columns, are an error.  A record with fewer fields than the header has nulls for them; an
    empty field is null and a quoted empty one an empty text.  No files, or files without a
    record, give an empty table."""
    records = csv_records(spark, path)
    first = records.where("block = 0").groupBy("file").agg(F.min_by(F.struct("row", "record"), "row").alias("h"))
    heads = first.select("file", F.col("h.row").alias("head"), F.col("h.record").alias("text"))
    # Distinct headers: two are enough to know that they differ.
    found = [r[0] for r in heads.select(F.replace(F.col("text"), F.lit("\ufeff"), F.lit(""))).distinct().limit(2).collect()]
    if not found:
        return spark.createDataFrame([], "question string, answer string, seq struct<file:string,block:long,row:long>")
    if len(found) > 1:
        raise ValueError(f"CSV files with different headers: {found}")
    names = next(csv.reader([found[0]]))
    if question not in names or answer not in names:
        raise ValueError(f"CSV header {names} without {question!r} or {answer!r}")
    schema = ", ".join(f"c{k} string" for k in range(len(names)))
    body = records.join(heads.select("file", F.lit(0).cast("long").alias("block"), F.col("head").alias("row")),
                        ["file", "block", "row"], "left_anti")
    fields = body.withColumn("r", F.from_csv("record", schema, {"escape": '"', "maxCharsPerColumn": "-1", "nullValue": ABSENT}))
    return fields.select(F.col(f"r.c{names.index(question)}").alias("question"), F.col(f"r.c{names.index(answer)}").alias("answer"),
                         F.struct("file", "block", "row").alias("seq"))


def scan_claims_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """``claim, label`` per line -> question, answer."""
    df = spark.read.schema("claim string, label string").json(path)
    return with_seq(df).select(F.col("claim").alias("question"), F.col("label").alias("answer"), "seq")


def scan_nested_qa_json(spark: SparkSession, path: str, limit: int | None = None, multiline: bool = False) -> DataFrame:
    """Records ``{data: [{Question, Answer: [...]}, ...]}``; all
    entries of each record, or its first ``limit``; first answer of each."""
    df = spark.read.schema("data array<struct<Question:string,Answer:array<string>>>").option(
        "multiLine", multiline).json(path)
    df = with_seq(df).select("seq", F.posexplode("data").alias("pos", "d"))
    if limit is not None:
        df = df.where(F.col("pos") < limit)
    return df.select("seq", F.col("pos").cast("bigint").alias("pos"), F.col("d.Question").alias("question"),
                     F.col("d.Answer")[0].alias("answer"))


def scan_flat_qa_json(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """``[{question, answer}]`` records."""
    return with_seq(spark.read.schema("question string, answer string").option("multiLine", multiline).json(path))


def scan_trace_json(spark: SparkSession, path: str, legacy: bool = True) -> DataFrame:
    """Trace records ``{question: {"0": {candiate, values}, ..., correct}}``
    as (rec, corrupt): the record, or the text of one that cannot be parsed.

    Any step key is kept.  The legacy layout is objects pretty-printed one after
    another, each followed by ``,\\n``, with a closing ``\\n]`` and no opening ``[``;
    records are cut at ``\\n},\\n`` (the brace is added back), the ``]`` remnant and
    an optional leading ``[`` are dropped.  Otherwise one object per line.
    """
    if legacy:
        raw = spark.read.option("lineSep", "\n},\n").text(path)
        v = F.regexp_replace(F.col("value"), r"^\s*\[", "")
        raw = raw.where(~F.trim(F.col("value")).isin("]", ""))
        rec = F.coalesce(F.from_json(F.concat(v, F.lit("\n}")), TRACE_SCHEMA),
                         F.from_json(F.regexp_replace(v, r",\s*$", ""), TRACE_SCHEMA))
    else:
        raw = spark.read.text(path).where(F.trim("value") != "")
        rec = F.from_json("value", TRACE_SCHEMA)
    raw = raw.select("value", rec.alias("rec"))
    return raw.select("rec", F.when(F.col("rec").isNull(), F.col("value")).alias("corrupt"))


def explode_trace(records: DataFrame) -> DataFrame:
    """Trace records -> candidate rows ``(question, step, idx, candidate,
    value)`` of all steps the data hold, ``idx`` the place in the step's list, and
    selected rows (``step`` null, from ``correct``).  Keys that are neither a step
    number nor ``correct`` and records that did not parse give no rows."""
    part = records.select(F.explode("rec").alias("question", "t")).select("question", F.explode("t").alias("key", "json"))
    st = F.from_json("json", TRACE_STEP)
    steps = F.transform(F.arrays_zip(st["candiate"].alias("c"), st["values"].alias("v")), lambda z, i: F.struct(
        F.col("key").cast("bigint").alias("step"), i.cast("bigint").alias("idx"), z["c"].alias("candidate"), z["v"].alias("value")))
    chosen = F.transform(F.from_json("json", "array<string>"), lambda z, i: F.struct(
        F.lit(None).cast("bigint").alias("step"), i.cast("bigint").alias("idx"), z.alias("candidate"),
        F.lit(None).cast("double").alias("value")))
    rows = F.when(F.col("key") == "correct", chosen.cast(TRACE_ROW)).when(
        F.regexp_like("key", F.lit("^[0-9]+$")), steps.cast(TRACE_ROW))
    return part.select("question", F.inline(rows))


def scan_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Text log lines with dense 0-based line numbers in file order.

    Lines keep their split order (``_metadata.file_path``, block start, row in
    split); each input split is one bucket of the bucketed prefix count, so no
    single task sorts the log, nor the counts of its splits.
    """
    raw = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_m"))
    # one bucket per input split, ordered by (file, block start)
    pos = global_positions(raw, ["_m"], F.struct("_f", "_b"))
    return pos.select(F.col("pos").alias("line_no"), "line", F.col("_f").alias("file"))


# --- fixed values: leading bytes of common image formats --------------------
IMAGE_MAGIC = (("89504E470D0A1A0A", "png"), ("FFD8FF", "jpeg"), ("47494638", "gif"), ("52494646", "webp"),
               ("424D", "bmp"))


def _image_format(head: Column) -> Column:
    fmt = F.lit("unknown")
    for magic, name in reversed(IMAGE_MAGIC):
        fmt = F.when(F.startswith(head, F.lit(magic)), F.lit(name)).otherwise(fmt)
    return fmt


def image_manifest(df: DataFrame, row_id: str, image_bytes: Column) -> DataFrame:
    """Per row with an image, the derived file name ``img_<row>.png``, the
    payload size and a format sniffed from the leading bytes; null when the
    image is absent.  (Decoding and re-encoding are not performed.)"""
    head = F.hex(F.substring(image_bytes, 1, 8))
    present = image_bytes.isNotNull()
    return df.select(row_id, F.when(present, F.concat(F.lit("img_"), F.col(row_id).cast("string"), F.lit(".png"))).alias("path"),
                     F.when(present, F.length(image_bytes)).cast("bigint").alias("n_bytes"),
                     F.when(present, head).alias("magic"), F.when(present, _image_format(head)).alias("format"))


def image_manifest_files(spark: SparkSession, path: str, pattern: str = "*", sniff: bool = True) -> DataFrame:
    """S9 from files: (file, n_bytes, magic, format) of every file below ``path`` whose name
    matches ``pattern``; an empty folder gives no rows, and neither does a file without bytes, which
    Spark's scans leave out.

    Name and size come from the listing.  For the leading bytes Spark opens a file at a time and keeps eight
    bytes of it; with ``sniff=False`` no file is opened, and ``magic`` and ``format`` are null."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    head = F.hex(F.substring("content", 1, 8)) if sniff else F.lit(None).cast("string")
    out = files.select(F.col("path").alias("file"), F.col("length").alias("n_bytes"), head.alias("magic"))
    return out.withColumn("format", F.when(F.col("magic").isNotNull(), _image_format(F.col("magic"))))
