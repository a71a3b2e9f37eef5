"""A JSON object of any size read by many tasks.

A file is cut into pieces at every ``}``, which Spark's text reader does in parallel for all blocks of a file.  What a
piece does to the state of the parser can be said without knowing the state before it: its quotes (escaped ones left out)
turn "within a string" round or not, and its brackets outside strings change the depth by one number if the piece begins
outside a string and by another if it begins within one.  A scan over the pieces of a block, and one over the few sums of
blocks, give every piece its state; a backslash never comes before the ``}`` of a cut, so no escape reaches across one.
Where the depth comes back to one, a top-level entry ends.  Entries are put together within their block, those that reach
over a block's border in a second step that sees two parts of each block, and are parsed by Spark one by one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.rx import let


def _brackets(text: Column) -> Column:
    """How much deeper a text without strings and without ``}`` ends than it begins."""
    opened = F.length(text) - F.length(F.translate(text, "{[", ""))
    return opened - (F.length(text) - F.length(F.translate(text, "]", "")))


def _pieces(lines: DataFrame) -> DataFrame:
    """``file, block, seq, value, quotes, deeper_0, deeper_1``: brackets of a piece that begins outside or within a string."""
    plain = F.split(F.regexp_replace("value", r"\\.", ""), '"', -1)

    def counted(parts: Column) -> Column:
        even = F.array_join(F.filter(parts, lambda x, i: i % 2 == 0), "")
        odd = F.array_join(F.filter(parts, lambda x, i: i % 2 == 1), "")
        return F.struct(
            (F.size(parts) - 1).alias("quotes"),
            _brackets(even).alias("deeper_0"),
            _brackets(odd).alias("deeper_1"),
        )

    rows = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
        let(plain, counted).alias("c"),
    )
    return rows.select("file", "block", "seq", "value", "c.*")


def _scanned(pieces: DataFrame) -> DataFrame:
    """Adds ``odd``, whether the quotes before a piece in its block are odd, and the depth a piece adds for either state of the block.

    ``turn_s``: what the piece adds, its ``}`` included, if the block begins with state ``s``.
    """
    before = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    rows = pieces.withColumn("odd", odd)

    def turn(s: int) -> Column:
        within = (F.col("odd") + s) % 2
        closes = (within + F.col("quotes")) % 2 == 0
        return F.when(within == 0, F.col("deeper_0")).otherwise(F.col("deeper_1")) - F.when(closes, 1).otherwise(0)

    return rows.withColumns({"turn_0": turn(0), "turn_1": turn(1)})


def _starts(scanned: DataFrame) -> DataFrame:
    """``file, block, within, depth, whole``: the state in which each block begins, and whether the file closes all it opens."""
    last = F.max_by("value", "seq")
    sums = scanned.groupBy("file", "block").agg(
        (F.sum("quotes") % 2).alias("quotes"), F.sum("turn_0").alias("turn_0"), F.sum("turn_1").alias("turn_1"), last.alias("last")
    )  # a row for each block
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    state = sums.withColumn("within", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int"))
    state = state.withColumn("turn", F.when(F.col("within") == 0, F.col("turn_0")).otherwise(F.col("turn_1")))
    end, rest = F.sum("turn").over(whole), F.last("last").over(whole)
    closed = (end == 0) | ((end == -1) & (rest != "") & (F.trim(F.translate(rest, "\r\n\t", "   ")) == ""))
    return state.select(
        "file", "block", "within", F.coalesce(F.sum("turn").over(before), F.lit(0)).alias("depth"), closed.alias("whole")
    )


def entries(lines: DataFrame) -> DataFrame:
    """``place, entry``: the texts ``"key":{...}`` of all top-level entries, with a number that rises with their place in the file.

    ``lines`` is a text table cut at ``}``.  A file that does not close what it opens has no entries.
    """
    pieces = _scanned(_pieces(lines))
    rows = pieces.join(_starts(pieces), ["file", "block"]).filter("whole")
    upto = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    turn = F.when(F.col("within") == 0, F.col("turn_0")).otherwise(F.col("turn_1"))
    outside = (F.col("within") + F.col("odd") + F.col("quotes")) % 2 == 0
    rows = rows.withColumn("after", F.col("depth") + F.sum(turn).over(upto))
    rows = rows.withColumn("ends", (outside & (F.col("after") == 1)).cast("int"))
    rows = rows.withColumn("part", F.sum("ends").over(upto) - F.col("ends"))  # entries that ended before in the block
    # texts of a part, in order; the } that was cut off comes back
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "value"))), lambda x: F.concat(x["value"], F.lit("}"))), "")
    parts = rows.groupBy("file", "block", "part").agg(text.alias("text"), F.max("ends").alias("ends"))
    place = F.struct("file", "block", "part")
    inner = parts.filter("part > 0 and ends = 1").select(place.alias("place"), "text")
    border = parts.filter("part = 0 or ends = 0")
    before = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    joined = border.withColumn("entry", F.coalesce(F.sum("ends").over(before), F.lit(0))).groupBy("file", "entry").agg(
        F.min(place).alias("place"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "part", "text"))), lambda x: x["text"]), "").alias("text"),
        F.max("ends").alias("ends"),
    )
    found = inner.unionByName(joined.filter("ends = 1").select("place", "text"))
    # what comes before the key: the outer object's own bracket, a comma, the end of an object before it
    return found.select("place", F.regexp_replace("text", r'^[^"]*', "").alias("entry"))


def json_store(spark: SparkSession, path: str, record: str, place: bool = False) -> DataFrame:
    """``key`` and the fields of ``record`` for each entry of files that are one JSON object (or several) by key.

    A missing file, or one that does not close what it opens, gives no rows; an entry whose value is no object is left out,
    and fields that cannot be read are null.  Repeated keys give a row each.  With ``place`` there is a column of this name
    that rises with the order in the file.  No task sees more than a block of a file, or an entry.
    """
    try:
        lines = spark.read.option("lineSep", "}").text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], f"place struct<file: string, block: bigint, part: bigint>, key string, {record}")
        return found if place else found.drop("place")
    pair = F.explode(F.from_json(F.concat(F.lit("{"), "entry", F.lit("}")), "map<string,string>"))
    rows = entries(lines).select("place", pair.alias("key", "value")).filter(F.col("value").startswith("{"))
    keys = ["place", "key"] if place else ["key"]
    return rows.withColumn("r", F.from_json("value", record, {"mode": "PERMISSIVE"})).select(*keys, "r.*")
