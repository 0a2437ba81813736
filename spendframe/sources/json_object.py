"""Large JSON objects as tables: ``{key: value, ...}`` of any size, on one line or many.

A JSON object on one line is one record to a line reader, so one task would parse it.  Here the file
is cut at commas by the text source, which splits files at any byte, and each piece tells what it
does to the state of a JSON reader: how many quotes it holds, and how it changes the nesting,
both when it starts inside a string and when it does not.  A block of the file (what one task reads)
is summed up in those terms, the blocks' summaries are added up along the file, and so every piece
knows whether it starts inside a string and how deep.  Pieces that belong together (a comma
inside a string or a nested value) are joined again, across block borders too.

An entry that is no ``"key": value`` is an error, and so is a file that ends inside a string or an
object.  Objects can follow each other on lines of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NEXT_OBJECT = r"(?<=\})\s*\n\s*(?=\{)"
ESCAPED = r"\\."
STRING = r'"[^"]*("|$)'


def _depth_change(text: Column) -> Column:
    """Brackets that open less those that close, outside strings."""
    bare = F.regexp_replace(text, STRING, "")
    return F.length(F.regexp_replace(bare, r"[^{\[]", "")) - F.length(F.regexp_replace(bare, r"[^}\]]", ""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, id, piece, quotes, out, ins): what stands between commas, in order of id
    within a block, and what it does to the state of a reader outside (``out``) or inside a string."""
    read = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value")
    cut = read.select("file", "block", "row", F.posexplode(F.split("value", NEXT_OBJECT)).alias("part", "piece"))
    plain = F.regexp_replace("piece", ESCAPED, "")
    return cut.select("file", "block", F.struct("row", "part").alias("id"), "piece",
                      (F.length(plain) - F.length(F.replace(plain, F.lit('"')))).alias("quotes"),
                      _depth_change(plain).alias("out"), _depth_change(F.concat(F.lit('"'), plain)).alias("ins"))


def _placed(pieces: DataFrame) -> DataFrame:
    """(file, block, id, piece, inside, depth): whether each piece starts inside a string, and the
    depth at its start."""
    along = Window.partitionBy("file", "block").orderBy("id")
    within = pieces.withColumn("odd", (F.sum("quotes").over(along) - F.col("quotes")) % 2)
    # a block's effect, for either state at its start
    change = lambda start: F.sum(F.when(F.col("odd") == start, F.col("out")).otherwise(F.col("ins")))
    blocks = within.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), change(0).alias("from_out"),
                                                 change(1).alias("from_in"))
    order = Window.partitionBy("file").orderBy("block")
    blocks = blocks.withColumn("start", (F.sum("quotes").over(order) - F.col("quotes")) % 2).withColumn(
        "change", F.when(F.col("start") == 0, F.col("from_out")).otherwise(F.col("from_in")))
    every = Window.partitionBy("file")
    whole = (F.sum("quotes").over(every) % 2 == 0) & (F.sum("change").over(every) == 0)
    blocks = blocks.select("file", "block", "start", F.when(whole, F.sum("change").over(order) - F.col("change")).otherwise(
        F.raise_error(F.concat(F.lit("not a whole JSON object: "), F.col("file"))).cast("bigint")).alias("before"))
    state = within.join(blocks, ["file", "block"]).withColumn("inside", (F.col("odd") + F.col("start")) % 2 == 1)
    own = F.when(F.col("inside"), F.col("ins")).otherwise(F.col("out"))
    return state.withColumn("own", own).withColumn(
        "depth", F.col("before") + F.sum("own").over(along) - F.col("own")).select(
        "file", "block", "id", "piece", "inside", "depth")


def read_entries(spark: SparkSession, path: str, under: Sequence[str] = (), value_type: str = "string") -> DataFrame:
    """(key, value) of the entries of the object(s) in ``path``, or of the object under the names
    ``under`` (one name per level) in it."""
    level = 1 + len(under)
    placed = _placed(_pieces(spark, path))
    starts = ~F.col("inside") & (F.col("depth") <= level)
    order = Window.partitionBy("file", "block").orderBy("id")
    # pieces of one entry: numbered in a block by the starts before; what a block begins with
    # may belong to an entry of a block before it
    counted = placed.withColumn("n", F.sum(starts.cast("int")).over(order))
    blocks = counted.groupBy("file", "block").agg(F.max("n").alias("entries"))
    along = Window.partitionBy("file").orderBy("block")
    blocks = blocks.withColumn("before", F.sum("entries").over(along) - F.col("entries")).drop("entries")
    numbered = counted.join(blocks, ["file", "block"]).withColumn("entry", F.col("n") + F.col("before"))
    joined = numbered.groupBy("file", "entry").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "id", "piece"))), lambda p: p["piece"]), ",").alias("text"),
        F.min(F.struct("block", "id", "depth"))["depth"].alias("depth"))
    text = F.trim(F.regexp_replace("text", r"\s+$", ""))
    # the piece that opens the object begins with the braces and names above the first entry
    opening = r"^\s*" + r"\s*".join([r"\{"] + [rf'"{name}"\s*:\s*\{{' for name in under]) + r"\s*"
    opens = (F.col("depth") == 0) & F.regexp_like("text", F.lit(opening))
    if under:           # other entries may stand before the one that leads on
        tail = r"^\s*" + r"\s*".join(rf'"{name}"\s*:\s*\{{' for name in under) + r"\s*"
        opens = opens | ((F.col("depth") == 1) & F.regexp_like("text", F.lit(tail)))
        body = F.regexp_replace(F.regexp_replace(text, opening, ""), tail, "")
    else:
        body = F.regexp_replace(text, opening, "")
    held = joined.where(opens | (F.col("depth") == level)).select(
        F.when(opens, body).otherwise(text).alias("body"), opens.alias("opens"))
    # the last entry ends with the braces that close what stands above it
    surplus = -_depth_change(F.regexp_replace("body", ESCAPED, ""))
    cleaned = held.withColumn("body", F.regexp_replace("body", r"\s+$", "")).withColumn("surplus", surplus).withColumn(
        "empty", F.col("opens") & (F.col("surplus") > 0))
    for _ in range(level):
        closed = (F.col("surplus") > 0) & F.col("body").endswith("}")
        cleaned = cleaned.select(F.when(closed, F.regexp_replace("body", r"\s*\}$", "")).otherwise(F.col("body")).alias("body"),
                                 F.when(closed, F.col("surplus") - 1).otherwise(F.col("surplus")).alias("surplus"), "empty")
    kind = f"MAP<STRING,{value_type.upper()}>"
    parsed = F.from_json(F.concat(F.lit("{"), F.col("body"), F.lit("}")), kind)
    good = F.regexp_like("body", F.lit(r'^\s*"(?:[^"\\]|\\.)*"\s*:\s*\S')) & parsed.isNotNull() & (F.size(parsed) == 1)
    entry = F.when(good, parsed).otherwise(F.raise_error(F.concat(F.lit("not an entry of a JSON object: "), F.col("body"))).cast(kind))
    return cleaned.where(~F.col("empty") | (F.trim("body") != "")).select(F.explode(entry).alias("key", "value"))
