"""Records of CSV files whose fields may hold line breaks, from files that stay splittable.

A line is a function of whether it begins inside a quoted field: it says whether the next line
does.  A line without quotes changes nothing; the others are read as a CSV parser does, once
from outside and once from inside.  A quote opens a field only at its beginning, a doubled one
is a character, and one that closes is followed by the separator or the end of the line.

Lines are put together block by block.  Within a block of a file the functions are composed by
windows; a block then is a function, too, and the few blocks of a file are composed in order.
So a file is read by many tasks, and no task sees more of it than a block.  A block that one task
read is cut into chunks of ``CHUNK`` lines, which count as blocks of their own: what a task
holds depends on neither the size of the files nor that of the splits.

A field that is opened but not closed would take all that follows with it.  So a line opens a
field over its end only if the next line that could close it does so properly, at most
``MAX_LINES`` further on; else it is malformed as a whole, and the lines after it are judged on
their own.

Lines end with a line feed, or with carriage return and line feed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Lines that a record may have before its first quote counts as one that was never closed.
MAX_LINES = 10_000
# Lines of a block that are composed at once.
CHUNK = 10_000
# Bytes of text that one task puts together.
TASK_BYTES = 8 << 20

# monotonically_increasing_id() is the partition times this, plus the place in it.
_PLACES = 1 << 33

_OPENED, _LITERAL, _START, _CLOSED, _BAD = 1, 2, 3, 0, 8
_STAYS, _ENDS, _IMPROPER = 1, 0, 2


def _quotes_read(value: Column, quote: str, sep: str, start: int) -> Column:
    """The state after all quotes of a line, and whether a quoted field was closed improperly."""
    pieces = F.split(value, "\\Q" + quote + "\\E", -1)

    def at_quote(state: Column, before: Column) -> Column:
        base = state.bitwiseAND(7)
        begins = before.endswith(sep)
        improper = (base == _CLOSED) & (before != "") & ~before.startswith(sep)
        opens = begins | ((before == "") & base.isin(_START, _CLOSED))
        then = F.when(base == _OPENED, _CLOSED).when(opens, _OPENED).otherwise(_LITERAL)
        return then.bitwiseOR(F.when(improper, _BAD).otherwise(state.bitwiseAND(_BAD)))

    state = F.aggregate(F.slice(pieces, 1, F.size(pieces) - 1), F.lit(start), at_quote)
    rest = F.element_at(pieces, -1)
    improper = (state.bitwiseAND(7) == _CLOSED) & ~rest.isin("", "\r") & ~rest.startswith(sep)
    return F.when(improper, state.bitwiseOR(_BAD)).otherwise(state)


def opens(value: Column, quote: str, sep: str = ",") -> Column:
    """Whether a line that begins outside a quoted field ends inside one."""
    return value.contains(quote) & (_quotes_read(value, quote, sep, _START).bitwiseAND(7) == _OPENED)


def from_inside(value: Column, quote: str, sep: str = ",") -> Column:
    """What a line that begins inside a quoted field does: it stays inside, ends it, or ends it improperly."""
    state = _quotes_read(value, quote, sep, _OPENED)
    ends = F.when(state.bitwiseAND(_BAD) != 0, _IMPROPER).when(state == _OPENED, _STAYS).otherwise(_ENDS)
    return F.when(value.contains(quote), ends).otherwise(_STAYS)


def read_lines(spark: SparkSession, path: str, wanted: Callable[[Column], Column] | None = None, having: str | None = None) -> DataFrame:
    """value, file and its size, block and nth (rising within a block) of each line, of files whose path is ``wanted``.

    Of the lines those ``having`` a text only, if one is given.
    """
    lines = spark.read.options(recursiveFileLookup=True, pathGlobFilter="*.csv", lineSep="\n").text(path)
    if having is not None:
        lines = lines.where(F.col("value").contains(having))  # first: it is cheaper than a look at the path
    if wanted is not None:
        # Before the numbers are given, so that it reaches the list of files.
        lines = lines.where(wanted(F.col("_metadata.file_path")))
    return lines.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth")
    )


def files_with_open_lines(lines: DataFrame, quote: str, sep: str = ",") -> DataFrame:
    """(file, size) of what a reader of single lines would read wrongly: a quoted field goes on after a line's end."""
    inner_return = F.rtrim("value", F.lit("\r")).contains("\r")
    # Not a second filter: that would be one with the first, which is compiled with the scan as long as it is by itself.
    found = F.bool_or(opens(F.col("value"), quote, sep) | inner_return)
    return lines.where(F.col("value").contains(quote)).groupBy("file", "size").agg(found.alias("open")).where("open").select("file", "size")


_FILE, _IN_FILE = ["file"], ["block", "chunk"]
_BLOCK = [*_FILE, *_IN_FILE]


def _judged(lines: DataFrame, quote: str, sep: str) -> DataFrame:
    """Adds line (its number in the file), opens, and goes_on: whether it opens a field that a later line closes."""
    marked = lines.withColumns({"opens": opens(F.col("value"), quote, sep), "inside": from_inside(F.col("value"), quote, sep)})
    up = Window.partitionBy(*_BLOCK).orderBy("nth")
    marked = marked.withColumn("own", F.row_number().over(up).cast("long"))
    decides = F.when(F.col("inside") != _STAYS, F.struct("own", "inside"))
    blocks = marked.groupBy(*_BLOCK).agg(F.count("*").alias("lines"), F.min(decides).alias("first"))
    before = Window.partitionBy(*_FILE).orderBy(*_IN_FILE).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("offset", F.coalesce(F.sum("lines").over(before), F.lit(0).cast("long")))
    after = Window.partitionBy(*_FILE).orderBy(*[F.desc(c) for c in _IN_FILE]).rowsBetween(Window.unboundedPreceding, -1)
    decider = F.when(F.col("first").isNotNull(), F.struct((F.col("offset") + F.col("first.own")).alias("line"), F.col("first.inside").alias("inside")))
    blocks = blocks.select(*_BLOCK, "offset", F.last(decider, ignorenulls=True).over(after).alias("later"))

    down = Window.partitionBy(*_BLOCK).orderBy(F.desc("nth")).rowsBetween(Window.unboundedPreceding, -1)
    known = marked.withColumn("next", F.last(decides, ignorenulls=True).over(down)).join(blocks, _BLOCK)
    known = known.withColumn("line", F.col("offset") + F.col("own"))
    closes = F.when(F.col("next").isNotNull(), F.struct((F.col("offset") + F.col("next.own")).alias("line"), F.col("next.inside").alias("inside"))).otherwise(F.col("later"))
    closed = (closes["inside"] == _ENDS) & (closes["line"] - F.col("line") <= MAX_LINES)
    return known.withColumn("goes_on", F.col("opens") & F.coalesce(closed, F.lit(False))).select(*_BLOCK, "nth", "line", "value", "opens", "goes_on", "inside")


def _numbered(judged: DataFrame) -> DataFrame:
    """Adds begins (whether the line begins outside) and record (the line its record begins with).

    A line that leads outside from anywhere, or inside from anywhere, settles the state; one that
    swaps it doesn't; so the state is that of the last settling line and the number of swaps since.
    """
    out, stays = F.col("goes_on").cast("int"), (F.col("inside") == _STAYS).cast("int")
    lines = judged.withColumns({"swap": ((out == 1) & (stays == 0)).cast("long"), "settles": F.when(out == stays, out)})
    until = Window.partitionBy(*_BLOCK).orderBy("nth")
    lines = lines.withColumn("swaps", F.sum("swap").over(until))
    settled = F.when(F.col("settles").isNotNull(), F.struct(F.col("settles").alias("to"), "swaps"))
    earlier = until.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("last", F.last(settled, ignorenulls=True).over(earlier))

    blocks = lines.groupBy(*_BLOCK).agg(F.max(F.when(F.col("settles").isNotNull(), F.struct("nth", "settles", "swaps"))).alias("end"), F.sum("swap").alias("swaps"))
    # A block's settled end, or the parity of its swaps; carried on from block to block.
    settles = F.when(F.col("end").isNotNull(), (F.col("end.settles") + F.col("swaps") - F.col("end.swaps")) % 2)
    blocks = blocks.select(*_BLOCK, settles.alias("to"), F.when(settles.isNull(), F.col("swaps") % 2).otherwise(0).alias("odd"))
    so_far = Window.partitionBy(*_FILE).orderBy(*_IN_FILE)
    blocks = blocks.withColumn("odds", F.sum("odd").over(so_far))
    back = so_far.rowsBetween(Window.unboundedPreceding, -1)
    at = F.last(F.when(F.col("to").isNotNull(), F.struct("to", "odds")), ignorenulls=True).over(back)
    blocks = blocks.withColumn("at", at).withColumn("ahead", F.coalesce(F.sum("odd").over(back), F.lit(0)))
    inside = (F.coalesce(F.col("at.to"), F.lit(0)) + F.col("ahead") - F.coalesce(F.col("at.odds"), F.lit(0))) % 2
    lines = lines.join(blocks.select(*_BLOCK, inside.alias("block_inside")), _BLOCK)

    own = F.col("swaps") - F.col("swap")  # before this line
    state = F.when(F.col("last").isNotNull(), (F.col("last.to") + own - F.col("last.swaps")) % 2).otherwise((F.col("block_inside") + own) % 2)
    lines = lines.withColumn("begins", state == 0)
    begun = F.when(F.col("begins"), F.col("line"))
    lines = lines.withColumn("record", F.last(begun, ignorenulls=True).over(until))
    last = lines.groupBy(*_BLOCK).agg(F.max(begun).alias("last_begun"))
    last = last.select(*_BLOCK, F.last("last_begun", ignorenulls=True).over(back).alias("carried"))
    return lines.join(last, _BLOCK).withColumn("record", F.coalesce("record", "carried"))


def tasks_for(size: int) -> int:
    """How many tasks put so many bytes of text together."""
    return max(1, -(-size // TASK_BYTES))


def assemble(lines: DataFrame, quote: str, sep: str = ",", tasks: int | None = None) -> DataFrame:
    """file, record (its first line's number), value and unclosed of each record of whole files.

    ``tasks`` are as many as the lines are dealt to, chunk by chunk; else the engine decides.
    """
    lines = lines.withColumn("chunk", F.floor(F.col("nth") % _PLACES / CHUNK)).select("value", *_BLOCK, "nth")
    if tasks:
        lines = lines.repartition(tasks, *_BLOCK)
    numbered = _numbered(_judged(lines, quote, sep))
    alone = F.col("begins") & ~F.col("goes_on")
    text = F.regexp_replace("value", "\r$", "")
    single = numbered.where(alone).select("file", "record", text.alias("value"), F.col("opens").alias("unclosed"))
    # A record has no more lines than may lie before its quote closes.
    record = Window.partitionBy("file", "record").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    whole = numbered.where(~alone).withColumn("parts", F.collect_list("value").over(record)).where(F.col("line") == F.col("record"))
    joined = F.regexp_replace(F.array_join("parts", "\n"), "\r$", "")
    return single.unionByName(whole.select("file", "record", joined.alias("value"), F.lit(False).alias("unclosed")))
