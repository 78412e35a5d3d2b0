"""Records of CSV files, found by many tasks whatever their quotes and line breaks.

Lines are read in blocks, as text files always are. A line takes one of two states, its
beginning inside or outside a quoted field, to the state at its end; a quote opens a
field only at its start, ``""`` is a quote, and a quote that something else than a comma
follows ends the quoting without ending the field. Such functions of two states compose:
they are put together for buckets of lines, then the few buckets of a file one after
another, and so every line's state is known without reading the file in order.

A quote that is opened and not closed would make one record of all lines up to the next
quote, or to the end of the file. It is closed by the next line that isn't plain text to
it, whatever the states before, so how far that is, is known for each bucket as well. If
it is over ``LONGEST`` lines, and the whole buckets between have the header's number of
commas a line, the quote is a stray one: its line is a record by itself, and those after
it are read as if it weren't there. A long text with other numbers of commas stays whole.

Only the buckets in which a record runs over the end of a line are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

BUCKET = 1024  # lines
LONGEST = 2048  # lines, two buckets at least: more than that lie over a whole bucket
MOST_SENT = 500_000  # buckets with broken records that are sent to every executor, some 100 bytes each
_QUOTED = r'"(?:[^"]++|"")*+"[^,]*+'  # a quoted field and what else is in it
_OPEN = r'"(?:[^"]++|"")*+$'  # a quoted field that the line doesn't close
_FIELDS = rf'(?:(?:{_QUOTED}|[^",][^,]*+|),)*+'
_OUT_TO_IN = rf"(?s)^{_FIELDS}{_OPEN}"
_THROUGH = r'(?s)^(?:[^"]++|"")*+$'  # no quote that ends the quoting
_OPENED_AGAIN = rf'(?s)^(?:[^"]++|"")*+"[^,]*+,{_FIELDS}{_OPEN}'
# A whole quoted field of a record.
QUOTED_FIELD = rf"(?s)(?:^|(?<=,)){_QUOTED}"


def lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, path, block, bucket, pos, value): the lines of files. ``pos`` rises within a
    block; ``file`` is a hash of the path."""
    within = F.col("pos").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        spark.read.option("lineSep", "\n")
        .text(paths)
        .select(
            F.xxhash64("_metadata.file_path").alias("file"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
            "value",
        )
        .withColumn("bucket", F.floor(within / BUCKET))
    )


def _without_return(value: Column) -> Column:
    """A line without the carriage return at its end."""
    return F.when(value.endswith("\r"), F.left(value, F.length(value) - 1)).otherwise(value)


def _after(value: Column) -> tuple[Column, Column, Column]:
    """Whether a line ends inside quotes if it begins outside, whether it does if it begins
    inside, and whether it then is all part of the quoted field it begins in."""
    text = _without_return(value)
    quotes = value.contains('"')
    through = ~quotes | text.rlike(_THROUGH)
    return quotes & text.rlike(_OUT_TO_IN), through | text.rlike(_OPENED_AGAIN), through


def _commas(value: Column) -> Column:
    return F.octet_length(value) - F.octet_length(F.replace(value, F.lit(","), F.lit("")))


def _change(number: Column) -> tuple[Column, Column, Column]:
    """A line's place, and whether it ends inside quotes if it begins outside and if it
    begins inside."""
    return F.shiftright(number, 2), number.bitwiseAND(F.lit(2)) != 0, number.bitwiseAND(F.lit(1)) != 0


def summary(found: DataFrame) -> DataFrame:
    """One row for each bucket: whether it begins inside quotes (``inside``), where the
    record that then is open began (``open``), whether any of its lines ends inside
    (``broken``), the line of a stray quote, if any (``stray``), and its first line that
    isn't blank (``head``).

    One pass over the text. Of a line that holds quotes its place and function are
    shuffled, of all others nothing but a bucket's sums.
    """
    from_out, from_in, through = _after(F.col("value"))
    # Place and function of a line in one number: a struct takes five times its room.
    functions = F.when(from_out, 2).otherwise(0) + F.when(from_in, 1).otherwise(0)
    changes = F.when(~through, F.col("pos") * 4 + functions)
    filled = F.when((F.col("block") == 0) & F.col("value").rlike(r"\S"), F.col("pos"))
    text = F.octet_length("value") > 1  # no empty line, nor a line's end alone
    buckets = found.groupBy("file", "block", "bucket").agg(
        F.sort_array(F.collect_list(changes)).alias("changes"),
        F.min("pos").alias("begin"),
        F.max("pos").alias("last"),
        F.count(F.lit(1)).alias("lines"),
        F.count_if(text).alias("texts"),
        F.sum(F.when(text, _commas(F.col("value"))).otherwise(0)).alias("commas"),
        F.min(filled).alias("head_pos"),
        F.min_by("value", filled).alias("head_value"),
        F.first("path").alias("path"),
    )

    def walked(begin: bool) -> Column:
        """State before the bucket's last change and the last line at which a record begins."""
        start = F.struct(F.lit(begin).alias("inside"), F.lit(None).cast("bigint").alias("at"))

        def step(s: Column, x: Column) -> Column:
            pos, o, i = _change(x)
            return F.struct(
                F.when(s["inside"], i).otherwise(o).alias("inside"),
                F.when(s["inside"], s["at"]).otherwise(pos).alias("at"),
            )

        return F.aggregate(F.slice("changes", 1, F.greatest(F.size("changes") - 1, F.lit(0))), start, step)

    head = F.when(F.col("head_pos").isNotNull(), F.struct(F.col("head_pos").alias("pos"), F.col("head_value").alias("value")))
    first, last = F.try_element_at("changes", F.lit(1)), F.try_element_at("changes", F.lit(-1))
    pos, o, i = _change(last)
    # From here on a bucket is a small row.
    walks = buckets.select(
        *("file", "path", "block", "bucket", "begin", "last", "lines", "texts", "commas"),
        head.alias("head"),
        walked(False).alias("out"),
        walked(True).alias("in"),
        F.exists("changes", lambda x: _change(x)[1]).alias("opens"),
        F.size("changes").alias("size"),
        _change(first)[0].alias("first_change"),
        F.when(last.isNotNull(), F.struct(pos.alias("pos"), o.alias("o"), i.alias("i"))).alias("change"),
    )
    order = Window.partitionBy("file").orderBy("block", "bucket")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    marked = _with_stray(walks, so_far)

    def ended(before: str) -> Column:
        """State at the bucket's end and the last line in it at which a record begins."""
        was, at = F.col(f"{before}.inside"), F.col(f"{before}.at")
        none, stray = F.col("change").isNull(), F.col("stray").isNotNull()
        now = F.when(none, was).when(was, F.col("change.i") & ~stray).otherwise(F.col("change.o") & ~stray)
        begun = F.when(none | was, at).otherwise(F.col("change.pos"))
        more = ~now & (F.coalesce("change.pos", F.lit(-1)) < F.col("last"))
        return F.struct(now.alias("inside"), F.when(more, F.col("last")).otherwise(begun).alias("at"))

    both = marked.withColumns({"out": ended("out"), "in": ended("in")})
    same = F.col("out.inside") == F.col("in.inside")
    flips = F.when(F.col("out.inside") & ~F.col("in.inside"), 1).otherwise(0)
    stated = (
        both.withColumn("flips", F.sum(flips).over(so_far))
        .withColumn("set", F.last(F.when(same, F.struct(F.col("out.inside").cast("int").alias("to"), "flips")), True).over(so_far))
        .withColumn(
            "ends",
            (F.coalesce(F.col("set.to"), F.lit(0)) + F.col("flips") - F.coalesce(F.col("set.flips"), F.lit(0))) % 2 == 1,
        )
        .withColumn("inside", F.coalesce(F.lag("ends").over(order), F.lit(False)))
    )
    begun = F.when(F.col("inside"), F.col("in.at")).otherwise(F.col("out.at"))
    # A bucket whose one opening quote is a stray one has no broken record.
    opens = F.col("opens") & ~((F.col("size") == 1) & F.col("stray").isNotNull())
    return (
        stated.withColumn("begun", F.when(begun.isNotNull(), F.struct("block", begun.alias("pos"))))
        .withColumn("open", F.last("begun", True).over(earlier))
        .withColumn("broken", F.col("inside") | opens)
        .select("file", "path", "block", "bucket", "inside", "open", "broken", "stray", "head")
    )


def _with_stray(walks: DataFrame, so_far: WindowSpec) -> DataFrame:
    """Adds ``stray``: the place of a bucket's last change, if a quote that it opens isn't
    closed for over ``LONGEST`` lines and the whole buckets between look like records."""
    back = Window.partitionBy("file").orderBy(F.desc("block"), F.desc("bucket"))
    later = back.rowsBetween(Window.unboundedPreceding, -1)
    sums = ["lines", "texts", "commas"]
    upto = walks.withColumns({f"{c}_upto": F.sum(c).over(so_far) for c in sums}).withColumn(
        "header", F.first("head", True).over(so_far)
    )
    before = {c: F.col(f"{c}_upto") - F.col(c) for c in sums}
    first_line = before["lines"] + F.col("first_change") - F.col("begin")
    stop = F.struct(first_line.alias("lines"), *(before[c].alias(c) for c in sums[1:]))
    end = F.struct(*(F.col(f"{c}_upto").alias(c) for c in sums))
    found = upto.withColumns(
        {
            "next": F.last(F.when(F.col("change").isNotNull(), stop), True).over(later),
            "end": F.first(end).over(back.rowsBetween(Window.unboundedPreceding, 0)),
        }
    ).withColumn("next", F.coalesce("next", "end"))
    line = before["lines"] + F.col("change.pos") - F.col("begin")
    texts, commas = (F.col(f"next.{c}") - F.col(f"{c}_upto") for c in sums[1:])
    columns = _commas(F.regexp_replace("header.value", QUOTED_FIELD, ""))
    alike = (texts > 0) & (F.abs(commas - texts * columns) * 2 <= texts)
    opened = F.col("change.o") | F.col("change.i")
    stray = opened & (F.col("next.lines") - line > LONGEST) & alike
    return found.withColumn("stray", F.when(stray, F.col("change.pos"))).drop("next", "end", "header", *(f"{c}_upto" for c in sums))


def records(found: DataFrame, buckets: DataFrame, number_broken: int | None = None) -> DataFrame:
    """(file, block, pos, record): every record with the place of its first line.

    ``buckets`` is the stored summary of the same lines, ``number_broken`` how many of them
    are broken, if known. The text is read once for lines that are a record each, and, if
    there are any, once for those of broken buckets. Up to ``MOST_SENT`` of these the text is
    told apart where it is read; for more, Spark may shuffle it.
    """
    place = ["file", "block", "bucket"]
    shown = ["file", "block", "pos", _without_return(F.col("value")).alias("record")]
    if number_broken == 0:
        return found.select(*shown)
    few = number_broken is not None and number_broken <= MOST_SENT
    sent = F.broadcast if few else lambda df: df
    broken = buckets.where("broken").select(*place, "inside", "open", "stray")
    whole = found.join(sent(broken.select(*place)), place, "left_anti").select(*shown)
    from_out, from_in, _ = _after(F.col("value"))
    kept = ~F.coalesce(F.col("pos") == F.col("stray"), F.lit(False))
    order = Window.partitionBy(*place).orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("o") == F.col("i")
    flips = F.when(F.col("o") & ~F.col("i"), 1).otherwise(0)
    begin = F.col("inside").cast("int")
    stated = (
        found.join(sent(broken), place)
        .withColumns({"o": from_out & kept, "i": from_in & kept})
        .withColumn("flips", F.sum(flips).over(so_far))
        .withColumn("set", F.last(F.when(same, F.struct(F.col("o").cast("int").alias("to"), "flips")), True).over(so_far))
        .withColumn(
            "ends", (F.coalesce("set.to", begin) + F.col("flips") - F.coalesce(F.col("set.flips"), F.lit(0))) % 2 == 1
        )
        .withColumn("begins_inside", F.coalesce(F.lag("ends").over(order), F.col("inside")))
    )
    start = F.when(~F.col("begins_inside"), F.struct("block", "pos"))
    joined = (
        stated.withColumn("first", F.coalesce(F.last(start, True).over(so_far), F.col("open")))
        .groupBy("file", "first")
        .agg(F.array_sort(F.collect_list(F.struct("block", "pos", "value"))).alias("parts"))
        .select("file", "first.block", "first.pos", F.array_join("parts.value", "\n").alias("record"))
    )
    return whole.union(joined.withColumn("record", _without_return(F.col("record"))))


def heads(buckets: DataFrame) -> DataFrame:
    """(file, path, pos, text, open, broken): each file's first line that isn't blank,
    whether its record goes on, and how many buckets of the file are broken."""
    stray = F.coalesce(F.col("stray") == F.col("head.pos"), F.lit(False))
    head = F.when(F.col("head").isNotNull(), F.struct("head.pos", "head.value", stray.alias("stray")))
    first = (
        buckets.groupBy("file")
        .agg(F.min(head).alias("head"), F.first("path").alias("path"), F.count_if("broken").alias("broken"))
        .where("head IS NOT NULL")
    )
    text = _without_return(F.col("head.value"))
    is_open = _after(text)[0] & ~F.col("head.stray")
    return first.select("file", "path", F.col("head.pos").alias("pos"), text.alias("text"), is_open.alias("open"), "broken")
