"""Quotation linking of conversations, in DataFrame functions only.

Lines that start with ``>`` are quotes; the number of ``>`` is their level.
Consecutive lines of one level are a passage. Passages and their lines are
normalised, hashed and looked up among the lines, paragraphs and whole bodies
of earlier messages of the conversation. A message replies to the latest
earlier one that a passage of its lowest quote level is found in, whole
passages before single lines; where nothing of that level is found, the next
level is asked, and so on, so that a nested quote still places a message.
Threads follow those links to their first message; the conversation is ordered
by thread, then turn, without quotes.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelore.llm.common import written

QUOTE = r"^[ \t]*>[> \t]*"
#: Turns of a conversation that are numbered together.
RUN = 1024


def _plain(c: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(c, r"\s+", " ")))


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, QUOTE, 0), "[^>]", ""))


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, r"\r?\n", -1), lambda x: F.struct(_level(x).alias("level"), F.regexp_replace(x, QUOTE, "").alias("own"), x.alias("raw")))


def _bound(value: Column, use) -> Column:
    """use(value) with the value as a lambda's variable: computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def passages(lines: Column) -> Column:
    """array<(level, text)>: runs of lines of one level, 0 included. Linear: places where a run begins, then the lines of each."""

    def of_lines(x: Column) -> Column:
        level = lambda i: F.element_at(x, i)["level"]

        def passage(begin: Column, end: Column) -> Column:
            line = lambda i: F.when(level(i) > 0, F.element_at(x, i)["own"]).otherwise(F.element_at(x, i)["raw"])
            own = F.transform(F.sequence(begin, end - 1), line)  # a slice would copy all lines each time
            return F.struct(level(begin).alias("level"), F.array_join(own, "\n").alias("text"))

        begins = F.filter(F.sequence(F.lit(1), F.size(x)), lambda i: (i == 1) | (level(i) != level(F.greatest(i - 1, F.lit(1)))))
        return _bound(begins, lambda b: F.transform(b, lambda s, k: passage(s, F.coalesce(F.try_element_at(b, k + 2), F.size(x) + 1))))

    return _bound(lines, of_lines)


def _keys(text: Column, rank: Column, pattern: str | None) -> Column:
    parts = F.array(text) if pattern is None else F.split(text, pattern)
    plain = F.filter(F.transform(parts, _plain), lambda p: p != "")
    return F.transform(plain, lambda p: F.struct(F.xxhash64(p).alias("key"), F.md5(p.cast("binary")).alias("check"), rank.alias("rank")))


def parse(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> + passages, content (lines that aren't quotes), n_quotes. Null text is empty."""
    own = messages.select("conv_id", "turn", "role", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    split = own.withColumn("passages", F.when(F.col("text").contains(">"), passages(_lines(F.col("text")))).otherwise(F.array(F.struct(F.lit(0).alias("level"), F.col("text").alias("text")))))
    said = F.filter("passages", lambda p: p["level"] == 0)
    content = F.btrim(F.regexp_replace(F.array_join(F.transform(said, lambda p: p["text"]), "\n"), r"\n{3,}", "\n\n"), F.lit(" \n\t\r"))
    return split.withColumns({"content": content, "n_quotes": F.size("passages") - F.size(said)}).drop("text")


def links(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to) of messages with a quote that is found in an earlier one."""
    quoted = parsed.filter("n_quotes > 0").select("conv_id", "turn", F.filter("passages", lambda p: p["level"] > 0).alias("q"))
    asked = F.flatten(F.transform("q", lambda p: F.concat(_keys(p["text"], 2 * p["level"], None), _keys(p["text"], 2 * p["level"] + 1, r"\n"))))
    asks = quoted.select("conv_id", "turn", F.explode(F.array_distinct(asked)).alias("k")).select("conv_id", "turn", "k.*")
    body, none = F.col("content"), F.lit(None).cast("int")
    held = F.concat(_keys(body, none, None), _keys(body, none, r"\n[ \t]*\n"), _keys(body, none, r"\n"))
    there = parsed.join(asks.select("conv_id").distinct(), "conv_id", "left_semi")
    holds = there.select("conv_id", "turn", F.explode(F.array_distinct(held)).alias("k")).select("conv_id", "turn", "k.*")
    # the latest earlier holder: by one pass over each text's holders and askers in a run of turns, or the last run before; no pairs are made
    both = holds.unionAll(asks).withColumn("run", F.floor(F.col("turn") / RUN))
    text, holder = ["conv_id", "key", "check"], F.when(F.col("rank").isNull(), F.col("turn"))
    last = both.groupBy(*text, "run").agg(F.max(holder).alias("last"))
    before = Window.partitionBy(*text).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*text, "run").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("near", F.max(holder).over(earlier)).filter("rank IS NOT NULL")
    seen = near.join(last.select(*text, "run", F.max("last").over(before).alias("far")), [*text, "run"]).withColumn("at", F.coalesce("near", "far")).filter("at IS NOT NULL")
    return seen.groupBy("conv_id", "turn").agg(F.max_by("at", F.struct(-F.col("rank"), "at")).alias("reply_to"))


def roots(found: DataFrame) -> DataFrame:
    """(conv_id, turn, thread): the first message of the chain of links, by pointer doubling."""
    now = written(found.select("conv_id", "turn", F.col("reply_to").alias("thread")), "threads")
    while True:
        up = now.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("above"))
        further = now.join(up, ["conv_id", "thread"], "left").select("conv_id", "turn", F.coalesce("above", "thread").alias("thread"), F.col("above").isNotNull().alias("moved"))
        further = written(further, "threads")
        if further.filter("moved").isEmpty():
            return further.drop("moved")
        now = further.drop("moved")


def conversations(messages: DataFrame) -> DataFrame:
    """messages(conv_id, turn, role, text) -> a row per row: conv_id, position, turn, role, content, reply_to, thread, n_quotes.

    position counts from 1 by thread, turn, role and content. A message without
    a found quote is a thread of its own and replies to nothing. Null turns
    never hold or find quotes and come last; null conv_id is a conversation.
    """
    parsed = written(parse(messages), "parsed")
    found = written(links(parsed.filter("conv_id IS NOT NULL AND turn IS NOT NULL")), "replies")
    top = roots(found)
    own = parsed.drop("passages").join(found, ["conv_id", "turn"], "left").join(top, ["conv_id", "turn"], "left")
    own = own.withColumn("thread", F.coalesce("thread", "turn")).withColumn("run", F.coalesce(F.floor(F.col("thread") / RUN), F.lit(1 << 60)))
    own = own.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    runs = own.groupBy("conv", "run").agg(F.count("*").alias("n"))
    base = F.coalesce(F.sum("n").over(Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    order = Window.partitionBy("conv", "run").orderBy(F.asc_nulls_last("thread"), F.asc_nulls_last("turn"), "role", "content")
    placed = own.join(runs.select("conv", "run", base.alias("base")), ["conv", "run"])
    placed = placed.withColumn("position", F.col("base") + F.row_number().over(order))
    return placed.select("conv_id", "position", "turn", "role", "content", "reply_to", "thread", "n_quotes")
