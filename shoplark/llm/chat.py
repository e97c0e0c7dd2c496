"""Chat formatting by quotation linking, in DataFrame and SQL functions only.

1. Each line has a quote level, the number of ">" before it. What is quoted is taken as units: every line, all lines
   of a level together, and, so that passages that were wrapped anew are found, the level's runs of consecutive lines,
   their paragraphs (parted by lines without letters or digits) and all its lines without announcements of deeper
   quotes. Units are normalised (lower case, runs of other than letters and digits as one blank) and hashed. A part
   of a paragraph that was wrapped anew is no unit.
2. A quoted unit is linked to the latest earlier message of its conversation that says it itself (level 0). The
   lookup is by (conversation, hash) in two steps, within spans of turns and over the spans, so that neither a huge
   conversation nor a line that everyone repeats makes pairs or one large group.
3. A message replies to the latest message that its level-1 quotes are linked to (else deeper ones, else the message
   before). Where that is not the message before, it begins a branch at the quoted message; branches are ordered
   depth-first by pointer doubling, and positions are counted by ranges, so no conversation is in one task.

Null texts are empty; a null conversation or turn is returned without link and position; messages that share
conversation and turn count as one for links and lie next to each other; quotes without original are cut out and
not linked; texts of quotes alone become empty; an empty table gives no rows. Only the four columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

#: Turns of one conversation that are looked up together.
SPAN = 4096
#: Lines that announce a quote ("On Monday A wrote:").
ANNOUNCE = r"(?i)^\s*(on|am|le|el)\b.{0,200}\b(wrote|schrieb|a écrit|escribió)\s*:\s*$"

LINES = r"transform(split(coalesce(text, ''), '\n'), x -> struct(length(regexp_replace(regexp_extract(x, '^[ \t]*((?:>[ \t]?)*)', 1), '[^>]', '')) AS level, regexp_replace(x, '^[ \t]*(?:>[ \t]?)*', '') AS words))"
PLAIN = r"trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' '))"


def parsed(messages: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv_id, turn, role, clean (own text without quotes and their announcements), units of (level, and the hashes h1 and h2)."""
    rows = messages.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    lines = rows.withColumn("lines", F.expr(LINES))
    # told: the line announces a quote that is deeper than itself.
    marked = f"transform(lines, (x, i) -> struct(x.level AS level, x.words AS words, {PLAIN.format('x.words')} AS said, x.words rlike r'{ANNOUNCE}' AND coalesce(get(lines, i + 1).level, 0) > x.level AS told))"
    lines = lines.withColumn("lines", F.expr(marked))
    own = "filter(lines, x -> x.level = 0 AND NOT x.told)"
    # Line breaks part passages: the normalised lines have none.
    parts = "split(array_join(transform(lines, y -> CASE WHEN {0} THEN y.said ELSE '\n' END), ' '), '\n')"
    wholes = "array_join(transform(filter(lines, y -> {0}), y -> y.said), ' ')"
    here = "y.level = l AND NOT y.told"
    passages = f"concat(array({wholes.format('y.level = l')}, {wholes.format(here)}), {parts.format(here)}, {parts.format(here + " AND y.said <> ''")})"
    units = f"concat(transform(lines, x -> struct(x.level AS level, x.said AS said)), flatten(transform(array_distinct(transform(lines, x -> x.level)), l -> transform({passages}, w -> struct(l AS level, trim(regexp_replace(w, ' +', ' ')) AS said)))))"
    return lines.select(
        "conv_id",
        "turn",
        "role",
        F.expr(rf"regexp_replace(trim(BOTH '\n' FROM array_join(transform({own}, x -> rtrim(x.words)), '\n')), '\n{{3,}}', '\n\n')").alias("clean"),
        F.expr(f"transform(filter({units}, u -> u.said <> ''), u -> struct(u.level AS level, xxhash64(u.said) AS h1, hash(u.said) AS h2))").alias("units"),
    )


def linked_units(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, to (the latest earlier turn that says the quoted unit itself, or null) of every quoted unit."""
    usable = messages.where("conv_id is not null and turn is not null")
    units = usable.select("conv_id", "turn", F.explode("units").alias("u"))
    units = units.select("conv_id", "turn", "u.level", "u.h1", "u.h2", F.floor(F.col("turn") / SPAN).alias("span"))
    key = ["conv_id", "h1", "h2"]
    quotes = stored(units.where("level > 0").distinct(), "quotes")
    first = units.where("level = 0").select("conv_id", "turn", "h1", "h2", "span").distinct()
    said = stored(first.join(quotes.select(*key).distinct(), key, "left_semi"), "said")
    # The latest turn of earlier spans, by key and span.
    ends = said.groupBy(*key, "span").agg(F.max("turn").alias("last")).unionByName(quotes.select(*key, "span").distinct().withColumn("last", F.lit(None).cast("long")))
    ends = ends.groupBy(*key, "span").agg(F.max("last").alias("last"))
    before = Window.partitionBy(*key).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*key, "span", F.max("last").over(before).alias("carried"))
    # The latest turn of the same span.
    both = said.withColumn("level", F.lit(0)).withColumn("at", F.col("turn")).unionByName(quotes.withColumn("at", F.lit(None).cast("long")))
    within = Window.partitionBy(*key, "span").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("near", F.max("at").over(within)).where("level > 0")
    return near.join(ends, [*key, "span"], "left").select("conv_id", "turn", "level", F.coalesce("near", "carried").alias("to"))


def replies(messages: DataFrame) -> DataFrame:
    """conv_id, turn, n_quotes, n_linked, reply_to of the messages with quotes."""
    to = F.col("to")
    return (
        linked_units(messages)
        .groupBy("conv_id", "turn")
        .agg(F.count("*").alias("n_quotes"), F.count(to).alias("n_linked"), F.max(F.when(F.col("level") == 1, to)).alias("direct"), F.max(to).alias("any"))
        .select("conv_id", "turn", "n_quotes", "n_linked", F.coalesce("direct", "any").alias("reply_to"))
    )


def branches(turns: DataFrame, links: DataFrame) -> DataFrame:
    """conv_id, begin, path of the branches: at which turn of which branch each begins, from the root down.

    turns has conv_id, turn and before (the turn before). A message whose reply_to is not the turn before begins a branch.
    """
    begun = links.where("reply_to is not null").join(turns, ["conv_id", "turn"]).where("reply_to < before").select("conv_id", F.col("turn").alias("begin"), F.col("reply_to").alias("at")).distinct()
    begun = stored(begun, "branches")
    # The branch that a quoted message is in: the last that begins at or before it.
    events = begun.select("conv_id", F.col("begin").alias("turn"), F.col("begin").alias("start"), F.lit(None).cast("long").alias("of")).unionByName(begun.select("conv_id", F.col("at").alias("turn"), F.lit(None).cast("long").alias("start"), F.col("begin").alias("of")))
    above = _latest(events, "start").where("of is not null").select("conv_id", F.col("of").alias("begin"), F.col("latest").alias("up"))
    paths = stored(begun.join(above, ["conv_id", "begin"]).select("conv_id", "begin", "up", F.array("at", "begin").alias("path")), "paths")
    while paths.where("up is not null").limit(1).count():
        there = paths.select("conv_id", F.col("begin").alias("up"), F.col("up").alias("further"), F.col("path").alias("front"))
        paths = stored(paths.join(there, ["conv_id", "up"], "left").select("conv_id", "begin", F.col("further").alias("up"), F.concat(F.coalesce("front", F.array().cast("array<bigint>")), "path").alias("path")), "paths")
    return paths.select("conv_id", "begin", "path")


def format_chats(messages: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text (without quotes), message (with its role), n_quotes, n_linked, reply_to, position, depth of every row.

    position counts from 0 within a conversation in reply order; depth is the number of branches around a message.
    """
    rows = stored(parsed(messages, conv_col, turn_col, role_col, text_col), "messages")
    usable = rows.where("conv_id is not null and turn is not null")
    links = stored(replies(rows), "replies")
    clean = rows.drop("units").withColumn("tie", F.xxhash64("role", "clean"))
    if links.isEmpty():
        shaped = clean.withColumns({"n_quotes": F.lit(0).cast("long"), "n_linked": F.lit(0).cast("long"), "quoted": F.lit(None).cast("long"), "path": F.array().cast("array<bigint>")})
    else:
        turns = _before(usable.select("conv_id", "turn").distinct())
        paths = branches(turns, links)
        held = _held(usable.select("conv_id", "turn").distinct(), paths)
        shaped = clean.join(links.withColumnRenamed("reply_to", "quoted"), ["conv_id", "turn"], "left").join(held, ["conv_id", "turn"], "left")
        shaped = shaped.withColumns({x: F.coalesce(x, F.lit(0).cast("long")) for x in ("n_quotes", "n_linked")}).withColumn("path", F.coalesce("path", F.array().cast("array<bigint>")))
    order = F.concat("path", F.array(F.col("turn"), F.lit(-1).cast("long")))
    placed = _positions(shaped.withColumn("order", F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), order)))
    said = F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), "clean")
    return placed.select("conv_id", "turn", "role", F.col("clean").alias("text"), said.alias("message"), "n_quotes", "n_linked", F.col("quoted").alias("reply_to"), "position", F.floor(F.size("path") / 2).cast("long").alias("depth"))


def _before(turns: DataFrame) -> DataFrame:
    """Adds the turn before, by spans of turns; only the last turn of each span is carried over the spans."""
    spans = turns.withColumn("span", F.floor(F.col("turn") / SPAN))
    ends = spans.groupBy("conv_id", "span").agg(F.max("turn").alias("last"))
    carried = ends.select("conv_id", "span", F.lag("last").over(Window.partitionBy("conv_id").orderBy("span")).alias("carried"))
    own = spans.withColumn("near", F.lag("turn").over(Window.partitionBy("conv_id", "span").orderBy("turn")))
    return own.join(carried, ["conv_id", "span"]).select("conv_id", "turn", F.coalesce("near", "carried").alias("before"))


def _held(turns: DataFrame, paths: DataFrame) -> DataFrame:
    """conv_id, turn, path of the branch that each message is in (the last one that begins at or before it)."""
    rows = turns.select("conv_id", "turn", F.lit(None).cast("long").alias("begin")).unionByName(paths.select("conv_id", F.col("begin").alias("turn"), "begin"))
    found = _latest(rows, "begin").where("begin is null and latest is not null").select("conv_id", "turn", F.col("latest").alias("begin"))
    return found.join(paths, ["conv_id", "begin"]).select("conv_id", "turn", "path")


def _latest(rows: DataFrame, value: str) -> DataFrame:
    """Adds latest, the greatest value at or before each turn of a conversation, by spans of turns: a span is sorted in
    one task, and only the greatest value of each span is carried over the spans."""
    rows = rows.withColumn("span", F.floor(F.col("turn") / SPAN))
    ends = rows.groupBy("conv_id", "span").agg(F.max(value).alias("last"))
    over = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("conv_id", "span", F.max("last").over(over).alias("carried"))
    upto = Window.partitionBy("conv_id", "span").orderBy("turn").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    near = rows.withColumn("near", F.max(value).over(upto))
    return near.join(carried, ["conv_id", "span"]).withColumn("latest", F.coalesce("near", "carried")).drop("near", "carried", "span")


def _positions(rows: DataFrame) -> DataFrame:
    """Adds position. Rows are dealt out by ranges of (conversation, order); each range counts its own and adds those before."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col("conv_id"), F.col("order"), F.col("tie")]
    sorted_rows = rows.repartitionByRange(n, *by).sortWithinPartitions(*by)
    numbered = stored(sorted_rows.withColumn("number", F.monotonically_increasing_id()), "ordered")
    numbered = numbered.withColumn("range", F.shiftright("number", 33))
    counts = numbered.where("order is not null").groupBy("conv_id", "range").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("conv_id", "range", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    placed = numbered.join(counts, ["conv_id", "range"], "left")
    return placed.withColumn("position", F.when(F.col("order").isNotNull(), F.col("number") - F.col("first") + F.col("earlier")))
