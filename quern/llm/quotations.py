"""Quotation linking: which message quotes which, and conversations in order of reply.

Only DataFrame functions are used. Lines are parted into passages, runs of lines of one quote
level without blank lines between. A quoted passage is normalised (lower case, blanks as one,
quote marks gone) and hashed; it is joined to the first message of its conversation that wrote
it unquoted, as a line, a passage or a whole text. A message replies to the author of its least
quoted level that is found, since deeper levels came along with that author's text: of several
to the one with most passages and lines of that level, then of all levels, then the later one.

A passage or an opening that very many messages share is one row per conversation after the
first place of each hash has been taken, so no pair of messages is formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.tables import stored

# How a quotation is announced, as mail programs write it.
ATTRIBUTION = r"(?i)^(on|am|le|el|il) .{3,120} (wrote|schrieb.{0,60}|a écrit|escribió|ha scritto) ?:$"
MARKS = r"^((?:[ \t]*>)+)[ \t]?"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def passages(messages: DataFrame, text_col: str) -> DataFrame:
    """Adds ``lines`` (level, line) and ``blocks`` (level, text)."""
    raw = F.split(F.coalesce(F.col(text_col), F.lit("")), r"\r\n|\n|\r")
    level = lambda x: F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 1), r"[^>]", ""))
    lines = F.transform(
        raw, lambda x: F.struct(level(x).alias("level"), F.regexp_replace(x, MARKS, "").alias("line"))
    )
    with_lines = messages.withColumn("lines", lines)
    # A form feed before each line that opens a passage, then its level; both are cut off again.
    opens = lambda x, i: (
        (i == 0)
        | (F.trim(x["line"]) == "")
        | (F.get("lines", i - 1)["level"] != x["level"])
        | (F.trim(F.get("lines", i - 1)["line"]) == "")
    )
    marked = F.array_join(
        F.transform(
            "lines",
            lambda x, i: F.concat(
                F.when(opens(x, i), F.concat(F.lit("\f"), x["level"].cast("string"), F.lit("\v"))).otherwise(F.lit("\n")),
                F.translate(x["line"], "\f\v", "  "),
            ),
        ),
        "",
    )
    parts = F.transform(
        F.split(F.substring(marked, 2, 2147483647), "\f"),
        lambda x: F.struct(
            F.substring_index(x, "\v", 1).cast("int").alias("level"), F.substring_index(x, "\v", -1).alias("text")
        ),
    )
    return with_lines.withColumn("blocks", F.filter(parts, lambda b: F.trim(b["text"]) != ""))


def _hashes(texts: Column) -> Column:
    """Different hashes of the normalised, non-empty texts of an array."""
    kept = F.filter(F.transform(texts, normalised), lambda x: x != "")
    return F.array_distinct(F.transform(kept, lambda x: F.sha2(x, 256)))


def _levelled(parts: Column, text: str) -> Column:
    """Different (level, hash) of the normalised, non-empty quoted texts of an array of structs."""
    kept = F.filter(parts, lambda x: (x["level"] > 0) & (normalised(x[text]) != ""))
    return F.array_distinct(
        F.transform(kept, lambda x: F.struct(x["level"].alias("level"), F.sha2(normalised(x[text]), 256).alias("hash")))
    )


def link_quotations(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text"
) -> DataFrame:
    """``row`` and ``out``: levels, passages, links, parent, root and depth of each message and
    its text without quotations and their announcements.

    To read a conversation in order of reply, sort by conv_id, root_turn, depth and turn:
    everything follows what it replies to. Only earlier turns can be quoted; a passage found
    nowhere stays unlinked. A message that quotes nothing known is the root of its own thread.
    Null texts are empty; messages of null conversation or turn link with nothing; repeated
    rows of one turn share its links. Writes intermediate tables when called.
    """
    rows = messages.select(F.struct("*").alias("row")).select(
        "row",
        F.col("row")[conv_col].alias("conv"),
        F.col("row")[turn_col].alias("turn"),
        F.col("row")[text_col].alias("body"),
    )
    parsed = passages(rows, "body")
    announces = lambda x, i: (
        (x["level"] == 0)
        & F.rlike(F.trim(x["line"]), F.lit(ATTRIBUTION))
        & (F.coalesce(F.get("lines", i + 1)["level"], F.lit(0)) > 0)
    )
    own_lines = F.transform(
        F.filter("lines", lambda x, i: (x["level"] == 0) & ~announces(x, i)), lambda x: x["line"]
    )
    parsed = parsed.withColumn("own", F.trim(F.array_join(own_lines, "\n"), F.lit("\n")))
    parsed = parsed.select(
        "row", "conv", "turn", "lines", "blocks", "own",
        F.coalesce(F.array_max(F.transform("blocks", lambda b: b["level"])), F.lit(0)).alias("levels"),
        _levelled(F.col("blocks"), "text").alias("quoted"),
        _levelled(F.col("lines"), "line").alias("quoted_lines"),
    )
    keyed = parsed.where("conv is not null and turn is not null")
    quotes = stored(
        keyed.where(F.size("quoted") > 0)
        .select("conv", "turn", F.inline(F.array_union("quoted", "quoted_lines")))
        .groupBy("conv", "turn", "hash")
        .agg(F.min("level").alias("level")),
        "quotes",
    )
    whole = F.array(F.col("own"))
    plain = F.filter("blocks", lambda b: b["level"] == 0)
    written = F.concat(whole, F.transform(plain, lambda b: b["text"]), F.split("own", "\n"))
    wanted = quotes.select("conv").distinct()
    originals = (
        keyed.join(wanted, "conv", "left_semi")
        .select("conv", "turn", F.explode(_hashes(written)).alias("hash"))
        .groupBy("conv", "hash")
        .agg(F.min("turn").alias("first"))
    )
    links = stored(
        quotes.join(originals, ["conv", "hash"]).where("first < turn").select("conv", "turn", "level", "first"), "links"
    )
    by_level = links.groupBy("conv", "turn", "first", "level").agg(F.count("*").alias("n"))
    by_parent = by_level.groupBy("conv", "turn", "first").agg(
        F.min("level").alias("least"), F.min_by("n", "level").alias("n_least"), F.sum("n").alias("n")
    )
    best = F.struct(-F.col("least"), "n_least", "n", "first")
    parents = by_parent.groupBy("conv", "turn").agg(F.max_by("first", best).alias("parent"), F.sum("n").alias("n_linked"))
    jumps = stored(parents.select("conv", "turn", "n_linked", "parent", F.col("parent").alias("root"), F.lit(1).alias("depth")), "jumps")
    moving = not jumps.isEmpty()
    while moving:  # doubles the distance looked back in every round
        back = jumps.select("conv", F.col("turn").alias("root"), F.col("root").alias("further"), F.col("depth").alias("more"))
        joined = jumps.join(back, ["conv", "root"], "left")
        after = stored(
            joined.select(
                "conv", "turn", "n_linked", "parent",
                F.coalesce("further", "root").alias("root"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "jumps",
        )
        moving = not after.where("moved").isEmpty()
        jumps = after.drop("moved")
    found = parsed.join(jumps, ["conv", "turn"], "left")
    n_quoted = F.size(F.array_distinct(F.transform("quoted", lambda x: x["hash"]))).cast("long")
    return found.select(
        "row",
        F.struct(
            F.col("levels").alias("quote_levels"),
            n_quoted.alias("n_quoted"),
            F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
            F.col("parent").alias("parent_turn"),
            F.coalesce("root", "turn").alias("root_turn"),
            F.coalesce("depth", F.lit(0)).alias("depth"),
            F.col("own").alias("own_text"),
        ).alias("out"),
    )
