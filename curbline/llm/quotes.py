"""Quotation linking: nested quotes to the messages they come from, and conversations without quotes.

A message is parted into paragraphs: runs of lines of one quote level, the number of ``>`` before a line. Quoted
and own paragraphs are normalised (lower case, single blanks) and hashed. A quoted passage comes from the last
earlier message that has the same paragraph as its own; ids of messages ascend with time. The parent of a message is
the latest one that it quotes at the lowest level at which any passage is found. Parents make a forest; a conversation
(``thread_id``) is named by its root, and ordered by ``msg_id`` each message stands after the one that it answers.

The search for the last earlier message works in blocks of ids: a window within each block of a hash, and one
over the blocks, which carries the last message of the earlier ones. A passage that a third of all messages
share is thus spread over as many tasks as it has blocks.

Defined cases: a null or empty text has no paragraphs; a null msg_id is left out; of rows that repeat a msg_id the
text first by code point counts; a message never quotes itself; a passage found nowhere is counted and dropped;
lines of ``>`` alone part paragraphs; very long texts are parsed whole; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curbline.llm.common import cut, small_batches, strings, table

QUOTED = re.compile(r"^((?:[ \t]*>)+)[ \t]?")
#: Lines that name the author of the quote below them.
ATTRIBUTION = re.compile(r"^(?:on|am|le|el)\b.*\b(?:wrote|schrieb|a écrit|escribió)\s*:\s*$", re.IGNORECASE)
#: Rows of one hash that a window holds at most, about; ids are taken to be spread evenly.
BLOCK_ROWS = 50_000
#: Bytes of text that are parsed at a time.
BATCH_BYTES = 4_000_000


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def passage_hash(text: str) -> str:
    return hashlib.md5(normalised(text).encode()).hexdigest()


def levels(text: str) -> list[tuple[int, str]]:
    """Each line with its quote level and without its marks; attributions left out."""
    rows = []
    for line in re.split(r"\r\n|\r|\n", text):
        marks = QUOTED.match(line)
        rows.append((marks[1].count(">"), line[marks.end() :]) if marks else (0, line))
    out = []
    for place, (level, line) in enumerate(rows):
        follows = rows[place + 1][0] if place + 1 < len(rows) else 0
        if not (follows > level and ATTRIBUTION.match(line.strip())):
            out.append((level, line))
    return out


def paragraphs(text: str) -> list[tuple[int, str]]:
    """Runs of lines of one level that are not blank."""
    out: list[tuple[int, list[str]]] = []
    border = True
    for level, line in levels(text):
        if not line.strip():
            border = True
        elif border or out[-1][0] != level:
            out.append((level, [line]))
            border = False
        else:
            out[-1][1].append(line)
    return [(level, "\n".join(lines)) for level, lines in out]


def own_text(text: str) -> str:
    """What is left without quotes, blank lines around it dropped."""
    return "\n".join(line for level, line in levels(text) if level == 0).strip()


def parse(messages: DataFrame) -> DataFrame:
    """``msg_id, own, passages`` of ``msg_id, text``; passages have level, hash and number."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.string()), ("number", pa.int32())]))
        for whole in batches:
            for batch in small_batches(whole, "text", BATCH_BYTES):
                texts = strings(batch["text"])
                found = [
                    [{"level": level, "hash": passage_hash(p), "number": n} for n, (level, p) in enumerate(paragraphs(t))]
                    for t in texts
                ]
                columns = [batch["msg_id"], pa.array(list(map(own_text, texts))), pa.array(found, kind)]
                yield pa.RecordBatch.from_arrays(columns, ["msg_id", "own", "passages"])

    once = messages.filter("msg_id is not null").groupBy(F.col("msg_id").cast("long").alias("msg_id"))
    schema = "msg_id long, own string, passages array<struct<level: int, hash: string, number: int>>"
    return cut(once.agg(F.min("text").alias("text")).mapInArrow(parsed, schema), "quotes-parsed")


def last_earlier(passages: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``msg_id, level, number, source`` of quoted passages: the last earlier message with that paragraph."""
    span = passages.agg(F.min("msg_id"), F.max("msg_id"), F.count("*")).first()
    width = max(1, ((span[1] or 0) - (span[0] or 0)) // max(1, (span[2] or 0) // block_rows))
    placed = passages.withColumn("block", F.floor(F.col("msg_id") / width))
    known = F.when(F.col("level") == 0, F.col("msg_id"))
    inside = Window.partitionBy("hash", "block").orderBy("msg_id").rangeBetween(Window.unboundedPreceding, -1)
    near = placed.withColumn("near", F.max(known).over(inside)).filter("level > 0")
    # Only hashes that are quoted carry their messages from block to block.
    per_block = placed.groupBy("hash", "block").agg(F.max(known).alias("last"), F.max("level").alias("most"))
    earlier = Window.partitionBy("hash").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_block.withColumn("far", F.max("last").over(earlier)).filter("most > 0").select("hash", "block", "far")
    return near.join(carried, ["hash", "block"]).select(
        "msg_id", "level", "number", F.coalesce("near", "far").alias("source")
    )


def link(messages: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``msg_id, thread_id, parent_id, depth, n_quotes, n_found, own`` of every message."""
    parsed = parse(messages)
    passages = parsed.select("msg_id", F.explode("passages").alias("p")).select("msg_id", "p.*")
    sources = cut(last_earlier(passages, block_rows), "quotes-sources")
    lowest = F.struct((-F.col("level")).alias("back"), "source")
    counted = cut(
        sources.groupBy("msg_id").agg(
            F.count("*").alias("n_quotes"),
            F.count("source").alias("n_found"),
            F.max(F.when(F.col("source").isNotNull(), lowest)).getField("source").alias("parent_id"),
        ),
        "quotes-parents",
    )
    parents = counted.filter("parent_id is not null").select("msg_id", "parent_id")
    threads = climb(parents)
    return (
        parsed.select("msg_id", "own")
        .join(counted, "msg_id", "left")
        .join(threads, "msg_id", "left")
        .select(
            "msg_id",
            F.coalesce("thread_id", "msg_id").alias("thread_id"),
            "parent_id",
            F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
            F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
            F.coalesce("n_found", F.lit(0)).alias("n_found"),
            "own",
        )
    )


def climb(parents: DataFrame) -> DataFrame:
    """``msg_id, thread_id, depth``: the root above each answer, and how many answers lie between.

    Steps are doubled: each round looks up the ancestor's ancestor, so a chain of n answers takes
    log2(n) rounds, and a row that has reached its root takes part no more.
    """
    steps = parents.select(
        "msg_id", F.col("parent_id").alias("up"), F.lit(1).cast("long").alias("depth"), F.lit(False).alias("done")
    )
    steps = cut(steps, "quotes-steps")
    while not steps.filter("not done").isEmpty():
        above = steps.select(
            F.col("msg_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("done").alias("top")
        )
        moved = steps.filter("not done").join(above, "up", "left").select(
            "msg_id",
            F.coalesce("next", "up").alias("up"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.coalesce("top", F.lit(True)).alias("done"),
        )
        steps = cut(steps.filter("done").unionByName(moved), "quotes-steps")
    return steps.select("msg_id", F.col("up").alias("thread_id"), "depth")


def write_conversations(linked: DataFrame, path: str) -> None:
    """Write the messages in reply order: by conversation, each after the one that it answers."""
    ordered = linked.repartitionByRange("thread_id", "msg_id").sortWithinPartitions("thread_id", "msg_id")
    ordered.write.parquet(path)


def quoted(text: str, marks: str) -> F.Column:
    """A text column with marks before each line."""
    return F.concat(F.lit(f"{marks} "), F.regexp_replace(text, "\n", f"\n{marks} "))


def as_mail(turns: DataFrame) -> DataFrame:
    """``msg_id, text`` of conversations as mail: each turn quotes the two before it, nested.

    Turns meet their predecessors by an equality of both keys, so a long conversation is no hot key.
    """
    known = turns.filter("conv_id is not null and turn is not null").groupBy("conv_id", "turn")
    once = cut(known.agg(F.coalesce(F.min("text"), F.lit("")).alias("text")), "quotes-turns")
    before = [
        once.select("conv_id", (F.col("turn") + back).alias("turn"), F.col("text").alias(f"before{back}")) for back in (1, 2)
    ]
    near = once.join(before[0], ["conv_id", "turn"], "left").join(before[1], ["conv_id", "turn"], "left")
    factor = id_factor(*once.agg(F.min("turn"), F.max("turn")).first())
    head = F.when(F.col("before1").isNotNull(), F.lit("On the turn before, they wrote:\n"))
    older = F.when(F.col("before1").isNotNull() & F.col("before2").isNotNull(), F.concat(quoted("before2", ">>"), F.lit("\n")))
    newer = F.concat(quoted("before1", ">"), F.lit("\n\n"))
    return near.select(
        message_id(factor).alias("msg_id"),
        F.concat(F.coalesce(head, F.lit("")), F.coalesce(older, F.lit("")), F.coalesce(newer, F.lit("")), "text").alias("text"),
    )


#: Turns that the ids of messages leave room for in each conversation, and more where the table has a longer one.
TURNS = 1_000_000


def id_factor(first: int | None, last: int | None) -> int:
    """Distance of the ids of two conversations, so that no turn from ``first`` to ``last`` runs into the next one."""
    return max(TURNS, (last or 0) - min(0, first or 0) + 1)


def message_id(factor: int) -> F.Column:
    """Ids that no two messages share; the session's arithmetic raises where they do not fit into a long."""
    return F.col("conv_id").cast("long") * F.lit(factor).cast("long") + F.col("turn")


def op6_quotes(spark, sf_dir: str) -> DataFrame:
    """Per message of the conversations written as mail: its parent, conversation, depth, quotes and own text."""
    linked = link(as_mail(table(spark, sf_dir, "conversations")))
    blank = F.trim(F.regexp_replace(F.lower("own"), r"[\s]+", " "))
    return linked.select(
        "msg_id", "thread_id", "parent_id", "depth", "n_quotes", "n_found", F.md5(blank).alias("own_hash")
    )


#: The truth that the quotes were made from, without any quote: the turn before, or the one before that if blank.
OP6_SQL = rf"""
with recursive turns as (
  select conv_id * {TURNS} + turn as msg_id, conv_id, turn, coalesce(min(text), '') as text
  from conversations where conv_id is not null and turn is not null group by conv_id, turn
), near as (
  select t.msg_id, t.text, a.msg_id as one, b.msg_id as two,
    len(list_filter(regexp_split_to_array(coalesce(a.text, ''), '\n\s*\n'), lambda x: trim(x, E' \n\t\r') <> '')) as n_one,
    case when a.msg_id is null then 0 else
      len(list_filter(regexp_split_to_array(coalesce(b.text, ''), '\n\s*\n'), lambda x: trim(x, E' \n\t\r') <> '')) end as n_two
  from turns t
  left join turns a on a.conv_id = t.conv_id and a.turn = t.turn - 1
  left join turns b on b.conv_id = t.conv_id and b.turn = t.turn - 2
), parents as (
  select *, case when n_one > 0 then one when n_two > 0 then two end as parent_id from near
), walk as (
  select msg_id, msg_id as thread_id, 0 as depth from parents where parent_id is null
  union all
  select p.msg_id, w.thread_id, w.depth + 1 from parents p join walk w on p.parent_id = w.msg_id
)
select p.msg_id, thread_id, parent_id, depth::bigint as depth, (n_one + n_two)::bigint as n_quotes,
  (n_one + n_two)::bigint as n_found,
  md5(trim(regexp_replace(lower(text), '\s+', ' ', 'g'))) as own_hash
from parents p join walk using (msg_id)
"""
