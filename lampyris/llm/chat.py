"""Conversations as training windows of a bounded number of tokens, as DataFrame expressions only.

A turn is rendered as ``<|role|>``, a line end, the text and ``<|end|>`` with a line end. Control strings inside roles and
texts are escaped, so a window can be read back exactly. Prefix sums of the turns' tokens choose the spans: the turns
after the system turn are cut where the sum passes multiples of a stride. Every window starts with the system turn,
repeats the last turns before its span as far as ``history`` and the budget allow, and then has its span. Only
assistant texts of the span itself are targets; what is repeated is masked. No group is larger than a conversation.

The stride is half of what the budget leaves beside system turn and history. A span then fits if no turn is longer than
the stride; a longer turn is kept whole, and its window is marked ``over_budget``.

Tokens are estimated as a quarter of a rendered turn's bytes, rounded up.

Defined results: a null text or role is empty. Rows are ordered by turn (null first), then role and text; repeated rows
are turns of their own. Rows without a conv_id are one conversation. The system turn is the first turn, if its role is
"system". Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stored

# The escape sign first, then the control strings of this and of other common templates.
ESCAPES = [
    ("\\", "\\s"), ("<|", "\\l"), ("|>", "\\r"), ("</s>", "\\e"), ("<s>", "\\b"), ("[INST]", "\\i"), ("[/INST]", "\\j"),
]
END = "<|end|>\n"


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """Codes back to what they stand for, the escape sign last: no other code's text holds one."""
    for plain, code in ESCAPES[::-1]:
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def windows(
    conversations: DataFrame, budget: int = 512, history: int = 96, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """(conv_id, window, text, targets, repeated, tokens, over_budget) of each window.

    ``targets``: spans [start, end) of the text under the loss mask, in code points. ``repeated``: how many turns at the
    start have been in an earlier window.
    """
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    head = F.concat(F.lit("<|"), F.replace(escape(role), F.lit("\n"), F.lit("\\m")), F.lit("|>\n"))
    turns = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("raw"),
        F.length(head).alias("lead"), escape(text).alias("body"), head.alias("head"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "raw")
    tokens = F.ceil((F.octet_length("head") + F.octet_length("body") + len(END)) / 4)
    turns = turns.withColumn("i", F.row_number().over(order)).withColumn("tokens", tokens)
    is_system = (F.col("i") == 1) & (F.col("role") == "system")
    whole = Window.partitionBy("conv_id")
    turns = turns.withColumn("system", is_system)
    turns = turns.withColumn("system_tokens", F.sum(F.when(F.col("system"), F.col("tokens")).otherwise(0)).over(whole))
    own = F.when(F.col("system"), 0).otherwise(F.col("tokens"))
    turns = turns.withColumn("until", F.sum(own).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("since", F.col("until") - own)
    stride = F.greatest(F.lit(1), F.floor((F.lit(budget - history) - F.col("system_tokens")) / 2))
    turns = turns.withColumn("stride", stride).withColumn("window", F.floor(F.col("since") / F.col("stride")))
    # several passes follow; the turns are numbered and summed up once
    turns = stored(turns.drop("raw", "turn"), "turns")
    parts = ["conv_id", "i", "role", "tokens", "head", "lead", "body", "since", "until"]
    fresh = turns.where(~F.col("system"))
    # a system turn alone makes a window too
    alone = turns.where("system").join(fresh.select("conv_id").distinct().withColumnRenamed("conv_id", "other"), F.col("conv_id").eqNullSafe(F.col("other")), "left_anti")
    span = fresh.groupBy("conv_id", "window").agg(
        F.min("since").alias("first"), F.sum("tokens").alias("new"), F.min("i").alias("from"), F.first("system_tokens").alias("system_tokens")
    )
    span = span.withColumn("room", F.least(F.lit(history), F.lit(budget) - F.col("system_tokens") - F.col("new")))
    span = span.withColumn("least", F.min("window").over(whole))
    reach = F.floor((F.col("since") + history) / F.col("stride"))
    past = fresh.where(reach > F.col("window")).withColumn("into", F.explode(F.sequence(F.col("window") + 1, reach)))
    info = span.select(F.col("conv_id").alias("c"), F.col("window").alias("w"), "first", "room", "least", F.col("from"))
    past = past.drop("window").join(info, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("into") == F.col("w")))
    past = past.where((F.col("i") < F.col("from")) & (F.col("since") >= F.col("first") - F.col("room"))).select(*parts, F.col("w").alias("window"), F.lit(1).alias("kind"))
    system = turns.where("system").join(info, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        *parts, F.col("w").alias("window"), F.when(F.col("w") == F.col("least"), 2).otherwise(0).alias("kind")
    )
    every = fresh.select(*parts, "window", F.lit(2).alias("kind")).union(past).union(system).union(alone.select(*parts, F.lit(0).alias("window"), F.lit(2).alias("kind")))
    rows = every.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(F.struct("i", "kind", "role", "tokens", "head", "lead", "body"))).alias("turns")
    )
    rendered = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start: long, end: long>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + t["lead"]
        end = begin + F.length(t["body"])
        target = (t["kind"] == 2) & (t["role"] == "assistant")
        spans = F.when(target, F.concat(acc["spans"], F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(acc["spans"])
        return F.struct((end + len(END)).alias("at"), spans.alias("spans"))

    total = F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["tokens"])
    return rows.select(
        "conv_id",
        "window",
        rendered.alias("text"),
        F.aggregate("turns", start, step, lambda a: a["spans"]).alias("targets"),
        F.size(F.filter("turns", lambda t: t["kind"] < 2)).alias("repeated"),
        total.alias("tokens"),
        (total > budget).alias("over_budget"),
    )


def read_back(found: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns, loss): per conversation, role and text of every turn once, and the text under the mask.

    ``turns`` is role, line end, text, line end of each turn, one after the other.
    """
    pieces = F.split(F.col("text"), r"<\|end\|>\n")
    fresh = F.expr("slice(pieces, repeated + 1, size(pieces) - 1 - repeated)")

    def turn(p: Column) -> Column:
        role = F.replace(F.regexp_extract(p, r"^<\|([^\n]*)\|>\n", 1), F.lit("\\m"), F.lit("\n"))
        body = F.regexp_replace(p, r"^<\|[^\n]*\|>\n", "")
        return F.concat(unescape(role), F.lit("\n"), unescape(body), F.lit("\n"))

    masked = F.transform("targets", lambda s: unescape(F.substring(F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    rows = found.withColumn("pieces", pieces).select(
        "conv_id", "window", F.transform(fresh, turn).alias("turns"), F.concat_ws("", masked).alias("loss"), F.length("text").alias("chars")
    )
    by = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"), F.sum("chars").alias("formatted_chars")
    )
    return by.select(
        "conv_id",
        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + F.size(x["turns"])).alias("n_turns"),
        F.concat_ws("", F.transform("w", lambda x: F.concat_ws("", x["turns"]))).alias("turns"),
        F.concat_ws("", F.transform("w", lambda x: x["loss"])).alias("loss"),
        "formatted_chars",
    )
