"""Conversations as training windows of a token budget, with a loss mask.

Every turn is written as ``### role``, the text and ``</turn>`` on lines of their own. Inside texts
and roles a backslash goes before each ``\\``, ``#`` and ``<`` (in roles also before a line break), so no
text can hold a marker, and dropping those backslashes gives the text back.

Prefix sums of the turns' tokens cut a conversation into cells of ``budget - 2 * reserve`` tokens. A
window's new turns are those that start in a cell; a turn that runs over the cell's end stays if
the window still holds it, else it gets a window of its own. So windows are turn-aligned and keep to
the budget unless one turn alone is longer. Before its new turns a window repeats the conversation's
first turn if that is a system turn of at most ``reserve`` tokens, and the last turns before it, up
to ``reserve`` tokens. The loss mask covers the texts of assistant turns, but not where they are
repeated: each target counts once.

Tokens are counted natively: a run of word characters or any other visible character is one.

All of it is DataFrame functions. A conversation of any length spreads over tasks: prefix sums run
per sorted part, and repeated turns meet their windows by (conversation, stretch of tokens).

Defined cases: turns are ordered by turn number (nulls first), then role and text. A null text or
role is empty. Rows repeated are turns repeated. Rows without conversation id are one conversation.
Other columns are ignored. An empty table gives no windows.
"""

import uuid

from pyspark.sql import Window, functions as F

from basketlens.llm.ordered import running_totals
from basketlens.llm.registry import query, table
from basketlens.sources.staging import remember, shared_folder

BUDGET = 1024
RESERVE = 256
TARGET_ROLE = "assistant"
SYSTEM_ROLE = "system"
HEAD, TAIL = "### ", "\n</turn>\n"
TOKEN = r"\w+|[^\w\s]"
WINDOWS_AT_ONCE = 64


def escape(text):
    return F.regexp_replace(text, r"([\\#<])", r"\\$1")


def escape_role(role):
    return F.regexp_replace(role, r"([\\#<\n])", r"\\$1")


def unescape(text):
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_windows(turns, conversation="conv_id", turn="turn", role="role", text="text", budget=BUDGET, reserve=RESERVE):
    """(conversation, window, n_turns, n_repeated, tokens, text, loss_spans), one row per window.

    ``loss_spans`` are (start, end) in code points of the window's text. Windows of a conversation
    follow each other by number; the numbers have gaps.
    """
    rows = turns.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"),
                        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    header = F.concat(F.lit(HEAD), escape_role("role"), F.lit("\n"))
    rows = (rows.withColumn("header", header).withColumn("body", escape("text"))
            .withColumn("piece", F.concat("header", "body", F.lit(TAIL)))
            .withColumn("tokens", F.regexp_count("piece", F.lit(TOKEN)).cast("long"))
            .select("conv", "turn", "role", "text", "piece", "tokens", F.length("header").alias("skip"),
                    F.length("body").alias("width")))
    rows = running_totals(rows, "conv", ["turn", "role", "text"], "tokens")
    cell = budget - 2 * reserve
    rows = rows.withColumn("cell", F.floor(F.col("before") / cell))
    first = F.min("before").over(Window.partitionBy("conv", "cell"))
    fits = F.col("before") + F.col("tokens") - first <= cell
    rows = rows.withColumn("window", F.col("cell") * 2 + F.when(fits, 0).otherwise(1))
    kept_system = (F.col("position") == 0) & (F.col("role") == SYSTEM_ROLE) & (F.col("tokens") <= reserve)
    rows = rows.select("conv", "window", "position", "before", "tokens", "piece", "skip", "width",
                       (F.col("role") == TARGET_ROLE).alias("target"), kept_system.alias("system"))

    piece = ["position", "tokens", "piece", "skip", "width"]
    new = rows.select("conv", "window", *piece, "target", F.lit(False).alias("repeated"))
    repeated = [F.lit(False).alias("target"), F.lit(True).alias("repeated")]
    later = rows.groupBy("conv", "window").agg(F.min("before").alias("start")).where("start > 0")
    # A repeated turn starts at most ``reserve`` tokens before its window: one of two stretches.
    stretch = F.explode(F.array_distinct(F.array(F.floor(F.greatest(F.col("start") - reserve, F.lit(0)) / reserve),
                                                 F.floor((F.col("start") - 1) / reserve))))
    wanting = later.select(F.col("conv").alias("c"), F.col("window").alias("to"), "start", stretch.alias("s"))
    history = (rows.where(~F.col("system")).withColumn("stretch", F.floor(F.col("before") / reserve)).drop("window")
               .join(wanting, F.col("conv").eqNullSafe(F.col("c")) & (F.col("stretch") == F.col("s")))
               .where((F.col("before") >= F.col("start") - reserve) & (F.col("before") + F.col("tokens") <= F.col("start")))
               .select("conv", F.col("to").alias("window"), *piece, *repeated))
    system = (rows.where("system").drop("window")
              .join(later.select(F.col("conv").alias("c"), F.col("window").alias("to")), F.col("conv").eqNullSafe(F.col("c")))
              .select("conv", F.col("to").alias("window"), *piece, *repeated))
    # A window's turns: as many as its budget holds.
    packed = (new.unionByName(history).unionByName(system).groupBy("conv", "window")
              .agg(F.array_sort(F.collect_list(F.struct("position", "repeated", "tokens", "skip", "width", "target", "piece")))
                   .alias("turns")))

    def step(state, x):
        start = state["at"] + x["skip"]
        span = F.struct(start.alias("start"), (start + x["width"]).alias("end"))
        return F.struct((state["at"] + F.length(x["piece"])).alias("at"),
                        F.when(x["target"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("ARRAY<STRUCT<start: INT, end: INT>>").alias("spans"))
    return packed.select(
        F.col("conv").alias(conversation), "window", F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("turns", lambda x: x["repeated"])).cast("long").alias("n_repeated"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda s, x: s + x["tokens"]).alias("tokens"),
        F.array_join(F.transform("turns", lambda x: x["piece"]), "").alias("text"),
        F.aggregate("turns", nothing, step, lambda s: s["spans"]).alias("loss_spans"))


def read_turns(windows):
    """The windows with ``turns``, their new turns (role, text), and ``targets``, the texts under the mask."""
    parts = F.split("text", TAIL, -1)
    fresh = F.slice(parts, (F.col("n_repeated") + 1).cast("int"), (F.col("n_turns") - F.col("n_repeated")).cast("int"))

    def decoded(part):
        role = F.regexp_extract(part, r"(?s)^### ([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n", 1)
        body = F.substring(part, F.length(role) + len(HEAD) + 2, F.length(part))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    masked = F.transform("loss_spans", lambda s: unescape(F.substring("text", s["start"] + 1, s["end"] - s["start"])))
    return windows.withColumn("turns", F.transform(fresh, decoded)).withColumn("targets", masked)


def conversation_digests(windows, conversation="conv_id"):
    """Per conversation: its turns and targets, joined in order and hashed, and sizes.

    Runs of windows are joined before whole conversations, so the last step has few rows.
    """
    read = read_turns(windows).select(
        F.col(conversation).alias("conv"), "window", F.size("turns").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join("targets", "").alias("loss"), F.length("text").cast("long").alias("chars"))

    def joined(frame, keys, order):
        ordered = frame.groupBy(*keys).agg(
            F.array_sort(F.collect_list(F.struct(order, "turns", "loss"))).alias("x"),
            F.sum("n").alias("n"), F.sum("chars").alias("chars"))
        return ordered.select(*keys, "n", "chars", F.array_join(F.col("x.turns"), "").alias("turns"),
                              F.array_join(F.col("x.loss"), "").alias("loss"))

    runs = joined(read.withColumn("run", F.floor(F.col("window") / WINDOWS_AT_ONCE)), ["conv", "run"], "window")
    whole = joined(runs, ["conv"], "run")
    return whole.select(F.col("conv").alias(conversation), F.col("n").cast("long").alias("n_turns"),
                        F.sha2("turns", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                        F.sha2("loss", 256).alias("loss_sha256"), F.col("chars").cast("long").alias("formatted_chars"))


@query("op1_chat_format")
def op1(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    path = remember(spark, f"{shared_folder(spark)}/windows/{uuid.uuid4().hex}")
    format_windows(turns.unionByName(extra)).write.parquet(path)
    return conversation_digests(spark.read.parquet(path))
