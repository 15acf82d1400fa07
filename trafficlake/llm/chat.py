r"""Chat formatting in budgeted windows.

Prefix sums of turn tokens place each turn of a conversation; the turns that start in the same stretch of
``stride`` tokens form a window, so windows are aligned to turns and no turn is cut. From the second window
on the system turn is retained and a limited history repeated; only assistant turns that are not repeated
are under the loss mask, so each is a target exactly once.

A turn is written ``<|im_start|>role\ntext<|im_end|>\n``. Inside roles and texts a backslash is doubled and
``<|`` becomes ``<\|``, in roles a line feed becomes a backslash and a line feed; so control strings occur
at turn borders only, and dropping the backslash before any character gives the original back.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficlake.llm.common import staged

START, END = "<|im_start|>", "<|im_end|>\n"
#: Tokens of a window's new turns, before the last turn that starts in it.
STRIDE = 512
#: Turns before a window that are repeated in it at most, and the tokens they may take.
HISTORY_TURNS = 2
HISTORY_TOKENS = 192

#: Prefix sums are made by blocks of turn numbers, so that a very long conversation is many groups.
_BLOCK = 256


def token_count(text: Column) -> Column:
    """An estimate that needs no vocabulary: four characters a token, and four tokens for the marks."""
    return (F.ceil(F.length(text) / 4) + 4).cast("bigint")


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _placed(turns: DataFrame) -> DataFrame:
    """Turns with ``idx``, their number in the conversation, and ``at``, the tokens before them."""
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("tokens", token_count(F.col("text"))).withColumn("block", F.expr(f"turn div {_BLOCK}"))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("n", F.count("*").over(inside)).withColumn("sum", F.sum("tokens").over(inside))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(F.max("n").alias("n"), F.max("sum").alias("sum"))
    blocks = blocks.select(
        F.col("conv_id").alias("c"),
        F.col("block").alias("b"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("sum_before"),
    )
    placed = rows.join(blocks, rows["conv_id"].eqNullSafe(blocks["c"]) & rows["block"].eqNullSafe(blocks["b"]))
    return placed.select(
        "conv_id",
        (F.col("n_before") + F.col("n") - 1).alias("idx"),
        (F.col("sum_before") + F.col("sum") - F.col("tokens")).alias("at"),
        "role",
        "text",
    )


def format_conversations(
    turns: DataFrame, stride: int = STRIDE, history_turns: int = HISTORY_TURNS, history_tokens: int = HISTORY_TOKENS
) -> DataFrame:
    """One row per window of a conversation in ``turns`` (conv_id, turn, role, text; other columns are
    ignored): conv_id, window, text, repeated (how many turns at the front are repetitions) and loss, an
    array of (start, end) code point offsets of the targets.

    Turns are taken by turn, role and text; every row is one turn, repeated rows too. Null roles and texts
    are empty, a null turn comes first, the rows without conv_id are one conversation. A turn longer than
    the stride has a window to itself. No rows give no rows.
    """
    placed = staged(_placed(turns).withColumn("window", F.floor(F.col("at") / stride)), "chat-turns")
    starts = placed.groupBy("conv_id", "window").agg(F.min("idx").alias("first"), F.min("at").alias("first_at"))
    recent = F.sequence(F.greatest(F.col("first") - history_turns, F.lit(0)), F.col("first") - 1)
    again = starts.where("first > 0").select(
        F.col("conv_id").alias("c"),
        F.col("window").alias("w"),
        "first_at",
        "first",
        F.explode(F.array_union(F.array(F.lit(0).cast("bigint")), recent)).alias("i"),
    )
    known = placed.drop("window")
    again = again.join(known, again["c"].eqNullSafe(known["conv_id"]) & (again["i"] == known["idx"]))
    system = (F.col("idx") == 0) & (F.col("role") == "system")
    near = (F.col("first") - F.col("idx") <= history_turns) & (F.col("first_at") - F.col("at") <= history_tokens)
    again = again.where(system | near).select("conv_id", F.col("w").alias("window"), "idx", "role", "text", F.lit(1).alias("again"))
    rows = placed.select("conv_id", "window", "idx", "role", "text", F.lit(0).alias("again")).unionByName(again)

    role = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\\n"))
    rows = rows.withColumn("head", F.concat(F.lit(START), role, F.lit("\n"))).withColumn("body", escaped(F.col("text")))
    length = F.length("head") + F.length("body") + len(END)
    order = Window.partitionBy("conv_id", "window").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    begin = (F.sum(length).over(order) - len(END) - F.length("body")).cast("bigint")
    target = (F.col("role") == "assistant") & (F.col("again") == 0)
    rows = rows.withColumn("begin", begin).select(
        "conv_id",
        "window",
        "again",
        F.struct(
            "idx",
            F.concat("head", "body", F.lit(END)).alias("piece"),
            F.when(target, F.struct(F.col("begin").alias("start"), (F.col("begin") + F.length("body")).alias("end"))).alias("span"),
        ).alias("one"),
    )
    windows = rows.groupBy("conv_id", "window").agg(F.sum("again").alias("repeated"), F.array_sort(F.collect_list("one")).alias("all"))
    return windows.select(
        "conv_id",
        "window",
        F.array_join(F.col("all.piece"), "").alias("text"),
        "repeated",
        F.array_compact(F.col("all.span")).alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, window, formatted_chars, turns, targets) from formatted windows: the turns that are not repeated, as
    (role, text), and the texts under the loss mask, all with the escapes undone."""
    parts = F.split("text", r"<\|im_start\|>")
    turn = r"(?s)^((?:[^\\\n]++|\\.)*+)\n(.*)$"

    def parsed(part: Column) -> Column:
        inner = F.left(part, F.length(part) - len(END))
        return F.struct(
            unescaped(F.regexp_extract(inner, turn, 1)).alias("role"), unescaped(F.regexp_extract(inner, turn, 2)).alias("text")
        )

    def masked(span: Column) -> Column:
        return unescaped(F.substring(F.col("text"), (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int")))

    new = F.slice(parts, (F.col("repeated") + 2).cast("int"), F.size(parts))
    return windows.select(
        "conv_id",
        "window",
        F.length("text").alias("formatted_chars"),
        F.transform(new, parsed).alias("turns"),
        F.transform("loss", masked).alias("targets"),
    )


def digests(windows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of formatted windows, from
    what ``read_back`` finds in them. A digest is of one conversation's whole text, so that text meets in
    one row."""
    one = F.struct(
        "window",
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join("targets", "").alias("targets"),
    )
    rows = read_back(windows).select("conv_id", F.size("turns").alias("n"), "formatted_chars", one.alias("one"))
    whole = rows.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sum("formatted_chars").alias("formatted_chars"),
        F.array_sort(F.collect_list("one")).alias("all"),
    )
    targets = F.array_join(F.col("all.targets"), "")
    return whole.select(
        "conv_id",
        F.col("n_turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.col("all.turns"), ""), 256).alias("turns_sha256"),
        F.length(targets).cast("bigint").alias("loss_chars"),
        F.sha2(targets, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("bigint").alias("formatted_chars"),
    )
