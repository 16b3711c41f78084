"""Chat formatting with Spark expressions only.

Template::

    <s>[role]text<+>text</s>[role]text</s>

Adjacent turns of one role share a block, joined by ``<+>``. Inside roles and texts the characters
that control strings are made of are written ``\\s`` (backslash), ``\\l`` (<), ``\\b`` ([) and
``\\e`` (]), so no text can forge a marker and every text reads back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def escape(c: Column) -> Column:
    for raw, code in (("\\", "\\s"), ("<", "\\l"), ("[", "\\b"), ("]", "\\e")):
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for raw, code in (("<", "\\l"), ("[", "\\b"), ("]", "\\e"), ("\\", "\\s")):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def _step(array: Column | str) -> Column:
    """Elements per step of two-level work on an array: the root of its size."""
    return F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(array)))).cast("int")


def _with_ends(df: DataFrame, lengths: str) -> DataFrame:
    """Adds ``ends``: running sums of the int array ``lengths`` in two levels, sqrt(n) additions for each element.

    Every array that a lambda reads is a column of its own and is referenced twice: an expression that
    the optimizer moved into the lambda would be computed again for each element.
    """
    total = lambda array: F.aggregate(array, F.lit(0).cast("long"), lambda a, x: a + x)
    step = F.col("step")
    stepped = df.withColumn("step", _step(lengths)).withColumn(
        "steps", F.transform(F.sequence(F.lit(0), F.size(lengths) - 1, step), lambda s: total(F.slice(lengths, s + 1, step)))
    )
    summed = stepped.withColumn("earlier", F.transform("steps", lambda _, i: total(F.slice("steps", F.lit(1), i))))

    def upto(i: Column) -> Column:
        whole = F.least(F.floor(i / step).cast("int"), F.size("earlier") - 1)
        return F.get("earlier", whole) + total(F.slice(lengths, whole * step + 1, i - whole * step + 1))

    return summed.withColumn("ends", F.transform(lengths, lambda _, i: upto(i)))


def format_chat(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: str = "assistant"
) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans array<struct<start,len>>``.

    Turns are ordered by (turn, role, text), null turns first; repeated rows stay as turns of their
    own. Null roles and texts count as empty; a null conversation id is a conversation. An empty table
    gives no rows; other columns are ignored. Spans are in code points of ``formatted``, one for each
    turn of role ``learn``. A conversation's turns meet in one value because the output is one string;
    no other grouping takes place.
    """
    blank = F.lit("")
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            escape(F.coalesce(F.col(role), blank)).alias("role"),
            escape(F.coalesce(F.col(text), blank)).alias("text"),
        ).alias("t"),
    )
    t = F.col("t")
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    opens = lambda i: (i == 0) | (t[i]["role"] != t[F.greatest(i - 1, F.lit(0))]["role"])
    starts = grouped.withColumn("starts", F.filter(F.sequence(F.lit(0), F.size("t") - 1), opens))
    blocks = starts.withColumn(
        "blocks",
        F.transform(
            "starts",
            lambda s, k: F.concat(
                F.lit("["),
                t[s]["role"],
                F.lit("]"),
                F.array_join(
                    F.transform(
                        F.slice(t, s + 1, F.coalesce(F.get("starts", k + 1), F.size(t)) - s), lambda x: x["text"]
                    ),
                    "<+>",
                ),
            ),
        ),
    )
    before = lambda x, i: F.when(
        opens(i), F.length(x["role"]) + 2 + F.when(i == 0, 3).otherwise(4)
    ).otherwise(3)
    measured = blocks.withColumn("lengths", F.transform(t, lambda x, i: before(x, i) + F.length(x["text"])))
    placed = _with_ends(measured, "lengths")
    spans = F.transform(
        F.filter(F.arrays_zip("t", "ends"), lambda z: z["t"]["role"] == escape(F.lit(learn))),
        lambda z: F.struct(
            (z["ends"] - F.length(z["t"]["text"])).alias("start"), F.length(z["t"]["text"]).cast("long").alias("len")
        ),
    )
    return placed.select(
        "conv_id",
        F.concat(F.lit("<s>"), F.array_join("blocks", "</s>"), F.lit("</s>")).alias("formatted"),
        spans.alias("loss_spans"),
    )


def parse_chat(formatted: Column) -> Column:
    """The turns of a formatted conversation, ``array<struct<role,text>>``, as they were before formatting."""
    body = F.substring(formatted, F.lit(4), F.length(formatted) - 7)
    return F.flatten(
        F.transform(
            F.split(body, "</s>"),
            lambda b: F.transform(
                F.split(F.substr(b, F.instr(b, "]") + 1), "<\\+>"),
                lambda x: F.struct(
                    unescape(F.substr(b, F.lit(2), F.instr(b, "]") - 2)).alias("role"), unescape(x).alias("text")
                ),
            ),
        )
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between.

    A place in a string is found by counting from its start, so spans are read off in steps: one piece of
    the whole for the root of their number, and the spans off that piece.
    """
    step = _step(spans)
    first = lambda own: F.get(own, F.lit(0))["start"]
    reach = lambda own: F.element_at(own, -1)["start"] + F.element_at(own, -1)["len"] - first(own)
    cut = lambda text, start, size: F.substr(text, (start + 1).cast("int"), size.cast("int"))
    stepped = F.transform(F.sequence(F.lit(0), F.size(spans) - 1, step), lambda s: F.slice(spans, s + 1, step))
    pieces = F.transform(stepped, lambda own: F.struct(own.alias("own"), cut(formatted, first(own), reach(own)).alias("piece")))
    texts = F.transform(
        pieces, lambda p: F.array_join(F.transform(p["own"], lambda s: unescape(cut(p["piece"], s["start"] - first(p["own"]), s["len"]))), "")
    )
    return F.when(F.size(spans) > 0, F.array_join(texts, "")).otherwise("")
