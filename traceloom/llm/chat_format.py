"""Chat formatting: a finite-state machine over roles and a declarative template.

DataFrame functions only. A conversation becomes text segments with loss flags;
the formatted text is their concatenation. Control strings cannot occur inside
texts, because every ``&``, ``<``, ``[`` and ``>`` of a text is written as an
entity, so turns can be read back from the formatted text alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template (role: opening, closing, whether its text is trained on), the
# states (state: role: next state) and the entities.
TEMPLATE = {"system": ("<<SYS>>", "<</SYS>>", False), "user": ("[INST]", "[/INST]", False), "assistant": ("<a>", "</s>", True)}
OTHER = ("<role:", "</role>")
STATES = {"start": {"system": "ready", "user": "asked"}, "ready": {"user": "asked"}, "asked": {"assistant": "answered"}, "answered": {"user": "asked"}}
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"), (">", "&gt;"))


def escape(c: Column) -> Column:
    for plain, entity in ENTITIES:
        c = F.replace(c, F.lit(plain), F.lit(entity))
    return c


def unescape(c: Column) -> Column:
    for plain, entity in reversed(ENTITIES):
        c = F.replace(c, F.lit(entity), F.lit(plain))
    return c


def _by_role(role: Column, k: int, other: Column) -> Column:
    c = other
    for name, parts in TEMPLATE.items():
        c = F.when(role == name, F.lit(parts[k])).otherwise(c)
    return c


def valid_order(roles: Column) -> Column:
    """Whether the machine accepts an array of roles."""

    def step(state: Column, role: Column) -> Column:
        c = F.lit("bad")
        for s, to in STATES.items():
            for r, nxt in to.items():
                c = F.when((state == s) & (role == r), F.lit(nxt)).otherwise(c)
        return c

    return ~F.aggregate(roles, F.lit("start"), step).isin("bad", "start")


def format_chats(rows: DataFrame) -> DataFrame:
    """(conv_id, valid, segments, formatted) of every conversation, in order of turn.

    ``segments`` are structs of text and loss. Null text and null role count as
    empty; roles without a template get a generic tag; turns with one number
    follow role, then text. A conversation whose roles the machine rejects is
    formatted all the same and marked not valid. A null conv_id is a
    conversation of its own. No rows give no rows. Only conv_id, turn, role and
    text are read.
    """
    turns = rows.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments(t: Column) -> Column:
        role = t["role"]
        opening = _by_role(role, 0, F.concat(F.lit(OTHER[0]), escape(role), F.lit(">")))
        return F.array(
            F.struct(opening.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), _by_role(role, 2, F.lit(False)).alias("loss")),
            F.struct(_by_role(role, 1, F.lit(OTHER[1])).alias("text"), F.lit(False).alias("loss")),
        )

    out = chats.select("conv_id", valid_order(F.col("turns.role")).alias("valid"), F.flatten(F.transform("turns", segments)).alias("segments"))
    return out.withColumn("formatted", F.array_join("segments.text", ""))


def read_back(formatted: str = "formatted") -> Column:
    """Array of (role, text) of a formatted conversation."""
    pattern = r"(<<SYS>>|\[INST\]|<a>|<role:[^>]*>)([^<\[]*)(?:<</SYS>>|\[/INST\]|</s>|</role>)"
    opening, body = (F.regexp_extract_all(F.col(formatted), F.lit(pattern), F.lit(k)) for k in (1, 2))

    def turn(tag: Column, text: Column) -> Column:
        role = unescape(F.substr(tag, F.lit(len(OTHER[0]) + 1), F.length(tag) - len(OTHER[0]) - 1))
        for name, parts in TEMPLATE.items():
            role = F.when(tag == parts[0], F.lit(name)).otherwise(role)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.zip_with(opening, body, turn)


def chat_digest(rows: DataFrame) -> DataFrame:
    """What is read back from the formatted conversations, as digests."""
    chats = format_chats(rows).withColumn("back", read_back())
    lossy = unescape(F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"]), ""))
    line = F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    chats = chats.withColumn("lossy", lossy)
    return chats.select("conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"), F.length("lossy").cast("long").alias("loss_chars"), F.sha2("lossy", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "valid")
