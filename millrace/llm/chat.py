r"""Chat formatting by grammar round trip, in SQL functions only.

Grammar: a turn is ``### `` role ``: `` text ``</turn>`` newline. Inside a role or text no
control string may stand; ``\`` begins an escape: ``\b`` a backslash, ``\e`` the end mark,
``\h`` the head mark, ``\c`` the colon mark of a role. The parser cuts at end marks, takes the
role up to the first colon mark and decodes escapes; it refuses a text with a control string.

A turn is rendered as it is, parsed again, and escaped if what comes back differs. Then the
whole conversation is parsed and compared with its source; if it still differs, every turn
of it is escaped. A conversation is one row: it is as long as its longest string may be (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, COLON, END = "### ", ": ", "</turn>"


def _escape(x: Column, role: bool = False) -> Column:
    x = F.replace(x, F.lit("\\"), F.lit("\\b"))
    x = F.replace(F.replace(x, F.lit(END), F.lit("\\e")), F.lit(HEAD), F.lit("\\h"))
    return F.replace(x, F.lit(COLON), F.lit("\\c")) if role else x


def unescape(x: Column) -> Column:
    for code, plain in (("\\c", COLON), ("\\h", HEAD), ("\\e", END), ("\\b", "\\")):
        x = F.replace(x, F.lit(code), F.lit(plain))
    return x


def _render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), role, F.lit(COLON), text, F.lit(END + "\n"))


def _parsed(piece: Column) -> Column:
    """Role and text of one turn; null where the grammar doesn't hold."""
    at = F.locate(COLON, piece)
    role, text = F.substring(piece, F.lit(len(HEAD) + 1), at - len(HEAD) - 1), F.substring(piece, at + len(COLON), F.length(piece))
    bad = ~F.startswith(piece, F.lit(HEAD)) | (at == 0)
    for x in (role, text):
        bad = bad | F.contains(x, F.lit(HEAD)) | F.contains(x, F.lit(END))
    return F.when(~bad, F.struct(unescape(role).alias("role"), unescape(text).alias("text")))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, text), an element null where the grammar is broken.

    What stands after the last end mark is a broken turn as well.
    """
    last = END + "\n"
    turns = F.transform(F.split(F.substring(formatted, F.lit(1), F.length(formatted) - len(last)), last, -1), _parsed)
    pieces = F.split(formatted, last, -1)
    broken = F.concat(F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), _parsed), F.array(F.when(F.lit(False), _parsed(F.lit("")))))
    none = F.filter(turns, lambda t: F.lit(False))
    return F.when(formatted == "", none).when(F.endswith(formatted, F.lit(last)), turns).otherwise(broken)


def format_conversations(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv, n_turns, formatted, layout, round_trip``.

    Turns are ordered by (turn, role, text), null turns first; null roles and texts are
    empty. ``layout`` has, per turn, its characters in ``formatted`` and where in them the
    text under the loss mask begins and how many characters it has (0 unless the role is
    ``learn``). ``round_trip`` says that parsing gives the source back. Rows of a null
    conversation id are one conversation; an empty table gives no rows.
    """
    rows = df.select(F.col(conv_col).alias("conv"), F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t"))
    convs = rows.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("source"))

    def rendered(everything: bool):
        def one(t: Column) -> Column:
            plain = _render(t["role"], t["text"])
            safe = parse(plain) == F.array(F.struct(t["role"].alias("role"), t["text"].alias("text")))
            role, text = _escape(t["role"], True), _escape(t["text"])
            escaped = F.struct(role.alias("role"), text.alias("text"))
            return escaped if everything else F.when(safe, F.struct(t["role"].alias("role"), t["text"].alias("text"))).otherwise(escaped)

        return F.transform("source", one)

    def whole(turns: str) -> Column:
        return F.array_join(F.transform(turns, lambda t: _render(t["role"], t["text"])), "")

    plain = F.transform("source", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    convs = convs.withColumn("turns", rendered(False)).withColumn("formatted", whole("turns"))
    convs = convs.withColumn("fits", F.coalesce(parse(F.col("formatted")) == plain, F.lit(False)))
    convs = convs.withColumn("turns", F.when(F.col("fits"), F.col("turns")).otherwise(rendered(True)))
    convs = convs.withColumn("formatted", F.when(F.col("fits"), F.col("formatted")).otherwise(whole("turns")))
    convs = convs.withColumn("round_trip", F.col("fits") | F.coalesce(parse(F.col("formatted")) == plain, F.lit(False)))
    extent = lambda t: F.struct(
        (F.length(t["role"]) + F.length(t["text"]) + len(HEAD + COLON + END) + 1).alias("chars"),
        (F.length(t["role"]) + len(HEAD + COLON)).alias("loss_start"),
        F.when(t["role"] == learn, F.length(t["text"])).otherwise(0).alias("loss_chars"),
    )
    return convs.select("conv", F.size("source").cast("long").alias("n_turns"), "formatted", F.transform("turns", extent).alias("layout"), "round_trip")


def read_back(formatted: DataFrame, *, learn: str = "assistant") -> DataFrame:
    """Formatted conversations -> ``conv, n_turns, turns, loss_text, formatted_chars``, from the formatted string alone: the loss is on the texts of role ``learn``."""
    turns = formatted.select("conv", parse(F.col("formatted")).alias("turns"), F.length("formatted").cast("long").alias("formatted_chars"))
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == learn), lambda t: t["text"]), "")
    return turns.select("conv", F.size("turns").cast("long").alias("n_turns"), "turns", loss.alias("loss_text"), "formatted_chars")
