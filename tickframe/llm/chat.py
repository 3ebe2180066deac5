"""Chat formatting with schema fingerprints.

A layout is declared by the nested field paths it needs and the expression
that turns a row into canonical turns (``array<struct<role,text>>``, or one
turn of a conversation told in rows). A table's paths are hashed to a
fingerprint which selects the mapping. In a table that mixes layouts (fields
of absent layouts null), every row's own fingerprint, the hash of the paths
present in it, selects among the mappings.

The template is ``[INST]role[/INST]text</s>``. Control strings inside roles
and texts are escaped by a backslash after their first character, backslashes
are doubled; ``unescape`` reverses that exactly. Everything is SQL functions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BEGIN, MIDDLE, END = "[INST]", "[/INST]", "</s>"

#: Control strings of this and other common templates (fixed values).
CONTROL = ("[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>", "<|")


def escape(text: Column) -> Column:
    """Double backslashes, then put one inside every control string. Between the
    first and the second character of a control string an escaped text has one
    backslash, or an even number where the text itself had some."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    out = text
    for c in reversed(CONTROL):
        out = F.replace(out, F.lit(c[0] + "\\" + c[1:]), F.lit(c))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


# ------------------------------------------------------------------ layouts

@dataclass(frozen=True)
class Layout:
    """``paths``: nested fields, ``[]`` for array elements. ``turns``: row ->
    array of (role, text); for a layout of one turn a row, ``turn`` names the
    columns (conversation, turn, role, text) instead."""
    name: str
    paths: tuple[str, ...]
    turns: Callable[[], Column] | None = None
    turn: tuple[str, str, str, str] | None = None

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


def fingerprint(paths: Iterable[str]) -> str:
    return sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.cast("string").alias("role"),
                    F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _pair(ask: str, answer: str) -> Callable[[], Column]:
    return lambda: F.array(_turn(F.lit("user"), F.col(ask)), _turn(F.lit("assistant"), F.col(answer)))


def _instruction() -> Column:
    given = F.coalesce(F.col("input"), F.lit(""))
    ask = F.when(given == "", F.coalesce(F.col("instruction"), F.lit(""))).otherwise(
        F.concat_ws("\n\n", F.col("instruction"), given))
    return F.array(_turn(F.lit("user"), ask), _turn(F.lit("assistant"), F.col("output")))


def _messages(column: str, role: str, text: str, names: dict[str, str]) -> Callable[[], Column]:
    def known(r: Column) -> Column:
        out = r
        for a, b in names.items():
            out = F.when(r == a, F.lit(b)).otherwise(out)
        return out
    return lambda: F.transform(F.col(column), lambda m: _turn(known(m[role]), m[text]))


#: Role names of the from/value layout (fixed values).
SPEAKERS = {"human": "user", "gpt": "assistant"}

LAYOUTS = (
    Layout("turn rows", ("conv_id", "turn", "role", "text"), turn=("conv_id", "turn", "role", "text")),
    Layout("messages", ("messages[].role", "messages[].content"),
           _messages("messages", "role", "content", {})),
    Layout("from/value", ("conversations[].from", "conversations[].value"),
           _messages("conversations", "from", "value", SPEAKERS)),
    Layout("instruction/input", ("instruction", "input", "output"), _instruction),
    Layout("instruction", ("instruction", "output"), _pair("instruction", "output")),
    Layout("prompt/completion", ("prompt", "completion"), _pair("prompt", "completion")),
    Layout("prompt/response", ("prompt", "response"), _pair("prompt", "response")),
)


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Paths of all leaves: ``a.b`` for structs, ``a[].b`` for arrays."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


def _match(df: DataFrame, layouts: Iterable[Layout]) -> list[Layout]:
    have = set(field_paths(df.schema))
    return [x for x in layouts if set(x.paths) <= have]


def _root(path: str) -> str:
    return path.split(".")[0].split("[")[0]


def to_turns(df: DataFrame, id_col: str = "id", layouts: Iterable[Layout] = LAYOUTS) -> DataFrame:
    """``conv_id, turn, role, text`` (and ``layout``) from any declared layout.

    The fingerprint of the table, the hash of the declared field paths it has, is looked
    up among those of the layouts; a table of one layout, turn rows included, is
    converted as such and its null fields read as empty. In a table that mixes layouts
    the fingerprint of each row (of the paths whose column it fills) selects its layout;
    where none fits, the layout of which the row fills the largest share (ties: the one
    declared first), with the rest read as empty. A row that fills no declared field, or
    has no turns, keeps one row with null turn, role and text, so nothing is dropped.
    Fields that no declared layout names are ignored. A table with none of the layouts
    is an error.
    """
    found = _match(df, layouts)
    if not found:
        raise ValueError("no declared layout has its fields in this table: "
                         + ", ".join(field_paths(df.schema)))
    known = sorted({p for x in found for p in x.paths})
    whole = {x.fingerprint: x for x in found}.get(fingerprint(known))
    if whole is not None and whole.turn:
        return _turn_rows(df, whole)
    if whole is not None:
        turns, name, own = whole.turns(), F.lit(whole.name), None
    else:
        filled = {p: F.col(f"`{_root(p)}`").isNotNull() for p in known}
        print_ = F.sha2(F.concat_ws("\n", *[F.when(filled[p], F.lit(p)) for p in known]), 256)
        share = {x.name: sum((F.when(filled[p], 1.0).otherwise(0.0) for p in x.paths), F.lit(0.0)) / len(x.paths)
                 for x in found}
        most = F.greatest(*share.values()) if len(share) > 1 else next(iter(share.values()))
        name = F.lit(None).cast("string")
        for x in reversed(found):
            name = F.when((share[x.name] == most) & (most > 0), F.lit(x.name)).otherwise(name)
        for x in found:
            name = F.when(print_ == x.fingerprint, F.lit(x.name)).otherwise(name)
        turns = F.lit(None)
        for x in found:
            turns = F.when(F.col("_name") == x.name, F.array(_turn(F.col(x.turn[2]), F.col(x.turn[3]))) if x.turn
                           else x.turns()).otherwise(turns)
        own = next((x for x in found if x.turn), None)
    conv = F.col(id_col) if id_col in df.columns or own is None else F.lit(None)
    at = F.col("_p").cast("bigint")
    out = df.select("*", name.alias("_name")).select(
        "_name", turns.alias("_t"), conv.alias("_id"), *([] if own is None else [
            F.col(own.turn[0]).alias("_conv"), F.col(own.turn[1]).cast("bigint").alias("_turn")]))
    conv = F.col("_id")
    if own is not None:
        mine = F.col("_name") == own.name
        same = out.schema["_conv"].dataType == out.schema["_id"].dataType
        conv = F.when(mine, F.col("_conv") if same else F.col("_conv").cast("string")).otherwise(
            conv if same else conv.cast("string"))
        at = F.when(mine, F.col("_turn")).otherwise(at)
    out = out.select("*", F.posexplode_outer("_t").alias("_p", "_e"))
    return out.select(conv.alias("conv_id"), at.alias("turn"), F.col("_e.role").alias("role"),
                      F.col("_e.text").alias("text"), F.col("_name").alias("layout"))


def _turn_rows(df: DataFrame, layout: Layout) -> DataFrame:
    conv, turn, role, text = layout.turn
    return df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.lit(layout.name).alias("layout"))


# ------------------------------------------------------------------ template

def format_chat(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, marks``: the formatted conversation and, per turn,
    its start and the span under the loss mask, in code points of ``formatted``.

    Turns are ordered by (turn, role, text), nulls first; repeated rows stay. A
    null role formats as an empty one, a null text as an empty text. A null
    conversation id is a conversation. One conversation is one row, as its text
    has to be.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(BEGIN), escape(role), F.lit(MIDDLE))
    body = escape(text)
    t = turns.select("conv_id", "turn", F.col("role").alias("r"), F.col("text").alias("x"),
                     head.alias("head"), body.alias("body"),
                     F.coalesce(F.col("role") == loss_role, F.lit(False)).alias("loss"))
    t = t.withColumn("piece", F.concat("head", "body", F.lit(END)))
    order = [F.col("turn").asc_nulls_first(), F.col("r").asc_nulls_first(), F.col("x").asc_nulls_first()]
    w = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.length("piece").cast("bigint")).over(w)
    t = (t.withColumn("n", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)))
         .withColumn("start", end - F.length("piece"))
         .withColumn("from", F.col("start") + F.length("head"))
         .withColumn("to", F.col("from") + F.when(F.col("loss"), F.length("body")).otherwise(0)))
    all_of = F.sort_array(F.collect_list(F.struct("n", "piece", "start", "from", "to")))
    g = t.groupBy("conv_id").agg(all_of.alias("p"))
    return g.select("conv_id", F.array_join(F.transform("p", lambda e: e["piece"]), "").alias("formatted"),
                    F.transform("p", lambda e: F.struct(e["start"].alias("start"), e["from"].alias("loss_from"),
                                                        e["to"].alias("loss_to"))).alias("marks"))


def read_chat(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns, loss_text, formatted``: the inverse of ``format_chat``,
    from its text and marks alone. ``turns`` is an array of (role, text);
    ``loss_text`` is the unescaped text under the loss mask."""
    pieces = F.slice(F.split("formatted", "</s>"), 1, F.size("marks"))
    df = formatted.withColumn("_z", F.arrays_zip(pieces.alias("piece"), F.col("marks")))

    def parsed(e: Column) -> Column:
        at = F.instr(e["piece"], F.lit(MIDDLE))
        return F.struct(
            unescape(F.substring(e["piece"], F.lit(len(BEGIN) + 1), at - F.lit(len(BEGIN) + 1))).alias("role"),
            unescape(F.substring(e["piece"], at + F.lit(len(MIDDLE)), F.length(e["piece"]))).alias("text"),
            unescape(F.substring(e["piece"],
                                 (e["marks"]["loss_from"] - e["marks"]["start"] + F.lit(1)).cast("int"),
                                 (e["marks"]["loss_to"] - e["marks"]["loss_from"]).cast("int"))).alias("loss"))

    df = df.withColumn("_t", F.transform("_z", parsed))
    return df.select("conv_id",
                     F.transform("_t", lambda e: F.struct(e["role"].alias("role"), e["text"].alias("text")))
                     .alias("turns"),
                     F.array_join(F.transform("_t", lambda e: e["loss"]), "").alias("loss_text"), "formatted")
