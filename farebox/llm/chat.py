"""Chat formatting: a finite-state machine checks turn order, a declarative template emits segments.

Each turn becomes three segments: a header, the escaped text, an end marker. Only
the text segment of roles with ``loss`` carries the loss flag. Texts are escaped
so that no control string of the template can occur inside them, and unescaping
gives them back exactly.

Turns are ordered by ``turn`` (null first), then role, then text; ties that agree
on all three are copies and interchangeable. Null text and null role count as
empty. Rows with a null conversation id form one conversation. A conversation
that the machine rejects is formatted all the same, with ``valid`` false and the
place of the first refused turn in ``refused_at`` (0-based; one past the last
turn if it ends where it may not; null if valid). A conversation is one output
row, so it must fit in a task; nothing else is gathered. An empty table gives no
conversation; columns beside conv_id, turn, role and text are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import let


@dataclass(frozen=True)
class Template:
    """Markers, roles under the loss, and the machine: state -> {role: next state}."""

    head: str = "### "
    head_end: str = ":\n"
    turn_end: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accept: tuple[str, ...] = ("asked", "answered")
    moves: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "instructed", "user": "asked"},
        "instructed": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })
    #: Control characters and their escapes; the escape character comes first, no code holds a control character.
    codes: tuple[tuple[str, str], ...] = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
    #: Further codes inside a role, which ends at the first colon.
    role_codes: tuple[tuple[str, str], ...] = ((":", "\\c"),)


DEFAULT = Template()
REFUSED = "refused"


def escape(text: Column, codes: tuple[tuple[str, str], ...]) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, codes: tuple[tuple[str, str], ...]) -> Column:
    """Each escape character starts one code, so codes can go one after another, its own code last."""
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _segments(turns: Column, t: Template) -> Column:
    def of(x: Column) -> Column:
        def part(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            part(F.concat(F.lit(t.head), escape(x["role"], t.codes + t.role_codes), F.lit(t.head_end)), F.lit(False)),
            part(escape(x["text"], t.codes), x["role"].isin(*t.loss_roles)),
            part(F.lit(t.turn_end), F.lit(False)))
    return F.flatten(F.transform(turns, of))


def _run_machine(turns: Column, t: Template) -> Column:
    """struct(state, at): where the machine ends and how many turns it took before refusing."""
    arcs = F.create_map(*[F.lit(x) for state, by_role in t.moves.items()
                          for role, to in by_role.items() for x in (f"{state}>{role}", to)])

    def step(acc: Column, x: Column) -> Column:
        to = F.coalesce(F.try_element_at(arcs, F.concat(acc["state"], F.lit(">"), x["role"])), F.lit(REFUSED))
        return F.struct(to.alias("state"), (acc["at"] + F.when(to == REFUSED, 0).otherwise(1)).alias("at"))

    return F.aggregate(turns, F.struct(F.lit(t.start).alias("state"), F.lit(0).alias("at")), step)


def format_conversations(rows: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conversation: conv_id, segments array<struct<text, loss>>, formatted, valid, refused_at.

    One shuffle on conv_id; everything after it is a projection.
    """
    t = template
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    grouped = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.collect_list("t").alias("ts"))
    made = grouped.select("conv_id", let(F.array_sort("ts"), lambda ts: F.struct(
        _segments(ts, t).alias("segments"), _run_machine(ts, t).alias("end"))).alias("m"))
    ok = F.col("m.end.state").isin(*t.accept)
    return made.select(
        "conv_id", F.col("m.segments").alias("segments"),
        F.array_join(F.transform("m.segments", lambda s: s["text"]), "").alias("formatted"),
        ok.alias("valid"), F.when(~ok, F.col("m.end.at")).alias("refused_at"))


def read_turns(formatted: Column, template: Template = DEFAULT) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    t = template

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, t.head_end, 1)
        return F.struct(
            unescape(F.substr(role, F.lit(len(t.head) + 1)), t.codes + t.role_codes).alias("role"),
            unescape(F.substr(piece, F.char_length(role) + len(t.head_end) + 1), t.codes).alias("text"))

    return let(F.split(formatted, t.turn_end.replace(".", "\\.")), lambda p: F.transform(
        F.slice(p, 1, F.size(p) - 1), turn))


def read_loss_text(segments: Column, template: Template = DEFAULT) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescape(s["text"], template.codes)), "")
