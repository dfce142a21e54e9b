"""Chat formatting: a finite-state machine over roles, and a declarative template with per-segment loss flags.

Texts are escaped so that no control character of the template is left in them: the escape character and each first
character of a control string become the escape character and a digit. Splitting at the control strings therefore
reads every turn back, whatever the texts hold.

Defined cases: a null role or text is empty; turns are ordered by (turn, role, text), nulls first, so repeated rows
and ties have one order; a null ``conv_id`` is a conversation of its own; an unknown role leads to the state
``error``, and the conversation is formatted all the same with ``valid`` false. One conversation is one value, as
its digest needs; conversations are spread over tasks.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    opening: str = "### "
    after_role: str = ": "
    closing: str = "</turn>\n"
    escape: str = "\\"
    learned: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accepting: tuple[str, ...] = ("assistant",)
    # state -> roles that may follow; the state after a turn is its role
    transitions: dict = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})

    def specials(self) -> str:
        return "".join(dict.fromkeys(self.escape + self.opening[0] + self.after_role[0] + self.closing[0]))


TEMPLATE = Template()


def escaped(text: Column, template: Template = TEMPLATE) -> Column:
    for i, c in enumerate(template.specials()):
        text = F.replace(text, F.lit(c), F.lit(f"{template.escape}{i}"))
    return text


def unescaped(text: Column, template: Template = TEMPLATE) -> Column:
    for i, c in reversed(list(enumerate(template.specials()))):
        text = F.replace(text, F.lit(f"{template.escape}{i}"), F.lit(c))
    return text


def final_state(roles: Column, template: Template = TEMPLATE) -> Column:
    """The state after all roles; ``error`` absorbs."""
    moves = F.create_map(*[F.lit(x) for state, follow in template.transitions.items()
                           for role in follow for x in (f"{state}\x00{role}", role)])
    step = lambda state, role: F.coalesce(F.element_at(moves, F.concat(state, F.lit("\x00"), role)), F.lit("error"))
    return F.aggregate(roles, F.lit(template.start), step)


def format_chats(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, ``segments`` (text, loss), ``formatted``, ``final_state`` and ``valid`` per conversation.

    ``segments`` joined are ``formatted``; only texts of the learned roles carry ``loss``.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(F.transform("turns", lambda t: F.array(
        segment(F.concat(F.lit(template.opening), escaped(t["role"], template), F.lit(template.after_role)), F.lit(False)),
        segment(escaped(t["text"], template), t["role"].isin(*template.learned)),
        segment(F.lit(template.closing), F.lit(False)))))
    state = final_state(F.transform("turns", lambda t: t["role"]), template)
    # The array passes through a generator, so that it is built once for all that reads it.
    return (chats.select("conv_id", F.inline(F.array(F.struct(segments.alias("segments"), state.alias("final_state")))))
            .select("conv_id", "segments", F.array_join(F.col("segments.text"), "").alias("formatted"), "final_state",
                    F.col("final_state").isin(*template.accepting).alias("valid")))


def turns_of(formatted: Column, template: Template = TEMPLATE) -> Column:
    """The (role, text) of all turns, read back from a formatted conversation."""
    parts = F.split(formatted, r"\Q" + template.closing + r"\E")
    def turn(part):
        role = F.substring_index(part, template.after_role, 1)
        skipped = F.length(role) + len(template.after_role)
        return F.struct(
            unescaped(F.substr(role, F.lit(len(template.opening) + 1)), template).alias("role"),
            unescaped(F.substr(part, skipped + 1), template).alias("text"))
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)


def loss_text(segments: Column, template: Template = TEMPLATE) -> Column:
    """All text under the loss mask, unescaped."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescaped(s["text"], template)), "")
