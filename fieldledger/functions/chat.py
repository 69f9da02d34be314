"""Chat text: markers around each message."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldledger import fixed_values as fv
from fieldledger.functions.casts import strip
from fieldledger.functions.text import nonblank


@dataclass(frozen=True)
class ChatTemplate:
    """Markers of a chat format; `trim` strips each message before it is placed."""

    begin: str = fv.CHAT_BEGIN
    role_open: str = fv.CHAT_ROLE_OPEN
    role_close: str = fv.CHAT_ROLE_CLOSE
    after_role: str = "\n"
    end_of_turn: str = fv.CHAT_END_OF_TURN
    trim: bool = False

    def opening(self, role: Column) -> Column:
        return F.concat(F.lit(self.role_open), role, F.lit(self.role_close + self.after_role))

    def message(self, role: Column, content: Column) -> Column:
        body = strip(content) if self.trim else content
        return F.concat(self.opening(role), body, F.lit(self.end_of_turn))


# One record per text, and one conversation per text.
RECORD_CHAT = ChatTemplate()
CONVERSATION_CHAT = ChatTemplate(after_role="\n\n", trim=True)


def with_context(instruction: Column, input_text: Column, lead: str = fv.CONTEXT_LEAD) -> Column:
    """The instruction, followed by its input where that is not blank."""
    return F.when(nonblank(input_text), F.concat(instruction, F.lit(lead), input_text)).otherwise(instruction)


def chat_record(
    t: ChatTemplate, system: Column, instruction: Column, output: Column, default_system: str
) -> Column:
    """Chat text of one record; a missing system message takes the default."""
    return F.concat(
        F.lit(t.begin),
        t.message(F.lit("system"), F.coalesce(system, F.lit(default_system))),
        t.message(F.lit("user"), instruction),
        t.message(F.lit("assistant"), output),
    )


def message_list(system: Column | None, user: Column, assistant: Column | None = None) -> Column:
    """Array of `{role, content}`; a message whose content is NULL is left out."""
    given = [("system", system), ("user", user), ("assistant", assistant)]
    entries = [
        F.when(content.isNotNull(), F.struct(F.lit(role).alias("role"), content.alias("content")))
        for role, content in given
        if content is not None
    ]
    return F.array_compact(F.array(*entries))
