"""Chat records and their text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.strict_json import kind, member, member_text, spaced_json

# Fixed values -------------------------------------------------------------
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
SYSTEM_PROMPT = "你是一个AI助手"
USER_SOURCES = ("human",)
ASSISTANT_SOURCES = ("gpt", "assistant")
CHAT_ROLES = ("system", "user", "assistant")
# --------------------------------------------------------------------------

MESSAGES_TYPE = "array<struct<role:string,content:string>>"


def _role_of(source: Column) -> Column:
    return F.when(source.isin(*USER_SOURCES), "user").when(
        source.isin(*ASSISTANT_SOURCES), "assistant"
    )


def _message(role: Column, content: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"))


def map_roles(turns: Column) -> Column:
    """``array<struct<from,value>>`` → messages; turns from anyone else are dropped."""
    named = F.filter(turns, lambda t: _role_of(t["from"]).isNotNull())
    return F.transform(named, lambda t: _message(_role_of(t["from"]), t["value"]))


def map_roles_variant(turns: Column) -> Column:
    """The same for ``array<variant>``: a missing value is empty text, a null value stays null."""

    def source(t: Column) -> Column:
        return F.try_variant_get(t, "$.from", "string")

    named = F.filter(turns, lambda t: _role_of(source(t)).isNotNull())
    return F.transform(
        named, lambda t: _message(_role_of(source(t)), member_text(t, "value"))
    )


def prepend_system(messages: Column, prompt: str = SYSTEM_PROMPT) -> Column:
    return F.concat(F.array(_message(F.lit("system"), F.lit(prompt))), messages)


def chat_messages(record: Column, prompt: str = SYSTEM_PROMPT) -> Column:
    """Messages of a raw conversation VARIANT, or null when the row is to be left out.

    It is left out when ``conversations`` is missing, empty or no list, when a turn is no
    object, and when no turn is from a user or an assistant.
    """
    turns = F.try_variant_get(record, "$.conversations", "array<variant>")
    messages = F.when(
        F.forall(turns, lambda t: F.coalesce(kind(t) == "OBJECT", F.lit(False))),
        map_roles_variant(turns),
    )
    return F.when(F.size(messages) > 0, prepend_system(messages, prompt))


def _frame(role: Column, content: Column) -> Column:
    return F.concat(
        F.lit(TURN_START),
        role,
        F.lit("\n"),
        F.coalesce(content, F.lit("")),
        F.lit(TURN_END + "\n"),
    )


def render_chat(messages: Column, add_generation_prompt: bool = False) -> Column:
    """Framed text of the system, user and assistant messages; other roles are skipped."""
    shown = F.filter(messages, lambda m: m["role"].isin(*CHAT_ROLES))
    text = F.array_join(F.transform(shown, lambda m: _frame(m["role"], m["content"])), "")
    if add_generation_prompt:
        text = F.concat(text, F.lit(TURN_START + "assistant\n"))
    return text


def render_exchange(instruction: Column, extra: Column, answer: Column) -> Column:
    """One user turn (instruction, then the input when there is any) and one assistant turn."""
    question = F.coalesce(instruction, F.lit(""))
    question = F.when(extra != "", F.concat(question, F.lit("\n"), extra)).otherwise(question)
    return F.concat(_frame(F.lit("user"), question), _frame(F.lit("assistant"), answer))


def render_instruction(record: Column) -> Column:
    extra = F.try_variant_get(record, "$.input", "string")
    # Zero, false and empty containers count as no input, like empty text.
    unset = (kind(member(record, "input")) != "STRING") & extra.isin("0", "false", "[]", "{}")
    answer = F.when(member(record, "output").isNotNull(), member_text(record, "output"))
    return render_exchange(
        F.try_variant_get(record, "$.instruction", "string"),
        F.when(~unset, extra),
        answer.otherwise(member_text(record, "response")),
    )


def message_list(record: Column) -> Column:
    """Non-empty list under ``messages``, or under ``conversation`` when that is absent or null."""
    messages = member(record, "messages")
    absent = messages.isNull() | F.is_variant_null(messages)
    turns = F.when(
        absent, F.try_variant_get(record, "$.conversation", "array<variant>")
    ).otherwise(F.try_variant_get(record, "$.messages", "array<variant>"))
    return F.when(F.size(turns) > 0, turns)


def render_turns(turns: Column) -> Column:
    """Framed text of ``array<variant>`` turns with any role."""
    return F.array_join(
        F.transform(
            turns, lambda t: _frame(member_text(t, "role", "user"), member_text(t, "content"))
        ),
        "",
    )


def render_messages(record: Column) -> Column:
    return render_turns(message_list(record))


def render_fallback(record: Column, source: Column) -> Column:
    """One user turn holding a plain string, or the JSON text of any other value."""
    text = F.when(
        kind(record) == "STRING", F.try_variant_get(record, "$", "string")
    ).otherwise(spaced_json(source))
    return _frame(F.lit("user"), text)


def render_chat_list(record: Column) -> Column:
    """Text of a top-level list of messages, the form the chat preparation writes."""
    turns = F.try_variant_get(record, "$", "array<variant>")
    is_chat = F.forall(turns, lambda t: F.coalesce(member(t, "role").isNotNull(), F.lit(False)))
    messages = F.transform(
        turns, lambda t: _message(member_text(t, "role"), member_text(t, "content"))
    )
    return F.when(is_chat & (F.size(turns) > 0), render_chat(messages))


def render_any(record: Column, source: Column) -> Column:
    """Text of any supervised record: chat list, instruction, messages, or fallback."""
    return F.when(
        member(record, "instruction").isNotNull(), render_instruction(record)
    ).otherwise(
        F.coalesce(
            render_chat_list(record), render_messages(record), render_fallback(record, source)
        )
    )


def with_bos(text: Column, bos: str = TURN_START) -> Column:
    return F.concat(F.lit(bos), text)
