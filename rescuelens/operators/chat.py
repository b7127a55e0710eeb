"""Chat transcripts, prompts and request bodies as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rescuelens import lexicons as lx
from rescuelens.functions import text

ROLES = ("system", "user", "assistant")


def first_by_role(turns: DataFrame, conv_col: str, turn_col: str, role_col: str,
                  text_col: str) -> DataFrame:
    """First non-empty content per role and conversation; a missing role gives ''.

    Empty messages are passed over. The smallest turn is found by partial aggregation,
    so long conversations are reduced before the shuffle.
    """
    def first(role: str) -> Column:
        content = F.when((F.col(role_col) == role) & (F.col(text_col) != ""), F.col(text_col))
        # rows without content have a null order, which min_by ignores
        order = F.when(content.isNotNull(), F.col(turn_col))
        return F.coalesce(F.min_by(F.col(text_col), order), F.lit("")).alias(f"{role}_text")

    return turns.groupBy(conv_col).agg(*map(first, ROLES))


def first_in_messages(messages: Column, role: str) -> Column:
    """Same for an array of role/content structs."""
    fitting = F.filter(messages, lambda m: (m["role"] == role) & (m["content"] != ""))
    return F.coalesce(F.try_element_at(fitting, F.lit(1))["content"], F.lit(""))


def merged_user(system: Column, user: Column) -> Column:
    """System and user text as one user turn, for models without a system role."""
    return text.strip(F.concat(text.strip(system), F.lit("\n\n"), text.strip(user)))


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat_messages(system: Column, user: Column, system_role: bool) -> Column:
    """Request messages. Without a system text there is only the user turn, unchanged."""
    has_system = F.coalesce(system != "", F.lit(False))
    if system_role:
        return F.when(has_system, F.array(message("system", system), message("user", user))
                      ).otherwise(F.array(message("user", user)))
    return F.array(message("user", F.when(has_system, merged_user(system, user)).otherwise(user)))


def training_messages(system: Column, user: Column, assistant: Column) -> Column:
    """One merged user turn and the stripped answer."""
    return F.array(message("user", merged_user(system, user)),
                   message("assistant", text.strip(assistant)))


def render(messages: Column, turn_template: str = "{role}: {content}\n") -> Column:
    """Messages as one text; the template says how a turn is written."""
    before, after = turn_template.split("{content}")
    turns = F.transform(messages, lambda m: F.concat(
        F.replace(F.lit(before), F.lit("{role}"), m["role"]), m["content"],
        F.replace(F.lit(after), F.lit("{role}"), m["role"])))
    return F.array_join(turns, "")


def plain_prompt(system: Column, user: Column) -> Column:
    """Prompt for models without any chat template."""
    return F.when(system != "", F.concat(
        system, F.lit("\n\nUser: "), user, F.lit("\nAssistant:"))).otherwise(user)


def plain_training_text(system: Column, user: Column, assistant: Column) -> Column:
    """The plain prompt with its answer; without a system text the turn marks stay."""
    asked = F.concat(F.lit("User: "), text.strip(user), F.lit("\nAssistant: "),
                     text.strip(assistant))
    lead = text.strip(system)
    return F.when(lead != "", F.concat(lead, F.lit("\n\n"), asked)).otherwise(asked)


def fill_prompt(template: Column | str, system_prompt: Column | str,
                slot: str = lx.PROMPT_SLOT) -> Column:
    """Put the system prompt into every slot of a template."""
    as_column = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.replace(as_column(template), F.lit(slot), as_column(system_prompt))


def record_json(record: Column) -> Column:
    """JSON text of a struct; null fields are written, other scripts are not escaped."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def correction_messages(system_prompt: str, record: Column) -> Column:
    """Body of a correction request: the record as JSON under the system prompt."""
    return F.array(message("system", F.lit(system_prompt)), message("user", record_json(record)))
