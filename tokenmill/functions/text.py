"""String expressions: whitespace, templates and chat markup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenmill import constants as C

# \s under (?U) is Unicode white space; the four separators are what Python's strip adds to it
_BLANK = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Unicode-aware strip of both ends (``trim`` only knows the space)."""
    return F.regexp_replace(text, rf"(?U)^{_BLANK}+|{_BLANK}+$", "")


def is_blank(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("")).rlike(r"(?U)[^\s\x1c-\x1f]")


def instruction_prompt(instruction: Column, input_text: Column) -> Column:
    """Single-turn prompt; the input block is there only for a non-blank input, unstripped."""
    given = F.when(is_blank(input_text), F.lit("")).otherwise(F.concat(F.lit(C.INPUT_HEADER), input_text))
    return F.concat(F.lit(C.INSTRUCTION_HEADER), instruction, given, F.lit(C.RESPONSE_HEADER))


def normalize_role(role: Column) -> Column:
    """Rendered role name, NULL for a role that is not part of the format."""
    known = F.create_map(*[F.lit(part) for pair in C.ROLES.items() for part in pair])
    return F.try_element_at(known, F.coalesce(role, F.lit("")))


def turn_header(role: Column) -> Column:
    return F.concat(F.lit(C.TURN_START), role, F.lit("\n"))


def turn_footer() -> Column:
    return F.lit(C.TURN_END + "\n")


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(turn_header(role), text, turn_footer())


def chat_prompt(instruction: Column, input_text: Column, system: Column | None = None) -> Column:
    """Prompt for inference: system turn, user turn, open assistant turn."""
    asked = F.when(is_blank(input_text), instruction).otherwise(
        strip(F.concat(instruction, F.lit("\n\n"), input_text))
    )
    system = F.lit(C.DEFAULT_SYSTEM) if system is None else system
    return F.concat(
        render_turn(F.lit("system"), system),
        render_turn(F.lit("user"), asked),
        turn_header(F.lit("assistant")),
    )


def trim_completion(text: Column, marker: str = C.TURN_END) -> Column:
    """Text before the first end-of-turn marker, stripped."""
    return strip(F.substring_index(text, marker, 1))


def cut_at_end_of_text(tokens: Column, end: int = C.END_OF_TEXT) -> Column:
    """Tokens before the first end-of-text token; all of them when there is none."""
    at = F.array_position(tokens, F.lit(end))
    return F.when(at > 0, F.slice(tokens, F.lit(1), (at - 1).cast("int"))).otherwise(tokens)


def after_last_space(text: Column) -> Column:
    return F.substring_index(text, " ", -1)


def before_last_space(text: Column) -> Column:
    """All before the last single space; the text must have one."""
    return F.substring(text, F.lit(1), F.length(text) - F.length(after_last_space(text)) - 1)
