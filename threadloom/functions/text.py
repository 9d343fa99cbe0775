"""Text expressions: lengths, templates, chat markup, verdict parsing."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from threadloom import schemas

# Chat markup.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
ASSISTANT_HEADER = "<|im_start|>assistant\n"

# Characters Python's str.strip removes that occur in the texts.
WHITESPACE = " \t\n\r\x0b\x0c"


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.cast("string").alias("content"))


def chat_markup(messages: Column, add_generation_prompt: bool = False) -> Column:
    """Render an array of role/content structs as chat text."""
    turns = F.transform(
        messages,
        lambda m: F.concat(
            F.lit(TURN_START), m["role"], F.lit("\n"), m["content"], F.lit(TURN_END + "\n")
        ),
    )
    rendered = F.array_join(turns, "")
    if add_generation_prompt:
        rendered = F.concat(rendered, F.lit(ASSISTANT_HEADER))
    return rendered


def fill_template(template: str, **values: Column) -> Column:
    """Named-variable template: ``{name}`` is replaced, ``{{``/``}}`` unescape.

    The template is cut at plan time, so a value that itself contains braces
    is never expanded a second time.
    """
    parts: list[Column] = []
    for literal, name in re.findall(r"((?:\{\{|\}\}|[^{}])+)|\{(\w+)\}", template):
        if name:
            if name not in values:
                raise ValueError(f"template variable {name!r} has no value")
            parts.append(F.coalesce(values[name].cast("string"), F.lit("")))
        else:
            parts.append(F.lit(literal.replace("{{", "{").replace("}}", "}")))
    return F.concat(*parts)


def strip_text(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def split_part_or_empty(text: Column, marker: str, index: int) -> Column:
    """Part ``index`` (from 0) of ``text`` cut at a literal marker, '' if absent."""
    parts = F.split(text, re.escape(marker), -1)
    return F.coalesce(F.try_element_at(parts, F.lit(index + 1)), F.lit(""))


def split_prompt_target(text: Column) -> tuple[Column, Column]:
    """Prompt and target of a rendered chat, cut at the assistant header."""
    head = F.replace(split_part_or_empty(text, ASSISTANT_HEADER, 0), F.lit(ASSISTANT_HEADER), F.lit(""))
    tail = split_part_or_empty(text, ASSISTANT_HEADER, 1)
    return strip_text(head), strip_text(split_part_or_empty(tail, TURN_END, 0))


def remove_thinking(text: Column) -> Column:
    return strip_text(F.regexp_replace(text, r"(?s)<think>(.*?)</think>", ""))


def strip_prompt(output: Column, prompt: Column) -> Column:
    """Text after the prompt, by length as the caller's slice does."""
    return F.substring(output, F.length(prompt) + F.lit(1), F.length(output))


def numbered_documents(texts: Column) -> Column:
    """Number and concatenate an ordered array of texts."""
    blocks = F.transform(
        texts,
        lambda text, i: F.concat(
            F.lit("Документ "), (i + F.lit(1)).cast("string"), F.lit("\n\n\n"), text, F.lit("\n\n\n")
        ),
    )
    return F.array_join(blocks, "")


def parse_verdict(text: Column) -> Column:
    """Judge output to a verdict struct; NULL when it cannot be parsed.

    A fenced json block wins over the bare text. All four keys are required.
    """
    fenced = F.regexp_extract(text, r"(?s)```json\s*(.*?)```", 1)
    body = F.when(F.length(fenced) > 0, fenced).otherwise(text)
    verdict = F.from_json(strip_text(body), schemas.VERDICT)
    complete = F.lit(True)
    for name in schemas.VERDICT.fieldNames():
        complete = complete & verdict[name].isNotNull()
    return F.when(complete, verdict)


def words(text: Column) -> Column:
    """Tokens between single spaces, empty ones dropped."""
    return F.filter(F.split(text, " ", -1), lambda t: t != "")


def file_safe(name: Column) -> Column:
    return F.replace(name, F.lit("/"), F.lit("_"))


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)
