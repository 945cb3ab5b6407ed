"""Reasoning and final answer in a model's reply: parser names, and a fold over the markers of each family."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Other spellings of parser names, and names that switch parsing off.
PARSER_ALIASES = {"gptoss": "openai_gptoss", "gpt_oss": "openai_gptoss", "openai_gpt_oss": "openai_gptoss", "openai_gptoss": "openai_gptoss", "qwen_3": "qwen3", "gemma_4": "gemma4"}
NO_PARSER = ["", "none", "off", "false", "no", "disabled"]
# Parts of a model's name (letters and digits only) and the parser of its family.
FAMILIES = {"gptoss": "openai_gptoss", "gemma4": "gemma4", "qwen3": "qwen3"}
# The marks that each family sets in its texts, and the marks of which one must be there.
MARKS = {"qwen3": ["<think>", "</think>", "<tool_call>"], "gemma4": ["<|channel>", "<channel|>"], "openai_gptoss": ["<|channel|>analysis", "<|channel|>final", "<|channel|>commentary", "<|message|>", "<|start|>assistant", "<|end|>", "<|return|>"]}
NEEDED = {"qwen3": ["<think>", "</think>", "<tool_call>"], "gemma4": ["<|channel>", "<channel|>"], "openai_gptoss": ["<|channel|>analysis", "<|channel|>final"]}
#: what a mark makes of the text behind it: reasoning (r), answer (a), neither (n), as before (=), with the mark itself (+)
STEPS = {
    "qwen3": {"<think>": "r", "</think>": "a", "<tool_call>": "a+"},
    "gemma4": {"<|channel>": "r", "<channel|>": "a"},
    "openai_gptoss": {"<|channel|>analysis": "r", "<|channel|>final": "a", "<|channel|>commentary": "n", "<|message|>": "=", "<|start|>assistant": "n", "<|end|>": "n", "<|return|>": "n"},
}


def plain_name(x: Column) -> Column:
    """Lower case with single underscores."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def parser_name(x: Column) -> Column:
    """A parser's name with other spellings resolved."""
    plain = plain_name(x)
    known = F.create_map(*(F.lit(v) for pair in PARSER_ALIASES.items() for v in pair))
    return F.coalesce(F.try_element_at(known, plain), plain)


def inferred_parser(model: Column) -> Column:
    """The parser of a model's family by its name, or null."""
    compact = F.regexp_replace(F.lower(F.coalesce(model, F.lit(""))), "[^a-z0-9]", "")
    return F.coalesce(*(F.when(compact.contains(part), name) for part, name in FAMILIES.items()))


def chosen_parser(model: Column, configured: Column) -> Column:
    """auto: by the model's name; none, off and the like (also null): no parser; else the named one."""
    name = plain_name(configured)
    return F.when(configured.isNull() | name.isin(NO_PARSER), None).when(name == "auto", inferred_parser(model)).otherwise(parser_name(configured))


def parser_of(model: str, configured: str | None = "auto") -> str | None:
    """chosen_parser for one model and setting."""
    plain = lambda x: re.sub("[^a-z0-9]+", "_", x.lower()).strip("_")
    name = plain(configured) if configured is not None else ""
    if name in NO_PARSER:
        return None
    if name == "auto":
        compact = re.sub("[^a-z0-9]", "", model.lower())
        return next((parser for part, parser in FAMILIES.items() if part in compact), None)
    return PARSER_ALIASES.get(name, name)


def _pattern(parser: str) -> str:
    return "|".join(re.escape(m) for m in MARKS[parser])


def _first(parser: str, text: str) -> str:
    """What a text starts as: reasoning if qwen3's closing mark comes without an opening one before it."""
    close, open_ = text.find("</think>"), text.find("<think>")
    return "r" if parser == "qwen3" and close >= 0 and not 0 <= open_ < close else "a"


def split_reply(text: str, parser: str | None) -> tuple[str, str]:
    """(reasoning, final text) of one reply; without a known parser or a mark of it all is final."""
    body = text.strip()
    if parser not in MARKS or not any(m in body for m in NEEDED[parser]):
        return "", body
    mode, parts = _first(parser, body), {"r": [], "a": [], "n": []}
    at = 0
    for mark in [*re.finditer(_pattern(parser), body), None]:
        parts[mode].append(body[at : mark.start() if mark else len(body)])
        if mark:
            step = STEPS[parser][mark[0]]
            mode = mode if step == "=" else step[0]
            if step.endswith("+"):
                parts[mode].append(mark[0])
            at = mark.end()
    reasoning = "".join(parts["r"]).strip()
    if parser == "gemma4":
        reasoning = re.sub(r"^thought\s*\n?", "", reasoning).strip()
    return reasoning, "".join(parts["a"]).strip()


def split_column(text: Column, parser: str) -> Column:
    """split_reply as one expression: a struct (reasoning, final), by a fold over marks and the texts between."""
    body = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")
    pattern = _pattern(parser)
    tokens = F.split(body, f"(?={pattern})|(?<={pattern})")
    steps = F.create_map(*(F.lit(v) for pair in STEPS[parser].items() for v in pair))
    close, open_ = F.locate("</think>", body), F.locate("<think>", body)
    first = F.when((close > 0) & ((open_ == 0) | (open_ > close)), "r").otherwise("a") if parser == "qwen3" else F.lit("a")

    def step(state: Column, token: Column) -> Column:
        said = F.try_element_at(steps, token)
        mode = F.when(said.isNull() | (said == "="), state["mode"]).otherwise(F.substring(said, 1, 1))
        kept = F.when(said.isNull() | said.endswith("+"), token).otherwise("")
        return F.struct(mode.alias("mode"), F.concat(state["r"], F.when(mode == "r", kept).otherwise("")).alias("r"), F.concat(state["a"], F.when(mode == "a", kept).otherwise("")).alias("a"))

    folded = F.aggregate(tokens, F.struct(first.alias("mode"), F.lit("").alias("r"), F.lit("").alias("a")), step)
    strip = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    reasoning = strip(folded["r"])
    reasoning = strip(F.regexp_replace(reasoning, r"^thought\s*\n?", "")) if parser == "gemma4" else reasoning
    marked = F.lit(False)
    for m in NEEDED[parser]:
        marked = marked | body.contains(m)
    return F.when(marked, F.struct(reasoning.alias("reasoning"), strip(folded["a"]).alias("final"))).otherwise(F.struct(F.lit("").alias("reasoning"), body.alias("final")))


def split_text(text: Column, parser: Column, server: Column | None = None) -> Column:
    """A struct (reasoning, final): the server's own field counts where it has one, else the parser's marks."""
    body = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")
    found = F.coalesce(*(F.when(parser == name, split_column(text, name)) for name in MARKS), F.struct(F.lit("").alias("reasoning"), body.alias("final")))
    return found if server is None else F.when(server.isNotNull(), F.struct(server.alias("reasoning"), body.alias("final"))).otherwise(found)
