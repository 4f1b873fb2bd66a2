"""Chat templates: literal pieces put around each message."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.tokens import count_tokens


def _literal_tokens(piece: str) -> int:
    return len(re.findall(r"[A-Za-z0-9]+|[^A-Za-z0-9\t\n\x0b\f\r ]", piece))


@dataclass(frozen=True)
class ChatTemplate:
    name: str
    bos: str
    before_role: str
    after_role: str
    after_content: str
    eos: str

    def __post_init__(self):
        pieces = (self.bos, self.before_role, self.after_role, self.after_content, self.eos)
        if not all(p.isascii() for p in pieces):
            raise ValueError("template pieces must be ASCII")
        if not self.after_role or not self.after_content:
            raise ValueError("a template must separate role, content and next message")

    @property
    def additive(self) -> bool:
        """True when no token can span two pieces, so counts of the pieces add up to the whole."""
        edges = (self.after_role[0], self.after_role[-1], self.after_content[0], self.after_content[-1])
        opens_clean = not self.bos or not self.bos[-1].isalnum()
        role_clean = not self.before_role or not self.before_role[-1].isalnum()
        return opens_clean and role_clean and not any(e.isalnum() for e in edges)

    @property
    def opening_tokens(self) -> int:
        return _literal_tokens(self.bos)

    @property
    def message_markup_tokens(self) -> int:
        return sum(_literal_tokens(p) for p in (self.before_role, self.after_role, self.after_content))

    def message_text(self, role: Column, content: Column) -> Column:
        return F.concat(
            F.lit(self.before_role),
            F.coalesce(role, F.lit("")),
            F.lit(self.after_role),
            F.coalesce(content, F.lit("")),
            F.lit(self.after_content),
        )

    @property
    def generation_prompt(self) -> str:
        return f"{self.before_role}assistant{self.after_role}"

    @property
    def prompt_tokens(self) -> int:
        return _literal_tokens(self.generation_prompt)

    def render(self, messages: Column) -> Column:
        """The whole conversation as one text, without a generation prompt."""
        parts = F.transform(messages, lambda m: self.message_text(m["role"], m["content"]))
        return F.concat(F.lit(self.bos), F.array_join(parts, ""))

    def render_context(self, messages: Column) -> Column:
        """All but the last message, then the opening of an assistant message."""
        return F.concat(self.render(context_messages(messages)), F.lit(self.generation_prompt))

    def render_scored(self, messages: Column) -> Column:
        """Context, then the bare content of the last message, then the end mark."""
        content = F.coalesce(response_message(messages)["content"], F.lit(""))
        return F.concat(self.render_context(messages), content, F.lit(self.eos))

    def message_total(self, role: Column, content_tokens: Column) -> Column:
        """Tokens one message adds to the rendered conversation."""
        return content_tokens + count_tokens(role) + F.lit(self.message_markup_tokens)

    def count_rendered(self, messages: Column) -> Column:
        """Token count of ``render(messages)``."""
        if not self.additive:
            return count_tokens(self.render(messages))
        return F.lit(self.opening_tokens) + F.aggregate(
            messages,
            F.lit(0),
            lambda acc, m: acc + self.message_total(m["role"], count_tokens(m["content"])),
        )


def context_messages(messages: Column) -> Column:
    return F.slice(messages, 1, F.greatest(F.size(messages) - 1, F.lit(0)))


def response_message(messages: Column) -> Column:
    return F.try_element_at(messages, F.lit(-1))


def total_tokens(messages: Column, template: ChatTemplate, special_tokens: int = 0) -> Column:
    """Length of the rendered conversation when the tokenizer adds its own marks once."""
    return template.count_rendered(messages) + F.lit(special_tokens)


# The markup of three published chat formats.
CHATML = ChatTemplate("chatml", "", "<|im_start|>", "\n", "<|im_end|>\n", "<|im_end|>")
HEADER = ChatTemplate(
    "header",
    "<|begin_of_text|>",
    "<|start_header_id|>",
    "<|end_header_id|>\n\n",
    "<|eot_id|>",
    "<|eot_id|>",
)
ROLE_TAG = ChatTemplate("role_tag", "", "", ": ", "\n", "")
TEMPLATES = {t.name: t for t in (CHATML, HEADER, ROLE_TAG)}
