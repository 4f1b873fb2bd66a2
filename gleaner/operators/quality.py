"""Quality checks on conversations, nested or as flat turn rows.

Both forms reduce a conversation to the same few facts (``FACTS``) and judge those with one
predicate. The flat form gets them from a map-side-combined aggregate, so a conversation of any
length is judged without ever being gathered in one place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.config import QualityFilters
from gleaner.functions.scores import balance_ratio
from gleaner.functions.template import CHATML, ChatTemplate
from gleaner.functions.tokens import count_tokens

FACTS = (
    "n_messages",
    "starts_with_user",
    "roles_allowed",
    "total_tokens",
    "fewest_tokens",
    "most_tokens",
    "user_tokens",
    "assistant_tokens",
    "refused",
    "complete",
)


def turn_count(n_messages: Column) -> Column:
    """User/assistant pairs: three messages are one turn, one message is none."""
    return F.floor(n_messages / 2).cast("int")


def matches_refusal(text: Column, patterns: tuple[str, ...]) -> Column:
    """True where any pattern is found, case ignored for all of Unicode."""
    if not patterns:
        return F.lit(False)
    return text.rlike("(?iu)" + "|".join(f"(?:{p})" for p in patterns))


def _refusal(role: Column, content: Column, filters: QualityFilters) -> Column:
    if not filters.check_for_refusal:
        return F.lit(False)
    hit = matches_refusal(content, filters.refusal_patterns)
    return F.when(role == "assistant", F.coalesce(hit, F.lit(False))).otherwise(F.lit(False))


def verdict(fact: Callable[[str], Column], filters: QualityFilters) -> Column:
    """All checks, cheap ones first. A row lacking a role or a text fails instead of raising."""
    ratio = balance_ratio(fact("user_tokens"), fact("assistant_tokens"))
    passed = (
        turn_count(fact("n_messages")).between(filters.min_turns, filters.max_turns)
        & fact("complete")
        & fact("starts_with_user")
        & fact("roles_allowed")
        & fact("total_tokens").between(filters.min_total_tokens, filters.max_total_tokens)
        & (fact("fewest_tokens") >= filters.min_tokens_per_turn)
        & (fact("most_tokens") <= filters.max_tokens_per_turn)
        & ~fact("refused")
        & F.coalesce(ratio <= filters.balanced_conversation_ratio, F.lit(True))
    )
    return F.coalesce(passed, F.lit(False))


def nested_facts(
    messages: Column,
    filters: QualityFilters,
    template: ChatTemplate = CHATML,
    total_mode: str = "template",
    special_tokens: int = 0,
    counts: Column | None = None,
    total: Column | None = None,
    finish: Callable[[Column], Column] | None = None,
) -> Column:
    """The facts of a ``messages`` array as one struct, or ``finish`` of that struct.

    Tokens are counted once per message: the first transform binds them, the fold only reads them.
    ``counts`` (an array aligned with the messages) and ``total`` replace the built-in tokenizer.
    """
    _check_mode(total_mode)

    def fact_row(m: Column, i: Column) -> Column:
        n = count_tokens(m["content"]) if counts is None else F.coalesce(F.get(counts, i), F.lit(0))
        return F.struct(
            m["role"].alias("role"),
            (n + F.lit(special_tokens if total_mode == "sum" else 0)).cast("int").alias("n"),
            _refusal(m["role"], m["content"], filters).alias("refused"),
            (m["role"].isNotNull() & m["content"].isNotNull()).alias("complete"),
        )

    def added(m: Column) -> Column:
        return m["n"] if total_mode == "sum" else template.message_total(m["role"], m["n"])

    start_total = template.opening_tokens if total_mode == "template" else 0
    zero = F.struct(
        F.lit(0).alias("n_messages"),
        F.lit(False).alias("starts_with_user"),
        F.lit(True).alias("roles_allowed"),
        F.lit(start_total).alias("total_tokens"),
        F.lit(None).cast("int").alias("fewest_tokens"),
        F.lit(None).cast("int").alias("most_tokens"),
        F.lit(0).alias("user_tokens"),
        F.lit(0).alias("assistant_tokens"),
        F.lit(False).alias("refused"),
        F.lit(True).alias("complete"),
    )

    def fold(acc: Column, m: Column) -> Column:
        allowed = F.coalesce(m["role"].isin(*filters.must_have_roles), F.lit(False))
        is_user = F.coalesce(m["role"] == "user", F.lit(False))
        first = F.when(acc["n_messages"] == 0, is_user).otherwise(acc["starts_with_user"])
        user = F.when(is_user, m["n"]).otherwise(F.lit(0))
        assistant = F.when(m["role"] == "assistant", m["n"]).otherwise(F.lit(0))
        return F.struct(
            (acc["n_messages"] + 1).alias("n_messages"),
            first.alias("starts_with_user"),
            (acc["roles_allowed"] & allowed).alias("roles_allowed"),
            (acc["total_tokens"] + added(m)).alias("total_tokens"),
            F.least(acc["fewest_tokens"], m["n"]).alias("fewest_tokens"),
            F.greatest(acc["most_tokens"], m["n"]).alias("most_tokens"),
            (acc["user_tokens"] + user).alias("user_tokens"),
            (acc["assistant_tokens"] + assistant).alias("assistant_tokens"),
            (acc["refused"] | m["refused"]).alias("refused"),
            (acc["complete"] & m["complete"]).alias("complete"),
        )

    rendered = None
    if total is not None:
        rendered = total
    elif total_mode == "template" and not template.additive:
        rendered = count_tokens(template.render(messages))

    def close(acc: Column) -> Column:
        whole = acc if rendered is None else acc.withField("total_tokens", rendered.cast("int"))
        return whole if finish is None else finish(whole)

    return F.aggregate(F.transform(messages, fact_row), zero, fold, close)


def passes_quality(messages: Column, filters: QualityFilters, **options) -> Column:
    judged = nested_facts(
        messages, filters, finish=lambda s: verdict(lambda name: s[name], filters), **options
    )
    return F.coalesce(judged, F.lit(False))


def quality_filter(
    df: DataFrame, filters: QualityFilters, messages: str = "messages", **options
) -> DataFrame:
    """Keep the rows whose conversation passes every check."""
    return df.filter(passes_quality(F.col(messages), filters, **options))


def conversation_facts(
    turns: DataFrame,
    filters: QualityFilters,
    template: ChatTemplate = CHATML,
    total_mode: str = "template",
    special_tokens: int = 0,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    counts: Column | None = None,
    totals: Column | None = None,
    opening: int | None = None,
) -> DataFrame:
    """One row of facts per conversation of a flat turn table.

    ``counts`` replaces the built-in tokenizer for the text of a turn, ``totals`` for the turn as
    rendered by the template, ``opening`` for what the template puts before the first turn.
    """
    _check_mode(total_mode)
    if total_mode == "template" and totals is None and not template.additive:
        raise ValueError(f"counts of template {template.name} do not add up over flat turns")
    role, text = F.col(role_col), F.col(text_col)
    n = F.coalesce(counts, F.lit(0)) if counts is not None else count_tokens(text)
    per_turn = turns.select(
        F.col(id_col),
        F.col(turn_col).alias("_turn"),
        role.alias("_role"),
        (n + F.lit(special_tokens if total_mode == "sum" else 0)).alias("_n"),
        *([] if totals is None else [totals.alias("_total")]),
        (count_tokens(role) if total_mode == "template" else F.lit(0)).alias("_role_n"),
        _refusal(role, text, filters).alias("_refused"),
        (role.isNotNull() & text.isNotNull()).alias("_complete"),
    )
    markup = template.message_markup_tokens if total_mode == "template" else 0
    added = F.col("_n") + F.col("_role_n") + F.lit(markup) if totals is None else F.col("_total")
    if total_mode == "sum":
        opening = 0
    elif opening is None:
        opening = template.opening_tokens
    allowed = F.coalesce(F.col("_role").isin(*filters.must_have_roles), F.lit(False))

    def by_role(name: str) -> Column:
        return F.sum(F.when(F.col("_role") == name, F.col("_n")).otherwise(F.lit(0)))

    return per_turn.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.min_by(F.coalesce(F.col("_role") == "user", F.lit(False)), "_turn").alias("starts_with_user"),
        F.bool_and(allowed).alias("roles_allowed"),
        (F.sum(added) + F.lit(opening)).alias("total_tokens"),
        F.min("_n").alias("fewest_tokens"),
        F.max("_n").alias("most_tokens"),
        by_role("user").alias("user_tokens"),
        by_role("assistant").alias("assistant_tokens"),
        F.bool_or("_refused").alias("refused"),
        F.bool_and("_complete").alias("complete"),
    )


def rejection_reason(fact: Callable[[str], Column], filters: QualityFilters) -> Column:
    """The first check that a conversation fails, in the order of the filter; null if it passes all."""
    turns, total = turn_count(fact("n_messages")), fact("total_tokens")
    ratio = balance_ratio(fact("user_tokens"), fact("assistant_tokens"))
    checks = {
        "turns": turns.between(filters.min_turns, filters.max_turns),
        "incomplete": fact("complete"),
        "first_role": fact("starts_with_user"),
        "roles": fact("roles_allowed"),
        "total_tokens": total.between(filters.min_total_tokens, filters.max_total_tokens),
        "message_tokens": (fact("fewest_tokens") >= filters.min_tokens_per_turn)
        & (fact("most_tokens") <= filters.max_tokens_per_turn),
        "refusal": ~fact("refused"),
        "balance": ratio.isNull() | (ratio <= filters.balanced_conversation_ratio),
    }
    reason = F.lit(None).cast("string")
    for name, passed in reversed(checks.items()):
        reason = F.when(~F.coalesce(passed, F.lit(False)), F.lit(name)).otherwise(reason)
    return reason


def rejection_funnel(turns: DataFrame, filters: QualityFilters, **options) -> DataFrame:
    """``reason, n``: conversations by the first check they fail; those that pass have a null reason."""
    facts = conversation_facts(turns, filters, **options)
    return facts.groupBy(rejection_reason(F.col, filters).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def judge_conversations(turns: DataFrame, filters: QualityFilters, **options) -> DataFrame:
    """Facts of every conversation with a ``passes`` flag."""
    facts = conversation_facts(turns, filters, **options)
    return facts.withColumn("passes", verdict(F.col, filters))


def _check_mode(total_mode: str) -> None:
    if total_mode not in ("template", "sum"):
        raise ValueError("total_mode is 'template' or 'sum'")
