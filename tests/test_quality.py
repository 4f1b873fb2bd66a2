import pytest
from pyspark.sql import functions as F

from gleaner.config import QualityFilters
from gleaner.functions.scores import balance_ratio
from gleaner.functions.template import (
    CHATML,
    HEADER,
    ROLE_TAG,
    ChatTemplate,
    context_messages,
    response_message,
    total_tokens,
)
from gleaner.functions.tokens import count_tokens, message_tokens
from gleaner.operators.quality import judge_conversations, nested_facts, passes_quality, quality_filter
from gleaner.sources.normalize import assemble_turns

FILTERS = QualityFilters(
    min_turns=1,
    max_turns=2,
    min_tokens_per_turn=2,
    max_tokens_per_turn=6,
    min_total_tokens=4,
    max_total_tokens=12,
    must_have_roles=("user", "assistant"),
    balanced_conversation_ratio=0.3,
    check_for_refusal=True,
    refusal_patterns=("i'm sorry", "i cannot", "était"),
)
U, A = "user", "assistant"
CASES = {
    "base": ([(U, "a b c"), (A, "d e f g")], True),
    "three messages are one turn": ([(U, "a b c"), (A, "d e f g"), (U, "a b")], True),
    "one message": ([(U, "a b c d")], False),
    "six messages": ([(U, "a b"), (A, "c d")] * 3, False),
    "system first": ([("system", "a b c"), (A, "d e f g")], False),
    "assistant first": ([(A, "a b c"), (U, "d e f g")], False),
    "other role": ([(U, "a b c"), (A, "a b c"), ("tool", "a b"), (A, "a b")], False),
    "only user messages": ([(U, "a b c"), (U, "d e f")], True),
    "assistant too short": ([(U, "a b c"), (A, "d")], False),
    "upper bounds included": ([(U, "a b c d e f"), (A, "a b c d e f")], True),
    "total too large": ([(U, "a b c d"), (A, "a b c d"), (U, "a b c"), (A, "a b c")], False),
    "one-sided": ([(U, "a b"), (A, "c d e f g")], False),
    "refusal": ([(U, "a b c"), (A, "I CANNOT go on")], False),
    "refusal by the user": ([(U, "I cannot go"), (A, "a b c")], True),
    "curly apostrophe": ([(U, "a b c"), (A, "I’m sorry")], True),
    "accented upper case": ([(U, "a b c"), (A, "ÉTAIT a b")], False),
    "no content": ([(U, "a b c"), (A, None)], False),
    "no role": ([(U, "a b c"), (None, "a b c")], False),
    "empty": ([], False),
    "null": (None, False),
}


@pytest.fixture(scope="module")
def nested(spark):
    rows = [(i, messages) for i, (messages, _) in enumerate(CASES.values())]
    return spark.createDataFrame(
        rows, "conv_id long, messages array<struct<role string, content string>>"
    ).cache()


def expected():
    return {i for i, (_, passes) in enumerate(CASES.values()) if passes}


def test_nested_checks(nested):
    out = quality_filter(nested, FILTERS, total_mode="sum")
    assert {r["conv_id"] for r in out.collect()} == expected()
    again = quality_filter(out, FILTERS, total_mode="sum")
    assert {r["conv_id"] for r in again.collect()} == expected()


def flat(nested):
    return nested.select("conv_id", F.posexplode("messages").alias("turn", "m")).select(
        "conv_id", "turn", F.col("m.role").alias("role"), F.col("m.content").alias("text")
    )


def test_flat_checks_agree(nested):
    judged = judge_conversations(flat(nested).repartition(7), FILTERS, total_mode="sum")
    assert {r["conv_id"] for r in judged.filter("passes").collect()} == expected()


@pytest.mark.parametrize("template", [CHATML, HEADER, ROLE_TAG], ids=lambda t: t.name)
def test_template_totals_agree(nested, template):
    whole = nested.filter("size(messages) > 0")
    want = {
        r[0]: r[1]
        for r in whole.select("conv_id", count_tokens(template.render(F.col("messages")))).collect()
    }
    in_rows = whole.select("conv_id", template.count_rendered(F.col("messages"))).collect()
    assert {r[0]: r[1] for r in in_rows} == want
    facts = nested_facts(F.col("messages"), FILTERS, template=template)
    assert {r[0]: r[1] for r in whole.select("conv_id", facts["total_tokens"]).collect()} == want
    complete = whole.filter(~F.exists("messages", lambda m: m.role.isNull()))
    judged = judge_conversations(flat(complete), FILTERS, template=template).collect()
    assert {r["conv_id"]: r["total_tokens"] for r in judged} == {
        r["conv_id"]: want[r["conv_id"]] for r in judged
    }


def test_template_that_does_not_add_up(nested):
    odd = ChatTemplate("odd", "", "", "x", "y", "")
    assert not odd.additive and CHATML.additive and HEADER.additive and ROLE_TAG.additive
    whole = nested.filter("conv_id = 0")
    facts = nested_facts(F.col("messages"), FILTERS, template=odd)
    rendered = count_tokens(odd.render(F.col("messages")))
    row = whole.select(facts["total_tokens"], rendered, odd.count_rendered(F.col("messages"))).first()
    assert row[0] == row[1] == row[2]
    with pytest.raises(ValueError, match="add up"):
        judge_conversations(flat(nested), FILTERS, template=odd)


def test_special_tokens_and_own_counts(nested):
    base = nested.filter("conv_id = 0")
    messages = F.col("messages")
    summed = nested_facts(messages, FILTERS, total_mode="sum", special_tokens=1)
    row = base.select(summed.alias("s")).first()["s"]
    assert (row["total_tokens"], row["user_tokens"], row["fewest_tokens"]) == (9, 4, 4)
    given = nested_facts(messages, FILTERS, counts=F.array(F.lit(5), F.lit(6)), total=F.lit(99))
    row = base.select(given.alias("s")).first()["s"]
    assert (row["total_tokens"], row["user_tokens"], row["most_tokens"]) == (99, 5, 6)
    row = base.select(total_tokens(messages, HEADER, 2) - HEADER.count_rendered(messages)).first()
    assert row[0] == 2
    with pytest.raises(ValueError, match="total_mode"):
        nested_facts(messages, FILTERS, total_mode="none")


def test_rendering(spark):
    df = spark.createDataFrame(
        [([(U, "q"), (A, "r")],)], "messages array<struct<role string, content string>>"
    )
    m = F.col("messages")
    row = df.select(
        CHATML.render(m),
        CHATML.render_context(m),
        CHATML.render_scored(m),
        context_messages(m),
        response_message(m)["content"],
        message_tokens(m),
    ).first()
    assert row[0] == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\nr<|im_end|>\n"
    assert row[1] == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n"
    assert row[2] == row[1] + "r<|im_end|>"
    assert len(row[3]) == 1 and row[4] == "r" and row[5] == [1, 1]
    none = df.select(F.slice(m, 1, 0).alias("m")).select(
        response_message(F.col("m")), CHATML.render(context_messages(F.col("m")))
    )
    assert tuple(none.first()) == (None, "")


def test_balance(spark):
    df = spark.createDataFrame([(2, 5), (4, 4), (0, 3)], "u int, a int")
    got = [r[0] for r in df.select(balance_ratio(F.col("u"), F.col("a"))).collect()]
    assert got == [pytest.approx(3 / 7), 0.0, None]


def test_one_long_conversation_among_short_ones(spark):
    """A conversation with a third of all rows is judged from partial counts, not gathered."""
    hot = spark.range(3000).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn")
    )
    rest = spark.range(6000).select(
        F.floor(F.col("id") / 2).alias("conv_id"), (F.col("id") % 2).alias("turn")
    )
    turns = hot.unionByName(rest).select(
        "conv_id",
        "turn",
        F.when(F.col("turn") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.lit("a b c").alias("text"),
    )
    judged = judge_conversations(turns, FILTERS, total_mode="sum")
    assert judged.filter("passes").count() == 3000
    assert judged.filter("conv_id = -1").first()["n_messages"] == 3000
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "collect_list" not in plan


def test_same_result_nested_or_flat_on_real_turns(spark):
    from gleaner.config import load_config

    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    for name in ("llama_3_2_instruct", "llama_3_1_base"):
        filters = load_config(name).quality_filters
        judged = judge_conversations(turns, filters).filter("passes").select("conv_id")
        passed = assemble_turns(turns).filter(passes_quality(F.col("messages"), filters))
        assert {r[0] for r in judged.collect()} == {r["conv_id"] for r in passed.collect()}


def test_letters_without_spaces_are_tokens(spark):
    row = spark.createDataFrame([("日本語 ab1中 ไทย, ひ。",)], "t string").select(count_tokens(F.col("t")).alias("n"))
    assert row.first()["n"] == 3 + 2 + 3 + 1 + 1 + 1
